"""Leads and their status log in the same hash buckets, folded bucket by bucket.

    added/batch=.../bucket=...      leads not folded yet
    log/batch=.../bucket=...        changes not folded yet
    data/version=.../bucket=...     folded leads, as they were saved
    marks/version=.../bucket=...    the latest folded change of each field, one row per changed lead
    state/version=...               for each folded bucket: which version of it counts, and up to which batch

A fold rewrites the buckets that something came to since their last fold, and no others; their new files
count from the moment the new state is written, as one small file. A reader works from one state, and what that
state names stays until the fold after the next, so nobody sees half of a switch.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from postsift import schemas
from postsift.functions import text as tx
from postsift.session import remove
from postsift.sinks.lead_store import create_table
from postsift.sources.leads import read_table

BUCKETS = 64
FIELDS = ("status", "sent", "sent_date")

_MARK = T.StructType([T.StructField("at", T.TimestampType()), T.StructField("value", T.StringType())])
_LONG, _INT = T.LongType(), T.IntegerType()


def _with(schema: T.StructType, *more) -> T.StructType:
    return T.StructType([*schema.fields, *[T.StructField(name, kind) for name, kind in more]])


_MARKED = T.StructType([T.StructField("seq", _LONG), *[T.StructField(f"mark_{f}", _MARK) for f in FIELDS]])
_ADDED = _with(schemas.LEADS, ("batch", _LONG), ("bucket", _INT))
_LOG = _with(schemas.STATUS_LOG, ("batch", _LONG), ("bucket", _INT))
_DATA = _with(schemas.LEADS, ("version", _LONG), ("bucket", _INT))
_MARKS = _with(_MARKED, ("version", _LONG), ("bucket", _INT))
_STATE = "bucket int, data long, upto long, version long"


class BucketStore:
    def __init__(self, spark: SparkSession, path: str, buckets=BUCKETS):
        """``buckets`` must be the same whenever the store is opened."""
        self.spark, self.buckets = spark, buckets
        self.added, self.log, self.data, self.marks, self.state = (
            f"{path}/{name}" for name in ("added", "log", "data", "marks", "state"))
        create_table(spark, self.added, _ADDED, "batch", "bucket")
        create_table(spark, self.log, _LOG, "batch", "bucket")
        create_table(spark, self.data, _DATA, "version", "bucket")
        create_table(spark, self.marks, _MARKS, "version", "bucket")
        create_table(spark, self.state, _STATE, "version")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("seq"), F.lit(self.buckets)).cast("int")

    def _put(self, rows: DataFrame, path: str, number: int) -> None:
        rows.withColumn("bucket", self._bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{path}/batch={number}")

    def append(self, leads: DataFrame, number: int) -> None:
        """Add leads as batch ``number``. Numbers grow over leads and changes alike; the same one replaces itself."""
        self._put(leads.select(schemas.LEADS.names), self.added, number)

    def record(self, changes: DataFrame, number: int) -> None:
        self._put(changes.select(schemas.STATUS_LOG.names), self.log, number)

    def places(self) -> tuple[int, DataFrame]:
        """The number of the state that counts, and its rows: (bucket, data, upto)."""
        rows = read_table(self.spark, self.state, _STATE)
        version = rows.agg(F.max("version")).first()[0] or 0
        return version, rows.where(F.col("version") == version).select("bucket", "data", "upto")

    def _open(self, path: str, schema, places: list) -> DataFrame:
        """Rows of batches that are not folded into their bucket yet; only partition names decide."""
        rows, newer = read_table(self.spark, path, schema), F.lit(True)
        for upto, buckets in _grouped((p.upto, p.bucket) for p in places):
            newer = newer & ~(F.col("bucket").isin(buckets) & (F.col("batch") <= upto))
        return rows.where(newer)

    def _folded(self, path: str, schema, places: list) -> DataFrame:
        wanted = F.lit(False)
        for data, held in _grouped((p.data, p.bucket) for p in places):
            wanted = wanted | (F.col("bucket").isin(held) & (F.col("version") == data))
        return read_table(self.spark, path, schema).where(wanted).drop("version")

    def _parts(self, places: list) -> tuple[DataFrame, DataFrame]:
        """All leads as saved, and for every changed seq the latest change of each field (also where its lead is yet to come)."""
        leads = self._folded(self.data, _DATA, places).unionByName(self._open(self.added, _ADDED, places).drop("batch"))
        log = self._open(self.log, _LOG, places).select("seq", "bucket", *[
            F.when(F.col("field") == f, F.struct("at", "value")).cast(_MARK).alias(f"mark_{f}") for f in FIELDS])
        marks = self._folded(self.marks, _MARKS, places).unionByName(log).groupBy("seq", "bucket").agg(
            *[F.max(f"mark_{f}").alias(f"mark_{f}") for f in FIELDS])
        return leads, marks

    def read(self) -> DataFrame:
        """Leads in their current state; of changes to a field the one with the latest time counts, then the greater value."""
        leads, marks = self._parts(self.places()[1].collect())  # three numbers for each bucket
        sent = F.col("mark_sent.value")
        return leads.join(marks.drop("bucket"), "seq", "left").withColumns({
            "status": F.coalesce("mark_status.value", "status"),
            "sent": F.coalesce(tx.is_sent(sent) | F.when(sent.isNull(), F.col("sent")), F.lit(False)),
            "sent_date": F.coalesce("mark_sent_date.value", "sent_date"),
        }).select(schemas.LEADS.names)

    def fold(self) -> list[int]:
        """Fold what came in since the last fold; returns the buckets that were rewritten."""
        version, state = self.places()
        places = state.collect()
        came = self._open(self.added, _ADDED, places).select("bucket", "batch").unionByName(
            self._open(self.log, _LOG, places).select("bucket", "batch"))
        last = {r.bucket: r.upto for r in came.groupBy("bucket").agg(F.max("batch").alias("upto")).collect()}
        if not last:
            return []
        touched, number = sorted(last), version + 1
        upto = max(last.values())
        for rows, path in zip(self._parts(places), (self.data, self.marks)):
            rows.where(F.col("bucket").isin(touched)).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(
                f"{path}/version={number}")
        kept = [(p.bucket, p.data, p.upto) for p in places if p.bucket not in last]
        rows = self.spark.createDataFrame(kept + [(b, number, upto) for b in touched], "bucket int, data long, upto long")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.state}/version={number}")
        self._clear(number)
        return touched

    def _clear(self, number: int) -> None:
        """Remove bucket files that neither this state nor the one before it names."""
        rows = read_table(self.spark, self.state, _STATE)
        live = rows.where(F.col("version") >= number - 1).select("bucket", F.col("data").alias("version")).distinct()
        for path, schema in ((self.data, _DATA), (self.marks, _MARKS)):
            there = read_table(self.spark, path, schema).select("bucket", "version").distinct()
            for bucket, version in there.join(live, ["bucket", "version"], "left_anti").collect():
                remove(self.spark, f"{path}/version={version}/bucket={bucket}")


def _grouped(pairs) -> list:
    """(value, buckets) for each value."""
    held: dict[int, list[int]] = {}
    for value, bucket in pairs:
        held.setdefault(value, []).append(bucket)
    return sorted(held.items())
