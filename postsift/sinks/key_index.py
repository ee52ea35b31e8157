"""Post ids stored so far, looked up without reading them all.

    recent/run_id=...            the ids of runs not folded yet, one small folder per run
    base/gen=.../bucket=...      folded ids by hash bucket, sorted
    filter/gen=.../bucket=...    a Bloom filter of each bucket, as rows (word, bits)
    state/version=...            which generations count, which runs they hold

A lookup reads the recent ids, the filters of the buckets its ids fall into, and of these
buckets only those whose filter lets an id through. Filters are plain tables: an id sets four bits of one
64-bit word, so one join row per id tests it, and the filter of new ids is an aggregate over them.
Writes add files only; ``fold`` and ``merge`` switch to them by writing a new version of the state,
and remove what is out of use after that. One writer at a time; readers see the state before or after.
"""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postsift.session import remove, staged
from postsift.sinks.lead_store import RUN, create_table, run_folder, write_run
from postsift.sources.leads import read_table

BUCKETS = 1024
# 64-bit words in a bucket's filter: at four ids a word about one unknown id in 40 passes.
WORDS = 1 << 16

_RECENT = f"post_id string, {RUN} string"
_BASE = f"post_id string, {RUN} string, gen long, bucket int"
_FILTER = "word int, bits long, gen long, bucket int"
_STATE = f"kind string, gen long, {RUN} string, n long, version long"


def _bits(post_id: str) -> Column:
    """The four bits of an id in its word."""
    parts = [f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({post_id}, 1), {6 * i}) & 63 AS INT))" for i in range(4)]
    return F.expr(" | ".join(parts))


class KeyIndex:
    """The ids saved by each run. ``buckets`` and ``words`` are fixed when the index is made."""

    def __init__(self, spark: SparkSession, path: str, buckets=BUCKETS, words=WORDS):
        self.spark = spark
        self.recent_path, self.base_path = f"{path}/recent", f"{path}/base"
        self.filter_path, self.state_path = f"{path}/filter", f"{path}/state"
        create_table(spark, self.recent_path, _RECENT, RUN)
        create_table(spark, self.base_path, _BASE, "gen", "bucket")
        create_table(spark, self.filter_path, _FILTER, "gen", "bucket")
        create_table(spark, self.state_path, _STATE, "version")
        if self._state()[0] == 0:
            self._switch(1, spark.createDataFrame([("layout", buckets, None, words)], "kind string, gen long, run_id string, n long"))
        self.buckets, self.words = self._state()[1].where("kind = 'layout'").select("gen", "n").first()

    # ---- state ---------------------------------------------------------------------------------

    def _state(self) -> tuple[int, DataFrame]:
        rows = read_table(self.spark, self.state_path, _STATE)
        version = rows.agg(F.max("version")).first()[0] or 0
        return version, rows.where(F.col("version") == version).drop("version")

    def _switch(self, version: int, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.state_path}/version={version}")

    def _generations(self, state: DataFrame) -> list[int]:
        return [r.gen for r in state.where("kind = 'gen'").select("gen").collect()]

    def _placed(self, ids: DataFrame) -> DataFrame:
        """Ids with the bucket, word and bits that stand for them."""
        return ids.select(
            "*", F.expr(f"cast(pmod(xxhash64(post_id), {self.buckets}L) AS INT) AS bucket"),
            F.expr(f"cast(pmod(shiftright(xxhash64(post_id), 20), {self.words}L) AS INT) AS word"), _bits("post_id").alias("bits"))

    def _recent(self) -> DataFrame:
        return read_table(self.spark, self.recent_path, _RECENT)

    def _alive(self, rows: DataFrame, state: DataFrame) -> DataFrame:
        """Folded rows that still count: not those of a run that was folded again later."""
        again = state.where("kind = 'again'").select(RUN, F.col("gen").alias("_since"))
        if again.isEmpty():
            return rows
        latest = again.groupBy(RUN).agg(F.max("_since").alias("_since"))
        return rows.join(latest, RUN, "left").where(F.col("_since").isNull() | (F.col("gen") >= F.col("_since"))).drop("_since")

    # ---- writing -------------------------------------------------------------------------------

    def add(self, ids: DataFrame, run_id: str) -> None:
        """Note the ids saved by a run; the same run again replaces them.

        A row without an id stands for the run itself, so a repeated run that saves nothing any
        more still replaces what it saved before.
        """
        mark = self.spark.createDataFrame([(None,)], "post_id string")
        write_run(ids.select("post_id").where(F.col("post_id").isNotNull()).unionByName(mark), self.recent_path, run_id)

    def fold(self) -> int:
        """Move the recent ids into buckets with filters; returns how many runs were folded.

        Only the buckets that these ids fall into get a file; what is stored already is not touched.
        """
        version, state = self._state()
        runs = sorted(r[0] for r in self._recent().select(RUN).distinct().collect())
        if not runs:
            return 0
        gen = max([0, *self._generations(state)]) + 1
        self._write(self._recent().where(F.col(RUN).isin(runs) & F.col("post_id").isNotNull()).distinct(), gen)
        folded = self.spark.createDataFrame([(r,) for r in runs], f"{RUN} string")
        known = state.where("kind = 'run'").select(RUN)
        row = lambda kind, gen, run, n=0: (F.lit(kind).alias("kind"), F.lit(gen).cast("long").alias("gen"), run.alias(RUN), F.lit(n).cast("long").alias("n"))
        again = folded.join(known, RUN, "left_semi")
        new = folded.join(known, RUN, "left_anti")
        self._switch(version + 1, state.unionByName(folded.limit(1).select(*row("gen", gen, F.lit(None).cast("string")))).unionByName(
            new.select(*row("run", gen, F.col(RUN)))).unionByName(again.select(*row("again", gen, F.col(RUN)))))
        for run in runs:
            remove(self.spark, run_folder(self.recent_path, run))
        return len(runs)

    def merge(self) -> None:
        """Rewrite all generations as one, without the rows that no longer count."""
        version, state = self._state()
        old = self._generations(state)
        if not old:
            return
        gen = max(old) + 1
        rows = read_table(self.spark, self.base_path, _BASE).where(F.col("gen").isin(old))
        self._write(self._alive(rows, state).select("post_id", RUN).distinct(), gen)
        kept = state.where("kind IN ('layout', 'run')")
        one = state.where("kind = 'gen'").agg(F.lit("gen").alias("kind"), F.lit(gen).cast("long").alias("gen"),
                                              F.lit(None).cast("string").alias(RUN), F.lit(0).cast("long").alias("n"))
        self._switch(version + 1, kept.unionByName(one))
        for g in old:
            remove(self.spark, f"{self.base_path}/gen={g}")
            remove(self.spark, f"{self.filter_path}/gen={g}")

    def _write(self, rows: DataFrame, gen: int) -> None:
        placed = self._placed(rows).drop("word", "bits")
        placed.repartition("bucket").sortWithinPartitions("bucket", "post_id").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.base_path}/gen={gen}")
        stored = self._placed(read_table(self.spark, f"{self.base_path}/gen={gen}", "post_id string, bucket int").select("post_id"))
        filters = stored.groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
        filters.repartition("bucket").sortWithinPartitions("bucket", "word").write.mode("overwrite").partitionBy("bucket").parquet(
            f"{self.filter_path}/gen={gen}")

    # ---- reading -------------------------------------------------------------------------------

    def asked(self, ids: DataFrame) -> DataFrame:
        """The distinct ids of a batch with their buckets, written once."""
        return staged(self._placed(ids.select("post_id").where(F.col("post_id").isNotNull()).distinct()), "asked")

    def maybe(self, asked: DataFrame, state: DataFrame | None = None) -> DataFrame:
        """(post_id, gen, bucket) that the filters let through; only the filters of hit buckets are read."""
        state = self._state()[1] if state is None else state
        hit = [r.bucket for r in asked.select("bucket").distinct().collect()]
        filters = read_table(self.spark, self.filter_path, _FILTER).where(
            F.col("gen").isin(self._generations(state)) & F.col("bucket").isin(hit))
        f = filters.withColumnRenamed("bits", "_bits")
        return asked.join(f, ["bucket", "word"]).where((F.col("_bits").bitwiseAND(F.col("bits"))) == F.col("bits")).select("post_id", "gen", "bucket")

    def opened(self, maybe: DataFrame) -> DataFrame:
        """The stored rows of the buckets that some id may stand in."""
        places = [(r.gen, r.bucket) for r in maybe.select("gen", "bucket").distinct().collect()]
        by_gen: dict[int, list[int]] = {}
        for gen, bucket in places:
            by_gen.setdefault(gen, []).append(bucket)
        wanted = F.lit(False)
        for gen, buckets in by_gen.items():
            wanted = wanted | ((F.col("gen") == gen) & F.col("bucket").isin(buckets))
        return read_table(self.spark, self.base_path, _BASE).where(wanted)

    def known(self, ids: DataFrame, but_run: str | None = None) -> DataFrame:
        """The distinct post ids of ``ids`` that runs other than ``but_run`` saved.

        A null id is never known. What is read follows the batch: its ids, the recent ids, the filters
        of at most as many buckets as it has ids, and the buckets they let through.
        """
        _, state = self._state()
        asked = self.asked(ids)
        recent = self._recent()
        fresh = recent.select(RUN).distinct()
        if but_run is not None:
            recent = recent.where(F.col(RUN) != but_run)
        maybe = staged(self.maybe(asked, state), "maybe")
        base = self._alive(self.opened(maybe), state).join(fresh, RUN, "left_anti")
        if but_run is not None:
            base = base.where(F.col(RUN) != but_run)
        found = base.join(maybe.select("post_id", "gen", "bucket"), ["post_id", "gen", "bucket"], "left_semi").select("post_id")
        return found.unionByName(recent.join(asked, "post_id", "left_semi").select("post_id")).distinct()
