"""What earlier runs came to, kept as small tables: counts of the stored leads, and numbers given out."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from postsift.operators.counts import action_stats, lead_counts
from postsift.operators.numbering import with_position
from postsift.operators.work_queue import resolve
from postsift.session import staged
from postsift.sinks.lead_store import RUN, create_table, write_run
from postsift.sources.leads import read_table

_COUNTS = "dimension string, key string, n long"
_NUMBERS = "first long, n long"


def measures(leads: DataFrame) -> DataFrame:
    """(dimension, key, n): total, per status, language and community, and the action figures."""
    stats = action_stats(leads)
    action = stats.unpivot([], stats.columns, "key", "n").select(F.lit("action").alias("dimension"), "key", "n")
    return lead_counts(leads).unionByName(action)


class CountLedger:
    """Counts of a lead store, as differences: one small part per run and per batch of changes.

    ``read`` sums the parts and never looks at a lead. A part written again replaces itself.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        create_table(spark, path, f"{_COUNTS}, {RUN} string", RUN)

    def _parts(self) -> DataFrame:
        return read_table(self.spark, self.path, f"{_COUNTS}, {RUN} string")

    def add_run(self, saved: DataFrame, run_id: str) -> None:
        """Count the leads that a run saved, in the state they were saved in."""
        write_run(measures(saved), self.path, f"run:{run_id}")

    def add_changes(self, leads: DataFrame, log: DataFrame, changes: DataFrame, name: str) -> None:
        """Take out what the changed leads counted before ``changes``, and put in what they count after.

        ``leads`` as they were saved, ``log`` without the changes; of both only the changed leads
        are used. Call it before the changes are logged; if it is repeated after that, the part
        says the same only while ``log`` is still the one from before.
        """
        seqs = changes.select("seq").distinct()
        touched = staged(leads.join(seqs, "seq", "left_semi"), "touched")
        before = log.join(seqs, "seq", "left_semi")
        gone = measures(resolve(touched, before)).withColumn("n", -F.col("n"))
        come = measures(resolve(touched, before.unionByName(changes.select(log.columns))))
        moved = gone.unionByName(come).groupBy("dimension", "key").agg(F.sum("n").alias("n")).where("n <> 0")
        write_run(moved, self.path, f"changes:{name}")

    def read(self) -> DataFrame:
        """(dimension, key, n) as a full count would give them: keys that no lead has any more are gone."""
        rows = self._parts().groupBy("dimension", "key").agg(F.sum("n").alias("n"))
        return rows.where((F.col("n") > 0) | F.col("dimension").isin("total", "action"))


class PositionLedger:
    """Positions that go on from run to run: each run's numbers start behind those given out before it."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        create_table(spark, path, f"{_NUMBERS}, {RUN} string", RUN)

    def _given(self) -> DataFrame:
        return read_table(self.spark, self.path, f"{_NUMBERS}, {RUN} string")

    def number(self, rows: DataFrame, run_id: str, name="position", seq="seq", size=None) -> DataFrame:
        """``rows`` of a run numbered on by ``seq``; with ``size`` also batch_no and batch_pos, from 0.

        The stored part of a run is its first number and how many it took, so nothing that was
        numbered is read or numbered again, and a batch that one run left short is filled by the next. A
        repeated run keeps its place. If it has more rows than before and others have followed, the
        numbers behind its place are taken, and it raises instead of giving them out twice.
        """
        n = rows.count()
        own, others = None, []
        for r in self._given().collect():  # two numbers for each run
            if r[RUN] == run_id:
                own = r
            else:
                others.append(r.first + r.n)
        if own is None:
            first = max([1, *others])
        else:
            first = own.first
            if n > own.n and any(end > first for end in others):
                raise ValueError(f"run {run_id!r} grew from {own.n} to {n} rows after later runs were numbered")
        write_run(self.spark.createDataFrame([(first, n)], _NUMBERS), self.path, run_id)
        placed = with_position(rows, name, seq).withColumn(name, F.col(name) + F.lit(first - 1))
        if size is None:
            return placed
        at = F.col(name) - 1
        return placed.select("*", F.floor(at / size).cast("bigint").alias("batch_no"), (at % size).cast("int").alias("batch_pos"))
