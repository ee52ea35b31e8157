"""The lead table: append with de-duplication, the status log, compaction, CSV and action export."""

from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F

from postsift import schemas
from postsift.operators import outcomes as oc, work_queue
from postsift.operators.projections import action_export, export_rows
from postsift.sources.leads import CSV_DIALECT, read_table

RUN = "run_id"

_STORED = schemas.with_columns(schemas.LEADS, (RUN, schemas.TEXT))


def create_table(spark: SparkSession, path: str, schema, *partitions: str) -> None:
    """Make an empty table at ``path`` unless something is there already."""
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(*partitions).parquet(path)


def write_run(df: DataFrame, path: str, run_id: str, **above: str) -> None:
    """Write ``df`` as the partition of ``run_id`` (below the partitions ``above``).

    The partition's folder itself is overwritten, so writing the same run again replaces it, also
    when fewer rows or none are left. The rebalance lets the runtime choose file sizes, so a small
    run leaves few files.
    """
    df.hint("rebalance").write.mode("overwrite").parquet(run_folder(path, run_id, **above))


def run_folder(path: str, run_id: str, **above: str) -> str:
    return "/".join([path, *[f"{name}={quote(value, safe='')}" for name, value in {**above, RUN: run_id}.items()]])


def counted(outcome: DataFrame) -> tuple[DataFrame, Observation]:
    """The saved rows of ``outcome``, and the outcome counts taken while they are written."""
    seen = Observation()
    return oc.saved(outcome.observe(seen, *oc.count_columns())), seen


def count_row(spark: SparkSession, seen: Observation) -> DataFrame:
    return spark.createDataFrame([Row(**{name: seen.get[name] for name in oc.OUTCOMES})],
                                 ", ".join(f"{name} long" for name in oc.OUTCOMES))


class LeadStore:
    """Leads under ``path/leads``, changes to them under ``path/status_log``.

    With an ``index`` (a KeyIndex) duplicates are looked up there, so a run reads what its own ids
    lead to; without one the id column of the whole store is scanned.
    """

    def __init__(self, spark: SparkSession, path: str, index=None):
        self.spark, self.index = spark, index
        self.leads_path = f"{path}/leads"
        self.log_path = f"{path}/status_log"
        create_table(spark, self.leads_path, _STORED, RUN)
        create_table(spark, self.log_path, schemas.STATUS_LOG)

    def stored(self) -> DataFrame:
        return read_table(self.spark, self.leads_path, _STORED)

    def log(self) -> DataFrame:
        return read_table(self.spark, self.log_path, schemas.STATUS_LOG)

    def read(self) -> DataFrame:
        """Stored leads in their current state."""
        return work_queue.resolve(self.stored().drop(RUN), self.log())

    def known(self, leads: DataFrame, but_run=None) -> DataFrame:
        """Post ids stored by other runs than ``but_run``.

        The store's id column is semi-joined with the run's ids: the runtime broadcasts these while
        they are few, and so scans the store without shuffling it.
        """
        rows = self.stored()
        if but_run is not None:
            rows = rows.where(F.col(RUN) != but_run)
        return rows.select("post_id").join(leads.select("post_id"), "post_id", "left_semi")

    def append(self, leads: DataFrame, run_id: str, min_score=None) -> DataFrame:
        """Save the new leads of a run and return one row of saved, skipped and filtered counts.

        ``leads`` is read more than once: hand in a written table. Outcomes are counted while the
        saved rows are written. Ids saved by an earlier attempt of the same run do not count as
        stored, so a repeated run writes the same partition again.
        """
        kept, seen = counted(oc.store_outcomes(leads, self.known(leads, run_id), min_score))
        write_run(kept.select(schemas.LEADS.names), self.leads_path, run_id)
        if self.index is not None:
            self.reindex(run_id)
        return count_row(self.spark, seen)

    def reindex(self, run_id: str) -> None:
        """Note the ids of a stored run in the index; also mends a run that stopped in between."""
        self.index.add(self.stored().where(F.col(RUN) == run_id), run_id)

    def record(self, changes: DataFrame) -> None:
        """Append changes to the status log."""
        changes.select(schemas.STATUS_LOG.names).write.mode("append").parquet(self.log_path)

    def set_status(self, post_id: str, status: str, at) -> bool:
        """Set the status of every lead with this post id; False if there is none."""
        if status not in work_queue.STATUSES:
            raise ValueError(f"unknown status {status!r}")
        leads = self.stored().where(F.col("post_id") == post_id)
        changes = leads.select("seq", "post_id", F.lit("status").alias("field"),
                               F.lit(status).alias("value"), F.lit(at).cast("timestamp").alias("at"))
        if leads.isEmpty():
            return False
        self.record(changes)
        return True

    def mark_sent(self, needle: str, at) -> int | None:
        """Mark the first lead whose URL holds ``needle`` as sent; pending leads left, None if not found."""
        changes = work_queue.sent_changes_by_text(self.stored(), needle, at)
        if changes.isEmpty():
            return None
        self.record(changes)
        return work_queue.remaining(self.read()).first()["remaining"]

    def compact(self, new_path: str) -> "LeadStore":
        """Write the current state to a new place and return the store there.

        Nothing is written over what is being read; the caller switches to the new store.
        """
        fresh = LeadStore(self.spark, new_path)
        write_run(self.read(), fresh.leads_path, "compacted")
        return fresh


def write_lead_csv(leads: DataFrame, path: str) -> None:
    export_rows(leads).write.mode("errorifexists").options(**CSV_DIALECT, emptyValue="").csv(path)


def export_for_action(leads: DataFrame, folder: str, as_of) -> str:
    """Write new leads for the day's work as CSV and return the path, named after the day."""
    day = str(as_of)[:10].replace("-", "")
    path = f"{folder}/leads_action_{day}"
    action_export(leads).write.mode("overwrite").options(**CSV_DIALECT, emptyValue="").csv(path)
    return path
