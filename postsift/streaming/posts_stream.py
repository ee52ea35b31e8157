"""The triage as a stream: posts arrive as files, leads leave to the same sinks as in a batch run."""

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from postsift import schemas
from postsift.functions import text as tx
from postsift.operators.triage import VERDICTS, funnel_counts
from postsift.operators.work_queue import latest_values
from postsift.session import shared_dir, staged
from postsift.sources.leads import read_table

EVERY_MINUTES = 60  # fixed value: default pause between scheduled runs
SALTS = 32


def post_stream(spark: SparkSession, path: str, schema=schemas.POSTS, max_files=None, **options) -> DataFrame:
    reader = spark.readStream.schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def trigger(once=True, minutes=EVERY_MINUTES) -> dict:
    """Take what is there and stop, or go on every ``minutes``."""
    return {"availableNow": True} if once else {"processingTime": f"{minutes} minutes"}


def dedup(posts: DataFrame, window="7 days") -> DataFrame:
    """One post per id within the watermark.

    A first pass keeps one post per id and salt, so a flood of copies of one id is thinned out by
    many tasks before a single task sees what is left of it. State is dropped once the watermark
    passes, and rows later than that are lost here: use ``start_sinks`` where ids must be
    remembered for good, or where a score gate decides what is saved.
    """
    timed = posts.withColumn("created_at", tx.created_at()).withWatermark("created_at", window)
    salted = timed.withColumn("_salt", F.pmod(F.xxhash64("seq"), F.lit(SALTS)))
    return salted.dropDuplicatesWithinWatermark(["id", "_salt"]).drop("_salt").dropDuplicatesWithinWatermark(["id"])


def funnel_per_window(classified: DataFrame, window="1 hour", watermark="7 days") -> DataFrame:
    """Posts per time window and verdict, as one row per window.

    Read it in update mode (``to_table(..., "update", ["start"])``), which lets go of windows behind the
    watermark: append mode holds back the last windows until later posts
    arrive.
    """
    timed = classified.withColumn("created_at", tx.created_at()).withWatermark("created_at", watermark)
    return timed.groupBy(F.window("created_at", window)).agg(*funnel_counts()).select("window.start", "total", *VERDICTS)


def start_sinks(leads: DataFrame, checkpoint: str, store=None, sheet=None, as_of=None, min_score=None,
                sheet_min_score=7, name="leads", once=True, minutes=EVERY_MINUTES) -> StreamingQuery:
    """Send each micro-batch to the lead store and the daily sheet.

    The run id is the id that Spark keeps in the checkpoint and the batch number, so a repeated
    batch replaces its own rows and never those of another stream. Duplicates within a batch and
    against everything stored are found by the sinks, without a watermark: a late post is treated
    like any other. ``as_of`` names the sheet's day: a text, a function asked at every micro-batch,
    or None for the time of the batch, so a stream that runs for days goes on to the next sheet.
    """
    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        kept = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        run_id = f"{name}-{kept}-{number:012d}"
        rows = staged(batch, "micro-batch")
        if store is not None:
            store.append(rows, run_id, min_score)
        if sheet is not None:
            now = as_of() if callable(as_of) else as_of
            if now is None:
                now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
            sheet.append(rows, now, run_id, sheet_min_score)

    return (
        leads.writeStream.queryName(name).option("checkpointLocation", checkpoint)
        .trigger(**trigger(once, minutes)).foreachBatch(write).start()
    )


def lifecycle(log: DataFrame) -> DataFrame:
    """Current status, sent and sent_date per changed lead, from a stream of log rows."""
    return latest_values(log)


class LateRows(StreamingQueryListener):
    """Keeps how many rows the watermark dropped in each micro-batch, in a table at ``path``.

    Add it with ``spark.streams.addListener`` before the stream starts. A query itself remembers
    only its last updates, and none after a restart.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        dropped = sum(s.numRowsDroppedByWatermark for s in event.progress.stateOperators)
        if dropped:
            row = [(str(event.progress.id), event.progress.batchId, dropped)]
            self.spark.createDataFrame(row, LATE).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


LATE = "query string, batch long, dropped long"


def late_rows(spark: SparkSession, path: str) -> DataFrame:
    """One row: how many rows came behind the watermark; a repeated micro-batch counts once."""
    rows = read_table(spark, path, LATE).groupBy("query", "batch").agg(F.max("dropped").alias("dropped"))
    return rows.agg(F.coalesce(F.sum("dropped"), F.lit(0)).alias("late"))


def to_table(result: DataFrame, name: str, mode="append", keys=(), timeout=None) -> DataFrame:
    """Run a stream over what is there and return its whole result as a table.

    In append mode each batch adds its rows. In update mode each batch adds the rows that changed
    and the last one of each of the ``keys`` counts, so a batch writes what it touched and nothing
    else. It waits until all is read; with a ``timeout`` in seconds it stops the stream and raises
    rather than return a part.
    """
    spark = result.sparkSession
    out, checkpoint = shared_dir(spark, f"{name}-out"), shared_dir(spark, f"{name}-checkpoint")
    writer = result.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", out).start()
    else:
        query = writer.foreachBatch(
            lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}")).start()
    if not (query.awaitTermination(timeout) if timeout is not None else query.awaitTermination() or True):
        query.stop()
        raise TimeoutError(f"stream {name} was not done after {timeout} seconds")
    if mode == "append":
        return read_table(spark, out, result.schema)
    schema = T.StructType([*result.schema.fields, T.StructField("batch", T.LongType())])
    rows = read_table(spark, out, schema)
    values = [F.col(c) for c in result.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_last"))
    return last.select(*keys, "_last.*").select(result.columns)
