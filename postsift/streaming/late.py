"""The funnel per time window with a side output: rows behind the watermark are kept, not dropped."""

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from postsift.functions import text as tx
from postsift.operators.triage import VERDICTS, funnel_counts
from postsift.session import staged
from postsift.sources.leads import read_table
from postsift.streaming.posts_stream import trigger

WINDOW, DELAY = timedelta(hours=1), timedelta(days=7)

_COUNTS = ", ".join(f"{name} long" for name in ("total", *VERDICTS))
_DELTAS = f"start timestamp, {_COUNTS}, batch long"
_LATE = "seq long, id string, created_at timestamp, verdict string, start timestamp, lag_seconds double, batch long"
_MARKS = "newest timestamp, batch long"


class WindowedFunnel:
    """Counts per window under ``path``: ``deltas`` of on-time rows, ``late`` rows, and the ``marks`` of time.

    Each micro-batch adds one row per window it touches, and never reads those of earlier ones. The
    watermark of a micro-batch is the newest time of all earlier micro-batches less ``delay``; a
    row is late when its window had ended by then. Everything a micro-batch writes goes into folders
    of its own number, so one that is repeated replaces itself and finds the same watermark.
    """

    def __init__(self, spark: SparkSession, path: str, window: timedelta = WINDOW, delay: timedelta = DELAY):
        self.spark, self.path, self.window, self.delay = spark, path, window, delay

    def _table(self, name: str, schema: str) -> DataFrame:
        return read_table(self.spark, f"{self.path}/{name}", schema)

    def _write(self, rows: DataFrame, name: str, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{name}/batch={number}")

    def take(self, batch: DataFrame, number: int) -> None:
        """Count one micro-batch of classified posts."""
        size = self.window // timedelta(microseconds=1)
        us = F.unix_micros("created_at")
        # Posts without a time have a window without a start; they are never late.
        rows = staged(batch.withColumn("created_at", tx.created_at()).select(
            "seq", "id", "created_at", "verdict", F.timestamp_micros(us - F.pmod(us, F.lit(size))).alias("start")), "micro-batch")
        mark = self._table("marks", _MARKS).where(F.col("batch") < number).agg(F.max("newest")).first()[0]
        late = F.lit(False)
        if mark is not None:
            late = F.coalesce(F.col("start") <= F.lit(mark - self.delay - self.window).cast("timestamp"), F.lit(False))
        self._write(rows.where(late).select(
            "seq", "id", "created_at", "verdict", "start",
            (F.lit(mark).cast("timestamp").cast("double") - F.col("created_at").cast("double")).alias("lag_seconds")), "late", number)
        self._write(rows.where(~late).groupBy("start").agg(*funnel_counts()).coalesce(1), "deltas", number)
        self._write(rows.agg(F.max("created_at").alias("newest")).coalesce(1), "marks", number)

    def start(self, classified: DataFrame, checkpoint: str, once=True, minutes=60) -> StreamingQuery:
        return (classified.writeStream.option("checkpointLocation", checkpoint).trigger(**trigger(once, minutes))
                .foreachBatch(self.take).start())

    def late(self) -> DataFrame:
        """The late rows: seq, id, created_at, verdict, the window they belong to and how late they were."""
        return self._table("late", _LATE)

    def totals(self) -> DataFrame:
        """Counts per window of the rows that came in time."""
        return self._summed(self._table("deltas", _DELTAS).drop("batch"))

    def folded(self) -> DataFrame:
        """Counts per window with the late rows in the windows they belong to, and ``late``, how many these are."""
        late = self.late().groupBy("start").agg(*funnel_counts(), F.count(F.lit(1)).alias("late"))
        on_time = self._table("deltas", _DELTAS).drop("batch").withColumn("late", F.lit(0).cast("long"))
        return self._summed(on_time.unionByName(late), "late")

    def _summed(self, rows: DataFrame, *more: str) -> DataFrame:
        return rows.groupBy("start").agg(*[F.sum(name).alias(name) for name in ("total", *VERDICTS, *more)])
