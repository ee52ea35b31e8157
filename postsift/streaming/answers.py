"""Requests and their answers as two streams: what is answered in time, and what has to be asked again."""

from pyspark.sql import DataFrame, functions as F

from postsift.operators.enrichment import parse_batch_answers
from postsift.streaming.remembered import keep_state_on_disk


def reconcile(requests: DataFrame, answers: DataFrame, key: str, wait="1 hour", delay="10 minutes") -> DataFrame:
    """Each of ``requests(key, asked_at)`` once: (key, asked_at, answered).

    ``answers(key, answered_at)`` holds the usable ones. A request is answered by one that comes at or
    after it and within ``wait``; several count as one. It is unanswered once both streams have passed
    its time by ``wait`` and ``delay``, so a missing or late answer is noticed without looking at
    stored requests. Time passes with the requests and with the usable answers. Repeated requests with the same key and time are one. Rows without key or time are
    left out. State holds open requests and recent answers only, keys and times of both.
    """
    keep_state_on_disk(requests.sparkSession)
    usable = F.col(key).isNotNull()
    asked = (requests.where(usable & F.col("asked_at").isNotNull()).select(key, "asked_at")
             .withWatermark("asked_at", delay).dropDuplicates([key, "asked_at"]))
    given = (answers.where(usable & F.col("answered_at").isNotNull()).select(F.col(key).alias("_key"), "answered_at")
             .withWatermark("answered_at", delay))
    in_time = (F.col(key) == F.col("_key")) & (F.col("answered_at") >= F.col("asked_at")) & (
        F.col("answered_at") <= F.col("asked_at") + F.expr(f"INTERVAL {wait}"))
    met = asked.join(given, in_time, "left_outer")
    return met.select(key, "asked_at", F.col("answered_at").isNotNull().alias("answered"))


def usable_batches(batch_answers: DataFrame) -> DataFrame:
    """(batch_no, answered_at) of the answers of ``batch_answers(batch_no, raw, answered_at)`` that can be used."""
    return parse_batch_answers(batch_answers, "answered_at").where("usable").select("batch_no", "answered_at")


def retries(requests: DataFrame, batch_answers: DataFrame, wait="1 hour", delay="10 minutes") -> DataFrame:
    """(batch_no, asked_at) of the batches without a usable answer in time; each is given once."""
    rows = reconcile(requests, usable_batches(batch_answers), "batch_no", wait, delay)
    return rows.where("NOT answered").select("batch_no", "asked_at")
