"""The queue of leads waiting for action, and the changes made to stored leads.

Stored leads are never edited in place. A change is a row of the status log, and the current state
of a lead is its stored row with the latest change of each field on top.
"""

from pyspark.sql import Column, DataFrame, functions as F

from postsift import schemas
from postsift.functions import text as tx
from postsift.operators.lookup import lookup
from postsift.operators.numbering import with_position

STATUSES = ["new", "contacted", "replied", "converted", "ignored"]


def is_pending() -> Column:
    """Worth a comment, with a draft that is not just white space, and not sent."""
    return (
        F.coalesce("comment_worthy", F.lit(False))
        & tx.has_ink(F.col("public_draft"))
        & ~F.coalesce("sent", F.lit(False))
    )


def is_pending_text() -> Column:
    """``is_pending`` for export rows, where flags are text."""
    return (
        tx.is_yes(F.col("comment_worthy"))
        & tx.has_ink(F.col("public_draft"))
        & ~tx.is_sent(F.col("sent"))
    )


def pending(leads: DataFrame) -> DataFrame:
    return leads.where(is_pending())


def numbered(leads: DataFrame) -> DataFrame:
    """Pending leads with their place in the queue."""
    return with_position(pending(leads), "place")


def next_pending(leads: DataFrame, limit=1) -> DataFrame:
    return pending(leads).orderBy("seq").limit(limit)


def remaining(leads: DataFrame) -> DataFrame:
    return leads.agg(F.count_if(is_pending()).alias("remaining"))


def status_changes(leads: DataFrame, requests: DataFrame) -> DataFrame:
    """Log rows for ``requests(post_id, status, at)``: one per lead with that post id.

    Requests for a status that does not exist change nothing. Of several requests for a post only
    the latest is kept, before the join: leads and requests of a post are never paired up.
    """
    latest = requests.where(F.col("status").isin(STATUSES)).groupBy("post_id").agg(
        F.max_by(F.struct("status", "at"), F.struct("at", "status")).alias("_r"))
    ids = leads.select("seq", "post_id")
    return lookup(ids, latest, "post_id").where(F.col("_r").isNotNull()).select(
        "seq", "post_id", F.lit("status").alias("field"), F.col("_r.status").alias("value"), F.col("_r.at").alias("at"))


def found(leads: DataFrame, requests: DataFrame) -> DataFrame:
    """Each requested post id with ``found``: whether any lead has it."""
    there = leads.select("post_id").distinct().withColumn("_there", F.lit(True))
    return requests.select("post_id").distinct().join(there, "post_id", "left").select(
        "post_id", F.coalesce("_there", F.lit(False)).alias("found"))


def sent_changes(leads: DataFrame, requests: DataFrame) -> DataFrame:
    """Log rows marking the first lead of each requested post as sent; ``requests(post_id, at)``."""
    first = leads.groupBy("post_id").agg(F.min("seq").alias("seq"))
    latest = requests.groupBy("post_id").agg(F.max("at").alias("at"))
    return _sent_rows(latest.join(first, "post_id"))


def sent_changes_by_text(leads: DataFrame, needle: str, at) -> DataFrame:
    """Log rows marking the first lead whose URL holds ``needle`` anywhere."""
    hits = leads.where(F.contains("post_url", F.lit(needle)))
    first = hits.agg(F.min_by(F.struct("seq", "post_id"), "seq").alias("_first"))
    row = first.where(F.col("_first").isNotNull()).select("_first.*", F.lit(at).cast("timestamp").alias("at"))
    return _sent_rows(row)


def _sent_rows(matched: DataFrame) -> DataFrame:
    changes = F.array(
        F.struct(F.lit("sent").alias("field"), F.lit("yes").alias("value")),
        F.struct(F.lit("sent_date").alias("field"), F.date_format("at", tx.MINUTES_FORMAT).alias("value")),
    )
    return matched.select("seq", "post_id", "at", F.inline(changes)).select(schemas.STATUS_LOG.names)


def latest_values(log: DataFrame) -> DataFrame:
    """The latest status, sent and sent_date per changed lead.

    Two changes of a field at the same instant resolve to the greater value, so the result does
    not depend on file order.
    """
    def latest(field):
        return F.max_by(
            F.when(F.col("field") == field, F.col("value")),
            F.when(F.col("field") == field, F.struct("at", "value")),
        ).alias(f"new_{field}")

    return log.groupBy("seq").agg(latest("status"), latest("sent"), latest("sent_date"))


def resolve(leads: DataFrame, log: DataFrame) -> DataFrame:
    """Leads with all logged changes applied. The join key ``seq`` is unique, so no key is hot."""
    rows = leads.join(latest_values(log), "seq", "left")
    return rows.withColumns({
        "status": F.coalesce("new_status", "status"),
        "sent": F.coalesce(tx.is_sent(F.col("new_sent")) | F.when(F.col("new_sent").isNull(), F.col("sent")), F.lit(False)),
        "sent_date": F.coalesce("new_sent_date", "sent_date"),
    }).select(leads.columns)
