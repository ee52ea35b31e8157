"""What happens to each lead at a sink: saved, skipped as a duplicate, or filtered by a gate.

Leads are taken in order of arrival and the first one of a post that passes the gate is saved.
The two sinks test in different order: the lead store looks for duplicates first, the daily sheet
applies its gate first. A filtered lead never blocks a later lead of the same post.
"""

from pyspark.sql import Column, DataFrame, functions as F

from postsift.operators.lookup import lookup

STORE_MIN_SCORE = 8  # fixed values: default thresholds of a run and of the daily sheet
SHEET_MIN_SCORE = 7

OUTCOMES = ["saved", "skipped", "filtered"]


def score_gate(min_score) -> Column:
    """True where the score reaches ``min_score``; no threshold lets everything through.

    A missing score and a score of 0 never reach a threshold.
    """
    if min_score is None:
        return F.lit(True)
    score = F.coalesce("signal_score", F.lit(0))
    return (score != 0) & (score >= min_score)


def draft_gate() -> Column:
    return F.coalesce("public_draft", F.lit("")) != ""


def high_signal(leads: DataFrame, threshold=STORE_MIN_SCORE) -> DataFrame:
    return leads.where(F.col("signal_score") >= threshold)


def store_outcomes(leads: DataFrame, stored: DataFrame, min_score=None) -> DataFrame:
    """Add ``outcome`` for the lead store; ``stored`` holds the post ids saved by earlier runs."""
    seen, passes = _seen_before(leads, stored, score_gate(min_score))
    outcome = F.when(F.col("_seen"), "skipped").when(~passes, "filtered").otherwise("saved")
    return seen.withColumn("outcome", outcome).drop("_seen")


def sheet_outcomes(leads: DataFrame, stored: DataFrame, min_score=SHEET_MIN_SCORE, gated=True) -> DataFrame:
    """Add ``outcome`` for the daily sheet; without the gates only duplicates are held back."""
    gate = draft_gate() & score_gate(min_score) if gated else F.lit(True)
    seen, passes = _seen_before(leads, stored, gate)
    outcome = F.when(~passes, "filtered").when(F.col("_seen"), "skipped").otherwise("saved")
    return seen.withColumn("outcome", outcome).drop("_seen")


def _seen_before(leads: DataFrame, stored: DataFrame, passes: Column):
    """Mark leads whose post is stored, or was saved by an earlier lead of this batch.

    The earliest passing lead per post is a plain aggregate, so partial results are merged before
    the shuffle and no post's leads are ever gathered in one place. Posts with a single, new lead
    are left out of the lookup; where copies are rare, what remains is small enough to broadcast.
    """
    posts = leads.groupBy("post_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.when(passes, F.col("seq"))).alias("_first"),
    )
    known = stored.select("post_id").distinct().withColumn("_stored", F.lit(True))
    facts = posts.join(known, "post_id", "left").where((F.col("n_rows") > 1) | F.col("_stored").isNotNull())
    rows = lookup(leads, facts.drop("n_rows"), "post_id")
    seen = F.coalesce("_stored", F.lit(False)) | F.coalesce(F.col("_first") < F.col("seq"), F.lit(False))
    return rows.withColumn("_seen", seen).drop("_first", "_stored"), passes


def outcome_counts(outcomes: DataFrame) -> DataFrame:
    """One row: saved, skipped, filtered; zeros where an outcome did not occur."""
    return outcomes.agg(*count_columns())


def count_columns() -> list[Column]:
    return [F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES]


def saved(outcomes: DataFrame) -> DataFrame:
    return outcomes.where(F.col("outcome") == "saved").drop("outcome")
