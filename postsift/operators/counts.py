"""Counts over stored leads and over runs."""

from pyspark.sql import DataFrame, functions as F

from postsift.operators.work_queue import is_pending


def lead_counts(leads: DataFrame) -> DataFrame:
    """Rows (dimension, key, n): the total, and leads per status, language and community.

    Blank keys are left out. The three groupings share one scan; the total reads no column and is
    there (as 0) even for an empty table.
    """
    dims = {"status": "status", "language": "language_detected", "subreddit": "subreddit"}
    keys = leads.select(*[F.nullif(F.col(c), F.lit("")).alias(d) for d, c in dims.items()])
    named = F.when(F.grouping("status") == 0, F.struct(F.lit("status").alias("dimension"), F.col("status").alias("key")))
    named = named.when(F.grouping("language") == 0, F.struct(F.lit("language").alias("dimension"), F.col("language").alias("key")))
    named = named.otherwise(F.struct(F.lit("subreddit").alias("dimension"), F.col("subreddit").alias("key")))
    per_key = (
        keys.groupingSets([["status"], ["language"], ["subreddit"]], "status", "language", "subreddit")
        .agg(named.alias("_named"), F.count(F.lit(1)).alias("n"))
        .select("_named.dimension", "_named.key", "n")
        .where(F.col("key").isNotNull())
    )
    total = leads.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("total").alias("dimension"), F.lit("").alias("key"), "n")
    return total.unionByName(per_key)


def ordered_counts(counts: DataFrame) -> DataFrame:
    return counts.orderBy("dimension", F.desc("n"), "key")


def action_stats(leads: DataFrame) -> DataFrame:
    """One row: total, comment_worthy, sent and pending."""
    return leads.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("comment_worthy").alias("comment_worthy"),
        F.count_if("sent").alias("sent"),
        F.count_if(is_pending()).alias("pending"),
    )


def run_counts(run_log: DataFrame) -> DataFrame:
    """One row: runs that succeeded, and all runs."""
    return run_log.agg(F.count_if("success").alias("succeeded"), F.count(F.lit(1)).alias("runs"))
