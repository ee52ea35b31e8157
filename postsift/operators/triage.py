"""The keyword triage: a verdict for every post, the funnel over verdicts, and the leads."""

from pyspark.sql import Column, DataFrame, functions as F

from postsift import schemas
from postsift.dictionaries import Dictionary, default_dictionary, language_needles
from postsift.functions import text as tx
from postsift.functions.matching import first_language, with_matches
from postsift.sources.posts import DELETED

VERDICTS = ["passed", "no_trigger", "excluded", "deleted_author"]


def classify(posts: DataFrame, dictionary: Dictionary | None = None, needles=None,
             require_trigger=True, exclude_on_match=True, engine="automaton") -> DataFrame:
    """Add verdict, passed, reason, matched_triggers, matched_excludes and language_detected.

    Rejects stay in the result. The text of each post is scanned once for triggers, excludes and
    language names together; texts of deleted authors are not scanned at all.
    """
    dictionary = dictionary or default_dictionary()
    needles = language_needles() if needles is None else needles
    groups = {
        "excludes": dictionary.texts("exclude"),
        "triggers": dictionary.texts("trigger"),
        "languages": list(needles),
    }
    deleted = F.col("author") == DELETED
    hits = with_matches(posts, F.when(~deleted, tx.full_text()), groups, "_hits", engine)

    excludes, triggers = F.col("_hits.excludes"), F.col("_hits.triggers")
    verdict = F.when(deleted, "deleted_author")
    if exclude_on_match:
        verdict = verdict.when(F.size(excludes) > 0, "excluded")
    if require_trigger:
        verdict = verdict.when(F.size(triggers) == 0, "no_trigger")
    verdict = verdict.otherwise("passed")

    named = F.concat(F.lit("excluded: "), F.array_join(F.slice(excludes, 1, 3), ", "))
    passed = F.col("verdict") == "passed"
    nothing = F.array().cast("array<string>")
    language = first_language(F.col("_hits.languages"), needles) if needles else F.lit(None).cast("string")
    return (
        hits.withColumn("verdict", verdict)
        .withColumns({
            "passed": passed,
            "reason": F.when(F.col("verdict") == "excluded", named).otherwise(F.col("verdict")),
            "matched_triggers": F.when(passed, triggers).otherwise(nothing),
            "matched_excludes": F.when(F.col("verdict").isin("passed", "excluded"), excludes).otherwise(nothing),
            "language_detected": F.when(passed, language),
        })
        .drop("_hits")
    )


def funnel_counts() -> list[Column]:
    """Aggregates over classified posts: the total and one count per verdict."""
    return [
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("verdict") == v).alias(v) for v in VERDICTS],
    ]


def with_rate(counts: DataFrame) -> DataFrame:
    passed, total = F.col("passed"), F.col("total")
    return counts.withColumns({
        "pass_rate": tx.percent(passed, total), "pass_rate_text": tx.percent_text(passed, total),
    })


def funnel(classified: DataFrame) -> DataFrame:
    """One row: total, one count per verdict, and the pass rate as number and as text."""
    return with_rate(classified.agg(*funnel_counts()))


def to_leads(classified: DataFrame, as_of) -> DataFrame:
    """Leads made from the posts that passed, scraped at ``as_of``; None is the time of the batch (of a stream)."""
    return post_to_lead(classified.where("passed"), as_of)


def post_to_lead(posts: DataFrame, as_of) -> DataFrame:
    """Posts in the lead schema. Lead fields the posts already carry are kept."""
    derived = {
        "post_id": F.col("id"),
        "body": F.col("selftext"),
        "post_url": tx.direct_url(),
        "message_url": tx.message_url(),
        "created_at": tx.created_at(),
        "scraped_at": F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp"),
    }
    defaults = {"status": F.lit("new"), "sent": F.lit(False)}

    def value(field):
        if field.name in derived:
            return derived[field.name]
        if field.name in posts.columns:
            return F.col(field.name)
        return defaults.get(field.name, F.lit(None)).cast(field.dataType)

    return posts.select(*[value(field).alias(field.name) for field in schemas.LEADS])
