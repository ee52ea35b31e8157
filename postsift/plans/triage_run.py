"""A whole run: posts in, leads triaged, enriched and saved, counts out."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Row, functions as F

from postsift import schemas
from postsift.dictionaries import COMMUNITIES, LANGUAGES, PRIORITY_CODES, Dictionary
from postsift.operators import enrichment, outcomes as oc
from postsift.operators.triage import classify, funnel_counts, to_leads, with_rate
from postsift.session import configure, staged
from postsift.sinks.daily_sheet import DailySheet, skipped_counts
from postsift.sinks.lead_store import LeadStore
from postsift.sources.leads import not_stored
from postsift.sources.posts import in_communities, newest, normalise

Step = Callable[[DataFrame], DataFrame]

EVERY = "*"  # in place of communities: every post of the input


@dataclass
class RunOptions:
    as_of: str
    run_id: str
    communities: list[str] | DataFrame | str | None = None  # None: the monitored ones; EVERY: all posts
    limit: int | None = None                          # None: every post of the communities
    dictionary: Dictionary | None = None
    needles: dict | None = None
    analyse: bool = False
    score: Step | None = None        # fills signal_score, signal_type, category
    judge: Step | None = None        # fills comment_worthy, comment_worthy_reason
    draft: Step | None = None        # fills public_draft, dm_draft
    threshold: int = oc.STORE_MIN_SCORE
    sheet_threshold: int = oc.SHEET_MIN_SCORE
    gate_when_unscored: bool = True  # scoring asked for but not at hand: the gate filters everything
    dedupe_early: bool = False       # drop stored posts before enrichment; counts then differ


def monitored_names() -> list[str]:
    """All default communities, sorted."""
    names = {n for group in COMMUNITIES.values() for n in group}
    names.update(n for code, _, _, subs in LANGUAGES if code in PRIORITY_CODES for n in subs)
    return sorted(names)


def run(posts: DataFrame, store: LeadStore, options: RunOptions, sheet: DailySheet | None = None) -> DataFrame:
    """Run once and return the summary row.

    Posts are read and scanned once. The funnel is counted while the posts that passed are written
    as leads; rejects are counted and never stored. The caller's steps each run once, and both
    sinks and all later counts read the written leads.
    """
    spark = configure(posts.sparkSession)
    names = monitored_names() if options.communities is None else options.communities
    if not isinstance(names, str):
        posts = in_communities(posts, names)
    elif names != EVERY:
        raise ValueError(f"communities must be names, a table, or {EVERY!r}")
    if options.limit is not None:
        posts = newest(posts, options.limit)

    counted = Observation("funnel")
    classified = classify(normalise(posts), options.dictionary, options.needles).observe(counted, *funnel_counts())
    leads = staged(to_leads(classified, options.as_of), "leads")
    funnel_row = with_rate(spark.createDataFrame([Row(**counted.get)], schemas.FUNNEL))
    if options.dedupe_early:
        leads = not_stored(leads, store.known(leads, options.run_id))
    leads = enrich(leads, options)

    gate = options.threshold if options.analyse and (options.score or options.gate_when_unscored) else None
    saved = store.append(leads, options.run_id, gate)
    if sheet is not None:
        on_sheet = sheet.append(leads, options.as_of, options.run_id, options.sheet_threshold)
    else:
        on_sheet = skipped_counts(leads)
    return summary(funnel_row, leads, saved, on_sheet, options.threshold if options.analyse else None)


def enrich(leads: DataFrame, options: RunOptions) -> DataFrame:
    """Score all leads; judge and draft the high-signal ones, the rest pass through unchanged."""
    if not options.analyse or options.score is None:
        return leads
    if options.score is enrichment.rubric:  # the rubric reads the terms of the run's own dictionary
        scored = enrichment.rubric(leads, options.dictionary)
    else:
        scored = staged(options.score(leads), "scored")
    if not (options.judge or options.draft):
        return scored
    high = oc.high_signal(scored, options.threshold)
    rest = scored.where(F.coalesce(F.col("signal_score") < options.threshold, F.lit(True)))
    if options.judge:
        high = staged(options.judge(high), "judged")
    if options.draft:
        worthy = F.coalesce("comment_worthy", F.lit(False)) if options.judge else F.lit(True)
        high = staged(options.draft(high.where(worthy)).unionByName(high.where(~worthy)), "drafted")
    return high.unionByName(rest)


def lead_totals(leads: DataFrame, threshold) -> DataFrame:
    """One row: leads, high-signal leads, and high-signal leads judged unworthy."""
    high = F.coalesce(F.col("signal_score") >= threshold, F.lit(False)) if threshold is not None else F.lit(False)
    return leads.agg(
        F.count(F.lit(1)).alias("leads_found"),
        F.count_if(high).alias("high_signal_leads"),
        F.count_if(high & ~F.col("comment_worthy")).alias("skipped_unworthy"),
    )


def summary(funnel_row: DataFrame, leads: DataFrame, saved: DataFrame, on_sheet: DataFrame, threshold) -> DataFrame:
    """The figures of a run as one row, merged from one-row aggregates."""
    parts = [
        funnel_row.withColumnRenamed("total", "posts_fetched"),
        lead_totals(leads, threshold),
        saved.select(*[F.col(o).alias(f"leads_{o}") for o in oc.OUTCOMES]),
        on_sheet.select(*[F.col(o).alias(f"sheet_{o}") for o in oc.OUTCOMES]),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part, allowMissingColumns=True)
    merged = rows.agg(*[F.max(name).alias(name) for name in rows.columns])
    return merged.withColumn(
        "comment_worthy_leads", F.col("high_signal_leads") - F.col("skipped_unworthy"))
