"""Leads in the shapes other tools read: export, sheet, action tab, dict, previews."""

from pyspark.sql import DataFrame, functions as F

from postsift import schemas
from postsift.functions import text as tx


def _text(name: str):
    return tx.text_or(F.col(name), "")


def _seconds(name: str):
    return F.date_format(name, tx.SECONDS_FORMAT)


def export_rows(leads: DataFrame) -> DataFrame:
    """The 22 text columns of the lead export. Score 0 is written as blank, like a missing one."""
    columns = {
        "scraped_at": _seconds("scraped_at"),
        "created_at": _seconds("created_at"),
        "title": tx.clip(F.col("title"), 100),
        "matched_triggers": F.array_join("matched_triggers", ", "),
        "language": _text("language_detected"),
        "score": F.col("score").cast("string"),
        "comments": F.col("num_comments").cast("string"),
        "signal_score": tx.number_or(F.col("signal_score"), ""),
        "comment_worthy": tx.flag_text(F.col("comment_worthy")),
        "mention_allowed": tx.flag_text(F.col("mention_allowed")),
        "sent": F.when(F.col("sent"), "yes").otherwise(""),
        **{name: _text(name) for name in (
            "signal_type", "category", "comment_worthy_reason", "public_draft", "dm_draft", "sent_date")},
    }
    return leads.select(*[columns.get(name, F.col(name)).alias(name) for name in schemas.EXPORT_COLUMNS])


def sheet_rows(leads: DataFrame, as_of) -> DataFrame:
    """The 18 columns of the daily sheet, stamped ``as_of``."""
    values = [
        F.date_format(F.lit(as_of).cast("timestamp"), tx.SECONDS_FORMAT),
        F.col("subreddit"), F.col("author"), tx.clip(F.col("title"), 100), F.col("post_url"),
        F.col("message_url"), F.array_join(F.slice("matched_triggers", 1, 5), ", "),
        _text("language_detected"), tx.number_or(F.col("signal_score"), ""), _text("signal_type"),
        _text("category"), tx.flag_text(F.col("comment_worthy")), _text("comment_worthy_reason"),
        _text("public_draft"), _text("dm_draft"), F.col("status"), F.lit(False), F.lit(""),
    ]
    return leads.select(*[value.alias(name) for value, name in zip(values, schemas.SHEET_COLUMNS)])


def action_rows(leads: DataFrame) -> DataFrame:
    """The 8 columns of the action tab."""
    score = F.col("signal_score")
    signal = F.when(F.coalesce(score, F.lit(0)) == 0, "").otherwise(
        F.concat(score.cast("string"), F.lit("/10")))
    values = [
        F.col("post_url"), tx.clip(F.col("title"), 80), F.col("subreddit"), signal,
        _text("category"), _text("public_draft"), F.lit(False), F.lit(""),
    ]
    return leads.select(*[value.alias(name) for value, name in zip(values, schemas.ACTION_COLUMNS)])


def action_export(leads: DataFrame) -> DataFrame:
    """The 7 columns needed to act on new leads."""
    new = export_rows(leads.where(F.col("status") == "new"))
    return new.select(*schemas.ACTION_EXPORT_COLUMNS)


def lead_dicts(leads: DataFrame) -> DataFrame:
    """All lead fields with ISO times and the triggers joined to one text."""
    changed = {
        "created_at": tx.iso_text(F.col("created_at")),
        "scraped_at": tx.iso_text(F.col("scraped_at")),
        "matched_triggers": F.array_join("matched_triggers", ", "),
    }
    fields = [f.name for f in schemas.LEADS if f.name != "seq"]
    return leads.select(*[changed.get(name, F.col(name)).alias(name) for name in fields])


def lead_json(leads: DataFrame) -> DataFrame:
    """``lead_dicts`` as one JSON text per lead, NULL fields included."""
    rows = lead_dicts(leads)
    return rows.select("post_id", F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("json"))


def lead_preview(leads: DataFrame) -> DataFrame:
    """What a run shows of a new lead."""
    score = F.col("signal_score")
    signal = F.when(F.coalesce(score, F.lit(0)) != 0, F.concat(
        score.cast("string"), F.lit("/10 ("), _text("signal_type"), F.lit(") - "), _text("category")))
    return leads.select(
        "seq", "subreddit", "author",
        F.concat(tx.clip(F.col("title"), 60), F.lit("...")).alias("title"),
        F.array_join(F.slice("matched_triggers", 1, 3), ", ").alias("triggers"),
        tx.text_or(F.col("language_detected"), "unknown").alias("language"),
        signal.alias("signal"), "post_url", "message_url",
    )


def queue_preview(leads: DataFrame) -> DataFrame:
    """What the work queue shows of a pending lead. The draft is cut before its lines are joined."""
    draft = F.col("public_draft")
    return leads.select(
        "seq", "subreddit",
        F.concat(tx.clip(F.col("title"), 60), F.lit("...")).alias("title"),
        F.concat(tx.number_or(F.col("signal_score"), ""), F.lit("/10 ("), _text("category"), F.lit(")")).alias("signal"),
        "post_url",
        F.when(_text("public_draft") != "", F.concat(tx.one_line(tx.clip(draft, 100)), F.lit("..."))).alias("draft"),
    )


def lead_detail(leads: DataFrame) -> DataFrame:
    """The full view of a lead to work on, with the id taken from its URL."""
    return leads.select(
        "seq", "subreddit", "title", "signal_score", "category",
        tx.post_id_from_url(F.col("post_url")).alias("post_id"),
        "post_url", "message_url", "public_draft",
    )
