"""Table schemas. Reads always name one of these; nothing is inferred."""

from pyspark.sql import types as T

# ``seq`` is the order of arrival: a unique integer per row. Files keep no row order in Spark, so
# every rule that says "first" or "earlier" refers to it.
TEXT, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
DOUBLE, TIME, BOOL = T.DoubleType(), T.TimestampType(), T.BooleanType()
TEXTS = T.ArrayType(TEXT)


def _struct(*columns) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


def with_columns(schema: T.StructType, *columns) -> T.StructType:
    return T.StructType(schema.fields + _struct(*columns).fields)


POSTS = _struct(
    ("seq", LONG), ("id", TEXT), ("subreddit", TEXT), ("author", TEXT), ("title", TEXT),
    ("selftext", TEXT), ("url", TEXT), ("permalink", TEXT), ("created_utc", DOUBLE),
    ("score", INT), ("num_comments", INT),
)

LEADS = _struct(
    ("seq", LONG), ("post_id", TEXT), ("subreddit", TEXT), ("author", TEXT), ("title", TEXT),
    ("body", TEXT), ("post_url", TEXT), ("message_url", TEXT), ("created_at", TIME),
    ("matched_triggers", TEXTS), ("language_detected", TEXT), ("score", INT),
    ("num_comments", INT), ("scraped_at", TIME), ("signal_score", INT), ("signal_type", TEXT),
    ("category", TEXT), ("comment_worthy", BOOL), ("comment_worthy_reason", TEXT),
    ("public_draft", TEXT), ("dm_draft", TEXT), ("mention_allowed", BOOL), ("status", TEXT),
    ("sent", BOOL), ("sent_date", TEXT),
)

DICT_TERMS = _struct(
    ("kind", TEXT), ("ord", INT), ("term", TEXT), ("section", TEXT), ("category", TEXT),
    ("signal", TEXT),
)
LANGUAGES = _struct(
    ("code", TEXT), ("name", TEXT), ("native_name", TEXT), ("subreddits", TEXTS),
    ("priority", INT),
)
COMMUNITIES = _struct(("name", TEXT), ("grp", TEXT))

# Changes to stored leads are appended here; ``seq`` names the changed row.
STATUS_LOG = _struct(
    ("seq", LONG), ("post_id", TEXT), ("field", TEXT), ("value", TEXT), ("at", TIME)
)

FUNNEL = _struct(*[(n, LONG) for n in ("total", "passed", "no_trigger", "excluded", "deleted_author")])

RUN_LOG = _struct(("run_id", TEXT), ("started_at", TIME), ("success", BOOL))

# Column order of the lead export, the daily sheet, the action tab and the action export.
EXPORT_COLUMNS = [
    "scraped_at", "created_at", "subreddit", "author", "title", "post_url", "message_url",
    "matched_triggers", "language", "score", "comments", "status", "signal_score", "signal_type",
    "category", "comment_worthy", "comment_worthy_reason", "mention_allowed", "public_draft",
    "dm_draft", "sent", "sent_date",
]
SHEET_COLUMNS = [
    "Timestamp", "Subreddit", "Author", "Title", "Post URL", "DM URL", "Matched Keywords",
    "Language", "Signal Score", "Signal Type", "Category", "Comment Worthy", "Worthy Reason",
    "Public Draft", "DM Draft", "Status", "Sent", "Sent Date",
]
ACTION_COLUMNS = [
    "Post URL", "Title", "Subreddit", "Signal", "Category", "Draft Comment", "Sent", "Sent Date",
]
ACTION_EXPORT_COLUMNS = [
    "subreddit", "author", "title", "post_url", "message_url", "matched_triggers", "language",
]

EXPORT = _struct(*[(name, TEXT) for name in EXPORT_COLUMNS])
