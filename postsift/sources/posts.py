"""Where posts come from, and the listings over them."""

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from postsift import schemas
from postsift.functions.text import bind, full_text

DELETED = "[deleted]"

# A corrupt record keeps its raw text here and goes to quarantine.
CORRUPT = "_corrupt_record"

TIME_RANGES = {  # fixed values: the named time ranges of a search
    "hour": "INTERVAL 1 HOUR",
    "day": "INTERVAL 1 DAY",
    "week": "INTERVAL 7 DAYS",
    "month": "INTERVAL 30 DAYS",
    "year": "INTERVAL 365 DAYS",
    "all": None,
}

# Own demonstration rows, one for each way a post can go.
SAMPLE_POSTS = [
    (1, "f1", "German", "ana", "Scared to speak German at work",
     "New job starts soon and I freeze up in every meeting", 1704096000.0, 9, 4),
    (2, "f4", "Korean", None, "Scared to speak Korean", "Any tips", 1704099600.0, 2, 0),
    (3, "f6", "casual", "eli", "Lunch thread", "What did you eat", 1704103200.0, 31, 57),
    (4, "f8", "languagelearning", "gus", "Life beyond Duolingo", "Ideas", 1704106800.0, 14, 6),
    (5, "f9", "languagelearning", "hal", "Upgrade my speaking practice", "Any plan", 1704110400.0, 3, 1),
    (6, "f11", "polyglot", "jo", "French or Spanish", "plateau in both, learning Spanish now", 1704114000.0, 22, 11),
    (7, "f12", "LearnJapanese", "kim", "\u65e5\u672c\u8a9e plateau", "", 1704117600.0, 7, 2),
]


def read_posts(spark: SparkSession, path: str, fmt="parquet", **options) -> DataFrame:
    return spark.read.schema(schemas.POSTS).options(**options).format(fmt).load(path)


def read_json_posts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Posts from JSON lines, and the quarantine: the lines that could not be read as posts."""
    schema = schemas.with_columns(schemas.POSTS, (CORRUPT, schemas.TEXT))
    record = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    rows = spark.read.text(path).where(F.trim("value") != "").select(record.alias("_r"))
    good = rows.where(F.col(f"_r.{CORRUPT}").isNull()).select("_r.*").drop(CORRUPT)
    return good, rows.select(f"_r.{CORRUPT}").where(F.col(CORRUPT).isNotNull())


def sample_posts(spark: SparkSession, limit=100) -> DataFrame:
    """A few fixed posts for demonstrations, whatever the communities."""
    rows = [
        (seq, id_, sub, author, title, body, f"https://reddit.com/r/{sub}/{id_}",
         f"/r/{sub}/comments/{id_}/x/", at, score, comments)
        for seq, id_, sub, author, title, body, at, score, comments in SAMPLE_POSTS[:limit]
    ]
    return spark.createDataFrame(rows, schemas.POSTS)


def open_posts(spark: SparkSession, source=None) -> DataFrame:
    """Posts from a DataFrame, a table name, a Parquet path, or the sample when nothing is named."""
    if source is None or source == "sample":
        return sample_posts(spark)
    if isinstance(source, DataFrame):
        return source
    if "/" not in source and spark.catalog.tableExists(source):
        return spark.table(source)
    return read_posts(spark, source)


def normalise(raw: DataFrame) -> DataFrame:
    """A missing author becomes ``[deleted]``, a missing title or body the empty text."""
    return raw.withColumns({
        "author": F.coalesce("author", F.lit(DELETED)),
        "title": F.coalesce("title", F.lit("")),
        "selftext": F.coalesce("selftext", F.lit("")),
    })


def parse_communities(text: str | None, default: list[str]) -> list[str]:
    """Names from a comma-separated list; nothing named means the default list."""
    names = [name.strip() for name in (text or "").split(",")]
    return [name for name in names if name] or list(default)


def in_communities(posts: DataFrame, communities) -> DataFrame:
    """Posts of the named communities (a list, or a table with ``name``), ignoring case.

    A list becomes a set in the scan. A table is semi-joined as it is: the runtime broadcasts it if
    it is small and otherwise splits a community that holds much of the input.
    """
    key = F.lower("subreddit")
    if isinstance(communities, DataFrame):
        names = communities.select(F.lower("name").alias("_key"))
        return posts.withColumn("_key", key).join(names, "_key", "left_semi").select(posts.columns)
    return posts.where(key.isin([name.lower() for name in communities]))


def _ranked(posts: DataFrame, order, limit: int, per_community: bool) -> DataFrame:
    if not per_community:
        return posts.orderBy(*order).limit(limit)
    # A rank limit on row_number is applied before the shuffle too, so a hot community sends
    # only its top rows from each task.
    window = Window.partitionBy(F.lower("subreddit")).orderBy(*order)
    return posts.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= limit).drop("_rank")


def newest_posts(posts, communities, limit=100, per_community=False) -> DataFrame:
    """Newest first; ``limit`` counts over all communities together unless ``per_community``."""
    return newest(in_communities(posts, communities), limit, per_community)


def newest(posts, limit=100, per_community=False) -> DataFrame:
    order = [F.desc("created_utc"), F.asc("id"), F.asc("seq")]
    return _ranked(posts, order, limit, per_community)


def hot_posts(posts, communities, limit=100) -> DataFrame:
    """Highest score first, then most comments, then newest."""
    order = [F.desc("score"), F.desc("num_comments"), F.desc("created_utc"), F.asc("id"), F.asc("seq")]
    return _ranked(in_communities(posts, communities), order, limit, False)


def search_posts(posts, communities, query, as_of, limit=100, time_filter="week", sort="new") -> DataFrame:
    """Posts whose text holds every word of the query, within a time range before ``as_of``.

    ``relevance`` ranks by how often the words occur.
    """
    found = in_communities(posts, communities)
    span = TIME_RANGES[time_filter]
    if span:
        start = F.unix_timestamp(F.lit(as_of).cast("timestamp") - F.expr(span))
        found = found.where(F.col("created_utc") >= start)
    text = F.lower(full_text())
    tokens = query.lower().split()
    if tokens:
        words = F.array(*[F.lit(token) for token in tokens])
        found = found.where(bind(text, lambda t: F.forall(words, lambda word: F.contains(t, word))))
    newest = [F.desc("created_utc"), F.asc("id"), F.asc("seq")]
    if sort == "relevance":
        def occurrences(t):
            gaps = ((F.length(t) - F.length(F.replace(t, F.lit(w), F.lit("")))) / len(w) for w in tokens)
            return sum(gaps, F.lit(0.0))

        order = [F.desc(bind(text, occurrences))] + newest
    else:
        order = {
            "new": newest,
            "top": [F.desc("score")] + newest,
            "hot": [F.desc("score"), F.desc("num_comments")] + newest,
            "comments": [F.desc("num_comments")] + newest,
        }[sort]
    return found.orderBy(*order).limit(limit)
