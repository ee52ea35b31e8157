"""Posts, leads, answers and requests made from the driver's tables, in Spark and in SQL.

Every table here covers all documents (or all events) with their whole texts. Remainders of counters
only vary the shape of a row; they never leave rows out.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from postsift import dictionaries as dic, schemas
from postsift.operators.enrichment import band
from postsift.operators.numbering import with_batch
from postsift.operators.triage import post_to_lead
from postsift.session import configure
from postsift.sources.leads import stored_ids
from postsift.sources.posts import normalise

AS_OF = "2024-02-01 00:00:00"

STATUS_BY_REMAINDER = ["new", "contacted", "replied", "converted", "ignored", ""]

MORE_TRIGGERS = ["plateau", "stuck", "shy", "app", "tutor", "level", "speak"]

# Words that do occur in the driver's invented prose, in the shape of a dictionary.
TABLE_TRIGGERS = {
    "anxiety": ["thble", "tion and"],
    "urgency": ["from the", "mit der"],
    "methods": ["los", "can not"],
    "needs": ["that", "que la", "that"],
    "level": ["tionth", "sich"],
    "paying": ["was for", "thble"],
}
TABLE_EXCLUDES = {"off_topic": ["license", "all rights"], "free": ["free", "no charge"]}

TABLE_LANGUAGES = [
    ("en", "That", "With", ["src0", "src1", "SRC2"]),
    ("fr", "Elle", "Aux", ["src3", "src4"]),
    ("de", "Und", "Mit", ["src5"]),
    ("es", "Los", "Que", ["src6", "src7"]),
    ("xx", "The", "Of", ["src19"]),
]
TABLE_PRIORITY = ["es", "fr", "nowhere", "de", "en"]

WANTED = ["src1", "SRC3", "src5", "src8", "src13"]


def table_dictionary() -> dic.Dictionary:
    return dic.Dictionary.from_sections(TABLE_TRIGGERS, TABLE_EXCLUDES)


def wide_dictionary() -> dic.Dictionary:
    """The default dictionary with the words above in its sections."""
    triggers = {"generated": dic.generated_terms()}
    triggers.update({s: words + TABLE_TRIGGERS.get(s, []) for s, words in dic.TRIGGERS.items()})
    excludes = {s: words + TABLE_EXCLUDES.get(s, []) for s, words in dic.EXCLUDES.items()}
    return dic.Dictionary.from_sections(triggers, excludes)


def table_needles() -> dict:
    return dic.language_needles(TABLE_LANGUAGES, TABLE_PRIORITY)


# --- Spark ------------------------------------------------------------------------------------

def _schema(**kinds):
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


TEXT, LONG, INT = T.StringType(), T.LongType(), T.IntegerType()
SCHEMAS = {
    "documents": _schema(doc_id=LONG, text=TEXT, lang=TEXT, source=TEXT, n_chars=LONG),
    "events": _schema(event_id=LONG, ts=T.TimestampNTZType(), user_id=LONG, event_type=TEXT,
                      value=T.DoubleType(), props=TEXT),
    "labels": _schema(doc_id=LONG, quality=INT, toxic=INT),
    "pages": _schema(page_id=LONG, url=TEXT, html=TEXT),
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return configure(spark).read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def events(spark, sf) -> DataFrame:
    return table(spark, sf, "events").withColumns({
        "ts": F.col("ts").cast("timestamp"),
        "k": F.get_json_object("props", "$.k").cast("int"),
    })


def raw_posts(spark, sf, documents: DataFrame | None = None) -> DataFrame:
    """Documents as posts; ``documents`` may be a stream. Exact copies share a post id.

    Texts are cut and digested before the join, so a query that needs only ids never moves a text.
    Partitioning by the join key costs nothing where the join shuffles anyway, and spreads a table
    that lies in few files over all tasks.
    """
    documents = table(spark, sf, "documents") if documents is None else documents
    id_ = F.substring(F.md5("text"), 1, 10)
    cut = F.locate("\n", F.col("text"))
    d = documents.select(
        F.col("doc_id").alias("seq"), id_.alias("id"), F.col("source").alias("subreddit"),
        F.when(cut > 0, F.left("text", cut - 1)).otherwise(F.col("text")).alias("title"),
        F.when(cut > 0, F.substr("text", cut + 1)).alias("selftext"),
        F.concat(F.lit("https://example.org/"), F.col("doc_id").cast("string")).alias("url"),
        F.concat(F.lit("/r/"), "source", F.lit("/comments/"), id_, F.lit("/"), "lang", F.lit("/")).alias("permalink"),
        "lang",
    ).repartition("seq")
    e = events(spark, sf).select(
        F.col("event_id").alias("seq"), "event_type",
        F.when(F.col("user_id") % 29 != 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))).alias("author"),
        F.floor(F.unix_micros("ts") / 1000000).cast("double").alias("created_utc"),
        F.floor("value").cast("int").alias("score"), F.col("k").alias("num_comments"),
    )
    return d.join(e, "seq", "left")


def posts(spark, sf, documents=None) -> DataFrame:
    return normalise(raw_posts(spark, sf, documents))


def leads(spark, sf) -> DataFrame:
    """Every post as a lead with scores, flags, drafts and states of all shapes."""
    k = F.col("num_comments")
    score = F.when(F.col("event_type") != "error", k % 11)
    statuses = F.array(*[F.lit(s) for s in STATUS_BY_REMAINDER])
    return post_to_lead(posts(spark, sf).withColumns({
        # From no trigger to nine, so that the prefixes of three and five do cut.
        "matched_triggers": F.slice(F.array("event_type", "lang", *map(F.lit, MORE_TRIGGERS)), 1, F.coalesce(k % 10, F.lit(0))),
        "language_detected": F.when(F.col("lang") == "es", "").when(F.col("lang") != "de", F.col("lang")),
        "signal_score": score,
        "signal_type": band(score),
        "category": F.when(k % 4 == 1, "").when(k % 4 == 2, "Practice Gap").when(k % 4 == 3, "App Fatigue"),
        "comment_worthy": F.when(k % 3 == 0, True).when(k % 3 == 1, False),
        "comment_worthy_reason": F.when(k % 3 == 1, "too vague"),
        "public_draft": F.when(k % 5 == 1, "").when(k % 5 == 2, "\t\n").when(
            k % 5 > 2, F.concat("title", F.lit("\n"), "selftext")),
        "dm_draft": F.when(k % 2 == 0, F.concat(F.lit("Hello "), "author")),
        "mention_allowed": F.when(k % 3 == 0, k % 5 == 3),
        "status": F.element_at(statuses, k % 6 + 1),
        "sent": k % 7 == 0,
        "sent_date": F.when(k % 7 == 0, "2024-01-31 10:00"),
    }), AS_OF)


def labelled_ids(spark, sf, label: str) -> DataFrame:
    """Post ids of the documents with this label, standing in for leads stored earlier."""
    labelled = table(spark, sf, "labels").where(F.col(label) == 1).select(F.col("doc_id").alias("seq"))
    stored = leads(spark, sf).select("seq", "post_url").join(labelled, "seq", "left_semi")
    return stored_ids(stored)


def score_answers(spark, sf) -> DataFrame:
    """One raw model answer per event, in twelve shapes, some of them broken."""
    k, shape = F.col("k"), F.col("event_id") % 12
    body = F.concat(F.lit('{"score":'), (k % 11).cast("string"), F.lit(',"signal_type":"HIGH","category":"Practice Gap"}'))
    raw = (
        F.when(shape == 0, body)
        .when(shape == 1, F.concat(F.lit("```json\n"), body, F.lit("\n``` done")))
        .when(shape == 2, F.concat(F.lit("sure: "), body, F.lit(" bye")))
        .when(shape == 3, '{"score":null}')
        .when(shape == 4, "{}")
        .when(shape == 5, "no json here")
        .when(shape == 6, "")
        .when(shape == 8, F.concat(body, F.lit(" and more")))
        .when(shape == 9, F.concat(F.lit("["), body, F.lit("]")))
        .when(shape == 10, F.concat(F.lit("  "), body, F.lit("\n")))
        .when(shape == 11, F.concat(F.lit('{"score":"'), (k % 11).cast("string"), F.lit('","category":null}')))
    )
    return events(spark, sf).select(F.col("event_id").alias("seq"), "k", raw.alias("raw"))


def addressed(spark, sf, answers: DataFrame) -> DataFrame:
    """Answers (seq, raw) of all events, sent to a document each; ``arrived`` tells which came last."""
    n = table(spark, sf, "documents").count()
    return answers.select((F.col("seq") % n).alias("seq"), F.col("seq").alias("arrived"), "raw")


def worthy_answers(spark, sf) -> DataFrame:
    """Raw answers of every event, each about the document that its id leaves as a remainder: a lead
    has several, of which the one of the latest event counts."""
    shape = F.col("event_id") % 8
    raw = (
        F.when(shape == 0, '{"worthy":true,"reason":"asks for help"}')
        .when(shape == 1, '{"worthy":false,"reason":"only venting"}')
        .when(shape == 2, '{"worthy":null}')
        .when(shape == 3, "{}")
        .when(shape == 4, "yes, worth it")
        .when(shape == 5, "[1]")
        .when(shape == 6, 'well {"worthy":0,"reason":null} ok')
    )
    return addressed(spark, sf, events(spark, sf).select(F.col("event_id").alias("seq"), raw.alias("raw")))


def batch_answers(spark, sf) -> DataFrame:
    """One raw answer per batch of five leads. Some leave posts out, some are unusable."""
    rows = with_batch(leads(spark, sf).select("seq", "post_id", "num_comments"))
    item = F.concat(F.lit('{"id":"'), "post_id", F.lit('","score":'), (F.col("num_comments") % 11).cast("string"), F.lit("}"))
    entry = F.struct("batch_pos", F.when(F.col("num_comments") % 6 != 5, item).alias("item"))
    grouped = rows.groupBy("batch_no").agg(F.sort_array(F.collect_list(entry)).alias("e"))
    listed = F.concat(F.lit("["), F.array_join("e.item", ","), F.lit("]"))
    raw = (
        F.when(F.col("batch_no") % 11 == 0, "sorry, no")
        .when(F.col("batch_no") % 11 == 1, '{"a":1}')
        .when(F.col("batch_no") % 11 == 2, F.concat(F.lit("```\n"), listed, F.lit("\n```")))
        .when(F.col("batch_no") % 11 == 3, "{}")
        .when(F.col("batch_no") % 11 != 4, listed)
    )
    return grouped.select("batch_no", raw.alias("raw"))


def status_requests(spark, sf) -> DataFrame:
    """Status changes asked for by clicks, purchases and views on posts; views name no real status."""
    p = posts(spark, sf).select("seq", F.col("id").alias("post_id"))
    n = table(spark, sf, "documents").count()
    status = F.when(F.col("event_type") == "click", "contacted").when(F.col("event_type") == "purchase", "converted")
    e = events(spark, sf).where(F.col("event_type").isin("click", "purchase", "view"))
    e = e.select((F.col("event_id") % n).alias("seq"), F.coalesce(status, F.lit("bogus")).alias("status"), F.col("ts").alias("at"))
    return p.join(e, "seq").select("post_id", "status", "at")


def sent_requests(spark, sf) -> DataFrame:
    p = posts(spark, sf).select("seq", F.col("id").alias("post_id"))
    n = table(spark, sf, "documents").count()
    e = events(spark, sf).where(F.col("event_type") == "signup")
    return p.join(e.select((F.col("event_id") % n).alias("seq"), F.col("ts").alias("at")), "seq").select("post_id", "at")


def table_languages(spark) -> DataFrame:
    priority = {code: i for i, code in enumerate(TABLE_PRIORITY)}
    rows = [(*row, priority.get(row[0])) for row in TABLE_LANGUAGES]
    return spark.createDataFrame(rows, schemas.LANGUAGES)


# --- the same tables in SQL -------------------------------------------------------------------

def sql_list(texts) -> str:
    return "[" + ", ".join("'" + t.replace("'", "''") + "'" for t in texts) + "]"


EVENTS = """events_k AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"""

POSTS = EVENTS + """,
raw_posts AS (
  SELECT d.doc_id AS seq, substr(md5(d.text), 1, 10) AS id, d.source AS subreddit,
    CASE WHEN e.user_id % 29 <> 0 THEN 'u' || e.user_id END AS author,
    CASE WHEN strpos(d.text, chr(10)) > 0 THEN substr(d.text, 1, strpos(d.text, chr(10)) - 1) ELSE d.text END AS title,
    CASE WHEN strpos(d.text, chr(10)) > 0 THEN substr(d.text, strpos(d.text, chr(10)) + 1) END AS selftext,
    '/r/' || d.source || '/comments/' || substr(md5(d.text), 1, 10) || '/' || d.lang || '/' AS permalink,
    epoch_us(e.ts) // 1000000 AS created_utc, CAST(floor(e.value) AS INTEGER) AS score, e.k AS num_comments,
    d.lang, e.event_type
  FROM documents d LEFT JOIN events_k e ON e.event_id = d.doc_id),
posts AS (
  SELECT * REPLACE (coalesce(author, '[deleted]') AS author, coalesce(selftext, '') AS selftext) FROM raw_posts)"""

BAND = "CASE WHEN {0} >= 8 THEN 'HIGH' WHEN {0} >= 5 THEN 'MEDIUM' WHEN {0} IS NOT NULL THEN 'LOW' END"

LEADS = (POSTS + """,
numbered_posts AS (SELECT *, CASE WHEN event_type <> 'error' THEN num_comments % 11 END AS sc, num_comments AS k FROM posts),
leads AS (
  SELECT seq, id AS post_id, subreddit, author, title, selftext AS body, 'https://reddit.com' || permalink AS post_url,
    'https://reddit.com/message/compose/?to=' || author AS message_url, created_utc,
    list_concat([event_type, lang], %TRIGGERS%)[1:coalesce(k % 10, 0)] AS matched_triggers,
    CASE WHEN lang = 'es' THEN '' WHEN lang <> 'de' THEN lang END AS language_detected,
    score, num_comments, sc AS signal_score, """ + BAND.format("sc") + """ AS signal_type,
    CASE k % 4 WHEN 1 THEN '' WHEN 2 THEN 'Practice Gap' WHEN 3 THEN 'App Fatigue' END AS category,
    CASE k % 3 WHEN 0 THEN true WHEN 1 THEN false END AS comment_worthy,
    CASE k % 3 WHEN 1 THEN 'too vague' END AS comment_worthy_reason,
    CASE WHEN k % 5 = 1 THEN '' WHEN k % 5 = 2 THEN chr(9) || chr(10)
         WHEN k % 5 > 2 THEN title || chr(10) || selftext END AS public_draft,
    CASE WHEN k % 2 = 0 THEN 'Hello ' || author END AS dm_draft,
    CASE WHEN k % 3 = 0 THEN k % 5 = 3 END AS mention_allowed,
    """ + "(%STATUSES%)[k % 6 + 1]" + """ AS status, k % 7 = 0 AS sent,
    CASE WHEN k % 7 = 0 THEN '2024-01-31 10:00' END AS sent_date
  FROM numbered_posts)""").replace("%STATUSES%", sql_list(STATUS_BY_REMAINDER)).replace("%TRIGGERS%", sql_list(MORE_TRIGGERS))

PENDING = "coalesce(comment_worthy, false) AND regexp_matches(coalesce(public_draft, ''), '\\S') AND NOT coalesce(sent, false)"


def stored_sql(label: str) -> str:
    return f"""stored AS (
  SELECT DISTINCT post_id FROM leads WHERE seq IN (SELECT doc_id FROM labels WHERE {label} = 1))"""


def triage_sql(dictionary, needles, source="posts") -> str:
    """Verdicts of ``source`` as the table ``classified``."""
    cases = " ".join(f"WHEN contains(t, '{needle}') THEN '{code}'" for needle, code in needles.items())
    return f"""matched AS (
  SELECT *, list_filter({sql_list(dictionary.texts("trigger"))}, lambda w: contains(t, w)) AS trig,
    list_filter({sql_list(dictionary.texts("exclude"))}, lambda w: contains(t, w)) AS excl,
    CASE {cases} END AS named
  FROM (SELECT *, lower(title || ' ' || selftext) AS t FROM {source})),
judged AS (
  SELECT *, CASE WHEN author = '[deleted]' THEN 'deleted_author' WHEN len(excl) > 0 THEN 'excluded'
    WHEN len(trig) = 0 THEN 'no_trigger' ELSE 'passed' END AS verdict FROM matched),
classified AS (
  SELECT *, CASE WHEN verdict = 'excluded' THEN 'excluded: ' || array_to_string(excl[1:3], ', ') ELSE verdict END AS reason,
    CASE WHEN verdict = 'passed' THEN trig ELSE [] END AS triggers,
    CASE WHEN verdict IN ('passed', 'excluded') THEN excl ELSE [] END AS excludes,
    CASE WHEN verdict = 'passed' THEN named END AS language
  FROM judged)"""
