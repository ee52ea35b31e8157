"""Queries over sinks, sources and streams: write whole tables, go on writing, and read back."""

from datetime import timedelta

from pyspark.sql import functions as F

from postsift.functions import text as tx
from postsift.operators import counts, enrichment as en, search_index as si, term_join as tj, triage, work_queue as wq
from postsift.plans.triage_run import EVERY, RunOptions, run
from postsift.session import shared_dir, staged
from postsift.sinks.daily_sheet import DailySheet
from postsift.sinks import bucket_store as bs, ledgers as cl
from postsift.sinks.key_index import KeyIndex
from postsift.sinks.lead_store import LeadStore
from postsift.sources import leads as ls, pages as pg, posts as ps
from postsift.streaming import answers as an, late as lt, lifecycle as lc, posts_stream as st, remembered as rm
from workload import checks as ck, tables as tb
from workload.checks import check
from workload.tables import LEADS, POSTS

_FIRST = f"WITH {LEADS}, first AS (SELECT min(seq) AS seq, post_id FROM leads GROUP BY post_id)"
_OUTCOMES = ("saved", "skipped", "filtered")


def _union(parts):
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


@check(f"""WITH {LEADS}, {ck._REQUESTS}, first AS (SELECT min(seq) AS seq, post_id FROM leads GROUP BY post_id),
changes AS (SELECT post_id, arg_max(status, (asked_at, status)) AS new_status FROM requests WHERE status <> 'bogus' GROUP BY post_id)
SELECT l.seq, l.post_id, coalesce(c.new_status, l.status) AS status FROM first f JOIN leads l ON l.seq = f.seq
  LEFT JOIN changes c ON c.post_id = l.post_id""")
def store_compaction(spark, sf):
    """All leads into a store that is opened twice, status changes logged, the current state written anew."""
    base = shared_dir(spark, "compaction")
    store = LeadStore(spark, f"{base}/v1")
    store.append(tb.leads(spark, sf), "r1")
    store = LeadStore(spark, f"{base}/v1")
    store.record(wq.status_changes(store.stored(), tb.status_requests(spark, sf)))
    return store.compact(f"{base}/v2").stored().select("seq", "post_id", "status")


@check(f"""{_FIRST} SELECT 1 AS step, (SELECT count(*) FROM first) AS saved, count(*) - (SELECT count(*) FROM first) AS skipped,
  0::BIGINT AS filtered FROM leads UNION ALL SELECT 2, 0, 1, 0""")
def append_one(spark, sf):
    """All leads, then the last one once more by itself."""
    store, rows = LeadStore(spark, shared_dir(spark, "append-one")), tb.leads(spark, sf)
    last = rows.agg(F.max("seq")).first()[0]
    steps = [store.append(rows, "r1"), store.append(rows.where(F.col("seq") == last), "r2")]
    return _union([s.select(F.lit(i + 1).alias("step"), *_OUTCOMES) for i, s in enumerate(steps)])


@check(f"""{_FIRST} SELECT 1 AS step, (SELECT count(*) FROM first) AS saved, count(*) - (SELECT count(*) FROM first) AS skipped,
  0::BIGINT AS filtered FROM leads UNION ALL SELECT 2, 0, 1, 0""")
def sheet_append_one(spark, sf):
    """The ungated form of the sheet: all leads, then the last one once more by itself."""
    sheet, rows = DailySheet(spark, shared_dir(spark, "sheet-one")), tb.leads(spark, sf)
    last = rows.agg(F.max("seq")).first()[0]
    steps = [sheet.append(rows, tb.AS_OF, "r1", gated=False),
             sheet.append(rows.where(F.col("seq") == last), tb.AS_OF, "r2", gated=False)]
    return _union([s.select(F.lit(i + 1).alias("step"), *_OUTCOMES) for i, s in enumerate(steps)])


@check(f"""WITH {LEADS} SELECT 'Leads-2024-03-0' || (1 + seq % 2) AS name, count(DISTINCT post_id) AS n_rows FROM leads GROUP BY 1""")
def sheet_rollover(spark, sf):
    """Leads of two days on two sheets, listed with their rows."""
    sheet, rows = DailySheet(spark, shared_dir(spark, "rollover")), tb.leads(spark, sf)
    for day in (0, 1):
        sheet.append(rows.where(F.col("seq") % 2 == day), f"2024-03-0{day + 1} 09:00:00", f"r{day}", gated=False)
    sizes = sheet.read().groupBy(F.col("sheet_date").alias("name")).agg(F.count("*").alias("n_rows"))
    return sheet.list_sheets().select("name").join(sizes, "name")


# Of the sample's seven posts those that are not among the given ones by id, which is all of them.
@check(f"""WITH {POSTS}, one AS (SELECT count(*) AS n_posts, CAST(sum(seq) AS BIGINT) AS seqs FROM posts)
SELECT source, n_posts + more AS n_posts, seqs + CASE WHEN more > 0 THEN 28 ELSE 0 END AS seqs
FROM one, (VALUES ('path', 0), ('rows', 0), ('view', 0), ('sample', 7), ('nothing', 7)) AS s(source, more)""")
def open_source(spark, sf):
    """The same posts named as a path, as rows and as a view; and the sample, named or not, beside them."""
    posts, path = tb.posts(spark, sf), shared_dir(spark, "posts")
    posts.write.parquet(path)
    posts.createOrReplaceTempView("posts_to_open")
    sources = {"path": path, "rows": posts, "view": "posts_to_open"}
    opened = {name: ps.open_posts(spark, source) for name, source in sources.items()}
    given = opened["path"].select("id", "seq")
    for name, source in (("sample", "sample"), ("nothing", None)):
        own = ps.open_posts(spark, source).select("id", "seq").join(given, "id", "left_anti")
        opened[name] = given.unionByName(own)
    return _union([
        rows.agg(F.count("*").alias("n_posts"), F.sum("seq").alias("seqs")).withColumn("source", F.lit(name))
        for name, rows in opened.items()])


@check(f"WITH {POSTS} SELECT seq, subreddit FROM posts WHERE subreddit IN ('src1', 'src3')")
def community_list(spark, sf):
    names = ps.parse_communities(" SRC1, ,src3,", ["src9"])
    return ps.in_communities(tb.posts(spark, sf), names).select("seq", "subreddit")


_PASSED = f"""{ck.TRIAGE}, tot AS (SELECT count(*) AS n, count(DISTINCT id) AS posts FROM classified WHERE verdict = 'passed')"""


def _options(run_id, **more):
    return RunOptions(as_of=tb.AS_OF, run_id=run_id, communities=EVERY, dictionary=ck.SMALL, needles=ck.NEEDLES, **more)


@check(f"""{_PASSED} SELECT true AS gated, n AS leads_found, 0::BIGINT AS leads_saved, 0::BIGINT AS leads_skipped, n AS leads_filtered FROM tot
UNION ALL SELECT false, n, posts, n - posts, 0 FROM tot""")
def unscored_gate(spark, sf):
    """Scoring asked for with no scorer at hand: the gate filters all, or is left out."""
    base, parts = shared_dir(spark, "unscored"), []
    for gated in (True, False):
        row = run(tb.raw_posts(spark, sf), LeadStore(spark, f"{base}/{gated}"),
                  _options("r1", analyse=True, gate_when_unscored=gated))
        parts.append(row.select(F.lit(gated).alias("gated"), "leads_found", "leads_saved", "leads_skipped", "leads_filtered"))
    return _union(parts)


@check(f"""{_PASSED} SELECT n AS leads_found, posts AS leads_saved, n - posts AS leads_skipped, n AS sheet_filtered FROM tot""")
def retry_early_dedupe(spark, sf):
    """A run that stopped before its sheet, repeated with early de-duplication."""
    base = shared_dir(spark, "retry")
    store, sheet = LeadStore(spark, f"{base}/store"), DailySheet(spark, f"{base}/sheet")
    run(tb.raw_posts(spark, sf), store, _options("r1"))
    again = run(tb.raw_posts(spark, sf), store, _options("r1", dedupe_early=True), sheet)
    return again.select("leads_found", "leads_saved", "leads_skipped", "sheet_filtered")


@check(f"WITH {LEADS} SELECT min(seq) AS seq, post_id FROM leads WHERE signal_score >= 10 GROUP BY post_id")
def repeated_run(spark, sf):
    """One run twice, the second time with a higher gate: its second result stands."""
    store, rows = LeadStore(spark, shared_dir(spark, "repeated")), tb.leads(spark, sf)
    for gate in (8, 10):
        store.append(rows, "r1", gate)
    return store.stored().select("seq", "post_id")


@check(f"{ck._WORTHY} SELECT seq, worthy AS comment_worthy, reason AS comment_worthy_reason FROM judged")
def answers_twice(spark, sf):
    """Every answer delivered twice."""
    answers = tb.worthy_answers(spark, sf)
    rows = en.apply_worthiness(tb.leads(spark, sf), answers.union(answers))
    return rows.select("seq", "comment_worthy", "comment_worthy_reason")


@check(f"""WITH {LEADS} SELECT seq, model, model = 'alpha-1' AS json_mode FROM leads, (VALUES ('alpha-1'), ('beta-1')) AS m(model)""")
def json_mode_requests(spark, sf):
    """The same requests to two models, of which one family knows JSON mode."""
    rows = en.score_requests(tb.leads(spark, sf), "{title}")
    return _union([en.for_model(rows, model, "alpha").select("seq", "model", "json_mode") for model in ("alpha-1", "beta-1")])


@check(f"""WITH {LEADS} SELECT 'public:' || seq AS request_id, 'beta-1' AS model, CASE WHEN coalesce(mention_allowed, false)
  THEN title || ' ' || ['one', 'two', 'three'][('0x' || substr(md5(post_id || ':pick'), 1, 8))::BIGINT % 10000 % 3 + 1] ELSE title END AS prompt
FROM leads WHERE comment_worthy""")
def draft_mentions(spark, sf):
    """Draft requests with a model and one of three mention texts drawn by post id."""
    templates = {"public": "{title}", "public_mention": "{title} {mention}", "dm": "{title}"}
    rows = en.draft_requests(tb.leads(spark, sf), templates, model="beta-1", mentions=("one", "two", "three"))
    return rows.where("kind = 'public'").select("request_id", "model", "prompt")


@check("""SELECT count(*) FILTER (event_type <> 'error') AS succeeded, count(*) AS runs FROM events""")
def run_successes(spark, sf):
    """Events as a log of runs: how many ended well."""
    return counts.run_counts(tb.events(spark, sf).select((F.col("event_type") != "error").alias("success")))


@check(f"WITH {LEADS} SELECT seq, CAST(length(title) % 11 AS INTEGER) AS signal_score FROM leads")
def pluggable_scorer(spark, sf):
    """A caller's scorer over Arrow batches."""
    def score(batches):
        for batch in batches:
            batch["signal_score"] = (batch["title"].str.len() % 11).astype("int32")
            yield batch

    rows = tb.leads(spark, sf).select("seq", "title", "signal_score")
    return en.with_scorer(rows, score, rows.schema).select("seq", "signal_score")


@check(f"WITH {POSTS} SELECT seq, id FROM posts")
def stream_trigger(spark, sf):
    """Posts that a stream takes with the trigger for what is there."""
    return st.to_table(ck._stream(spark, sf).select("seq", "id"), "trigger")


@check(f"{ck.TRIAGE} SELECT DISTINCT id AS post_id FROM classified WHERE verdict = 'passed'")
def stream_two_checkpoints(spark, sf):
    """Two streams, each with its own checkpoint, into one store."""
    base = shared_dir(spark, "two-streams")
    store = LeadStore(spark, f"{base}/store")
    for half in (0, 1):
        posts = ck._stream(spark, sf).where(F.col("seq") % 2 == half)
        leads = triage.to_leads(triage.classify(posts, ck.SMALL, ck.NEEDLES), tb.AS_OF)
        st.start_sinks(leads, f"{base}/checkpoint-{half}", store=store).awaitTermination()
    return store.stored().select("post_id")


_HITS = " + ".join(
    f"(CASE WHEN list_has_any(list_concat(trig, excl), {tb.sql_list(ck.WIDE.with_signal(signal))}) THEN {points} ELSE 0 END)"
    for signal, points in en.RUBRIC_POINTS.items())


@check(f"""{ck.TRIAGE_WIDE} SELECT seq, CAST(greatest(1, least(10, 5 + {_HITS})) AS INTEGER) AS signal_score
FROM matched WHERE author <> '[deleted]' AND len(trig) > 0""")
def rubric_with_excludes(spark, sf):
    """The rubric where posts with exclude terms are kept, so a wish for something free costs its points."""
    rows = triage.classify(tb.posts(spark, sf), ck.WIDE, ck.NEEDLES, exclude_on_match=False).where("passed")
    return en.rubric(rows, ck.WIDE, ("matched_triggers", "matched_excludes")).select("seq", "signal_score")


@check(f"""WITH {ck._ANSWERS}, {ck._JSON} SELECT seq, signal_score, CASE WHEN needs_retry THEN 'unreadable'
  WHEN signal_score IS NULL THEN 'no score' ELSE 'out of range' END AS cause
FROM parsed WHERE needs_retry OR signal_score IS NULL OR signal_score NOT BETWEEN 1 AND 10""")
def score_quarantine(spark, sf):
    parsed = en.parse_score_answers(tb.score_answers(spark, sf))
    return en.quarantined_scores(parsed).select("seq", "signal_score", "cause")


# --- the id index ---------------------------------------------------------------------------------

def _indexed_store(spark, name) -> LeadStore:
    base = shared_dir(spark, name)
    return LeadStore(spark, f"{base}/store", KeyIndex(spark, f"{base}/index", 16, 1024))


@check(f"WITH {LEADS}, {tb.stored_sql('quality')} SELECT seq, post_id FROM leads WHERE post_id NOT IN (SELECT post_id FROM stored)")
def indexed_new_posts(spark, sf):
    """Leads whose post is not stored; the stored ids lie in an index, folded in two steps and merged."""
    index = KeyIndex(spark, f"{shared_dir(spark, 'indexed-posts')}/index", 16, 1024)
    ids = staged(tb.labelled_ids(spark, sf, "quality"), "ids")
    half = F.pmod(F.xxhash64("post_id"), F.lit(2))
    index.add(ids.where(half == 0), "r0")
    index.fold()
    for number in range(2):
        index.add(ids.where(half == number), f"r{number}")
    index.fold()
    index.merge()
    leads = staged(tb.leads(spark, sf).select("seq", "post_id"), "leads")
    return ls.not_stored(leads, index.known(leads))


@check(f"""WITH {LEADS}, firsts AS (SELECT arg_min(seq, (seq % 3, seq)) AS seq, post_id FROM leads
  WHERE signal_score >= 5 GROUP BY post_id)
SELECT seq, post_id, 'r' || seq % 3 AS run_id FROM firsts""")
def indexed_save_outcomes(spark, sf):
    """All leads in three runs into a store with an index; the second run is repeated after it was folded."""
    store, rows = _indexed_store(spark, "indexed-store"), staged(tb.leads(spark, sf), "leads")
    for step, number in enumerate((0, 1, 1, 2)):
        store.append(rows.where(F.pmod("seq", F.lit(3)) == number), f"r{number}", 5)
        if step == 1:
            store.index.fold()
    return store.stored().select("seq", "post_id", "run_id")


# --- streams that remember ------------------------------------------------------------------------

def _in_files(spark, rows, name, parts):
    """``rows`` as a folder of files, one after the other: each is a micro-batch of a stream."""
    path, rows = shared_dir(spark, name), staged(rows, f"{name}-rows")
    for part in parts:
        rows.where(part).coalesce(1).write.mode("append").parquet(path)
    return path, rows.schema


@check(f"""WITH {LEADS}, firsts AS (SELECT arg_min(seq, (seq % 3, seq)) AS seq, post_id FROM leads
  WHERE signal_score >= 5 GROUP BY post_id) SELECT seq, post_id FROM firsts""")
def stream_first_saved(spark, sf):
    """All leads in three micro-batches, the last after a restart; ids are remembered in keyed state."""
    rows = tb.leads(spark, sf).select("seq", "post_id", "signal_score")
    thirds = [F.pmod("seq", F.lit(3)) == n for n in range(3)]
    path, schema = _in_files(spark, rows.where(thirds[0] | thirds[1]), "first-saved", thirds[:2])
    out, checkpoint = shared_dir(spark, "first-saved-out"), shared_dir(spark, "first-saved-checkpoint")

    def go():
        leads = st.post_stream(spark, path, schema, max_files=1)
        rm.first_saved(leads, 5).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).format(
            "parquet").option("path", out).start().awaitTermination()

    go()
    staged(rows.where(thirds[2]), "rest").coalesce(1).write.mode("append").parquet(path)
    go()
    return spark.read.parquet(out).select("seq", "post_id")


_RULES = " ".join(f"WHEN '{status}' THEN asked IN ({', '.join(repr(s) for s in after) or 'NULL'})" for status, after in lc.FOLLOWS.items())
_ASKED = "CASE event_type WHEN 'click' THEN 'contacted' WHEN 'view' THEN 'replied' WHEN 'purchase' THEN 'converted' WHEN 'error' THEN 'ignored' ELSE 'new' END"


@check(f"""WITH RECURSIVE asked AS (SELECT 'u' || user_id AS post_id, {_ASKED} AS asked, ts::TIMESTAMP AS moment FROM events),
numbered AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY post_id ORDER BY moment, asked) AS n FROM asked),
walk AS (
  SELECT post_id, 0::BIGINT AS n, 'new' AS before, NULL::VARCHAR AS asked, NULL::TIMESTAMP AS moment, false AS good, 'new' AS status, NULL::TIMESTAMP AS since,
    false AS was_stale, false AS stale FROM (SELECT DISTINCT post_id FROM asked)
  UNION ALL
  SELECT post_id, n, before, asked, moment, good, CASE WHEN good THEN asked ELSE before END, CASE WHEN good THEN moment ELSE since END, gone, NOT good AND (stale OR gone) FROM (
    SELECT w.post_id, x.n, w.status AS before, x.asked, x.moment, coalesce(CASE w.status {_RULES.replace("asked IN", "x.asked IN")} END, false) AS good, w.since, w.stale,
      w.status IN ('contacted', 'replied') AND NOT w.stale AND x.moment > w.since + INTERVAL 1 DAY AS gone
    FROM walk w JOIN numbered x ON x.post_id = w.post_id AND x.n = w.n + 1)),
ends AS (SELECT post_id, status, since, stale FROM walk QUALIFY n = max(n) OVER (PARTITION BY post_id)),
steps AS (SELECT post_id, before, asked, moment, CASE WHEN good THEN 'applied' ELSE 'refused' END AS outcome FROM walk WHERE n > 0
  UNION ALL SELECT x.post_id, x.before, NULL, p.since + INTERVAL 1 DAY, 'stale' FROM walk x JOIN walk p ON p.post_id = x.post_id AND p.n = x.n - 1 WHERE x.was_stale
  UNION ALL SELECT post_id, status, NULL, since + INTERVAL 1 DAY, 'stale' FROM ends WHERE status IN ('contacted', 'replied') AND NOT stale
    AND since + INTERVAL 1 DAY < (SELECT max(moment) FROM asked) - INTERVAL 2 DAYS)
SELECT post_id, before, asked, strftime(moment, '%Y-%m-%d %H:%M:%S') AS "at", outcome FROM steps""")
def lifecycle_steps(spark, sf):
    """Every event as a status request of its user, in three micro-batches by time: applied, refused and stale."""
    e = tb.events(spark, sf)
    asked = F.when(F.col("event_type") == "click", "contacted").when(F.col("event_type") == "view", "replied").when(
        F.col("event_type") == "purchase", "converted").when(F.col("event_type") == "error", "ignored").otherwise("new")
    rows = e.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("post_id"), asked.alias("status"), F.col("ts").cast("timestamp").alias("at"))
    low, high = rows.agg(F.min("at"), F.max("at")).first()
    a, b = (F.lit(low + (high - low) * share).cast("timestamp") for share in (0.4, 0.7))
    path, schema = _in_files(spark, rows, "lifecycle", [F.col("at") < a, F.col("at").between(a, b) & (F.col("at") < b), F.col("at") >= b])
    done = st.to_table(lc.steps(st.post_stream(spark, path, schema, max_files=1), "2 days", 1), "lifecycle-steps")
    return done.select("post_id", "before", "asked", F.date_format("at", tx.SECONDS_FORMAT).alias("at"), "outcome")


@check(f"""{ck._BATCHED} SELECT DISTINCT batch_no FROM batched WHERE NOT ({ck._USABLE}) OR batch_no % 11 = 5""")
def stream_retries(spark, sf):
    """Batches to be asked again: their answer is missing, unusable or an hour late; others are answered twice."""
    answers = staged(tb.batch_answers(spark, sf), "answers")
    start = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("batch_no") * 60)
    asked = answers.select("batch_no", start.alias("asked_at"))
    delay = F.when(F.col("batch_no") % 11 == 5, 5400).otherwise(120)
    given = answers.where("raw IS NOT NULL").select("batch_no", "raw", F.timestamp_seconds(start.cast("long") + delay).alias("answered_at"))
    twice = given.where("batch_no % 11 > 6").withColumn("answered_at", F.timestamp_seconds(F.col("answered_at").cast("long") + 60))
    # A later sign of life in both streams, so the last requests are not waited for any more.
    end = answers.agg(F.max("batch_no").alias("batch_no")).select(F.timestamp_seconds(F.lit(1_704_067_200 + 864_000) + F.col("batch_no") * 60).alias("at"))
    last = answers.agg(F.max("batch_no")).first()[0] or 0
    parts = [F.col("batch_no").between(0, last // 2), F.col("batch_no") > last // 2, F.col("batch_no") < 0]
    none = F.lit(-1).cast("long").alias("batch_no")
    a_path, a_schema = _in_files(spark, asked.unionByName(end.select(none, F.col("at").alias("asked_at"))), "asked", parts)
    g_path, g_schema = _in_files(spark, given.unionByName(twice).unionByName(
        end.select(none, F.lit("{}").alias("raw"), F.col("at").alias("answered_at"))), "given", parts)
    rows = an.retries(st.post_stream(spark, a_path, a_schema, max_files=1), st.post_stream(spark, g_path, g_schema, max_files=1))
    return st.to_table(rows, "retries").select("batch_no")


@check(f"""{ck.TRIAGE}, timed AS (SELECT *, make_timestamp(created_utc * 1000000) AS moment, date_trunc('hour', make_timestamp(created_utc * 1000000)) AS start FROM classified),
mark AS (SELECT max(moment) - INTERVAL 2 DAYS AS w FROM timed WHERE seq % 2 = 0)
SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS hour, {ck._FUNNEL}, count(*) FILTER (coalesce(seq % 2 = 1 AND start + INTERVAL 1 HOUR <= w, false)) AS late
FROM timed, mark GROUP BY start""")
def late_funnel(spark, sf):
    """The funnel per hour of two micro-batches, the second mostly late; late rows are folded into their hours."""
    rows = ck.small_triage(spark, sf).select("seq", "id", "created_utc", "verdict")
    path, schema = _in_files(spark, rows, "late", [F.col("seq") % 2 == 0, F.col("seq") % 2 == 1])
    funnel = lt.WindowedFunnel(spark, shared_dir(spark, "late-funnel"), delay=timedelta(days=2))
    funnel.start(st.post_stream(spark, path, schema, max_files=1), shared_dir(spark, "late-checkpoint")).awaitTermination()
    return funnel.folded().select(F.date_format("start", tx.SECONDS_FORMAT).alias("hour"), "total", *triage.VERDICTS, "late")


# --- the search index -----------------------------------------------------------------------------

_QUERIES = [("any", "tion with from", False, False), ("all", "that from", True, False), ("phrase", "from the", True, True)]


def _bm25(mode, query, every, phrase):
    said = query.split()
    need = len(set(said)) if every else 1
    held = ", ".join(f"'{t}'" for t in said)
    beside = f"AND contains(' ' || array_to_string(words, ' ') || ' ', ' {query} ')" if phrase else ""
    return f"""SELECT * FROM (SELECT '{mode}' AS mode, seq, CAST(round(sum(idf * n * 2.2::DOUBLE / (n + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / average))) * 1000) AS BIGINT) AS score
  FROM (SELECT seq, word, count(*) AS n FROM spoken WHERE word IN ({held}) GROUP BY seq, word) JOIN worded USING (seq) JOIN rare USING (word), sizes
  WHERE true {beside} GROUP BY seq HAVING count(*) >= {need} ORDER BY sum(idf * n * 2.2::DOUBLE / (n + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * length / average))) DESC, seq LIMIT 50)"""


@check(f"""WITH {POSTS},
worded AS MATERIALIZED (SELECT seq, w AS words, len(w) AS length FROM (SELECT seq, regexp_extract_all(lower(title || ' ' || selftext), '[\\p{{L}}\\p{{N}}]+') AS w FROM posts)),
spoken AS MATERIALIZED (SELECT seq, unnest(words) AS word FROM worded),
sizes AS (SELECT count(*) AS posts_n, sum(length) / count(*) AS average FROM worded),
rare AS (SELECT word, ln(1 + (any_value(posts_n) - count(DISTINCT seq) + 0.5::DOUBLE) / (count(DISTINCT seq) + 0.5::DOUBLE)) AS idf FROM spoken, sizes GROUP BY word)
{' UNION ALL '.join(_bm25(*q) for q in _QUERIES)}""")
def indexed_search(spark, sf):
    """The 50 best posts for three searches, over an index that was added to twice."""
    index = si.SearchIndex(spark, shared_dir(spark, "search-index"), buckets=16, block=4096)
    posts = tb.posts(spark, sf).select("seq", "title", "selftext")
    for number in range(2):
        index.add(posts.where(F.pmod("seq", F.lit(2)) == number), f"p{number}")
    found = [index.search(query, 50, every, phrase).select(F.lit(mode).alias("mode"), "seq", F.round(F.col("score") * 1000).cast("long").alias("score"))
             for mode, query, every, phrase in _QUERIES]
    return _union(found)


# --- the term table -------------------------------------------------------------------------------

@check(f"""{ck.TRIAGE_WIDE} SELECT seq, 'trigger' AS kind, array_to_string(trig, '|') AS terms FROM matched WHERE len(trig) > 0
UNION ALL SELECT seq, 'exclude', array_to_string(excl, '|') FROM matched WHERE len(excl) > 0""")
def term_table_matches(spark, sf):
    """The default dictionary as a table, joined to the posts by q-grams."""
    posts = staged(tb.posts(spark, sf).select("seq", "title", "selftext"), "posts")
    rows = tj.term_matches(posts, ck.WIDE.table(spark))
    return rows.select("seq", "kind", ck.joined("terms").alias("terms"))


# --- ledgers --------------------------------------------------------------------------------------

@check(f"""WITH {LEADS}, {ck._REQUESTS}, first AS (SELECT min(seq) AS seq FROM leads GROUP BY post_id),
changes AS (SELECT post_id, arg_max(status, (asked_at, status)) AS new_status FROM requests WHERE status <> 'bogus' GROUP BY post_id),
kept AS (SELECT l.* REPLACE (coalesce(c.new_status, l.status) AS status) FROM first JOIN leads l USING (seq) LEFT JOIN changes c ON c.post_id = l.post_id)
SELECT 'total' AS dimension, '' AS key, count(*) AS n FROM kept
UNION ALL SELECT 'status', status, count(*) FROM kept WHERE status <> '' GROUP BY status
UNION ALL SELECT 'language', language_detected, count(*) FROM kept WHERE language_detected <> '' GROUP BY language_detected
UNION ALL SELECT 'subreddit', subreddit, count(*) FROM kept WHERE subreddit <> '' GROUP BY subreddit
UNION ALL SELECT 'action', 'total', count(*) FROM kept UNION ALL SELECT 'action', 'comment_worthy', count(*) FILTER (comment_worthy) FROM kept
UNION ALL SELECT 'action', 'sent', count(*) FILTER (sent) FROM kept UNION ALL SELECT 'action', 'pending', count(*) FILTER ({tb.PENDING}) FROM kept""")
def counts_kept(spark, sf):
    """Counts summed from the parts of two runs, one of them repeated, and of two batches of status changes."""
    base = shared_dir(spark, "counts-kept")
    store, ledger = LeadStore(spark, f"{base}/store"), cl.CountLedger(spark, f"{base}/counts")
    firsts = staged(tb.leads(spark, sf), "leads")
    half = firsts.agg(F.max("seq")).first()[0] // 2
    for run_id, part in (("r1", F.col("seq") <= half), ("r2", F.col("seq") > half), ("r2", F.col("seq") > half)):
        store.append(firsts.where(part), run_id)
        ledger.add_run(store.stored().where(F.col("run_id") == run_id).drop("run_id"), run_id)
    requests = tb.status_requests(spark, sf)
    for number in range(2):
        some = requests.where(F.pmod(F.xxhash64("post_id", "at"), F.lit(2)) == number)
        changes = staged(wq.status_changes(store.stored(), some), "changes")
        ledger.add_changes(store.stored().drop("run_id"), store.log(), changes, f"c{number}")
        store.record(changes)
    return ledger.read()


@check(f"""WITH {LEADS} SELECT seq, place, (place - 1) // 5 AS batch_no, CAST((place - 1) % 5 AS INTEGER) AS batch_pos
FROM (SELECT seq, row_number() OVER (ORDER BY seq) AS place FROM leads)""")
def numbers_go_on(spark, sf):
    """All leads in three runs, numbered and batched like one; the last run is repeated."""
    ledger = cl.PositionLedger(spark, shared_dir(spark, "numbers"))
    rows = staged(tb.leads(spark, sf).select("seq"), "leads")
    last = rows.agg(F.max("seq")).first()[0]
    cuts = [-1, last // 3, last // 2, last]
    parts = [rows.where((F.col("seq") > a) & (F.col("seq") <= b)) for a, b in zip(cuts, cuts[1:])]
    numbered = [ledger.number(part, f"r{i}", "place", size=5) for i, part in enumerate(parts)]
    return _union([*numbered[:2], ledger.number(parts[2], "r2", "place", size=5)])


# --- listing pages --------------------------------------------------------------------------------

@check(f"""WITH {POSTS}, wanted AS (SELECT * FROM posts WHERE subreddit IN ('src1', 'src3', 'src5') AND created_utc >= (SELECT avg(created_utc) FROM posts))
SELECT 'batch' AS read_as, seq, id, subreddit, author, num_comments FROM wanted
UNION ALL SELECT 'stream', seq, id, subreddit, author, num_comments FROM wanted""")
def paged_posts(spark, sf):
    """All posts as listing pages, read with filters in batch, and as a stream that stops halfway and goes on."""
    pg.use_pages(spark)
    folder, rows = shared_dir(spark, "pages"), staged(tb.posts(spark, sf), "posts")
    since = rows.agg(F.avg("created_utc")).first()[0]
    wanted = F.col("subreddit").isin("src1", "src3", "src5") & (F.col("created_utc") >= since)
    columns = ["seq", "id", "subreddit", "author", "num_comments"]
    out, checkpoint = shared_dir(spark, "pages-out"), shared_dir(spark, "pages-checkpoint")

    def go():
        posts = spark.readStream.format("listing_pages").option("path", folder).load()
        posts.where(wanted).select(columns).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).format(
            "parquet").option("path", out).start().awaitTermination()

    half = rows.agg(F.max("seq")).first()[0] // 2
    n_pages = staged(pg.write_pages(rows.where(F.col("seq") <= half), folder), "first-pages").count()
    go()
    staged(pg.write_pages(rows.where(F.col("seq") > half), folder, first=n_pages), "more-pages")
    go()
    batch = spark.read.format("listing_pages").option("path", folder).load().where(wanted).select(columns)
    return _union([df.select(F.lit(name).alias("read_as"), *columns) for name, df in (("batch", batch), ("stream", spark.read.schema(batch.schema).parquet(out)))])


# --- leads in buckets -----------------------------------------------------------------------------

@check(f"""WITH {LEADS}, {ck._REQUESTS},
changes AS (SELECT post_id, arg_max(status, (asked_at, status)) AS new_status FROM requests WHERE status <> 'bogus' GROUP BY post_id)
SELECT l.seq, l.post_id, coalesce(c.new_status, l.status) AS status FROM leads l LEFT JOIN changes c ON c.post_id = l.post_id""")
def bucket_compaction(spark, sf):
    """All leads in two batches and their status changes in two, folded in between, and read with one batch still open."""
    store, rows = bs.BucketStore(spark, shared_dir(spark, "buckets"), 8), staged(tb.leads(spark, sf), "leads")
    half = F.pmod("seq", F.lit(2))
    store.append(rows.where(half == 0), 1)
    store.fold()
    store.append(rows.where(half == 1), 2)
    requests = tb.status_requests(spark, sf)
    for number in range(2):
        some = requests.where(F.pmod(F.xxhash64("post_id", "at"), F.lit(2)) == number)
        store.record(wq.status_changes(rows, some), 3 + number)
        if number == 0:
            store.fold()
    return store.read().select("seq", "post_id", "status")
