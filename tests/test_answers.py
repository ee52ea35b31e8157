import pytest
from pyspark.sql import functions as F

from postsift.functions import jsontext as js
from postsift.functions.sampling import chosen, pick
from postsift.operators import enrichment as en
from test_outcomes import make_leads

ANSWERS = [
    ('{"score":9,"signal_type":"HIGH","category":"Practice Gap"}', None, 9, "HIGH", "Practice Gap", False),
    ('of course\n```json\n{"score":4}\n```\nbye', '{"score":4}', 4, "MEDIUM", "General Learning", False),
    ('```\n[1]``` and ```{"score":4}```', "[1]", None, None, None, True),
    ('sure: {"score":null} bye', '{"score":null}', None, "MEDIUM", "General Learning", False),
    ("{}", None, 5, "MEDIUM", "General Learning", False),
    ("no json here", None, None, None, None, True),
    ("", None, None, None, None, True),
    (None, None, None, None, None, True),
    (" \t\n", "", None, None, None, True),
    ('{"score":9} trailing', None, None, None, None, True),
    ('{"score":9}, {"score":8}', None, None, None, None, True),
    ('a {"score":1}] b]', '{"score":1}] b]', None, None, None, True),
    ("{'score':9}", None, None, None, None, True),
    ('{"score":"7","category":null}', None, 7, "MEDIUM", None, False),
    ('{"score":1,"score":2}', None, 2, "MEDIUM", "General Learning", False),
    ('{"score":"many"}', None, None, "MEDIUM", "General Learning", False),
]


def test_single_answers(spark):
    df = spark.createDataFrame([(i, a[0]) for i, a in enumerate(ANSWERS)], "seq long, raw string")
    rows = {r.seq: r for r in en.parse_score_answers(df).collect()}
    for i, (raw, extracted, score, kind, category, retry) in enumerate(ANSWERS):
        row = rows[i]
        assert (row.signal_score, row.signal_type, row.category, row.needs_retry) == (score, kind, category, retry), raw
        assert row.extracted == (raw if extracted is None else extracted), raw


BATCHES = {
    0: ('[{"id":"a","score":8},{"id":"b"},{"id":"a","score":2}]', True),
    1: ('[{"id":"a","score":8},5]', False),
    2: ('{"id":"a"}', False),
    3: ("{}", True), 4: ("[]", True), 5: ('""', True), 6: ("null", False), 7: ("7", False), 8: ("oops", False),
    9: (None, False), 10: ('[{"id":5,"score":8}]', True),
}


def test_batch_answers(spark):
    answers = spark.createDataFrame([(n, raw) for n, (raw, _) in BATCHES.items()], "batch_no long, raw string")
    batches = answers.select("batch_no").union(spark.createDataFrame([(11,)], "batch_no long"))
    retry = {r.batch_no for r in en.retry_batches(batches, answers).collect()}
    assert retry == {n for n, (_, good) in BATCHES.items() if not good} | {11}
    items = {r.batch_no: r["items"] for r in en.parse_batch_answers(answers).collect()}
    assert [(i.id, i.signal_score) for i in items[0]] == [("a", 8), ("b", 5), ("a", 2)]
    assert [(i.id, i.signal_score) for i in items[10]] == [(None, 8)]


def test_last_item_of_an_id_wins(spark):
    leads = make_leads(spark, [(1, "a", 1, None), (2, "b", 1, None), (3, "c", 1, None), (4, "a", 1, None)])
    answers = spark.createDataFrame([(0, BATCHES[0][0])], "batch_no long, raw string")
    got = {r.seq: r.signal_score for r in en.apply_batch_scores(leads, answers).collect()}
    assert got == {1: 2, 2: 5, 3: None, 4: 2}


def test_singles_fill_only_unusable_batches(spark):
    leads = make_leads(spark, [(i, f"p{i}", None, None) for i in range(7)])
    answers = spark.createDataFrame([(0, '[{"id":"p1","score":6}]'), (1, "oops")], "batch_no long, raw string")
    singles = spark.createDataFrame([(0, '{"score":9}'), (5, '{"score":3}')], "seq long, raw string")
    got = {r.seq: r.signal_score for r in en.apply_batch_scores(leads, answers, singles).collect()}
    assert got == {0: None, 1: 6, 2: None, 3: None, 4: None, 5: 3, 6: None}


def test_batch_requests_hold_five_posts_in_order(spark):
    leads = make_leads(spark, [(i * 10, f"p{i}", None, None) for i in range(12)]).withColumns({
        "title": F.lit('quote " and \n'), "body": F.repeat(F.lit("x"), F.lit(700)),
        "matched_triggers": F.array(*[F.lit(str(i)) for i in range(7)])})
    rows = {r.batch_no: r for r in en.batch_requests(leads).collect()}
    assert [rows[b].n_posts for b in range(3)] == [5, 5, 2]
    import json
    posts = json.loads(rows[1].posts_json)
    assert [p["id"] for p in posts] == ["p5", "p6", "p7", "p8", "p9"]
    assert len(posts[0]["body"]) == 500 and posts[0]["triggers"] == "0, 1, 2, 3, 4" and posts[0]["title"] == 'quote " and \n'


WORTHY = [
    ('{"worthy":true,"reason":"r"}', True, "r"), ('{"worthy":false}', False, en.REASON_ABSENT),
    ('{"worthy":null,"reason":null}', None, None), ('{"worthy":"yes"}', True, en.REASON_ABSENT),
    ('{"worthy":0}', None, en.REASON_ABSENT), ('{"worthy":[]}', None, en.REASON_ABSENT),
    ("", True, en.REASON_NO_ANSWER), (None, True, en.REASON_NO_ANSWER), ("maybe", True, en.REASON_UNREADABLE),
    ("[true]", True, en.REASON_OTHER),
]


def test_worthiness(spark):
    leads = make_leads(spark, [(i, f"p{i}", 9, None) for i in range(len(WORTHY) + 1)])
    answers = spark.createDataFrame([(i, w[0]) for i, w in enumerate(WORTHY)], "seq long, raw string")
    judged = en.apply_worthiness(leads, answers)
    rows = {r.seq: (r.comment_worthy, r.comment_worthy_reason) for r in judged.collect()}
    assert rows == {**{i: w[1:] for i, w in enumerate(WORTHY)}, len(WORTHY): (True, en.REASON_NO_ANSWER)}
    assert en.unworthy_count(judged).first().unworthy == 1
    off = en.apply_worthiness(leads, None).first()
    assert (off.comment_worthy, off.comment_worthy_reason) == (True, en.REASON_OFF)


def test_drafts(spark):
    leads = make_leads(spark, [(1, "a", 9, None), (2, "b", 9, None), (3, "c", 9, None)]).withColumns({
        "title": F.lit("{body}"), "body": F.lit("b"), "subreddit": F.lit("s"),
        "comment_worthy": F.when(F.col("seq") == 1, True).when(F.col("seq") == 2, False),
        "mention_allowed": F.col("seq") == 1})
    templates = {"public": "{title}", "public_mention": "{{x}} {category} {title}", "dm": "{category}, {language}"}
    rows = {r.request_id: r for r in en.draft_requests(leads, templates).collect()}
    assert set(rows) == {"public:1", "dm:1"}
    assert rows["public:1"].prompt == "{x} General Learning {body}"
    assert rows["dm:1"].prompt == "language learning challenges, a new language"
    assert (rows["public:1"].max_tokens, rows["dm:1"].max_tokens) == (500, 200)
    assert en.draft_requests(leads, templates, require_worthy=False).count() == 6
    answers = spark.createDataFrame([(1, "public", "hello"), (1, "dm", "hi")], "seq long, kind string, text string")
    drafted = {r.seq: (r.public_draft, r.dm_draft) for r in en.apply_drafts(leads, answers).collect()}
    assert drafted == {1: ("hello", "hi"), 2: (None, None), 3: (None, None)}


@pytest.mark.parametrize("triggers,score,kind,category", [
    (["new job", "too shy", "worth paying"], 10, "HIGH", "Speaking Anxiety"),
    (["new job"], 8, "HIGH", "Immersion Prep"), (["too shy"], 7, "MEDIUM", "Speaking Anxiety"),
    (["for free"], 1, "LOW", "General Learning"), (["for free", "new job"], 3, "LOW", "Immersion Prep"),
    ([], 5, "MEDIUM", "General Learning"), (["plateau", "b1", "b2"], 7, "MEDIUM", "Plateau Frustration"),
])
def test_rubric(spark, triggers, score, kind, category):
    leads = make_leads(spark, [(1, "a", None, None)]).withColumn(
        "matched_triggers", F.array(*[F.lit(t) for t in triggers]).cast("array<string>"))
    row = en.rubric(leads).first()
    assert (row.signal_score, row.signal_type, row.category) == (score, kind, category)


def test_scorer_plugs_in(spark):
    leads = make_leads(spark, [(i, f"p{i}", None, None) for i in range(10)])

    def scorer(batches):
        for pdf in batches:
            yield pdf.assign(signal_score=pdf["seq"] % 3)[["seq", "signal_score"]]

    rows = en.with_scorer(leads, scorer, "seq long, signal_score int").collect()
    assert {r.seq: r.signal_score for r in rows} == {i: i % 3 for i in range(10)}


def test_draws_repeat_and_match_the_rate(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("k"))
    share = keys.agg(F.avg(chosen(F.col("k"), 0.2).cast("int"))).first()[0]
    assert abs(share - 0.2) < 0.02
    picks = [r["n"] for r in keys.groupBy(pick(F.col("k"), 5).alias("p")).agg(F.count("*").alias("n")).collect()]
    assert len(picks) == 5 and min(picks) > 3600
    again = keys.repartition(9).agg(F.avg(chosen(F.col("k"), 0.2).cast("int"))).first()[0]
    assert share == again


def test_envelope_and_json_mode(spark):
    df = spark.createDataFrame([
        ('{"candidates":[{"content":{"parts":[{"text":"hi"}]}}]}',), ('{"candidates":[]}',), ("{}",), ("broken",), (None,)], "raw string")
    assert [r[0] for r in df.select(js.envelope_text(F.col("raw"))).collect()] == ["hi", None, None, None, None]
    modes = spark.createDataFrame([("gem-x",), ("other",)], "model string")
    assert [r[0] for r in modes.select(en.json_mode(F.lit(True), F.col("model"), "gem")).collect()] == [True, False]
