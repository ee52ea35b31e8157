import random

import pytest
from pyspark.sql import functions as F

from postsift import schemas
from postsift.operators import outcomes as oc
from postsift.operators.enrichment import apply_scores
from postsift.operators.lookup import lookup
from postsift.operators.numbering import with_batch, with_position

GOLDEN = [
    (1, "a", 9, "d", "skipped", "skipped"), (2, "a", 3, "d", "skipped", "filtered"),
    (3, "b", 5, "d", "filtered", "filtered"), (4, "b", 9, "d", "saved", "saved"),
    (5, "b", 2, "d", "skipped", "filtered"), (6, "c", None, "d", "filtered", "filtered"),
    (7, "d", 0, "d", "filtered", "filtered"), (8, "e", 7, "d", "filtered", "saved"),
    (9, "f", 9, "", "saved", "filtered"),
]


def make_leads(spark, rows):
    """Leads from (seq, post_id, signal_score, public_draft)."""
    short = spark.createDataFrame(rows, "seq long, post_id string, signal_score int, public_draft string")
    return short.select(*[
        F.col(f.name) if f.name in short.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.LEADS])


def ids(spark, names):
    return spark.createDataFrame([(n,) for n in names], "post_id string")


def test_golden_outcomes(spark):
    leads = make_leads(spark, [row[:4] for row in GOLDEN])
    stored = ids(spark, ["a"])
    store = oc.store_outcomes(leads, stored, 8)
    assert {r.seq: r.outcome for r in store.collect()} == {row[0]: row[4] for row in GOLDEN}
    assert oc.outcome_counts(store).first().asDict() == {"saved": 2, "skipped": 3, "filtered": 4}
    sheet = oc.sheet_outcomes(leads, stored, 7)
    assert {r.seq: r.outcome for r in sheet.collect()} == {row[0]: row[5] for row in GOLDEN}
    assert oc.outcome_counts(sheet).first().asDict() == {"saved": 2, "skipped": 1, "filtered": 6}


def walk(rows, stored, min_score, sheet):
    """The rule row by row."""
    seen, result = set(stored), {}
    for seq, post, score, draft in sorted(rows):
        ok = min_score is None or bool(score and score >= min_score)
        ok = ok and (not sheet or bool(draft))
        if sheet:
            outcome = "filtered" if not ok else "skipped" if post in seen else "saved"
        else:
            outcome = "skipped" if post in seen else "filtered" if not ok else "saved"
        if outcome == "saved":
            seen.add(post)
        result[seq] = outcome
    return result


@pytest.mark.parametrize("seed,min_score", [(1, 8), (2, None), (3, 5)])
def test_outcomes_equal_the_walk_with_a_hot_post(spark, seed, min_score):
    rng = random.Random(seed)
    rows = []
    for seq in range(600):
        post = "hot" if rng.random() < 0.4 else f"p{rng.randint(0, 60)}"
        rows.append((seq, post, rng.choice([None, 0, 2, 5, 7, 8, 9]), rng.choice([None, "", " ", "text"])))
    stored = {"p1", "p7"} | ({"hot"} if seed == 2 else set())
    for partitions in (1, 7):
        leads = make_leads(spark, rows).repartition(partitions)
        store = oc.store_outcomes(leads, ids(spark, stored), min_score)
        assert {r.seq: r.outcome for r in store.select("seq", "outcome").collect()} == walk(rows, stored, min_score, False)
        sheet = oc.sheet_outcomes(leads, ids(spark, stored), min_score)
        assert {r.seq: r.outcome for r in sheet.select("seq", "outcome").collect()} == walk(rows, stored, min_score, True)


def test_hot_rows_are_split_at_run_time(spark):
    """A key with two thirds of the rows: the runtime splits it over several tasks."""
    rows = spark.range(300_000).select(
        F.col("id").alias("seq"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    facts = rows.groupBy("k").agg(F.max(F.length("k")).alias("v"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128k",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = lookup(rows, facts, "k")
        assert out.where(F.col("v") == F.length("k")).count() == 300_000
        out.collect()
        assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_many_hot_keys(spark):
    rows = spark.range(100_000).select(F.col("id").alias("seq"), (F.col("id") % 20_000).cast("string").alias("k"))
    facts = rows.groupBy("k").agg(F.max(F.col("k").cast("int")).alias("v"))
    assert lookup(rows, facts, "k").where(F.col("v") == F.col("k").cast("int")).count() == 100_000


def test_positions_of_sparse_numbers(spark):
    """Numbers over the whole 64-bit range, each in a block of its own."""
    seqs = sorted(random.Random(0).sample(range(-2**63, 2**63, 2**50 + 12_345), 500))
    got = {r.seq: r.position for r in with_position(spark.createDataFrame([(s,) for s in seqs], "seq long")).collect()}
    assert got == {s: i + 1 for i, s in enumerate(seqs)}


def test_one_answer_delivered_twice(spark):
    from postsift.operators import enrichment as en
    leads = make_leads(spark, [(1, "a", None, None), (2, "b", None, None)])
    worthy = spark.createDataFrame([(1, '{"worthy":true}', 1), (1, '{"worthy":false}', 2), (2, None, 1)], "seq long, raw string, arrived int")
    assert {r.seq: r.comment_worthy for r in en.apply_worthiness(leads, worthy).collect()} == {1: False, 2: True}
    batch = spark.createDataFrame([(0, "no"), (0, "no")], "batch_no long, raw string")
    single = spark.createDataFrame([(1, '{"score":3}'), (1, '{"score":3}')], "seq long, raw string")
    got = sorted((r.seq, r.signal_score) for r in en.apply_batch_scores(leads, batch, single).collect())
    assert got == [(1, 3), (2, None)]


def test_null_key_finds_nothing(spark):
    leads = make_leads(spark, [(1, None, 9, "d"), (2, None, 9, "d")])
    assert [r.outcome for r in oc.store_outcomes(leads, ids(spark, []), 8).collect()] == ["saved", "saved"]


def test_last_score_of_an_id_wins(spark):
    leads = make_leads(spark, [(1, "a", None, None), (2, "b", None, None), (3, "a", None, None)])
    scores = spark.createDataFrame(
        [("a", 0, 3, "LOW", "x"), ("a", 5, None, "HIGH", "y"), ("c", 1, 9, "HIGH", "z")],
        "post_id string, pos int, signal_score int, signal_type string, category string")
    got = {r.seq: (r.signal_score, r.signal_type) for r in apply_scores(leads, scores).collect()}
    assert got == {1: (None, "HIGH"), 2: (None, None), 3: (None, "HIGH")}


@pytest.mark.parametrize("block", [1, 3, 7, 100_000])
def test_positions_and_batches(spark, block):
    seqs = sorted(random.Random(block).sample(range(-50, 5000), 101))
    df = spark.createDataFrame([(s,) for s in seqs], "seq long").repartition(5)
    got = {r.seq: r.position for r in with_position(df, block=block).collect()}
    assert got == {s: i + 1 for i, s in enumerate(seqs)}
    batches = {r.seq: (r.batch_no, r.batch_pos) for r in with_batch(df, 5, block=block).collect()}
    assert batches == {s: (i // 5, i % 5) for i, s in enumerate(seqs)}


def test_gates(spark):
    leads = make_leads(spark, [(1, "a", None, None), (2, "b", 0, ""), (3, "c", 8, " ")])
    assert [r.seq for r in oc.high_signal(leads, 0).collect()] == [2, 3]
    assert [r.seq for r in leads.where(oc.score_gate(0)).collect()] == [3]
    assert leads.where(oc.score_gate(None)).count() == 3
    assert [r.seq for r in leads.where(oc.draft_gate()).collect()] == [3]
