"""The search index against scores worked out post by post, and what a search reads."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from postsift.operators.search_index import SearchIndex
from postsift.session import shared_dir

POSTS = "seq long, title string, selftext string"


def brute(posts, query, k, every, phrase):
    words = {seq: re.findall(r"[^\W_]+", f"{title} {body}".lower()) for seq, title, body in posts}
    said = re.findall(r"[^\W_]+", query.lower())
    average = sum(map(len, words.values())) / len(words) or 1
    rows = []
    for seq, own in words.items():
        held = [t for t in sorted(set(said)) if t in own]
        beside = any(own[i: i + len(said)] == said for i in range(len(own)))
        if not held or (every and len(held) < len(set(said))) or (phrase and not beside):
            continue
        score = 0.0
        for t in held:
            n, df = own.count(t), sum(t in w for w in words.values())
            score += math.log(1 + (len(words) - df + 0.5) / (df + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(own) / average))
        rows.append((seq, round(score, 9)))
    return sorted(rows, key=lambda r: (-r[1], r[0]))[:k]


@pytest.fixture(scope="module")
def held(spark):
    rng = random.Random(5)
    words = ["the"] * 30 + ["of"] * 10 + [f"w{i}" for i in range(40)] + ["Übung", "it's", "3d"]
    posts = [(i * 7, " ".join(rng.choices(words, k=rng.choice([1, 4, 9]))), " ".join(rng.choices(words, k=rng.choice([0, 5, 60])))) for i in range(500)]
    posts += [(4001, "", ""), (4002, "the the the", ""), (4003, "the the the", "")]
    index = SearchIndex(spark, shared_dir(spark, "search"), buckets=8, block=64)
    index.add(spark.createDataFrame(posts[:200], POSTS), "a")
    index.add(spark.createDataFrame(posts[:250], POSTS), "a")  # the same part again, with more posts
    index.add(spark.createDataFrame(posts[250:], POSTS), "b")
    return index, posts


@pytest.mark.parametrize("query, k, every, phrase", [
    ("the w3", 10, True, False), ("the w3 of", 40, False, False), ("the", 7, True, False), ("the of", 9, True, True),
    ("the the", 600, True, True), ("ÜBUNG, w1", 5, False, False), ("nowhere the", 5, True, False), ("nowhere", 5, False, False), (" - ", 5, True, False)])
def test_against_every_post(held, query, k, every, phrase):
    index, posts = held
    got = [(r.seq, round(r.score, 9)) for r in index.search(query, k, every, phrase).collect()]
    want = brute(posts, query, k, every, phrase)
    assert [g[0] for g in got] == [w[0] for w in want] and all(abs(g[1] - w[1]) < 1e-6 for g, w in zip(got, want))


def test_a_search_reads_its_own_terms_and_the_best_blocks(held):
    index, _ = held
    plan = index.postings(["w3"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1][:120]
    assert "term" in plan.split("PushedFilters: [")[1][:200]
    assert {r.term for r in index.postings(["w3", "of"]).select("term").distinct().collect()} == {"w3", "of"}


def test_an_empty_index(spark):
    index = SearchIndex(spark, shared_dir(spark, "search"))
    assert index.search("the", 3).collect() == []
    index.add(spark.createDataFrame([], POSTS), "none")
    assert index.search("the", 3).collect() == [] and index.stats() == (0, 1.0)


def test_posts_are_shuffled_once_and_packed(spark):
    """The rows of the index come from one exchange, whatever the posts come from."""
    index = SearchIndex(spark, shared_dir(spark, "search"), buckets=4, block=64)
    rows = index.rows(spark.createDataFrame([(-70, "a b", "a"), (5, "b", "b c"), (6, None, "a")], POSTS))
    plan = rows._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("Exchange") == 1 and "ObjectHashAggregate" in plan.split("Exchange")[0]
    got = {(r.term, r.block): [(p.seq, p.n, p.length, p.places) for p in r.posts] for r in rows.collect()}
    assert got == {("a", -2): [(-70, 2, 3, [0, 2])], ("b", -2): [(-70, 1, 3, [1])], ("b", 0): [(5, 2, 3, [0, 1])], ("c", 0): [(5, 1, 3, [2])]}


@pytest.mark.parametrize("words_at_once", [1, 7, 2_000_000])
def test_pieces_and_repeated_posts(spark, monkeypatch, words_at_once):
    """Posts of one batch in pieces of any size; one that comes twice is one post with all its words."""
    import pyarrow as pa

    from postsift.operators import search_index as si

    monkeypatch.setattr(si, "_WORDS_AT_ONCE", words_at_once)
    texts = [(3, ["x", "y", "x"]), (9, []), (None, ["y"]), (130, ["x"]), (3, ["x", "y", "x"]), (4, None)]
    batch = pa.RecordBatch.from_arrays([pa.array([t[0] for t in texts], pa.int64()), pa.array([t[1] for t in texts], pa.list_(pa.string()))], ["seq", "words"])
    packed = [tuple(r.values()) for b in si._inverted(64)(iter([batch])) for r in b.to_pylist()]
    rows = spark.createDataFrame(packed, si._PACKED).groupBy("term", "block").agg(F.flatten(F.collect_list("posts")).alias("p"))
    got = {(r.term, r.block): [(p.seq, p.n, p.length, p.places) for p in r.posts]
           for r in rows.select("term", "block", si._whole(F.col("p")).alias("posts")).collect()}
    assert got == {("x", 0): [(3, 4, 3, [0, 0, 2, 2])], ("y", 0): [(3, 2, 3, [1, 1])], ("x", 2): [(130, 1, 1, [0])], ("y", None): [(None, 1, 1, [0])]}
