"""Terms joined as a table against a plain substring test and the automaton."""

import random

import pytest
from pyspark.sql import functions as F

from postsift.functions.matching import with_matches
from postsift.functions.text import full_text
from postsift.operators.term_join import term_matches

POSTS, TERMS = "seq long, title string, selftext string", "kind string, ord int, term string"


def got(spark, posts, terms, **more):
    rows = term_matches(spark.createDataFrame(posts, POSTS), spark.createDataFrame(terms, TERMS), **more).collect()
    return {(r.seq, r.kind): r.terms for r in rows}


@pytest.mark.parametrize("sample", [20_000, 1])
def test_against_substrings(spark, sample):
    """Short, empty, repeated and non-ASCII terms; the sample that q-grams are chosen by changes nothing."""
    rng = random.Random(3)
    letters = "abcdeé 日"
    posts = [(i, "".join(rng.choices(letters, k=rng.choice([0, 2, 30]))).upper(), "".join(rng.choices(letters, k=rng.choice([0, 3, 200])))) for i in range(120)]
    terms = [("trigger", i, "".join(rng.choices(letters, k=rng.choice([1, 2, 3, 4, 5, 6])))) for i in range(300)]
    terms += [("trigger", 300, ""), ("exclude", 0, "ab"), ("exclude", 1, "ab"), ("exclude", 2, None), ("exclude", 3, "never there")]
    want = {}
    for seq, title, body in posts:
        text = f"{title} {body}".lower()
        for kind, _, term in terms:
            if term is not None and term in text:
                want.setdefault((seq, kind), []).append(term)
    assert got(spark, posts, terms, sample=sample) == want


def test_nothing_to_match(spark):
    assert got(spark, [(1, "some", "text")], []) == {} == got(spark, [], [("trigger", 0, "some"), ("trigger", 1, "")])


def test_a_large_table_gives_what_the_automaton_gives(spark):
    rng = random.Random(8)
    syllables = ["ba", "de", "ki", "lo", "mu", "ra", "sen", "tor"]
    word = lambda: "".join(rng.choices(syllables, k=rng.choice([2, 3, 4])))
    posts = spark.createDataFrame([(i, word(), " ".join(word() for _ in range(60))) for i in range(300)], POSTS)
    listed = list(dict.fromkeys(" ".join(word() for _ in range(rng.choice([1, 1, 2]))) for _ in range(30_000)))
    terms = spark.createDataFrame([("trigger", i, t) for i, t in enumerate(listed)], TERMS)
    joined = {r.seq: r.terms for r in term_matches(posts, terms).collect()}
    scanned = with_matches(posts, full_text(), {"trigger": listed}).select("seq", F.col("hits.trigger").alias("terms"))
    assert joined == {r.seq: r.terms for r in scanned.collect() if r.terms}


def test_every_substring_has_its_grams_in_the_text():
    from postsift.operators.term_join import _keys

    text = "aé日b aé😀日b".lower()
    for size in range(6):
        held = set(_keys(text.encode(), size).tolist())
        runs = [text.encode()[i: i + size] for i in range(len(text.encode()) - size + 1)]
        assert len(held) == len(set(runs))
        for low in range(len(text)):
            for high in range(low, len(text) + 1):
                assert set(_keys(text[low:high].encode(), size).tolist()) <= held
    assert _keys(b"", 4).tolist() == [] and _keys(b"abc", 4).tolist() == [] and len(_keys(b"", 0)) == 1


def test_texts_are_cut_once_for_all_sizes(spark):
    """One walk cuts a text into the q-grams of every size."""
    from postsift.operators import term_join as tj

    posts = spark.createDataFrame([(1, "Ab", "c"), (2, None, "x"), (3, "", "")], POSTS)
    held = tj._held(posts, [0, 2, 4])
    assert held._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython") == 1
    assert sorted((r.seq, r.n) for r in held.groupBy("seq").agg(F.count("*").alias("n")).collect()) == [(1, 1 + 3 + 1), (3, 1)]
