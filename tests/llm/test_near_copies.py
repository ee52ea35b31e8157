"""The near-duplicate stage against all pairs of shingle sets."""

import random

import numpy as np
import pytest

from postsift.llm import decontaminate, near_dup


def brute(texts):
    """The smallest place of each text's group: all pairs of sets are compared."""
    sets = [decontaminate.shingle_set(t or "") for t in texts]
    places, label = {}, np.arange(len(texts))
    for i, own in enumerate(sets):
        for shingle in own or [None]:
            places.setdefault(shingle, []).append(i)
    common = {}
    for held in places.values():
        for x, i in enumerate(held):
            for j in held[:x]:
                common[i, j] = common.get((i, j), 0) + 1
    linked = [(i, j) for (i, j), n in common.items() if not sets[i] or 5 * n >= 4 * (len(sets[i]) + len(sets[j]) - n)]
    if linked:
        near_dup.unite(label, *np.array(linked).T)
    return label, linked


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def kept(spark, texts, parts=4):
    return sorted(r.doc_id for r in near_dup.keep_first(frame(spark, texts).repartition(parts)).collect())


def changed(rng, body, n):
    out = list(body)
    for at in rng.sample(range(len(body)), n):
        out[at] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def test_stage_keeps_one_of_similar_texts(spark):
    rng, texts = random.Random(6), []
    for _ in range(60):
        body = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([40, 150, 600]))]
        texts += [" ".join(body)] + [changed(rng, body, rng.choice([0, 1, 2, 4, 6]) * len(body) // 200 + 1) for _ in range(4)]
    label, linked = brute(texts)
    assert [1 for i, j in linked if bin((near_dup.fingerprint(texts[i]) ^ near_dup.fingerprint(texts[j])) & (2**64 - 1)).count("1") > near_dup.RADIUS]
    assert kept(spark, texts) == sorted(set(label.tolist()))


@pytest.fixture(scope="module")
def family():
    """600 texts of 400 words, six words changed in each: most pairs are just below the bound."""
    rng = random.Random(1)
    body = [f"w{rng.randrange(5000)}" for _ in range(400)]
    texts = [changed(rng, body, 6) for _ in range(600)]
    return texts, sorted(set(brute(texts)[0].tolist()))


@pytest.mark.parametrize("parts", [1, 60])
def test_a_large_family_loses_no_link(spark, family, parts):
    texts, want = family
    assert 100 < len(want) < 500
    assert kept(spark, texts, parts) == want


def test_a_family_in_many_trees(spark, family):
    """The same over trees of 50 documents, or of few bytes."""
    texts, want = family
    for sizes in ((50, 1 << 30), (1 << 20, 40000)):
        chosen = near_dup.leaders(frame(spark, texts), *sizes)
        assert sorted(r.id for r in chosen.collect()) == want


def test_a_large_group_of_copies_is_one_class(spark):
    rng = random.Random(2)
    body = [f"w{rng.randrange(5000)}" for _ in range(200)]
    texts = [changed(rng, body, 1) for _ in range(300)] + ["other text of its own here"]
    chosen = near_dup.leaders(frame(spark, texts), 20, 1 << 30)
    assert sorted(r.id for r in chosen.collect()) == sorted(set(brute(texts)[0].tolist())) == [0, 300]


def test_rows_that_repeat(spark):
    rows = [(None, "a b c d e f", "x"), (None, "a b c d e f", "y"), (3, "", "x"), (2, None, "x"), (2, None, "x"), (9, "q r s", "x"), (9, "Q R S", "x"), (9, "q r s", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, none string")
    got = near_dup.keep_first(df)
    assert got.columns == df.columns
    assert sorted((r.doc_id or 0, (r.text or "").lower()) for r in got.collect()) == [(0, "a b c d e f"), (2, ""), (9, "q r s")]
    assert near_dup.keep_first(df.limit(0)).collect() == []
