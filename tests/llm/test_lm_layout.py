"""What the language model learns: the same however the table is split, and more than the counts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from postsift.llm import lm_score, queries


@pytest.fixture(scope="module")
def docs(spark):
    return queries.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")


def per_token(docs):
    rows = lm_score.scores(docs).where("held_out")
    return rows.agg(F.sum("base_score") / F.sum("n_tokens"), F.sum("score") / F.sum("n_tokens")).first()


def test_scores_do_not_depend_on_partitions(docs):
    base, one = per_token(docs.repartition(1))
    again, many = per_token(docs.repartition(50))
    assert base == pytest.approx(again) and one == pytest.approx(many, abs=1e-6)
    assert one > base + 0.01


def test_pieces_and_rounds_keep_what_is_learnt(docs, monkeypatch):
    """Pieces of a tenth of the corpus, averaged, still learn from one another."""
    base, whole = per_token(docs)
    monkeypatch.setattr(lm_score.train, "__defaults__", (40_000, 2))
    _, small = per_token(docs)
    assert small - base > 0.2 * (whole - base) > 0


def test_known_words_have_no_cliff(spark, monkeypatch):
    """More words of one count than may be known: those with small hashes are, about as many as may be."""
    monkeypatch.setattr(lm_score, "KNOWN", 100)
    counts = spark.createDataFrame([(f"w{i}".encode(), 1) for i in range(1000)] + [(b"often", 7000), (b"very", 9000)], "word binary, n long")
    corpus = lm_score.Corpus(counts, 3)
    assert 60 < len(corpus.vocabulary) < 140 and corpus.vocabulary.n_heads == min(lm_score.HEADS, len(corpus.vocabulary))
    assert {b"often", b"very"} <= set(corpus.vocabulary) and corpus.tokens == 3 + 1000 + 16000


def test_probabilities_over_all_words_sum_to_one(spark):
    """Brute force over one context: every word's class probability times its share, and the unknown ones' rest."""
    words = [b"a", b"b", b"c", b"dd", b"xdd", b"e"]
    counts = spark.createDataFrame([(w, 5 - i if i < 5 else 1) for i, w in enumerate(words)], "word binary, n long")
    corpus = lm_score.Corpus(counts, 2)
    model, known = corpus.model, corpus.vocabulary
    classes = np.arange(known.size, dtype=np.int32)
    logs = np.array([model.log_probs(np.array([c], np.int32), np.array([1]))[0] for c in classes])
    assert np.exp(logs).sum() == pytest.approx(1, abs=1e-4)
