"""Posts matched with a term table of any size: terms under their rarest q-gram, checked by substring.

An automaton of a dictionary lies whole in every task. A table of a million terms is joined
instead: a text that holds a term holds all its q-grams, so each term waits under the one q-gram that is
rarest in a sample of the posts, and a text meets only the terms under q-grams it has. What
meets is checked with ``contains``, so neither the sample nor the choice of q-gram changes a result.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from postsift.functions import text as tx
from postsift.session import staged

Q = 4
# Posts, spread by hash, that q-grams are counted in to choose the rarest.
SAMPLE = 20_000


def _keys(text: bytes, size: int) -> np.ndarray:
    """The distinct runs of ``size`` bytes as numbers, in order; up to seven bytes no two runs have the same."""
    held, n = np.frombuffer(text, np.uint8), max(0, len(text) - size + 1)
    keys = np.full(n, size, np.uint64)
    for k in range(size):
        keys *= np.uint64(257)
        keys += held[k: k + n]
    keys.sort()
    return keys[np.concatenate((np.ones(min(n, 1), bool), keys[1:] != keys[:-1]))].view(np.int64)


def grams(text: Column, sizes: list[int]) -> Column:
    """The distinct q-grams of a text of all ``sizes``: runs of UTF-8 bytes as numbers, the empty run for size 0.

    None are left out, and a run has the same number wherever it stands, so a text that holds a term has all the term's.
    """
    sizes = list(sizes)

    @F.pandas_udf("array<bigint>")
    def cut(texts: pd.Series) -> pd.Series:
        held = (None if t is None else t.encode() for t in texts)
        return pd.Series([None if t is None else np.unique(np.concatenate([_keys(t, size) for size in sizes])) for t in held], dtype=object)

    return cut(text)


def _held(posts: DataFrame, sizes: list[int]) -> DataFrame:
    """(seq, gram) of all q-grams of the lowered texts."""
    return posts.select("seq", F.explode(grams(F.lower(tx.full_text()), sizes)).alias("gram"))


def signatures(terms: DataFrame, posts: DataFrame, q=Q, sample=SAMPLE) -> DataFrame:
    """``terms(term, ...)`` with ``gram``, the rarest q-gram of the term or the whole of a shorter one, and its ``size``."""
    n = max(1, posts.count())
    share = min(1.0, sample / n)
    some = posts.where(F.pmod(F.xxhash64("seq"), F.lit(1 << 30)) < int(share * (1 << 30)))
    counts = _held(some, [q]).groupBy("gram").agg(F.count("*").alias("n"))
    named = terms.select("term").distinct().withColumn("size", F.least(F.octet_length("term"), F.lit(q)))
    own = named.where(F.col("size") == q).select("term", F.explode(grams(F.col("term"), [q])).alias("gram"))
    best = own.join(counts, "gram", "left").groupBy("term").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram")).alias("best"))
    placed = best.select("term", "best.gram", F.lit(q).alias("size"))
    for size in range(q):
        placed = placed.unionByName(named.where(F.col("size") == size).select(
            "term", F.get(grams(F.col("term"), [size]), F.lit(0)).alias("gram"), "size"))
    return terms.join(placed, "term")


def term_matches(posts: DataFrame, terms: DataFrame, q=Q, sample=SAMPLE) -> DataFrame:
    """(seq, kind, terms): the terms of each kind that each of ``posts(seq, title, selftext)`` holds, in their order.

    ``terms(kind, ord, term)`` holds lowered terms; one that is listed twice is found twice. Posts without
    a match have no row. The empty term is part of every text, null terms of none. Seqs are unique.
    Terms never pass through the driver: they are shuffled by q-gram, and only q-grams that some
    term waits under leave the tasks that cut the texts up.
    """
    terms = terms.where(F.col("term").isNotNull()).select("kind", "ord", "term")
    placed = staged(signatures(terms, posts, q, sample), "signatures")
    sizes = sorted(r.size for r in placed.select("size").distinct().collect())  # from 0 to ``q``
    # All sizes in one walk, so a text is read and cut up once.
    met = _held(posts, sizes).join(placed.select("gram").distinct(), "gram", "left_semi") if sizes else posts.select(
        "seq", F.lit(0).cast("long").alias("gram")).limit(0)
    near = met.join(placed, "gram").groupBy("seq").agg(F.collect_list(F.struct("kind", "ord", "term")).alias("near"))
    texts = posts.join(near, "seq").select("near", "seq", F.explode(F.array(F.lower(tx.full_text()))).alias("text"))
    found = texts.select("seq", F.explode(F.filter("near", lambda t: F.contains(F.col("text"), t["term"]))).alias("hit"))
    return found.select("seq", "hit.*").groupBy("seq", "kind").agg(
        F.sort_array(F.collect_list(F.struct("ord", "term"))).alias("hits")).select("seq", "kind", F.col("hits.term").alias("terms"))
