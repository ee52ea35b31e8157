"""Full-text search over an inverted index with positions: BM25 ranking, phrases, top k by block maxima.

    postings/part=.../bucket=...   one row per term and block of posts: the posts' seqs, how often and
                                   where the term stands in each, their lengths, and the block's extremes
    stats/part=...                 number of posts and of words

A block is a run of ``BLOCK`` consecutive seqs, so the posts of the commonest term are still many
bounded rows. Terms lie in hash buckets and are sorted in them, so a search reads its own terms'
rows. What a block can score at most follows from its largest count and its shortest post: the
blocks that can score highest are opened first, and the others only if they can still reach the top.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from postsift.functions import text as tx
from postsift.session import staged
from postsift.sources.leads import read_table

K1, B = 1.2, 0.75
BLOCK = 1 << 16
BUCKETS = 256
# Files that the rows of a bucket are dealt over.
LANES = 16
# Blocks opened before the others are judged.
FIRST_BLOCKS = 8
# A term is a run of letters and digits, lowered.
TERM = r"[\p{L}\p{N}]+"

_POST = "struct<seq: bigint, length: int, n: int, places: array<int>>"
_POSTINGS = f"term string, block long, posts array<{_POST}>, n_posts long, most int, shortest int, bucket int"
_STATS = "n_posts long, n_words long"
# What goes through the shuffle: the posts of one batch under a term and block.
_PACKED = f"term string, block long, posts array<{_POST}>"
# Words that a task turns round at once.
_WORDS_AT_ONCE = 2_000_000


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def weight(n: Column, length: Column, average: float) -> Column:
    """What ``n`` occurrences in a post of ``length`` words count, without the term's rarity."""
    return n * (K1 + 1) / (n + K1 * (1 - B + B * length / average))


def _turned(seqs: np.ndarray, known: np.ndarray, words: pa.ListArray, size: int) -> pa.RecordBatch:
    """Rows of ``_PACKED`` for some posts (``known``: the seq isn't null): one per term and block."""
    lengths = np.diff(words.offsets.to_numpy()).astype(np.int64)
    blocks = np.floor_divide(seqs, size)
    order = np.lexsort((lengths, seqs, known))
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    coded = words.flatten().dictionary_encode()
    post = np.repeat(np.arange(len(seqs)), lengths)
    place = np.arange(len(post)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    code = coded.indices.to_numpy().astype(np.int64)
    by = np.argsort(code * len(seqs) + rank[post], kind="stable")
    code, post, place = code[by], post[by], place[by]
    changes = np.flatnonzero((np.diff(code) != 0) | (np.diff(post) != 0)) + 1
    first = np.concatenate(([0], changes))  # of each post under each term
    inner, n = np.append(first, len(place)), np.diff(first, append=len(place))
    code, post = code[first], post[first]
    at, sure = blocks[post], known[post]
    outer = np.concatenate(([0], np.flatnonzero((np.diff(code) != 0) | (np.diff(at) != 0) | (np.diff(sure) != 0)) + 1))
    posts = pa.StructArray.from_arrays([
        pa.array(seqs[post], pa.int64(), mask=~sure), pa.array(lengths[post], pa.int32()), pa.array(n, pa.int32()),
        pa.ListArray.from_arrays(pa.array(inner, pa.int32()), pa.array(place, pa.int32()))], ["seq", "length", "n", "places"])
    return pa.RecordBatch.from_arrays([
        coded.dictionary.take(pa.array(code[outer])), pa.array(at[outer], pa.int64(), mask=~sure[outer]),
        pa.ListArray.from_arrays(pa.array(np.append(outer, len(first)), pa.int32()), posts)], ["term", "block", "posts"])


def _inverted(size: int):
    """Arrow batches of (seq, words) as batches of ``_PACKED``, worked out in pieces of a bounded number of words."""
    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column("words")), 0))
            lengths = pc.list_value_length(batch.column("words")).to_numpy(zero_copy_only=False)
            piece = np.cumsum(lengths, dtype=np.int64) // _WORDS_AT_ONCE
            edges = [*np.flatnonzero(np.diff(piece, prepend=-1)), len(lengths)]
            for low, high in zip(edges, edges[1:]):
                seq, words = (batch.column(name).slice(low, high - low) for name in ("seq", "words"))
                words = pa.ListArray.from_arrays(
                    np.concatenate(([0], np.cumsum(lengths[low:high]))).astype(np.int32), words.flatten())
                yield _turned(seq.fill_null(0).to_numpy().astype(np.int64), seq.is_valid().to_numpy(zero_copy_only=False), words, size)

    return turn


def _whole(posts: Column) -> Column:
    """The collected posts of a term and block in order; a post that was given twice is one."""
    def differs(p, q):
        return ~(p["seq"].eqNullSafe(q["seq"]) & (p["length"] == q["length"]))

    def as_one(run):
        places = F.sort_array(F.flatten(F.transform(run, lambda p: p["places"])))
        p = F.get(run, F.lit(0))
        return F.struct(p["seq"].alias("seq"), p["length"].alias("length"), F.size(places).alias("n"), places.alias("places"))

    def merged(held):
        starts = F.filter(F.sequence(F.lit(0), F.size(held) - 1), lambda i: (i == 0) | differs(F.get(held, i), F.get(held, i - 1)))
        return tx.bind(starts, lambda at: F.transform(at, lambda low, k: tx.bind(
            F.slice(held, low + 1, F.coalesce(F.get(at, k + 1), F.size(held)) - low), as_one)))

    def once(held):
        alone = F.size(F.array_distinct(F.transform(held, lambda p: p["seq"]))) == F.size(held)
        return F.when(alone, held).otherwise(merged(held))

    return tx.bind(F.sort_array(posts), once)


def _moved(places: Column, by: int) -> Column:
    return F.transform(places, lambda place: place - by)


class SearchIndex:
    """Posts under ``path``, searchable by their words. The same name added again replaces its posts."""

    def __init__(self, spark: SparkSession, path: str, buckets=BUCKETS, block=BLOCK):
        self.spark, self.buckets, self.block = spark, buckets, block
        self.postings_path, self.stats_path = f"{path}/postings", f"{path}/stats"

    def _bucket(self, term: Column) -> Column:
        return F.pmod(F.xxhash64(term), F.lit(self.buckets)).cast("int")

    def add(self, posts: DataFrame, part: str) -> None:
        """Index ``posts(seq, title, selftext)``; seqs are unique over all parts."""
        path = f"{self.postings_path}/part={part}"
        self.rows(posts).sortWithinPartitions("bucket", "term", "block").write.mode("overwrite").partitionBy("bucket").parquet(path)
        # Every word is in the index once, so their number is read there; posts without words count too.
        said = read_table(self.spark, path, _POSTINGS).select(F.aggregate("posts.n", F.lit(0).cast("long"), lambda s, n: s + n).alias("n"))
        n_words = said.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        self.spark.createDataFrame([(posts.count(), n_words)], _STATS).coalesce(1).write.mode("overwrite").parquet(
            f"{self.stats_path}/part={part}")

    def rows(self, posts: DataFrame) -> DataFrame:
        """The index of ``posts`` as rows: one per term and block, dealt by bucket and block.

        Posts are turned round where they lie, so one packed row per term and block of a batch is
        all that is shuffled, and that once.
        """
        words = posts.select("seq", terms(tx.full_text()).alias("words"))
        packed = words.mapInArrow(_inverted(self.block), _PACKED).select(
            "*", self._bucket(F.col("term")).alias("bucket"), F.pmod("block", F.lit(LANES)).alias("lane"))
        # A bucket's rows are dealt over several files by block, so a common term doesn't make one long task.
        rows = packed.repartition("bucket", "lane").groupBy("bucket", "lane", "term", "block").agg(
            F.flatten(F.collect_list("posts")).alias("posts"))
        rows = rows.select("bucket", "term", "block", F.explode(F.array(_whole(F.col("posts")))).alias("posts"))
        return rows.select(
            "term", "block", "posts", F.size("posts").cast("long").alias("n_posts"), F.array_max("posts.n").alias("most"),
            F.array_min("posts.length").alias("shortest"), "bucket")

    def postings(self, wanted: list[str]) -> DataFrame:
        """The rows of these terms; partitions and row groups of other terms are not read."""
        rows = read_table(self.spark, self.postings_path, f"{_POSTINGS}, part string")
        asked = self.spark.createDataFrame([(t,) for t in wanted], "term string").select(self._bucket(F.col("term")).alias("b"))
        buckets = sorted({r.b for r in asked.collect()})
        return rows.where(F.col("bucket").isin(buckets) & F.col("term").isin(wanted))

    def stats(self) -> tuple[int, float]:
        """Number of posts and their average length (1 for none)."""
        n, words = read_table(self.spark, self.stats_path, f"{_STATS}, part string").agg(F.sum("n_posts"), F.sum("n_words")).first()
        return n or 0, (words or 0) / n if n and words else 1.0

    def search(self, query: str, k: int, every=True, phrase=False) -> DataFrame:
        """The ``k`` best posts for the words of ``query``: (seq, score), best first, ties by smaller seq.

        With ``every`` a post must hold all the words, with ``phrase`` side by side in their order;
        a word said twice counts once in the score. A query without words finds nothing.
        """
        said = self.spark.range(1).select(terms(F.lit(query))).first()[0]
        wanted = sorted(set(said))
        n_posts, average = self.stats()
        rows = self.postings(wanted) if wanted else self.postings([""])
        # One narrow row per term and block: postings themselves are not read here.
        heads = staged(rows.select("term", "block", "n_posts", "most", "shortest"), "heads")
        held_by = {r.term: r.n for r in heads.groupBy("term").agg(F.sum("n_posts").alias("n")).collect()}
        idf = F.lit(0.0)
        for term, n in sorted(held_by.items()):
            idf = F.when(F.col("term") == term, F.log(F.lit(1 + (n_posts - n + 0.5) / (n + 0.5)))).otherwise(idf)
        need = len(wanted) if every or phrase else 1
        best = heads.groupBy("block").agg(F.sum(idf * weight(F.col("most"), F.col("shortest"), average)).alias("bound"),
                                          F.count_distinct("term").alias("n_terms")).where(F.col("n_terms") >= need)
        best = staged(best, "bounds")
        first = best.orderBy(F.desc("bound"), "block").limit(FIRST_BLOCKS).select("block")
        opened = self._scored(rows.join(F.broadcast(first), "block"), idf, average, said if phrase else None, need)
        floor = opened.orderBy(F.desc("score"), "seq").limit(k).agg(F.min("score"), F.count("*")).first()
        left = best if floor[1] < k else best.where(F.col("bound") * (1 + 1e-9) >= floor[0])
        scored = self._scored(rows.join(left.select("block"), "block"), idf, average, said if phrase else None, need)
        return scored.orderBy(F.desc("score"), "seq").limit(k)

    def _scored(self, rows: DataFrame, idf: Column, average: float, said: list[str] | None, need: int) -> DataFrame:
        """(seq, score) of the posts in ``rows`` that hold enough of the terms, or all of them as said."""
        each = rows.select("term", idf.alias("idf"), F.explode("posts").alias("p")).select("term", "idf", "p.*")
        if said is None:
            each = each.drop("places")
        places = [] if said is None else [F.map_from_entries(F.collect_list(F.struct("term", "places"))).alias("at")]
        posts = each.groupBy("seq").agg(
            F.sum(F.col("idf") * weight(F.col("n"), F.col("length"), average)).alias("score"), F.count("*").alias("held"), *places)
        posts = posts.where(F.col("held") >= need)
        if said is not None:
            starts = F.col("at")[said[0]]
            for i, term in enumerate(said[1:], 1):
                starts = F.array_intersect(starts, _moved(F.col("at")[term], i))
            posts = posts.where(F.size(starts) > 0)
        return posts.select("seq", "score")
