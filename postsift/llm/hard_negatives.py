"""Hard negatives for anchors: exact inner-product search over lists that clusters of anchors share.

Anchors of a similar direction form a cluster. By the angle between its centre and a candidate no
member can score that candidate higher than a bound (Abuzaid et al. 2019): the candidates are
ordered once for the cluster by falling bound, and each member walks that list until what is left
can no longer change its answer. So every answer is certified, whatever the clusters look like.

The search runs twice over the candidates: for each anchor's best rows of its own label, then for
the best rows of other labels inside the window below each of these. A task keeps its best answers
from one block of rows to the next, so later walks end sooner, and gives them when it has
read all its rows. Anchors come in passes of a bounded number, the only thing sent to all tasks.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postsift.session import shared_dir, staged

SCALE = 256
LEAST_SHARE, MOST_SHARE = 80, 100
POSITIVES, NEGATIVES = 5, 5
# Bytes of the anchors of one pass: their vectors, and what a task keeps for each of them.
PASS_BYTES, ANSWER_BYTES = 64 << 20, 512
# Clusters of a pass, and the anchors their centres are fitted on (spread by hash).
CLUSTERS, FIT_SAMPLE = 64, 4096
# Scaled components stay below this, so products of up to 32,768 dimensions fit 64 bits.
MOST = 1 << 24


def centres(vectors: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Unit directions of about ``n`` clusters (spherical k-means from evenly spread starts)."""
    length = np.linalg.norm(vectors, axis=1, keepdims=True)
    unit = vectors / np.where(length > 0, length, 1)
    middle = unit[np.unique(np.linspace(0, len(unit) - 1, n).astype(int))]
    for _ in range(rounds):
        own = np.argmax(unit @ middle.T, axis=1)
        total = np.zeros_like(middle)
        np.add.at(total, own, unit)
        size = np.linalg.norm(total, axis=1, keepdims=True)
        middle = np.where(size > 0, total / np.where(size > 0, size, 1), middle)
    return middle


def angles(vectors: np.ndarray, middle: np.ndarray) -> np.ndarray:
    """Angle between each vector and each centre; 0 where the vector (or the centre) is zero."""
    length = np.linalg.norm(vectors, axis=1)
    cosine = (vectors @ middle.T) / np.where(length > 0, length, 1)[:, None]
    return np.where((length > 0)[:, None], np.arccos(np.clip(cosine, -1, 1)), 0.0)


class Clustered:
    """Anchors of one length of vector, in clusters with their widest angle."""

    def __init__(self, ids, labels, vectors, n_clusters=CLUSTERS):
        self.ids, self.labels, self.whole = ids, labels, vectors
        self.vectors = vectors.astype(np.float64)
        self.length = np.linalg.norm(self.vectors, axis=1)
        n = max(1, min(n_clusters, int(np.sqrt(len(ids)))))
        step = max(1, len(ids) // FIT_SAMPLE)
        self.centres = centres(self.vectors[::step], n)
        turned = angles(self.vectors, self.centres)
        own = np.argmin(turned, axis=1)
        self.members = [np.flatnonzero(own == c) for c in range(len(self.centres))]
        self.width = np.array([turned[m, c].max(initial=0.0) for c, m in enumerate(self.members)])
        self.peak = np.abs(vectors).max(initial=0)

    def products(self, members, block, chosen):
        """Exact inner products of anchors and candidates."""
        left = self.whole[members]
        if int(self.peak) * block.peak * left.shape[1] < 1 << 53:
            return (self.vectors[members] @ block.vectors[chosen].T).astype(np.int64)
        return left @ block.whole[chosen].T

    def lists(self, block):
        """(members, candidates by falling bound, bounds) of each cluster."""
        turned = angles(block.vectors, self.centres)
        for c, members in enumerate(self.members):
            if len(members):
                bound = block.length * np.cos(np.maximum(turned[:, c] - self.width[c] - 1e-7, 0))
                order = np.argsort(-bound, kind="stable")
                yield members, order, bound[order]


class Block:
    """Candidates of one length of vector."""

    def __init__(self, ids, labels, vectors):
        self.ids, self.labels, self.whole = ids, labels, vectors
        self.vectors = vectors.astype(np.float64)
        self.length = np.linalg.norm(self.vectors, axis=1)
        self.peak = int(np.abs(vectors).max(initial=0))


class Best:
    """The best ``k`` (score, id) of each of ``n`` askers: higher scores first, then smaller ids."""

    def __init__(self, n, k):
        self.k = k
        self.scores = np.full((n, k), np.iinfo(np.int64).min)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)
        self.filled = np.zeros(n, np.int64)

    def floor(self, who):
        """A candidate below this can't enter; the least number while there are fewer than ``k``."""
        return self.scores[who, -1]

    def offer(self, who, scores, ids):
        """Take (asker, score, id) rows into the lists."""
        if not len(who):
            return
        touched = np.unique(who)
        n_old = np.minimum(self.filled[touched], self.k)
        old = np.repeat(touched, n_old)
        slot = np.arange(len(old)) - np.repeat(np.cumsum(n_old) - n_old, n_old)
        who = np.concatenate([old, who])
        scores = np.concatenate([self.scores[old, slot], scores])
        ids = np.concatenate([self.ids[old, slot], ids])
        order = np.lexsort((ids, -scores, who))
        who, scores, ids = who[order], scores[order], ids[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        kept = place < self.k
        who, scores, ids, place = who[kept], scores[kept], ids[kept], place[kept]
        self.scores[who, place], self.ids[who, place] = scores, ids
        self.filled[touched] = np.bincount(who, minlength=len(self.filled))[touched]

    def rows(self):
        who = np.repeat(np.arange(len(self.filled)), self.filled)
        place = np.arange(len(who)) - np.repeat(np.cumsum(self.filled) - self.filled, self.filled)
        return who, self.scores[who, place], self.ids[who, place]


def _steps(n, first=64):
    """Growing pieces of a list of ``n``."""
    start = 0
    while start < n:
        yield start, min(n, start + first)
        start, first = start + first, min(first * 2, 2048)


class Positives:
    """For each anchor its best rows of the same label and another id."""

    def __init__(self, anchors: Clustered, k=POSITIVES):
        self.anchors, self.best = anchors, Best(len(anchors.ids), k)

    def meet(self, block: Block):
        a = self.anchors
        for members, order, bound in a.lists(block):
            labels = np.intersect1d(a.labels[members], block.labels)
            for label in labels:
                asking = members[a.labels[members] == label]
                mine = block.labels[order] == label
                self._walk(block, asking, order[mine], bound[mine])

    def _walk(self, block, asking, order, bound):
        a = self.anchors
        for start, stop in _steps(len(order)):
            limit = a.length[asking] * bound[start]
            asking = asking[limit + 1e-6 * np.abs(limit) + 1 >= self.best.floor(asking)]
            if not len(asking):
                return
            chosen = order[start:stop]
            scores = a.products(asking, block, chosen)
            good = (scores >= self.best.floor(asking)[:, None]) & (block.ids[chosen][None, :] != a.ids[asking][:, None])
            row, column = np.nonzero(good)
            self.best.offer(asking[row], scores[row, column], block.ids[chosen[column]])


class Negatives:
    """For each (anchor, positive) the best rows of other labels inside the window below the positive."""

    def __init__(self, anchors: Clustered, owner, ranks, ids, scores, k=NEGATIVES, least=LEAST_SHARE, most=MOST_SHARE):
        """Askers are positives: ``owner`` is the place of their anchor, sorted, then rank, id and score."""
        self.anchors, self.owner, self.positives = anchors, owner, (ranks, ids, scores)
        # least * p <= 100 * s <= most * p for whole s; an empty window asks for nothing.
        self.low, self.high = -((-least * scores) // 100), (most * scores) // 100
        self.best = Best(len(owner), k)
        self.first = np.searchsorted(owner, np.arange(len(anchors.ids)))
        self.last = np.searchsorted(owner, np.arange(len(anchors.ids)), "right")

    def meet(self, block: Block):
        for members, order, bound in self.anchors.lists(block):
            count = self.last[members] - self.first[members]
            asking = np.repeat(self.first[members], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            self._walk(block, asking[self.low[asking] <= self.high[asking]], order, bound)

    def _walk(self, block, asking, order, bound):
        a = self.anchors
        for start, stop in _steps(len(order)):
            limit = a.length[self.owner[asking]] * bound[start]
            asking = asking[limit + 1e-6 * np.abs(limit) + 1 >= np.maximum(self.low[asking], self.best.floor(asking))]
            if not len(asking):
                return
            chosen = order[start:stop]
            members, which = np.unique(self.owner[asking], return_inverse=True)
            scores = a.products(members, block, chosen)
            other = a.labels[members][:, None] != block.labels[chosen][None, :]
            floor = np.maximum(self.low[asking], self.best.floor(asking))
            for part in range(0, len(asking), 1024):  # so the table of askers by candidates stays small
                who, own = asking[part: part + 1024], which[part: part + 1024]
                good = other[own] & (scores[own] >= floor[part: part + 1024, None]) & (scores[own] <= self.high[who][:, None])
                row, column = np.nonzero(good)
                self.best.offer(who[row], scores[own[row], column], block.ids[chosen[column]])


def prepared(rows: DataFrame, scale=SCALE, shift_every=None, labels=10) -> DataFrame:
    """vec_id, label, vector (scaled whole components as 64-bit numbers) of the rows that take part."""
    fit = F.lit(None).cast("int") if shift_every is None else F.pmod(F.col("vec_id"), F.lit(shift_every))
    label = F.when(fit == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    usable = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
              & F.forall("embedding", lambda x: F.coalesce(F.abs(x.cast("double") * scale) < MOST, F.lit(False))))
    picked = rows.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                                       F.col("embedding").cast("array<double>").alias("vector"))

    def pack(batches):
        for batch in batches:
            lists = batch.column("vector")
            values = np.floor(lists.flatten().to_numpy(zero_copy_only=False) * scale).astype("<i4")
            ends = 4 * np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
            vectors = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends.astype("<i8").tobytes()), pa.py_buffer(values.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), vectors.cast(pa.binary())],
                                             names=["vec_id", "label", "vector"])

    return picked.mapInArrow(pack, "vec_id long, label long, vector binary")


def by_length(ids, labels, vectors):
    """Rows of each length of vector, as (length in bytes, ids, labels, matrix of whole numbers)."""
    sizes = np.array([len(v) for v in vectors], np.int64)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        matrix = np.frombuffer(b"".join(vectors[i] for i in at), "<i4").reshape(len(at), -1).astype(np.int64)
        yield int(size), ids[at], labels[at], matrix


def _search(rows: DataFrame, anchors: list, make, columns) -> DataFrame:
    """Each task's best answers: ``make(anchors of one length)`` walks the blocks, ``columns`` names its askers."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def walk(batches):
        walkers = {size: make(size, Clustered(*held)) for size, *held in shared.value}
        for batch in batches:
            vectors = batch.column("vector").to_pylist()
            for size, *held in by_length(batch.column("vec_id").to_numpy(), batch.column("label").to_numpy(), vectors):
                if size in walkers:
                    walkers[size].meet(Block(*held))
        for size, walker in walkers.items():
            who, scores, ids = walker.best.rows()
            made = columns(size, walker, who) + [pa.array(ids), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(made, names=["anchor_id", "positive_rank", "positive_id", "positive_score", "other_id", "score"])

    return rows.mapInArrow(walk, "anchor_id long, positive_rank long, positive_id long, positive_score long, other_id long, score long")


def _first(found: DataFrame, k: int, *keys) -> DataFrame:
    """The first ``k`` rows of each key with their ``rank``; every task gave at most ``k`` of each."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors_every=100, shift_every=7, positives=POSITIVES, negatives=NEGATIVES,
         least=LEAST_SHARE, most=MOST_SHARE, scale=SCALE, pass_bytes=PASS_BYTES) -> DataFrame:
    """Per anchor and positive the first hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows`` has vec_id, label and embedding. Components become floor(scale * x), scores are whole
    inner products; higher ones come first, ties by smaller vec_id. Where vec_id is divisible by
    ``shift_every`` the label moves on by one (modulo 10). Anchors are rows whose vec_id is divisible
    by ``anchors_every``; positives the first rows of the same label and another vec_id; negatives
    the first rows of another label with least * positive <= 100 * negative <= most * positive.

    A row with a null vec_id or label, a null vector or a null or non-finite component takes no part,
    nor does one with a component so large (65,536 and more) that scores wouldn't fit. Vectors meet
    vectors of their own length only. Repeated candidates each count; of anchors with the same
    vec_id the one with the least label, then vector, asks. Empty tables give no rows; other columns
    are ignored.
    """
    spark = rows.sparkSession
    table = staged(prepared(rows, scale, shift_every), "vectors")
    asking = staged(table.where(F.pmod("vec_id", F.lit(anchors_every)) == 0).groupBy("vec_id").agg(
        F.min(F.struct("label", "vector")).alias("row")).select("vec_id", "row.*"), "anchors")
    n_bytes = asking.agg(F.coalesce(F.sum(F.octet_length("vector") * 2 + ANSWER_BYTES), F.lit(0))).first()[0]
    n_passes = -(-n_bytes // pass_bytes) or 1
    out = shared_dir(spark, "negatives")
    for number in range(n_passes):
        some = asking.where(F.pmod(F.xxhash64("vec_id"), F.lit(n_passes)) == number).orderBy(F.xxhash64("vec_id"))
        held = some.toArrow()
        groups = list(by_length(held.column("vec_id").to_numpy(), held.column("label").to_numpy(), held.column("vector").to_pylist()))

        def of_anchor(size, walker, who):
            return [pa.array(walker.anchors.ids[who])] + [pa.nulls(len(who), pa.int64())] * 3

        found = _search(table, groups, lambda size, a: Positives(a, positives), of_anchor)
        best = _first(found, positives, "anchor_id").select("anchor_id", "rank", "other_id", "score").toArrow()
        asked, anchor = {}, best.column("anchor_id").to_numpy()
        for size, ids, *_ in groups:
            order = np.argsort(ids, kind="stable")
            at = np.searchsorted(ids[order], anchor)
            known = (at < len(ids)) & (ids[order][np.minimum(at, len(ids) - 1)] == anchor)
            owner = order[at[known]]
            values = [best.column(c).to_numpy()[known].astype(np.int64) for c in ("rank", "other_id", "score")]
            by_owner = np.lexsort((values[0], owner))
            asked[size] = (owner[by_owner], *[v[by_owner] for v in values])
        shared = spark.sparkContext.broadcast(asked)

        def negatives_of(size, anchors):
            return Negatives(anchors, *shared.value[size], negatives, least, most)

        def of_positive(size, walker, who):
            return [pa.array(walker.anchors.ids[walker.owner[who]])] + [pa.array(v[who]) for v in walker.positives]

        found = _search(table, groups, negatives_of, of_positive)
        ranked = _first(found, negatives, "anchor_id", "positive_rank", "positive_id", "positive_score")
        ranked.select("anchor_id", "positive_id", "rank", F.col("other_id").alias("negative_id"), "positive_score",
                      F.col("score").alias("negative_score")).write.parquet(f"{out}/pass={number}")
    return spark.read.parquet(*[f"{out}/pass={number}" for number in range(n_passes)])
