"""Best-fit packing of token pieces into sequences: large items matched, small ones in the gaps."""

import bisect

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from postsift.llm.text import blocks
from postsift.llm.tokens import crc, encoder
from postsift.session import staged

CAPACITY = 4096
END_ID = 1

RUN = ("length", "first_rank", "per_bin", "first_bin", "bins", "offset")


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """Where every piece goes, from the number of pieces of each length alone.

    ``counts[n]`` is the number of pieces of n tokens. A run (length, first_rank, per_bin,
    first_bin, bins, offset) puts the pieces of one length from first_rank on into consecutive
    bins, per_bin to each, from ``offset`` on. Pieces above a third of the capacity fit at most
    twice into a bin: from the longest down each is matched with the longest that still fits.
    Smaller ones follow, longest first, each into the fullest bin that takes it.
    """
    counts = np.asarray(counts, np.int64).copy()
    ranks = np.zeros(capacity + 1, np.int64)
    runs, bins = [], 0
    gaps: dict[int, list] = {}  # free tokens -> [(first bin, number of bins)]
    sizes: list[int] = []  # the keys of gaps, sorted

    def put(length, per_bin, first_bin, n_bins, offset):
        runs.append((length, ranks[length], per_bin, first_bin, n_bins, offset))
        ranks[length] += per_bin * n_bins
        counts[length] -= per_bin * n_bins

    def leave(gap, first_bin, n_bins):
        if gap and n_bins:
            if gap not in gaps:
                bisect.insort(sizes, gap)
                gaps[gap] = []
            gaps[gap].append((first_bin, n_bins))

    large = [n for n in range(capacity // 3 + 1, capacity + 1) if counts[n]]
    while large:
        n = large[-1]
        if not counts[n]:
            large.pop()
            continue
        mate = bisect.bisect_right(large, capacity - n) - 1
        while mate >= 0 and counts[large[mate]] < 1 + (large[mate] == n):
            if not counts[large[mate]]:
                large.pop(mate)
            mate -= 1
        if mate < 0:
            count = int(counts[n])
            put(n, 1, bins, count, 0)
            leave(capacity - n, bins, count)
        elif large[mate] == n:
            count = int(counts[n] // 2)
            put(n, 2, bins, count, 0)
            leave(capacity - 2 * n, bins, count)
        else:
            other = large[mate]
            count = int(min(counts[n], counts[other]))
            put(n, 1, bins, count, 0)
            put(other, 1, bins, count, n)
            leave(capacity - n - other, bins, count)
        bins += count

    for n in range(capacity // 3, 0, -1):
        while counts[n]:
            at = bisect.bisect_left(sizes, n)
            if at == len(sizes):
                first, many, gap = bins, int(-(-counts[n] // (capacity // n))), capacity
                bins += many
            else:
                gap = sizes[at]
                first, many = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    sizes.pop(at)
            fit = gap // n
            full = int(min(many, counts[n] // fit))
            if full:
                put(n, fit, first, full, capacity - gap)
                leave(gap - fit * n, first, full)
            rest = int(counts[n]) if full < many else 0
            if rest:
                put(n, rest, first + full, 1, capacity - gap)
                leave(gap - rest * n, first + full, 1)
            leave(gap, first + full + bool(rest), many - full - bool(rest))
    return np.array(sorted(runs), np.int64).reshape(-1, len(RUN))


PIECE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("part", T.LongType()),
    T.StructField("rank", T.LongType()), T.StructField("ids", T.BinaryType()),
])


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The documents' pieces; part and rank number those of one length within the task that cut them."""

    def cut(batches):
        tokens = encoder(tokenizer, spaced=False)
        seen = np.zeros(capacity + 1, np.int64).tolist()
        part = TaskContext.get().partitionId()
        end = END_ID.to_bytes(4, "little")
        for whole in batches:
            for batch in blocks(whole, "text"):
                rows = []
                for doc, ids in zip(batch.column("doc_id").to_pylist(), tokens.encode(batch.column("text").to_pylist())):
                    ids += end
                    for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at: at + 4 * capacity]
                        size = len(own) // 4
                        rows.append((doc, i, at // 4, size, crc(own), part, seen[size], own if with_ids else None))
                        seen[size] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), _ARROW)], names=PIECE.names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, PIECE)


_ARROW = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if asked for).

    Null and empty texts are the end id alone; a document longer than the capacity is cut into
    full pieces and a last, shorter one. Repeated rows are packed as often as they come, a
    null doc_id is kept. The only thing gathered on the driver is the number of pieces of each
    length: at most ``capacity`` numbers, whatever the input; the plan made from them goes to
    the tasks. Each piece finds its place from its length and its rank among those of that length.
    """
    cut = staged(pieces(docs, tokenizer, capacity, with_ids), "pieces")
    per_part = cut.groupBy("part", "length").count()
    counts = np.zeros(capacity + 1, np.int64)
    for length, count in cut.groupBy("length").count().collect():
        counts[length] = count
    runs = plan(counts, capacity)
    before = F.sum("count").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    base = per_part.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = cut.join(base, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    kept = [c for c in PIECE.names if c not in ("part", "rank") and (with_ids or c != "ids")]
    schema = T.StructType([PIECE[c] for c in kept] + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    starts = (runs[:, 0] << 44) | runs[:, 1]

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            run = runs[np.searchsorted(starts, (length << 44) | rank, "right") - 1]
            gone = rank - run[:, 1]
            sequence = run[:, 3] + gone // run[:, 2]
            offset = run[:, 5] + gone % run[:, 2] * length
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(sequence), pa.array(offset)], names=schema.names)

    return ranked.select(*kept, "rank").mapInArrow(place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the ids of its pieces in order, from ``pack(..., with_ids=True)``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts"))
