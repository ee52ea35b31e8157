"""Importance resampling towards a target: hashed word features, array-scored weights, exact top share.

Each feature falls into one of ``buckets``; how often each bucket is hit in the corpus and in the
target gives its gain, and a document's weight is the mean gain of its features, looked up in one
array. Weights plus Gumbel noise are drawn without replacement: the highest scores win.

The cutoff is found without sorting all scores. A quantile sketch names a bracket of scores around it,
exact counts of what lies above and inside the bracket accept it or widen it, and only the rows of
the accepted bracket are ordered to find the last drawn one.
"""

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postsift.llm.text import blocks, flat, lowered
from postsift.session import staged

BUCKETS = 10000
WORD_RUN = 1
SEED = "2024"
PERCENT = 10
LEAST_WORDS = 20
# Size of the quantile sketch (its error in rank is about 0.2 %) and half the first bracket's width in rank.
SKETCH = 1024
MARGIN = 0.01
# Sketches of the tasks are merged in so many groups first, so no task reads one of every task.
MERGERS = 64
# Longer words are hashed one by one.
LONG_WORD = 64

# Bytes that belong to words once A-Z are lowered: 0-9, a-z and all from 0x80 on.
_WORD = np.zeros(256, bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return table


_CRC = _crc_table()


def word_spans(data, offsets):
    """Start and end of every word in ``data`` and the row it stands in."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _WORD[data]
    fresh = np.zeros(len(data) + 1, bool)
    fresh[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | fresh[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | fresh[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _feed(state, data, starts, ends):
    """The CRC states after the bytes of each span."""
    state, sizes = state.copy(), ends - starts
    short = np.flatnonzero(sizes <= LONG_WORD)
    short = short[np.argsort(-sizes[short], kind="stable")]
    lengths = -sizes[short]
    for k in range(int(-lengths[0]) if len(short) else 0):
        on = short[: np.searchsorted(lengths, -k, "left")]
        state[on] = (state[on] >> np.uint32(8)) ^ _CRC[(state[on] ^ data[starts[on] + k]) & np.uint32(255)]
    for i in np.flatnonzero(sizes > LONG_WORD):
        before = int(state[i]) ^ 0xFFFFFFFF
        state[i] = zlib.crc32(data[starts[i]: ends[i]].tobytes(), before) ^ 0xFFFFFFFF
    return state


def features(array, buckets=BUCKETS, run=WORD_RUN):
    """The bucket of every feature of a string column, its row, and the words of each row.

    A feature is a run of 1 to ``run`` words joined by one space; its bucket is the CRC-32 of its
    bytes modulo ``buckets``. Null texts have none.
    """
    data, offsets = flat(array)
    data = lowered(data)
    starts, ends, rows = word_spans(data, offsets)
    state = _feed(np.full(len(starts), 0xFFFFFFFF, np.uint32), data, starts, ends)
    found, owners = [state ^ np.uint32(0xFFFFFFFF)], [rows]
    for k in range(1, run):
        state = state[:-1] if len(state) else state
        state = (state >> np.uint32(8)) ^ _CRC[(state ^ np.uint32(0x20)) & np.uint32(255)]
        state = _feed(state, data, starts[k:], ends[k:])
        whole = rows[: len(state)] == rows[k:]
        found.append(state[whole] ^ np.uint32(0xFFFFFFFF))
        owners.append(rows[: len(state)][whole])
    return (np.concatenate(found).astype(np.int64) % buckets, np.concatenate(owners),
            np.bincount(rows, minlength=len(array)))


def bucket_counts(docs: DataFrame, buckets=BUCKETS, run=WORD_RUN) -> DataFrame:
    """How often the features of all texts hit each bucket, as (bucket, n); counted in the tasks first."""
    def count(batches):
        total = np.zeros(buckets, np.int64)
        for whole in batches:
            for batch in blocks(whole, "text"):
                total += np.bincount(features(batch.column("text"), buckets, run)[0], minlength=buckets)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(total[hit])], names=["bucket", "n"])

    return docs.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets=BUCKETS, run=WORD_RUN) -> np.ndarray:
    """The gain of each bucket in thousandths of a nat; ``buckets`` numbers are all the driver sees."""
    held = []
    for side in (docs, target):
        counts = np.zeros(buckets, np.int64)
        for bucket, n in bucket_counts(side, buckets, run).collect():
            counts[bucket] = n
        held.append((counts.tolist(), int(counts.sum())))
    (own, all_own), (wanted, all_wanted) = held
    return np.array([math.floor(1000 * math.log(float(t + 1) * (all_own + buckets) / (float(s + 1) * (all_wanted + buckets))))
                     for s, t in zip(own, wanted)], np.int64)


def noise(seed=SEED) -> Column:
    """Gumbel noise in thousandths, drawn by the hash of doc_id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    draw = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((draw + 0.5) / F.lit(4294967296.0))))


WEIGHED = "doc_id long, n_words long, n_features long, weight long"


def weigh(docs: DataFrame, gains: np.ndarray, run=WORD_RUN) -> DataFrame:
    """Per document: doc_id, n_words, n_features, weight (floored mean gain, 0 without features)."""
    buckets = len(gains)

    def score(batches):
        for whole in batches:
            for batch in blocks(whole, "text"):
                bucket, rows, n_words = features(batch.column("text"), buckets, run)
                count = np.bincount(rows, minlength=batch.num_rows)
                total = np.zeros(batch.num_rows, np.int64)
                np.add.at(total, rows, gains[bucket])
                made = [batch.column("doc_id")] + [pa.array(x.astype(np.int64)) for x in (n_words, count, total // np.maximum(count, 1))]
                yield pa.RecordBatch.from_arrays(made, names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(score, WEIGHED)


def ranked(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank`` (1, 2, 3...) by falling score, then doc_id (nulls last), then row.

    Rows are dealt by ranges of that order and numbered inside their range; the ranges' sizes, one
    number each, give what comes before.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    schema = f"{', '.join(f'{n} {t}' for n, t in rows.dtypes)}, part long, place long"
    names = rows.columns

    def number(batches):
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            made = [pa.array(np.full(batch.num_rows, part)), pa.array(np.arange(place + 1, place + 1 + batch.num_rows))]
            yield pa.RecordBatch.from_arrays(batch.columns + made, names=names + ["part", "place"])
            place += batch.num_rows

    placed = staged(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(number, schema), "ranked")
    sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
    before = F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return placed.join(sizes.select("part", before.alias("before")), "part").select(
        *names, (F.col("before") + F.col("place")).alias("rank"))


def bracket(scores: DataFrame, n: int, k: int, margin=MARGIN, sketch_size=SKETCH):
    """(low, high, above): the ``k``-th highest of ``n`` scores lies in [low, high], ``above`` are higher.

    The sketch only proposes: counts over all scores decide, and a bracket that misses is
    widened until it holds the place, at last from the least score to the highest.
    """
    parts = scores.groupBy(F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("part")).agg(
        F.kll_sketch_agg_bigint("score", sketch_size).alias("sketch"),
        F.min("score").alias("least"), F.max("score").alias("most"))
    whole = staged(parts.agg(F.kll_merge_agg_bigint("sketch").alias("sketch"), F.min("least").alias("least"),
                             F.max("most").alias("most")), "sketch")
    while True:
        at = 1 - k / n
        low, high = (F.kll_sketch_get_quantile_bigint("sketch", F.lit(float(min(1, max(0, at + m))))) for m in (-margin, margin))
        low, high = whole.select(F.when(F.lit(margin >= 1), F.col("least")).otherwise(low),
                                 F.when(F.lit(margin >= 1), F.col("most")).otherwise(high)).first()
        above, inside = scores.agg(F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))).first()
        if above < k <= above + inside:
            return low, high, above
        margin *= 2


def resample(docs: DataFrame, target: DataFrame, percent=PERCENT, least_words=LEAST_WORDS, buckets=BUCKETS,
             run=WORD_RUN, seed=SEED) -> DataFrame:
    """Every row of ``docs``: doc_id, n_features, weight, score, and rank where it is drawn (else null).

    Of the N rows with at least ``least_words`` words, the floor(percent * N / 100) highest scores are
    drawn; ties go to the smaller doc_id, null doc_ids come last, and of rows with the same doc_id and
    score any may come first. Null and empty texts have no features and weight 0. A null doc_id draws
    its noise from the empty text. Repeated rows each count. Without target texts all wanted
    counts are 0; an empty table gives no rows. Other columns are ignored.
    """
    gains = bucket_gains(docs, target, buckets, run)
    scored = staged(weigh(docs, gains, run).select(
        "doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise(seed)).alias("score"),
        F.monotonically_increasing_id().alias("row")), "scored")
    enough = F.col("n_words") >= least_words
    able = scored.where(enough)
    n = able.count()
    k = percent * n // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not k:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    low, high, above = bracket(able.select("score"), n, k)
    last = ranked(able.where(F.col("score").between(low, high)).select("doc_id", "score", "row")).where(
        F.col("rank") == k - above).first()
    same = F.col("doc_id").eqNullSafe(F.lit(last.doc_id).cast("long"))
    before = F.col("doc_id").isNotNull() if last.doc_id is None else F.coalesce(F.col("doc_id") < last.doc_id, F.lit(False))
    drawn = enough & ((F.col("score") > last.score) | ((F.col("score") == last.score) & (before | (same & (F.col("row") <= last.row)))))
    return ranked(scored.where(drawn).select(*columns, "row")).select(*columns, "rank").unionByName(
        scored.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))
