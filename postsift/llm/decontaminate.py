"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

Short items are looked for inside long documents. Containment can't be searched by plain MinHash:
the longer the document, the smaller its similarity to an item it holds. So items are partitioned by
size (LSH Ensemble, Zhu et al. 2016), and for each class [2^k, 2^(k+1)) of shingle counts a document
is seen as overlapping windows of three blocks of 2^k shingles. Any 2^(k+1) neighbouring shingles lie
inside one window, and an item of the class with containment t has at least the similarity
t / (3 + 1 - t) with it. HASHES minimum hashes, each a band of its own, then leave a chance of a
miss below one in a million. What shares a minimum is verified by exact shingle containment.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postsift.llm.text import SHINGLE_WORDS, blocks, flat, lowered, mix, shingle_hashes, word_hashes, words

CONTAINMENT = 0.8
HASHES = 48
# Bytes of item texts that are searched for in one pass over the documents.
ITEM_BLOCK_BYTES = 8 << 20
NO_HASH = np.uint64(0xFFFFFFFFFFFFFFFF)

_SALTS = mix(np.arange(1, HASHES + 1, dtype=np.uint64))


def text_shingles(array):
    """Shingle hashes of each text of a string column, and the bounds of the rows in them."""
    data, offsets = flat(array)
    data = lowered(data)
    starts, ends, rows = words(data, offsets)
    return shingle_hashes(word_hashes(data, starts, ends), rows, len(array))


def in_order(text: str) -> bytes:
    """The lowered words of a text with a space around each."""
    return b" " + b" ".join(text.encode().lower().split()) + b" "


def shingle_set(text: str) -> set:
    """The shingles themselves: five words, or all of them if there are fewer."""
    found = text.encode().lower().split()
    if not found:
        return set()
    return {b" ".join(found[i: i + SHINGLE_WORDS]) for i in range(max(1, len(found) - SHINGLE_WORDS + 1))}


class ItemIndex:
    """Minimum hashes of items by size class, as sorted arrays, and the items' own shingles."""

    def __init__(self, items: list, inside: bool = False):
        """``items``: (item_id, text) with different shingle sets. ``inside``: see ``leaks``."""
        self.items = [(key, shingle_set(text)) for key, text in items]
        texts = [text for (_, text), (_, shingles) in zip(items, self.items) if shingles]
        self.items = [x for x in self.items if x[1]]
        hashes, bounds = text_shingles(pa.array(texts, pa.string()))
        classes: dict[int, list] = {}
        short: dict[int, list] = {}
        # An item of fewer words than a shingle is its own length's only shingle where it is looked for inside texts.
        self.whole = {}
        for i, (_, shingles) in enumerate(self.items):
            own = in_order(texts[i])
            if inside and own.count(b" ") - 1 < SHINGLE_WORDS:
                self.whole[i] = own
                short.setdefault(own.count(b" ") - 1, []).append(i)
            else:
                classes.setdefault(len(shingles).bit_length() - 1, []).append(i)
        self.short = {}
        for size, members in sorted(short.items()):
            keys = hashes[bounds[members]]
            order = np.argsort(keys)
            self.short[size] = keys[order], np.array(members)[order]
        self.classes = {}
        for k, members in sorted(classes.items()):
            minima = np.array([[mix(hashes[bounds[i]: bounds[i + 1]] ^ s).min() for i in members] for s in _SALTS])
            order = np.argsort(minima, axis=1)
            self.classes[k] = (np.take_along_axis(minima, order, 1), np.array(members)[order])

    def short_candidates(self, texts):
        """(row, item) pairs of items below a shingle's length and rows that hold such a run of words."""
        found = []
        if self.short:
            data, offsets = flat(texts)
            data = lowered(data)
            starts, ends, rows = words(data, offsets)
            hashed = word_hashes(data, starts, ends)
        for size, (keys, members) in self.short.items():
            runs, bounds = shingle_hashes(hashed, rows, len(texts), size)
            low = np.searchsorted(keys, runs, "left")
            many = np.searchsorted(keys, runs, "right") - low
            row = np.repeat(np.repeat(np.arange(len(texts)), np.diff(bounds)), many)
            at = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            found.append(np.unique(np.stack([row, members[at]], 1), axis=0))
        return np.concatenate(found) if found else np.empty((0, 2), np.int64)

    def candidates(self, hashes, bounds):
        """(row, item) pairs that share a minimum hash in some window."""
        if not len(hashes):
            return np.empty((0, 2), np.int64)
        # Block bounds of each class: every 2^k shingles from the start of a row.
        found = []
        shape = {}
        for k in self.classes:
            counts = -(-(bounds[1:] - bounds[:-1]) >> k)
            row = np.repeat(np.arange(len(counts)), counts)
            first = np.concatenate([[0], np.cumsum(counts)])
            shape[k] = (bounds[:-1][row] + ((np.arange(first[-1]) - first[:-1][row]) << k), row)
        for i, salt in enumerate(_SALTS):
            salted = mix(hashes ^ salt)
            for k, (keys, members) in self.classes.items():
                starts, row = shape[k]
                least = np.minimum.reduceat(salted, starts)
                window = least.copy()
                for step in (1, 2):
                    same = row[step:] == row[:-step]
                    window[:-step] = np.minimum(window[:-step], np.where(same, least[step:], NO_HASH))
                low = np.searchsorted(keys[i], window, "left")
                hit = np.flatnonzero((low < len(keys[i])) & (keys[i][np.minimum(low, len(keys[i]) - 1)] == window))
                if len(hit):
                    low = low[hit]
                    size = np.searchsorted(keys[i], window[hit], "right") - low
                    at = np.repeat(low, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    found.append(np.stack([np.repeat(row[hit], size), members[i][at]], 1))
        return np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 2), np.int64)


FOUND = "doc_id long, item_id long, n_shingles long, n_found long, containment double"


def _held(index: ItemIndex, texts, containment: float):
    """Yield (row, item_id, n_shingles, n_found) for every text that holds an item."""
    for row, item in index.short_candidates(texts).tolist():
        if index.whole[item] in in_order(texts[row].as_py()):
            yield row, index.items[item][0], 1, 1
    last, held = None, set()
    for row, item in index.candidates(*text_shingles(texts)).tolist():
        if row != last:
            last, held = row, shingle_set(texts[row].as_py())
        item_id, wanted = index.items[item]
        common = len(wanted & held)
        if common >= containment * len(wanted):
            yield row, item_id, len(wanted), common


def _block(docs: DataFrame, items: list, containment: float, inside: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(ItemIndex(items, inside))

    def search(batches):
        for whole in batches:
            for batch in blocks(whole, "text"):
                keys = batch.column("doc_id")
                rows = [(keys[row].as_py(), item_id, n, common, common / n)
                        for row, item_id, n, common in _held(shared.value, batch.column("text"), containment)]
                if rows:
                    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
                    names = ("doc_id", "item_id", "n_shingles", "n_found", "containment")
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return docs.mapInArrow(search, FOUND)


def _without(docs: DataFrame, items: list, containment: float) -> DataFrame:
    """``docs`` without the rows that hold one of ``items``, left out in the task that finds them."""
    shared = docs.sparkSession.sparkContext.broadcast(ItemIndex(items))

    def drop(batches):
        for whole in batches:
            for batch in blocks(whole, "text"):
                stays = np.ones(batch.num_rows, bool)
                stays[[row for row, *_ in _held(shared.value, batch.column("text"), containment)]] = False
                yield batch.filter(pa.array(stays))

    return docs.mapInArrow(drop, docs.schema)


def _item_blocks(items: DataFrame, block_bytes: int):
    """The different item texts, lowered and with single spaces, as lists of (item_id, text) of bounded size."""
    body = F.array_join(F.filter(F.split(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
                                         "[\\x20\\x09-\\x0D]+"), lambda w: w != ""), " ")
    known = items.where("text is not null").groupBy(body.alias("body")).agg(F.min("item_id").alias("item_id")).where("body != ''")
    size = known.agg(F.coalesce(F.sum(F.octet_length("body")), F.lit(0))).first()[0]
    n_blocks = max(1, math.ceil(size / block_bytes))
    for number in range(n_blocks):
        some = known.where(F.pmod(F.xxhash64("body"), F.lit(n_blocks)) == number)
        yield sorted(tuple(r) for r in some.select("item_id", "body").collect())


def leaks(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT,
          block_bytes: int = ITEM_BLOCK_BYTES, inside: bool = False) -> DataFrame:
    """Pairs (doc_id, item_id, n_shingles, n_found, containment) of documents that hold an item.

    Words are separated by ASCII white space, A-Z count as a-z. An item is held when at least
    ``containment`` of its distinct five-word shingles are in the whole document. An item of one to
    four words is one shingle of all its words, held by a document of just these words; with
    ``inside`` it is held wherever its words follow one another. Items with the same words in the
    same order are one, under the smallest item_id. Null and empty texts hold nothing and are
    held by nothing. Repeated document rows give repeated pairs; other columns are ignored.

    Only items travel to the tasks, at most about ``block_bytes`` of text at a time: a larger
    benchmark is searched for in several passes over the documents.
    """
    docs = docs.select("doc_id", "text")
    parts = [_block(docs, some, containment, inside) for some in _item_blocks(items, block_bytes)]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def clean(docs: DataFrame, items: DataFrame, containment: float = CONTAINMENT, block_bytes: int = ITEM_BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows whose text holds an item (see ``leaks``).

    The tasks that find such a row leave it out, so nothing is shuffled or written in between;
    repeated rows and null doc_ids are rows like any other.
    """
    for some in _item_blocks(items, block_bytes):
        docs = _without(docs, some, containment)
    return docs
