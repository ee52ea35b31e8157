"""Token-id files: concatenated ids with Elias-Fano coded document boundaries, written and read on Spark.

A file holds the ids of consecutive documents, then two monotone sequences in Elias-Fano form
(where each document ends, and the doc_ids themselves), then a fixed footer:

    ids | ends: low bits, high bits, samples | doc_ids: the same | footer

All numbers are little-endian. Files are written under a temporary name and renamed when complete,
so a task that is run again, or twice at once, leaves one whole file.
"""

import struct
import uuid

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsift.llm.text import blocks
from postsift.llm.tokens import crc, encoder
from postsift.session import shared_dir, staged

# Ids in one file at most, but for a longer single document.
FILE_IDS = 16 << 20
# Documents in one batch of rows when files are read.
DOCS_AT_ONCE = 4096
SAMPLE = 256
MAGIC = b"EFTOKENS"
FOOTER = struct.Struct("<8sQQQQqQQQQQQ")


class EliasFano:
    """A sequence of ascending whole numbers from 0 on, in close to two bits and log2(u/n) each.

    The low bits stand packed; the high parts are unary: value i sets bit (high part + i) of a
    bit vector. ``select`` finds that bit from a sample of every 256th one and a popcount over
    the bytes that follow, so single offsets are read without a table of 64-bit numbers.
    """

    def __init__(self, n, low_bits, low, high, samples):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values):
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = values & np.uint64((1 << low_bits) - 1)
        bits = ((low[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(at[-1]) + 1 if n else 0, np.uint8)
        high[at] = 1
        return cls(n, low_bits, np.packbits(bits.ravel(), bitorder="little"),
                   np.packbits(high, bitorder="little"), at[::SAMPLE].astype("<u4"))

    def _low(self, i: int) -> int:
        first, last = i * self.low_bits, (i + 1) * self.low_bits
        whole = int.from_bytes(self.low[first // 8: (last + 7) // 8].tobytes(), "little")
        return (whole >> (first % 8)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Value i."""
        at, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        if left:
            step = at // 8
            left += int(np.bitwise_count(self.high[step] & np.uint8((1 << at % 8) - 1))) + 1
            width = 64
            while True:
                ones = np.cumsum(np.bitwise_count(self.high[step: step + width]), dtype=np.int64)
                if ones[-1] >= left:
                    break
                left -= int(ones[-1])
                step += width
            byte = int(np.searchsorted(ones, left))
            left -= int(ones[byte - 1]) if byte else 0
            inside = np.flatnonzero(np.unpackbits(self.high[step + byte: step + byte + 1], bitorder="little"))
            at = (step + byte) * 8 + int(inside[left - 1])
        return ((at - i) << self.low_bits) | self._low(i)

    def decode(self) -> np.ndarray:
        """All values."""
        at = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n].astype(np.uint64)
        bits = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits)
        low = (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(1, dtype=np.uint64)
        return ((at - np.arange(self.n, dtype=np.uint64)) << np.uint64(self.low_bits)) | low

    def parts(self):
        return [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]


class TokenFile:
    """One file, read whole or a document at a time."""

    def __init__(self, path: str):
        store, name = fs.FileSystem.from_uri(path)
        self.source = store.open_input_file(name)
        size = self.source.size()
        (magic, self.id_bytes, self.n_ids, self.n_docs, self.n_null, self.base, *self.sizes) = FOOTER.unpack(
            self.source.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        at = self.n_ids * self.id_bytes
        data = self.source.read_at(size - FOOTER.size - at, at)
        self.ends, used = self._sequence(data, 0, self.n_docs, self.sizes[:3])
        self.keys, _ = self._sequence(data, used, self.n_docs - self.n_null, self.sizes[3:])

    @staticmethod
    def _sequence(data, at, n, sizes):
        low_bits, low, high = sizes
        samples = 4 * -(-n // SAMPLE)
        cut = np.frombuffer(data, np.uint8)[at: at + low + high + samples]
        return EliasFano(n, low_bits, cut[:low], cut[low: low + high], cut[low + high:].view("<u4")), at + low + high + samples

    def ids(self, start: int, stop: int) -> np.ndarray:
        data = self.source.read_at((stop - start) * self.id_bytes, start * self.id_bytes)
        return np.frombuffer(data, f"<u{self.id_bytes}")

    def document(self, i: int) -> np.ndarray:
        """The ids of document ``i`` of this file."""
        return self.ids(self.ends.select(i - 1) if i else 0, self.ends.select(i))

    def doc_ids(self) -> list:
        """Null ids come first, then ascending ones."""
        return [None] * self.n_null + [self.base + int(v) for v in self.keys.decode()]

    def close(self):
        self.source.close()


class _Writer:
    def __init__(self, folder, name, id_bytes):
        self.store, base = fs.FileSystem.from_uri(folder)
        self.store.create_dir(base, recursive=True)
        self.final = f"{base}/{name}"
        self.open_name = f"{base}/.{name}.{uuid.uuid4().hex}"
        self.path = f"{folder}/{name}"
        self.out = self.store.open_output_stream(self.open_name)
        self.id_bytes, self.n_ids, self.ends, self.keys = id_bytes, 0, [], []

    def add(self, key, ids: bytes):
        wide = np.frombuffer(ids, "<u4")
        if len(wide) and int(wide.max()) >> (8 * self.id_bytes):
            raise ValueError(f"token id {int(wide.max())} doesn't fit {self.id_bytes} bytes")
        self.out.write(wide.astype(f"<u{self.id_bytes}").tobytes())
        self.n_ids += len(ids) // 4
        self.ends.append(self.n_ids)
        self.keys.append(key)

    def close(self):
        known = [k for k in self.keys if k is not None]
        base = known[0] if known else 0
        ends = EliasFano.of(self.ends)
        keys = EliasFano.of([k - base for k in known])
        for part in ends.parts() + keys.parts():
            self.out.write(part)
        sizes = [x for s in (ends, keys) for x in (s.low_bits, len(s.low), len(s.high))]
        self.out.write(FOOTER.pack(
            MAGIC, self.id_bytes, self.n_ids, len(self.ends), len(self.keys) - len(known), base, *sizes))
        self.out.close()
        self.store.move(self.open_name, self.final)


MANIFEST = "part long, file long, path string, n_docs long, n_ids long"


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_bytes: int = 2,
          file_ids: int = FILE_IDS) -> DataFrame:
    """Write ``docs`` in ascending doc_id order; return the manifest, one row per file.

    Null texts count as empty: the end id alone. A null doc_id comes before all others, repeated
    doc_ids stand side by side. Other columns are ignored.
    """

    def save(batches):
        tokens = encoder(tokenizer, spaced=True)
        end = end_id.to_bytes(4, "little")
        part, number, writer = TaskContext.get().partitionId(), 0, None
        for whole in batches:
            for batch in blocks(whole, "text"):
                for key, ids in zip(batch.column("doc_id").to_pylist(), tokens.encode(batch.column("text").to_pylist())):
                    if writer and writer.n_ids + len(ids) // 4 + 1 > file_ids:
                        writer.close()
                        yield _manifest(part, number, writer)
                        number, writer = number + 1, None
                    writer = writer or _Writer(folder, f"ids-{part:06d}-{number:04d}.eft", id_bytes)
                    writer.add(key, ids + end)
        if writer:
            writer.close()
            yield _manifest(part, number, writer)

    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first()))
    return staged(ordered.mapInArrow(save, MANIFEST), "manifest")


def _manifest(part, number, writer):
    values = (part, number, writer.path, len(writer.ends), writer.n_ids)
    names = ("part", "file", "path", "n_docs", "n_ids")
    return pa.RecordBatch.from_pydict({n: [v] for n, v in zip(names, values)})


ROW = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])


def read(manifest: DataFrame, at_once: int = 1 << 20) -> DataFrame:
    """Per document, from the files: doc_id, start over all files, n_tokens, ids_crc32.

    Where a document ends is selected from the coded boundaries, a bounded number at a time, and the
    files are spread over the tasks. The manifest has one narrow row per file, so its running sum is small however large the ids are.
    """
    before = F.sum("n_ids").over(Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.select("path", F.coalesce(before, F.lit(0)).alias("before"))
    # A stated number of partitions, which the runtime doesn't merge into one.
    spread = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    files = placed.repartition(spread, F.col("path"))

    def load(batches):
        for batch in batches:
            for path, before in zip(batch.column("path").to_pylist(), batch.column("before").to_pylist()):
                file = TokenFile(path)
                keys, start, i = file.doc_ids(), 0, 0
                while i < file.n_docs:
                    ends = [file.ends.select(i)]
                    while i + len(ends) < file.n_docs and len(ends) < DOCS_AT_ONCE:
                        end = file.ends.select(i + len(ends))
                        if end - start > at_once:
                            break
                        ends.append(end)
                    starts = [start, *ends[:-1]]
                    ids = file.ids(start, ends[-1]).astype("<u4").tobytes()
                    sums = [crc(ids[4 * (a - start): 4 * (b - start)]) for a, b in zip(starts, ends)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys[i: i + len(ends)], pa.int64()), pa.array([a + before for a in starts], pa.int64()),
                         pa.array([b - a for a, b in zip(starts, ends)], pa.int64()), pa.array(sums, pa.int64())], names=ROW.names)
                    start, i = ends[-1], i + len(ends)
                file.close()

    return files.mapInArrow(load, ROW)


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the documents' ids to a fresh folder below the shared one and read the files back."""
    return read(write(docs, shared_dir(spark, "token-files"), tokenizer, end_id))
