"""Small numpy helpers for tasks that walk text columns: rows as one byte buffer, words, shingles."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Text handled at a time inside a task; one longer row is still handled whole.
BLOCK_BYTES = 4 << 20
SHINGLE_WORDS = 5

_POWERS = np.cumprod(np.full(4096, 0x9E3779B97F4A7C15, np.uint64))


def blocks(batch, column, limit=BLOCK_BYTES):
    """Slices of an Arrow record batch whose texts in ``column`` take about ``limit`` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def flat(array):
    """The bytes of a string column and the row offsets into them; null counts as empty."""
    array = pc.fill_null(array.cast(pa.large_string()), "")
    bounds = np.frombuffer(array.buffers()[1], np.int64)[array.offset: array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8)[bounds[0]: bounds[-1]] if data is not None and len(array) else np.empty(0, np.uint8)
    return data, bounds - bounds[0] if len(bounds) else np.zeros(1, np.int64)


def lowered(data):
    """ASCII capitals as small letters."""
    return data + np.uint8(32) * ((data >= 65) & (data <= 90))


def words(data, offsets):
    """Start and end of every word (run of bytes that are not ASCII white space) and its row."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    first = np.ones(len(data) + 1, bool)
    first[1:-1] = space[:-1]
    first[offsets] = True
    starts = np.flatnonzero(first[:-1] & ~space)
    last = np.ones(len(data) + 1, bool)
    last[:-1] = space
    last[offsets] = True
    ends = np.flatnonzero(last[1:] & ~space) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def mix(h):
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data, starts, ends):
    """A 64-bit hash of each word's bytes."""
    if not len(starts):
        return np.empty(0, np.uint64)
    sizes = ends - starts
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    terms = (data[np.repeat(starts, sizes) + place] + np.uint64(1)) * _POWERS[place & 4095]
    return mix(np.add.reduceat(terms, np.cumsum(sizes) - sizes) + sizes.astype(np.uint64))


def shingle_hashes(hashes, rows, n_rows, size=SHINGLE_WORDS):
    """Hashes of the ``size``-word shingles of each row, and the row bounds in them.

    A row with fewer words, but at least one, has a single shingle of all its words.
    """
    counts = np.bincount(rows, minlength=n_rows)
    made = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(made)])
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    place = np.repeat(first, made) + np.arange(bounds[-1]) - np.repeat(bounds[:-1], made)
    width = np.repeat(np.minimum(counts, size), made)
    out = width.astype(np.uint64)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    for k in range(size):
        out += np.where(k < width, padded[place + k] * _POWERS[k + 1], np.uint64(0))
    return mix(out), bounds
