"""WARC archives: written by tasks, found again through a two-level capture index, read by ranges.

A capture is one gzip member in an archive, so it can be read alone from its offset. Of captures with
equal payloads one is a response; the others are revisit records that name it and hold no body.

The index holds one line per capture, ordered by its key: the URL with its host reversed, so a site's
captures stand together. Each index file is a run of compressed blocks of such lines, then a sparse
directory with the first key and the place of every block, then a fixed footer. To find a URL, the index
files are picked by their first and last keys, the directory is searched by halves, and the one or
few blocks that can hold the key are read by their ranges; then the captures are, likewise.
"""

import base64
import bisect
import hashlib
import struct
import uuid
import zlib
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postsift.llm.text import blocks
from postsift.operators.lookup import lookup
from postsift.session import shared_dir, staged

# Bytes after which an archive file is closed, lines of one index block, captures of one index file.
FILE_BYTES = 1 << 30
BLOCK_LINES = 1000
INDEX_LINES = 1 << 18
# Captures of one archive that lie this close together are fetched in one read of about READ bytes.
GAP, READ = 1 << 16, 8 << 20
DATE = "2024-02-01T00:00:00Z"
# Payloads below this are never revisits.
LEAST_BYTES = 0
# Fixed values of the format: the profile of records whose payload was seen before.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"WARCINDX"
FOOTER = struct.Struct("<8sQQQ")
DEFAULT_PORTS = {"http": "80", "https": "443"}


def url_key(url: str | None) -> str:
    """The URL with its host reversed: ``http://Blog.a.com:80/x?q#f`` becomes ``com,a,blog)/x?q``.

    Scheme, user, default port and fragment go, host letters are lowered. A text without ``://`` has
    no host. Null counts as empty.
    """
    text = (url or "").split("#", 1)[0]
    scheme, found, rest = text.partition("://")
    if not found:
        return f"){text}"
    cut = min([i for i in (rest.find("/"), rest.find("?")) if i >= 0], default=len(rest))
    host, path = rest[:cut].rpartition("@")[2], rest[cut:]
    name, colon, port = host.rpartition(":")
    if not colon or not port.isdigit():
        name, port = host, ""
    keep = f":{port}" if port and DEFAULT_PORTS.get(scheme.lower()) != port else ""
    return f"{','.join(reversed(name.lower().split('.')))}{keep}){path if path.startswith('/') else '/' + path}"


def header_text(text: str) -> str:
    """``text`` for a header line: control characters and spaces as %XX."""
    return "".join(f"%{ord(c):02X}" if ord(c) <= 0x20 or ord(c) == 0x7F else c for c in text)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _page(page_id) -> str:
    return f"<urn:page:{page_id}>"


def record(page_id, url, payload: bytes, refers_to=None, first_url=None, date=DATE) -> bytes:
    """One record: a response, or a revisit of page ``refers_to`` where that is given."""
    size = len(payload)
    body = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Date: {date}"]
    if page_id is not None:
        lines.append(f"WARC-Record-ID: {_page(page_id)}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {header_text(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest(payload)}")
    if refers_to is None:
        body += payload
    else:
        lines += [f"WARC-Refers-To: {_page(refers_to)}", f"WARC-Refers-To-Date: {date}", f"WARC-Profile: {REVISIT_PROFILE}"]
        if first_url is not None:
            lines.append(f"WARC-Refers-To-Target-URI: {header_text(first_url)}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _headers(text: bytes) -> dict:
    pairs = (line.partition(":") for line in text.decode().split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def _page_id(text):
    return int(text[len("<urn:page:"):-1]) if text else None


def parse(data: bytes) -> dict:
    """The fields of one record: page_id, url, record_type, refers_to, payload (None for a revisit),
    payload_bytes and payload_digest. A response whose payload doesn't have its stated digest or size raises."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    size, kind = int(_headers(http)["content-length"]), fields["warc-type"]
    stated = fields["warc-payload-digest"].removeprefix("sha1:")
    if kind == "response" and (len(body) != size or digest(body) != stated):
        raise ValueError(f"damaged record {fields.get('warc-record-id')}")
    return {"page_id": _page_id(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": kind,
            "refers_to": _page_id(fields.get("warc-refers-to")), "payload": body if kind == "response" else None,
            "payload_bytes": size, "payload_digest": stated}


class _File:
    """A file under a temporary name that gets its own when complete, so a task run twice leaves whole files."""

    def __init__(self, folder, name):
        self.store, base = fs.FileSystem.from_uri(folder)
        self.store.create_dir(base, recursive=True)
        name = f"{uuid.uuid4().hex}-{name}"
        self.open_name, self.final, self.path = f"{base}/.{name}", f"{base}/{name}", f"{folder}/{name}"
        self.out, self.size = self.store.open_output_stream(self.open_name, compression=None), 0

    def add(self, data: bytes) -> tuple[int, int]:
        """Write ``data`` and return where it stands: offset and length."""
        self.out.write(data)
        self.size += len(data)
        return self.size - len(data), len(data)

    def close(self):
        self.out.close()
        self.store.move(self.open_name, self.final)


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


# ---- writing ---------------------------------------------------------------------------------------------

CAPTURE = "key string, page_id long, file string, offset long, length long"
_NAMES = [part.split()[0] for part in CAPTURE.split(", ")]


def _payload(html="html") -> Column:
    return F.coalesce(F.col(html), F.lit(""))


def typed(pages: DataFrame, least_bytes=LEAST_BYTES) -> DataFrame:
    """page_id, url, html, refers_to, first_url: which pages revisit the smallest page_id of their payload.

    Payloads are the same when SHA-1, a second 64-bit hash and the size agree. Only payloads that occur
    more than once are looked up, and a payload with a third of all pages is one row there.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), _payload().alias("html"))
    rows = rows.withColumn("same", F.concat_ws(":", F.sha1("html"), F.xxhash64("html"), F.octet_length("html")))
    large = F.octet_length("html") >= least_bytes
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")
    firsts = rows.where(large).groupBy("same").agg(F.count("*").alias("n"), F.min(order).alias("first")).where(
        (F.col("n") > 1) & F.col("first.page_id").isNotNull()).select(
        "same", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    again = large & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return lookup(rows, firsts, "same").select(
        "page_id", "url", "html", F.when(again, F.col("first_id")).alias("refers_to"), F.when(again, F.col("first_url")).alias("first_url"))


def write(pages: DataFrame, folder: str, file_bytes=FILE_BYTES, least_bytes=LEAST_BYTES, date=DATE) -> DataFrame:
    """Write a record per row of ``pages`` and return the captures: key, page_id, file, offset, length."""
    def save(batches):
        part, file, count = TaskContext.get().partitionId(), None, 0
        for whole in batches:
            for batch in blocks(whole, "html"):
                made = []
                for page_id, url, html, refers_to, first_url in zip(*(batch.column(c).to_pylist() for c in range(5))):
                    if file is None:
                        file, count = _File(folder, f"{part:06d}-{count:04d}.warc.gz"), count + 1
                    place = file.add(_gzip(record(page_id, url, html.encode(), refers_to, first_url, date)))
                    made.append((header_text(url_key(url)), page_id, file.path, *place))
                    if file.size >= file_bytes:
                        file.close()
                        file = None
                columns = [pa.array(c, t) for c, t in zip(zip(*made), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)
        if file is not None:
            file.close()

    return staged(typed(pages, least_bytes).mapInArrow(save, CAPTURE), "captures")


# ---- the index -------------------------------------------------------------------------------------------

SHARD = "path string, first_key string, last_key string, n_captures long, n_blocks long"


def _line(values) -> str:
    key, page_id, file, offset, length = values
    return "\t".join([key, "" if page_id is None else str(page_id), file, str(offset), str(length)])


def _values(line: str):
    key, page_id, file, offset, length = line.split("\t")
    return key, int(page_id) if page_id else None, file, int(offset), int(length)


def _shard(folder, name, lines, block_lines):
    """Write one index file of sorted ``lines`` (key, line) and return its row for the manifest."""
    file, directory = _File(folder, name), []
    for start in range(0, len(lines), block_lines):
        some = lines[start: start + block_lines]
        place = file.add(zlib.compress("\n".join(line for _, line in some).encode(), 6))
        directory.append(f"{some[0][0]}\t{place[0]}\t{place[1]}")
    offset, length = file.add(zlib.compress("\n".join(directory).encode(), 6))
    file.add(FOOTER.pack(MAGIC, offset, length, len(lines)))
    file.close()
    return [file.path], [lines[0][0]], [lines[-1][0]], [len(lines)], [len(directory)]


def build_index(captures: DataFrame, folder: str, block_lines=BLOCK_LINES, index_lines=INDEX_LINES) -> DataFrame:
    """Write the captures as index files, ordered by key, and return one row per file.

    Files are ranges of (key, file, offset), so a URL captured very often spans several of them.
    """
    order = [F.asc("key"), F.asc("file"), F.asc("offset")]

    def save(batches):
        part, number, held = TaskContext.get().partitionId(), 0, []
        names = [p.split()[0] for p in SHARD.split(", ")]
        for batch in batches:
            for values in zip(*(batch.column(c).to_pylist() for c in range(5))):
                held.append((values[0], _line(values)))
                if len(held) == index_lines:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, _shard(folder, f"{part:06d}-{number:04d}.idx", held, block_lines))))
                    number, held = number + 1, []
        if held:
            yield pa.RecordBatch.from_pydict(dict(zip(names, _shard(folder, f"{part:06d}-{number:04d}.idx", held, block_lines))))

    dealt = captures.select(*_NAMES).repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(dealt.mapInArrow(save, SHARD), "index")


class IndexFile:
    """One index file: its directory is read whole, its blocks by their ranges."""

    def __init__(self, path: str):
        store, name = fs.FileSystem.from_uri(path)
        self.source = store.open_input_file(name)
        size = self.source.size()
        magic, offset, length, self.n_captures = FOOTER.unpack(self.source.read_at(FOOTER.size, size - FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{path} is no index file")
        lines = zlib.decompress(self.source.read_at(length, offset)).decode().split("\n")
        self.directory = [(key, int(at), int(n)) for key, at, n in (line.split("\t") for line in lines)]
        self.keys = [entry[0] for entry in self.directory]
        self.n_read = 0

    def block(self, i: int) -> list:
        """The captures of block ``i``, in order."""
        _, offset, length = self.directory[i]
        self.n_read += 1
        return [_values(line) for line in zlib.decompress(self.source.read_at(length, offset)).decode().split("\n")]

    def find(self, key: str):
        """The captures with ``key``: blocks from the last that starts before it to the last that starts with it."""
        for i in range(max(0, bisect.bisect_left(self.keys, key) - 1), bisect.bisect_right(self.keys, key)):
            held = self.block(i)
            low = bisect.bisect_left(held, key, key=lambda v: v[0])
            yield from held[low: bisect.bisect_right(held, key, key=lambda v: v[0])]

    def all(self):
        for i in range(len(self.directory)):
            yield self.block(i)

    def close(self):
        self.source.close()


def _capture_batch(rows):
    kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=_NAMES)


def captures_of(index: DataFrame) -> DataFrame:
    """All captures, block by block from the index files."""
    def load(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                file = IndexFile(path)
                for held in file.all():
                    yield _capture_batch(held)
                file.close()

    return _dealt(index.select("path"), "path").mapInArrow(load, CAPTURE)


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows spread by key over a stated number of partitions, which the runtime doesn't merge."""
    spread = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(spread, *[F.col(k) for k in keys])


def find(index: DataFrame, urls: DataFrame) -> DataFrame:
    """The captures of each distinct ``url`` of ``urls``, as (url, key, page_id, file, offset, length).

    The manifest, one narrow row per index file (of up to INDEX_LINES captures), goes to all tasks: a
    key's files stand together in it and are found by halves. A task then opens each file once for
    all its keys, in order.
    """
    files = sorted(tuple(r) for r in index.select("first_key", "last_key", "path").collect())
    shared = urls.sparkSession.sparkContext.broadcast(([f[0] for f in files], [f[1] for f in files], [f[2] for f in files]))

    def place(batches):
        firsts, lasts, paths = shared.value
        for batch in batches:
            made = []
            for url in batch.column("url").to_pylist():
                key = header_text(url_key(url))
                made += [(url, key, path) for path in paths[bisect.bisect_left(lasts, key): bisect.bisect_right(firsts, key)]]
            yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], pa.string()) for i in range(3)], names=["url", "key", "path"])

    asked = urls.select("url").distinct().mapInArrow(place, "url string, key string, path string")

    def load(batches):
        path, file = None, None
        for batch in batches:
            made = []
            for url, key, wanted in zip(*(batch.column(c).to_pylist() for c in ("url", "key", "path"))):
                if wanted != path:
                    if file is not None:
                        file.close()
                    path, file = wanted, IndexFile(wanted)
                made += [(url, *found) for found in file.find(key)]
            if made:
                captures = _capture_batch([m[1:] for m in made])
                yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made])] + captures.columns, names=["url", *_NAMES])
        if file is not None:
            file.close()

    return _dealt(asked, "path").sortWithinPartitions("path", "key").mapInArrow(load, f"url string, {CAPTURE}")


# ---- reading ---------------------------------------------------------------------------------------------

RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


@lru_cache(maxsize=4)
def _open(path):
    store, name = fs.FileSystem.from_uri(path)
    return store.open_input_file(name)


def _ranges(places):
    """Runs of (offset, length), in order, that are close enough for one read."""
    run, end = [], 0
    for offset, length in places:
        if run and (offset > end + GAP or end - run[0][0] > READ):
            yield run
            run = []
        run.append((offset, length))
        end = max(end, offset + length)
    if run:
        yield run


def fetch(captures: DataFrame, payloads=True) -> DataFrame:
    """The records at ``captures`` (file, offset, length), read by ranges; without payloads they are only checked."""
    names = [p.split()[0] for p in RECORD.split(", ")]
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64())

    def batch_of(made):
        return pa.RecordBatch.from_arrays([pa.array([m[n] for m in made], k) for n, k in zip(names, kinds)], names=names)

    def load(batches):
        for batch in batches:
            by_file = {}
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                by_file.setdefault(file, []).append((offset, length))
            for file, places in by_file.items():
                for run in _ranges(sorted(places)):
                    start = run[0][0]
                    data = _open(file).read_at(max(o + n for o, n in run) - start, start)
                    made = []
                    for offset, length in run:
                        found = parse(zlib.decompress(data[offset - start: offset - start + length], 31))
                        made.append(found if payloads else {**found, "payload": None})
                    yield batch_of(made)

    # Stretches of one archive, so one archive may be read by many tasks.
    stretch = F.shiftright("offset", 26)
    dealt = captures.select("file", "offset", "length", stretch.alias("stretch"))
    return _dealt(dealt, "file", "stretch").sortWithinPartitions("file", "offset").select("file", "offset", "length").mapInArrow(load, RECORD)


def round_trip(spark: SparkSession, pages: DataFrame, least_bytes=LEAST_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as archives with an index, read all back through the index.

    Per row: page_id, payload_bytes, payload_digest (base32 SHA-1 of the whole payload), record_type,
    refers_to, url. A null html is an empty payload. Of rows with equal payloads of ``least_bytes`` or
    more, those with the smallest page_id are responses (repeated rows with that id all are), the
    others revisit it; a null page_id comes after all others, and rows that all have none are
    responses. A null URL has no target; control characters and spaces of URLs come back as %XX.
    An empty table gives no rows, other columns are ignored.
    """
    base = shared_dir(spark, "warc")
    captures = write(pages, f"{base}/archives", least_bytes=least_bytes)
    index = build_index(captures, f"{base}/index")
    return fetch(captures_of(index), payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")
