"""Listing pages as a Spark data source: a folder of JSON pages, read in batch or as a stream.

A page is one file of JSON lines, a post each, named ``<number>.json`` or ``<number>-<anything>.json``; its
number says where it stands in the listing. Numbers only grow, and a page isn't changed once it is there.

    use_pages(spark)
    spark.read.format("listing_pages").option("path", folder).load()
    spark.readStream.format("listing_pages").option("path", folder).option("pagesPerBatch", 4).load()

Community and time filters of a query are pushed down: a line that fails them isn't turned into a row. A
stream's offset is the number of the last page taken, so a restart goes on behind it. With pagesPerBatch a
run with the trigger availableNow takes one such batch; without it, all pages that are there. Lines that
are no JSON object are passed over; fields of another kind than the schema's are NULL.
"""

import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    LessThan, LessThanOrEqual,
)

from postsift import schemas
from postsift.operators.numbering import with_batch

PAGES_PER_TASK = 8
ROWS = 4096

# How a pushed filter tests a value, by its kind.
_TESTS = {
    EqualTo: lambda value, wanted: value == wanted, In: lambda value, wanted: value in wanted,
    GreaterThan: lambda value, wanted: value > wanted, GreaterThanOrEqual: lambda value, wanted: value >= wanted,
    LessThan: lambda value, wanted: value < wanted, LessThanOrEqual: lambda value, wanted: value <= wanted,
}
_PUSHED = ("subreddit", "created_utc")


def list_pages(folder: str) -> list[tuple[int, str]]:
    """(number, path) of the folder's pages in order; other files are passed over."""
    store, base = fs.FileSystem.from_uri(folder)
    found = []
    for info in store.get_file_info(fs.FileSelector(base, allow_not_found=True)):
        number = info.base_name.removesuffix(".json").split("-")[0]
        if info.type == fs.FileType.File and info.base_name.endswith(".json") and number.isdigit():
            found.append((int(number), info.path))
    return sorted(found)


class Pages(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


def _dealt(pages: list[tuple[int, str]], per_task: int) -> list[Pages]:
    paths = [path for _, path in pages]
    return [Pages(paths[i: i + per_task]) for i in range(0, len(paths), per_task)]


def _passes(post: dict, tests) -> bool:
    for column, test, wanted in tests:
        value = post.get(column)
        if value is None or not test(value, wanted):
            return False
    return True


def _value(field, post: dict):
    """A field of a post in the type of the schema; NULL where it is absent or of another kind."""
    value, kind = post.get(field.name), field.dataType.typeName()
    if kind == "string":
        return value if isinstance(value, str) else None
    if isinstance(value, bool) or not isinstance(value, (int, float)):
        return None
    return float(value) if kind == "double" else int(value)


class _Lines:
    """Turns pages into record batches; shared by the batch and the stream reader."""

    def __init__(self, schema, options):
        self.schema, self.folder = schema, options["path"]
        self.per_task = int(options.get("pagesPerTask", PAGES_PER_TASK))
        self.tests = []

    def read(self, partition: Pages | None) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(self.schema)
        store, _ = fs.FileSystem.from_uri(self.folder)
        held = []

        def batch():
            return pa.RecordBatch.from_arrays(
                [pa.array([_value(f, post) for post in held], kinds.field(f.name).type) for f in self.schema.fields], schema=kinds)

        for path in partition.paths if partition else []:  # Spark reads once where there is no partition
            with store.open_input_stream(path) as page:
                for line in page.read().decode().split("\n"):
                    try:
                        post = json.loads(line)
                    except ValueError:
                        continue
                    if isinstance(post, dict) and _passes(post, self.tests):
                        held.append(post)
                    if len(held) == ROWS:
                        yield batch()
                        held = []
        if held:
            yield batch()


class BatchReader(_Lines, DataSourceReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Take the tests on community and time; Spark applies what is given back, nulls pass none of them."""
        for test in filters:
            column = getattr(test, "attribute", None)
            if type(test) in _TESTS and column is not None and len(column) == 1 and column[0] in _PUSHED and test.value is not None:
                self.tests.append((column[0], _TESTS[type(test)], test.value))
            else:
                yield test

    def partitions(self) -> list[Pages]:
        return _dealt(list_pages(self.folder), self.per_task)


class StreamReader(_Lines, DataSourceStreamReader):
    def __init__(self, schema, options):
        super().__init__(schema, options)
        self.per_batch = int(options.get("pagesPerBatch", 0))
        self.last = -1

    def initialOffset(self) -> dict:
        return {"page": -1}

    def latestOffset(self) -> dict:
        ahead = [number for number, _ in list_pages(self.folder) if number > self.last]
        if ahead:
            self.last = ahead[min(len(ahead), self.per_batch or len(ahead)) - 1]
        return {"page": self.last}

    def partitions(self, start: dict, end: dict) -> list[Pages]:
        self.last = max(self.last, end["page"])
        return _dealt([p for p in list_pages(self.folder) if start["page"] < p[0] <= end["page"]], self.per_task)

    def commit(self, end: dict) -> None:
        self.last = max(self.last, end["page"])


class ListingPages(DataSource):
    """Posts from a folder of listing pages: options path, pagesPerTask, pagesPerBatch (streams; 0: all there are)."""

    @classmethod
    def name(cls) -> str:
        return "listing_pages"

    def schema(self):
        return schemas.POSTS

    def reader(self, schema) -> BatchReader:
        return BatchReader(schema, self.options)

    def streamReader(self, schema) -> StreamReader:
        return StreamReader(schema, self.options)


def use_pages(spark: SparkSession) -> None:
    """Make the format known to a session, with its filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ListingPages)


def write_pages(posts: DataFrame, folder: str, size=500, first=0) -> DataFrame:
    """Write ``posts`` in order of seq as pages of ``size`` rows, numbered from ``first``: (number, n_posts) per page.

    A page is written under a temporary name and then renamed, so a task that runs twice leaves it whole.
    """
    def save(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        held: dict[int, list[str]] = {}
        for batch in batches:
            for number, line in zip(batch.column("batch_no").to_pylist(), batch.column("line").to_pylist()):
                held.setdefault(number, []).append(line)
            for number in sorted(held)[:-1]:
                yield close(store, base, number, held.pop(number))
        for number in sorted(held):
            yield close(store, base, number, held.pop(number))

    def close(store, base, number, lines):
        name = f"{base}/.{number}-{uuid.uuid4().hex}"
        with store.open_output_stream(name) as out:
            out.write("\n".join(lines).encode())
        store.move(name, f"{base}/{number + first}.json")
        return pa.RecordBatch.from_pydict({"number": [number + first], "n_posts": [len(lines)]})

    rows = with_batch(posts.select("seq", F.to_json(F.struct(*[c for c in schemas.POSTS.names if c in posts.columns])).alias("line")), size)
    dealt = rows.repartition("batch_no").sortWithinPartitions("batch_no", "batch_pos").select("batch_no", "line")
    return dealt.mapInArrow(save, "number long, n_posts long")
