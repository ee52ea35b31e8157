"""SimHash near-duplicates: fingerprints, links found in BK-trees, connected groups."""

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postsift.llm.text import blocks, flat, lowered, shingle_hashes, word_hashes, words
from postsift.session import scratch, shared_dir, staged

RADIUS = 3
SHINGLE = 3
# Fingerprints in one BK-tree. A larger shard is held by several trees, each met by all its queries.
TREE_SIZE = 4096
# Starts of five runs of bits. Three differing bits leave at least two of the five runs untouched, so each pair of
# runs is a table of its own, with keys of about 26 bits.
RUNS = (0, 13, 26, 39, 52, 64)


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of one text: a bit is 1 where over half of the shingle hashes have it."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    count = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(b" ".join(words[i: i + SHINGLE]), 42) for i in range(count)), np.uint64, count)
    ones = np.zeros(64, np.int64)
    for at in range(0, count, 1 << 16):
        bits = np.unpackbits(hashes[at: at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.int64)[0])


def add_fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint", keep=None) -> DataFrame:
    """``docs`` (or its columns in ``keep``) with the fingerprint as a signed long.

    Null and empty texts, and texts of white space only, have fingerprint zero.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c != name]
    frame = docs.select(F.col(f"`{text}`").alias("__text"), *[F.col(f"`{c}`") for c in kept])
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(name, T.LongType())])

    def add(batches):
        for whole in batches:
            for batch in blocks(whole, "__text"):
                prints = pa.array([fingerprint(t.as_py()) for t in batch.column("__text")], pa.int64())
                yield pa.RecordBatch.from_arrays(batch.columns[1:] + [prints], names=kept + [name])

    return frame.mapInArrow(add, schema)


# ---- BK-trees -------------------------------------------------------------------------------------------


def build_trees(prints: np.ndarray, shard: np.ndarray):
    """A BK-tree for each shard, all grown level by level.

    The first fingerprint that reaches a place becomes the node there; the others go on to the
    child named by their Hamming distance to it. Returns the roots' shards and nodes, and the
    edges as (parent * 65 + distance) with the child at its end, both sorted.
    """
    left = np.arange(len(prints))
    place = shard.astype(np.int64)
    roots = None
    keys, children = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    while True:
        names, first, which = np.unique(place, return_index=True, return_inverse=True)
        nodes = left[first]
        if roots is None:
            roots = (names, nodes)
        else:
            keys.append(names)
            children.append(nodes)
        rest = np.ones(len(left), bool)
        rest[first] = False
        if not rest.any():
            break
        parent = nodes[which[rest]]
        left = left[rest]
        place = parent * 65 + np.bitwise_count(prints[left] ^ prints[parent])
    keys, children = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(keys)
    return roots, keys[order], children[order]


def search_trees(trees, prints, query, query_shard, radius=RADIUS, at_once=2048):
    """Yield (query, node) index pairs within ``radius``; only edges within the radius are followed."""
    (shards, nodes), keys, children = trees
    found = np.searchsorted(shards, query_shard)
    inside = found < len(shards)
    inside[inside] = shards[found[inside]] == query_shard[inside]
    asking = np.flatnonzero(inside)
    for start in range(0, len(asking), at_once):
        q = asking[start: start + at_once]
        v = nodes[found[q]]
        while len(q):
            gap = np.bitwise_count(query[q] ^ prints[v]).astype(np.int64)
            near = gap <= radius
            yield q[near], v[near]
            low = np.searchsorted(keys, v * 65 + np.maximum(gap - radius, 0))
            size = np.searchsorted(keys, v * 65 + np.minimum(gap + radius, 64), "right") - low
            q = np.repeat(q, size)
            ends = np.cumsum(size)
            v = children[np.repeat(low, size) + np.arange(len(q)) - np.repeat(ends - size, size)]


def unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the classes of each pair in ``label``, in place; a class is named by its smallest member."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, label[label]):
            label[:] = label[label]


EDGE = "a long, b long"


def _link(batches):
    """Rows (shard, member, fingerprint) sorted by shard, members first: a spanning set of links."""
    held_shard, held = np.empty(0, np.int64), np.empty(0, np.uint64)
    for batch in batches:
        shard = np.concatenate([held_shard, batch.column("shard").to_numpy()])
        prints = np.concatenate([held, batch.column("print").to_numpy().view(np.uint64)])
        member = np.concatenate([np.ones(len(held), bool), batch.column("member").to_numpy(zero_copy_only=False) == 0])
        if not len(shard):
            continue
        inside = np.flatnonzero(member)
        label = np.arange(len(prints))
        asking = np.arange(len(held), len(prints))
        trees = build_trees(prints[inside], shard[inside])
        for q, v in search_trees(trees, prints[inside], prints[asking], shard[asking]):
            unite(label, asking[q], inside[v])
        tied = np.flatnonzero(label != np.arange(len(label)))
        ends = [pa.array(prints[i].view(np.int64)) for i in (tied, label[tied])]
        yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])
        open_ = member & (shard == shard[-1])
        held_shard, held = shard[open_], prints[open_]


def _tables() -> list:
    """The shard of ``print`` in the table of each two runs of bits."""
    def run(i):
        return f"(shiftrightunsigned(print, {RUNS[i]}) & {(1 << (RUNS[i + 1] - RUNS[i])) - 1}L)"

    pairs = itertools.combinations(range(len(RUNS) - 1), 2)
    return [F.expr(f"shiftleft({number}L, 26) | shiftleft({run(i)}, 13) | {run(j)}") for number, (i, j) in enumerate(pairs)]


def links(prints: DataFrame, tree_size: int = TREE_SIZE) -> DataFrame:
    """Links (a, b) that connect all fingerprints within the radius of one another.

    ``prints``: distinct longs in ``print``. Two fingerprints that differ in three bits agree in
    two of five runs of bits, so each value of each two runs is a shard with a BK-tree of its own: ten
    shards for a fingerprint, of some 2^26 in a table, so a shard of ten billion fingerprints holds
    about 150. Shards above ``tree_size`` are split by hash into several trees, and each of their
    fingerprints is a query to the trees before its own. Within a tree's task only links that join two
    classes are given, never all pairs.
    """
    keyed = prints.select("print", F.explode(F.array(*_tables())).alias("key"))
    large = (keyed.groupBy("key").count().where(F.col("count") > tree_size)
             .select("key", F.ceil(F.col("count") / tree_size).alias("trees")))
    own = F.pmod(F.xxhash64("print"), F.coalesce("trees", F.lit(1)))
    placed = keyed.join(large, "key", "left").withColumn("own", own)
    tiles = placed.select("print", "key", "own", F.explode(F.sequence(F.lit(0).cast("long"), "own")).alias("tile"))
    shards = tiles.select(
        (F.col("key") + F.shiftleft("tile", 32)).alias("shard"),
        F.when(F.col("tile") == F.col("own"), 0).otherwise(1).alias("member"), "print")
    dealt = shards.repartition("shard").sortWithinPartitions("shard", "member")
    return dealt.mapInArrow(_link, EDGE)


def _stars(edges: DataFrame, small: bool) -> DataFrame:
    """One star step: hang neighbours on the smallest vertex around (Kiveris et al. 2014)."""
    if small:
        around = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        around = edges.union(edges.select("b", "a")).toDF("u", "v")
    least = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    hung = around.join(least, "u")
    hung = hung.select("v", "m") if small else hung.where("v > u").select("v", "m")
    if small:
        hung = hung.union(least.select("u", "m"))
    return hung.where("v != m").toDF("a", "b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every vertex of ``edges`` (a, b) but the roots; a root is its group's smallest.

    Large-star and small-star steps until nothing moves. Each round is written to the shared
    folder, so lineage stays short and a lost executor costs a task.
    """
    edges = staged(edges.where("a != b").distinct(), "links")
    state = None
    while True:
        edges = staged(_stars(_stars(edges, small=False), small=True), "stars")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == state:
            return edges.toDF("node", "root")
        state = now


def grouped(prints: DataFrame, order=("doc_id",)) -> DataFrame:
    """For each distinct ``fingerprint`` of ``prints``: the first row of its group by ``order`` (nulls last)."""
    rank = F.min(F.struct(*[x for c in order for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))]))
    nodes = staged(prints.groupBy(F.col("fingerprint").alias("print")).agg(rank.alias("first")), "prints")
    roots = components(links(nodes.select("print")))
    placed = nodes.join(roots, nodes.print == roots.node, "left").select(
        "print", "first", F.coalesce("root", "print").alias("root"))
    placed = staged(placed, "roots")
    firsts = placed.groupBy("root").agg(F.min("first").alias("first"))
    return placed.select("print", "root").join(firsts, "root").select("print", "first")


def near_dups(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id.

    Rows are linked when their fingerprints differ in at most three bits; component_id is the
    smallest doc_id reachable. Empty texts share fingerprint zero. Repeated rows stay repeated; a
    null doc_id never names a group unless all of it are null. Other columns are ignored.
    """
    prints = staged(add_fingerprints(docs, keep=["doc_id"]), "fingerprints")
    firsts = grouped(prints)
    return prints.join(firsts, prints.fingerprint == firsts.print).select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"))


# ---- the pipeline's stage: similar documents, verified ---------------------------------------------------

# Two documents are near copies when their sets of five-word shingles share this part of their union.
SIMILAR = (4, 5)
# Documents of that similarity differ in about 10 of 64 bits, rarely in over 20.
WIDE = 20
# Shards: MATCHING minima of the shingle hashes together. 16 shards miss a pair of similarity 0.8 once in 4500.
MATCHING, SHARDS = 4, 16
# Documents and bytes of text in one verifying tree; a larger shard is held by several, each met by all.
FULL_TREE, FULL_BYTES = 2048, 64 << 20
_FACTORS = np.random.default_rng(11).integers(0, 1 << 63, MATCHING * SHARDS, np.uint64) * np.uint64(2) + np.uint64(1)


def simhash(hashes: np.ndarray) -> int:
    """The 64-bit SimHash of distinct shingle hashes; zero for none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at: at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def shard_keys(hashes: np.ndarray) -> list:
    """A key for each group of MATCHING minima of the shingle hashes; none without shingles."""
    if not len(hashes):
        return []
    least = np.array([(hashes * f).min() for f in _FACTORS]).reshape(SHARDS, MATCHING)
    return [xxhash.xxh64_intdigest(row.tobytes(), i) - (1 << 63) for i, row in enumerate(least)]


def shingle_sets(column):
    """For each text its distinct five-word shingle hashes, in order."""
    data, offsets = flat(column)
    starts, ends, rows = words(lowered(data), offsets)
    hashes, bounds = shingle_hashes(word_hashes(lowered(data), starts, ends), rows, len(column))
    for i in range(len(column)):
        yield np.unique(hashes[bounds[i]: bounds[i + 1]])


# A row is known by its doc_id (0 for null, which ``none`` tells) and two hashes of its text: values
# that Spark works out wherever the row is read.
ROW = ["none", "id", "text_a", "text_b"]
MARKS = "none boolean, id long, text_a long, text_b long, size long, same binary, print long, keys array<long>"


def known_by(text="text", key="doc_id") -> list:
    return [F.col(key).isNull().alias("none"), F.coalesce(F.col(key).cast("long"), F.lit(0).cast("long")).alias("id"),
            F.xxhash64(text).alias("text_a"), F.xxhash64(text, F.lit(1)).alias("text_b")]


def add_marks(docs: DataFrame) -> DataFrame:
    """Per row: what it is known by, a digest of its shingle set, the SimHash and the shard keys."""
    names = [part.split()[0] for part in MARKS.split(", ")]

    def add(batches):
        for whole in batches:
            for batch in blocks(whole, "text"):
                same, prints, keys = [], [], []
                for own in shingle_sets(batch.column("text")):
                    same.append(xxhash.xxh3_128_digest(own.tobytes()))
                    prints.append(simhash(own))
                    keys.append(shard_keys(own))
                made = [pa.array(same, pa.binary()), pa.array(prints, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in names[:5]] + made, names=names)

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("size")
    return docs.select(*known_by(), size, "text").mapInArrow(add, MARKS)


def _bits(sets: list, known: np.ndarray) -> np.ndarray:
    """Which of the ``known`` shingles each set holds, as rows of 64-bit words."""
    width = -(-max(1, len(known)) // 64) * 64
    out = np.zeros((len(sets), width // 64), np.uint64)
    for i, own in enumerate(sets):
        at = np.searchsorted(known, own)
        at = at[(at < len(known)) & (known[np.minimum(at, len(known) - 1)] == own)] if len(known) else at[:0]
        row = np.zeros(width, np.uint8)
        row[at] = 1
        out[i] = np.packbits(row, bitorder="little").view(np.uint64)
    return out


def similar_pairs(bits_a, size_a, bits_b, size_b):
    """Whether each pair of sets, given as bit rows and sizes, is similar."""
    common = np.bitwise_count(bits_a & bits_b).sum(1, dtype=np.int64)
    part, whole = SIMILAR
    return whole * common >= part * (size_a + size_b - common)


def _unite_shard(label, inside, asking, prints, sets):
    """Merge the classes in ``label`` of all similar pairs of asking and inside rows within WIDE bits."""
    known, times = np.unique(np.concatenate([sets[i] for i in inside]), return_counts=True)
    others = [sets[i] for i in np.setdiff1d(asking, inside)]
    met = np.isin(known, np.concatenate(others)) if others else np.zeros(len(known), bool)
    known = known[(times > 1) | met]  # no other shingle can be common to a pair
    bits, sizes = _bits([sets[i] for i in inside], known), np.array([len(sets[i]) for i in inside])
    own = np.zeros(len(inside), np.int64)
    trees = build_trees(prints[inside], own)
    for start in range(0, len(asking), 256):
        some = asking[start: start + 256]
        some_bits, some_sizes = _bits([sets[i] for i in some], known), np.array([len(sets[i]) for i in some])
        for q, v in search_trees(trees, prints[inside], prints[some], np.zeros(len(some), np.int64), WIDE, 256):
            for at in range(0, len(q), 4096):
                qq, vv = q[at: at + 4096], v[at: at + 4096]
                open_ = label[some[qq]] != label[inside[vv]]
                qq, vv = qq[open_], vv[open_]
                good = similar_pairs(some_bits[qq], some_sizes[qq], bits[vv], sizes[vv])
                unite(label, some[qq[good]], inside[vv[good]])


def _verify(batches):
    """Rows (shard, member, node, root, print, text) sorted by shard, members first: links between roots."""
    held = None
    for whole in batches:
        for batch in blocks(whole, "text", FULL_BYTES):
            sets = list(shingle_sets(batch.column("text")))
            shard, member, node, root = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "member", "node", "root"))
            prints, member = batch.column("print").to_numpy().view(np.uint64), member == 0
            n_held = 0
            if held is not None:
                n_held = len(held[0])
                shard, node, root, prints = (np.concatenate(pair) for pair in zip(held[:4], (shard, node, root, prints)))
                member, sets = np.concatenate([np.ones(n_held, bool), member]), held[4] + sets
            _, first, which = np.unique(np.stack([shard, root]), axis=1, return_index=True, return_inverse=True)
            start = first[which.ravel()]
            label = start.copy()
            cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1], [True]]))
            for low, high in zip(cuts[:-1], cuts[1:]):
                here = np.arange(low, high)
                inside, asking = here[member[low:high]], here[here >= n_held]
                if len(inside) and len(asking) and (start[here] != start[low]).any():
                    _unite_shard(label, inside, asking, prints, sets)
            moved = np.flatnonzero((start == np.arange(len(label))) & (label != start))
            yield pa.RecordBatch.from_arrays([pa.array(root[moved]), pa.array(root[label[moved]])], names=["a", "b"])
            open_ = np.flatnonzero(member & (shard == shard[-1]))
            held = (shard[open_], node[open_], root[label[open_]], prints[open_], [sets[i] for i in open_])


def _trees(texts: DataFrame, placed: DataFrame, tree_size, tree_bytes) -> DataFrame:
    """(key, trees) of the shards that take more than one tree."""
    held = placed.join(texts.select("node", "size"), "node").groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    return held.select("key", F.greatest(F.ceil(F.col("n") / tree_size), F.ceil(F.col("bytes") / tree_bytes)).alias("trees")).where("trees > 1")


def verified_links(texts: DataFrame, placed: DataFrame, across=True, tree_size=FULL_TREE, tree_bytes=FULL_BYTES) -> DataFrame:
    """Links (a, b) between classes whose members are similar.

    ``texts`` has node, print, size and text, ``placed`` has (node, key, root): a node's shards and the
    class it is in so far. A shard of many documents, or much text, is held by several BK-trees; with
    ``across`` each document also meets the trees before its own. Inside a tree, pairs of different
    classes within WIDE bits are compared by their whole shingle sets, and similar ones join
    their classes at once, so only links between classes leave the task.
    """
    own = F.pmod(F.xxhash64("node"), F.coalesce("trees", F.lit(1)))
    tiles = F.explode(F.sequence(F.lit(0).cast("long"), "own")) if across else F.col("own")
    tiled = placed.join(_trees(texts, placed, tree_size, tree_bytes), "key", "left").withColumn("own", own).select(
        "node", "root", "key", "own", tiles.alias("tile"))
    shards = tiled.select("node", "root", F.xxhash64("key", "tile").alias("shard"),
                          F.when(F.col("tile") == F.col("own"), 0).otherwise(1).alias("member"))
    dealt = shards.join(texts.select("node", "print", "text"), "node").select(
        "shard", "member", "node", "root", "print", "text").repartition("shard").sortWithinPartitions("shard", "member")
    return dealt.mapInArrow(_verify, EDGE)


def _crowded(placed: DataFrame) -> DataFrame:
    """Of ``placed`` (node, key, root) the shards that hold several classes, each set of nodes once."""
    hashed = F.xxhash64("node")
    shards = placed.groupBy("key").agg(
        F.count("*").alias("n"), F.bit_xor(hashed).alias("x"), F.sum(F.shiftright(hashed, 20)).alias("y"),
        F.min("root").alias("least"), F.max("root").alias("most")).where("least < most")
    kept = shards.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key")
    return placed.join(kept, "key", "left_semi")


def leaders(docs: DataFrame, tree_size=FULL_TREE, tree_bytes=FULL_BYTES) -> DataFrame:
    """The row that stays of each group: none, id, text_a, text_b, and how many rows are just like it (copies).

    Rows of equal shingle sets are one node. A node first meets those of its largest shard. Then, in
    shards of several trees, one node of each class meets those of other classes, again and again
    while that leaves fewer classes, so a very large group of copies is one class before its trees are
    paired. At last all shards that still hold several classes are gone through whole: the result is
    that of checking every pair that shares a shard and is within WIDE bits, however rows are dealt.
    """
    spark = docs.sparkSession
    path = shared_dir(spark, "leaders")
    with scratch(spark):
        marks = staged(add_marks(docs), "marks")
        rows = marks.groupBy("same", *ROW).agg(F.count("*").alias("copies"), F.first("print").alias("print"),
                                               F.first("size").alias("size"), F.first("keys").alias("keys"))
        first = F.min(F.struct(*ROW, "copies", "size")).alias("first")
        nodes = staged(rows.groupBy("same").agg(first, F.first("print").alias("print"), F.first("keys").alias("keys")).select(
            F.monotonically_increasing_id().alias("node"), "first", "print", "keys"), "nodes")
        keyed = nodes.select("node", F.explode("keys").alias("key"))
        many = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        shared = staged(keyed.join(many, "key"), "shared")
        best = shared.groupBy("node").agg(F.max_by("key", F.struct("n", "key")).alias("key"))
        wanted = best.select("node").join(nodes, "node").select("node", "print", "first.size", *[F.col(f"first.{c}") for c in ROW])
        found = docs.select(*known_by(), "text").join(wanted, ROW)
        texts = staged(found.groupBy(*ROW).agg(F.first(F.struct("node", "print", "size", "text")).alias("row")).select("row.*"), "texts")

        def placed_by(links):
            roots = components(links)
            return roots, staged(shared.join(roots, "node", "left").select("node", "key", F.coalesce("root", "node").alias("root")), "placed")

        links_ = staged(verified_links(texts, best.withColumn("root", F.col("node")), False, tree_size, tree_bytes), "links")
        before = None
        while True:
            roots, placed = placed_by(links_)
            large = placed.join(_trees(texts, placed, tree_size, tree_bytes), "key", "left_semi")
            ones = staged(_crowded(large.groupBy("key", "root").agg(F.min("node").alias("node"))), "ones")
            n = ones.count()
            if not n or (before is not None and 4 * n > 3 * before):
                break
            before = n
            links_ = staged(links_.union(verified_links(texts, ones, False, tree_size, tree_bytes)), "links")
        roots = components(links_.union(verified_links(texts, _crowded(placed), True, tree_size, tree_bytes)))
        groups = nodes.join(roots, "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min("first").alias("first"))
        groups.select(*[F.col(f"first.{c}") for c in (*ROW, "copies")]).write.parquet(path)
    return spark.read.parquet(path)


def keep_first(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest doc_id, of equal ones any one.

    Two rows are linked when their sets of five-word shingles (letters lowered; all words where
    there are fewer) have a similarity of 0.8 or more, checked on the sets; groups are what
    links connect. Null and empty texts are one group, null doc_ids come last. BK-trees over the
    SimHashes of rows that share minima find the pairs to check, and all of them are checked.
    """
    kept = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("doc"), *known_by())
    found = rows.join(leaders(docs), ROW)
    alone = found.where("copies = 1").select("doc")
    again = found.where("copies > 1").groupBy(*ROW).agg(F.first("doc").alias("doc")).select("doc")
    return alone.union(again).select(*[F.col(f"doc.`{c}`").alias(c) for c in kept])
