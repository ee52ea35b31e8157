"""Archives with their index, importance resampling and hard negatives: brute force, odd rows, other sizes."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from postsift.llm import hard_negatives, resampling, warc
from postsift.session import shared_dir

# ---- archives ----------------------------------------------------------------------------------------------

PAGES = "page_id long, url string, html string, offset int, file string"
ODD = [(5, "http://b.example.com/x", "same", 1, "f"), (3, "https://A.example.com:443/", "same", 1, "f"), (9, None, None, 1, "f"),
       (8, "no host", "", 1, "f"), (7, "http://b.example.com/x#part", "é" * 70000, 1, "f"), (2, "http://u@[::1]:81/a\r\nb c", "same ", 1, "f"),
       (None, "http://c.example.com", "same", 1, "f"), (3, "http://twice.example.com", "same", 1, "f"), (None, None, "lone", 1, "f"),
       (None, None, "lone", 1, "f")]


def test_archives_hold_every_page(spark):
    got = warc.round_trip(spark, spark.createDataFrame(ODD, PAGES)).collect()
    first = {"same": 3, "": 8, "same ": 2, "é" * 70000: 7, "lone": None}
    want = []
    for page_id, _, html, *_ in ODD:
        own = first[html or ""]
        again = own is not None and page_id != own
        want.append((page_id, len((html or "").encode()), warc.digest((html or "").encode()), "revisit" if again else "response", own if again else None))
    key = lambda r: (r[0] is None, r[0] or 0, r[2], str(r[4]))
    assert sorted((tuple(r)[:5] for r in got), key=key) == sorted(want, key=key)
    assert {r.url for r in got if r.page_id == 2} == {"http://u@[::1]:81/a%0D%0Ab%20c"}
    assert warc.round_trip(spark, spark.createDataFrame([], PAGES)).collect() == []


def test_small_payloads_are_never_revisits(spark):
    got = warc.round_trip(spark, spark.createDataFrame(ODD, PAGES), least_bytes=5).collect()
    assert {r.record_type for r in got} == {"response"}


def test_index_finds_urls_by_key(spark):
    rng = random.Random(3)
    hosts = ["a.example.com", "b.a.example.com", "example.org", "hot.example.net"]
    urls = ["http://hot.example.net/same"] * 700 + [f"https://{rng.choice(hosts)}/{rng.randrange(200)}" for _ in range(900)]
    rng.shuffle(urls)
    pages = spark.createDataFrame([(i, u, f"page {i % 500}") for i, u in enumerate(urls)], "page_id long, url string, html string")
    base = shared_dir(spark, "test-warc")
    captures = warc.write(pages.repartition(5), f"{base}/archives", file_bytes=20000)
    index = warc.build_index(captures, f"{base}/index", block_lines=16, index_lines=100)
    files = index.collect()
    assert sum(f.n_captures for f in files) == len(urls) and captures.select("file").distinct().count() > 5
    ordered = sorted((f.first_key, f.last_key) for f in files)
    assert all(a[1] <= b[0] for a, b in zip(ordered, ordered[1:]))
    wanted = sorted(set(rng.sample(urls, 60))) + ["http://none.example.com/", "http://HOT.example.net:80/same#x"]
    found = warc.find(index, spark.createDataFrame([(u,) for u in wanted], "url string"))
    keys = [warc.url_key(u) for u in urls]
    assert sorted((r.url, r.page_id) for r in found.collect()) == sorted(
        (u, i) for u in wanted for i, k in enumerate(keys) if k == warc.url_key(u))
    assert {r.url for r in warc.fetch(found.where("url = 'http://hot.example.net/same'")).collect()} == {"http://hot.example.net/same"}


def test_a_search_opens_few_blocks(spark):
    pages = spark.createDataFrame([(i, f"http://h{i % 7}.example.com/{i:05d}", "x") for i in range(3000)], "page_id long, url string, html string")
    base = shared_dir(spark, "test-blocks")
    index = warc.build_index(warc.write(pages, f"{base}/archives"), f"{base}/index", block_lines=50)
    file = warc.IndexFile(index.first().path)
    key = file.keys[len(file.keys) // 2]
    assert [c[0] for c in file.find(key)] == [key] and file.n_read <= 2 < len(file.directory)
    file.close()


@pytest.mark.parametrize("url, key", [
    ("http://Blog.a.com:80/x?q#f", "com,a,blog)/x?q"), ("https://a.com:8443", "com,a:8443)/"), ("http://a.com?q=1", "com,a)/?q=1"),
    ("plain", ")plain"), (None, ")"), ("http://u:p@a.com/@x", "com,a)/@x")])
def test_keys_reverse_the_host(url, key):
    assert warc.url_key(url) == key


def test_a_damaged_record_is_refused():
    data = warc.record(1, "http://a.com/", b"text")
    assert warc.parse(data)["payload"] == b"text"
    with pytest.raises(ValueError):
        warc.parse(data[:-8] + b"test" + data[-4:])


# ---- resampling --------------------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text, n):
    found = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    return len(found), [" ".join(found[i: i + k]) for k in range(1, n + 1) for i in range(len(found) - k + 1)]


def brute_resample(docs, target, percent, least, buckets, n):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    count = lambda texts: np.bincount([bucket(f) for t in texts for f in runs(t, n)[1]], minlength=buckets)
    s, t = count([d[1] for d in docs]).tolist(), count(target).tolist()
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for doc_id, text in docs:
        n_words, found = runs(text, n)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, n_words >= least])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = i + 1
    return [tuple(r[:5]) for r in rows]


@pytest.mark.parametrize("run, percent", [(1, 10), (3, 37), (1, 100), (2, 0)])
def test_resampling_against_brute_force(spark, run, percent):
    rng = random.Random(run)
    words = [f"w{i}" for i in range(300)] + ["Ünï", "x" * 90, "y" * 65, "1_2"]
    docs = [(i, rng.choice([" ", "-", "\t"]).join(rng.choices(words, k=rng.choice([0, 1, 5, 30, 200])))) for i in range(400)]
    docs += [(400, None), (401, ""), (402, ",;"), (None, "a b c d e f g"), (7, "repeated id, other text with several words")]
    target = [" ".join(rng.choices(words[:40], k=20)) for _ in range(30)] + [None, ""]
    got = resampling.resample(
        spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, rank int, n int").repartition(7),
        spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"), percent, 5, 97, run)
    key = lambda r: tuple((v is None, v or 0) for v in r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute_resample(docs, target, percent, 5, 97, run), key=key)


def test_resampling_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "word " * 30)] * 20, "doc_id long, text string")
    assert resampling.resample(none, none).collect() == []
    assert sorted(r.rank or 0 for r in resampling.resample(some, none).collect()) == [0] * 18 + [1, 2]


@pytest.mark.parametrize("margin", [0.0, 0.001, 0.3])
def test_bracket_is_widened_until_it_holds_the_place(spark, margin):
    """Even a bracket of no width from a tiny sketch ends right; half of all scores are the same."""
    scores = [5] * 3000 + list(range(3000))
    df = spark.createDataFrame([(s,) for s in scores], "score long").repartition(6)
    ordered = sorted(scores, reverse=True)
    for k in (1, 17, 2990, 4000, 6000):
        low, high, above = resampling.bracket(df, len(scores), k, max(margin, 1e-6), 8)
        assert low <= ordered[k - 1] <= high and above == sum(s > high for s in scores) < k


# ---- hard negatives ----------------------------------------------------------------------------------------

def brute_mine(rows, every, shift, n_pos, n_neg, least, most):
    kept = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept.append((vec_id, (label + 1) % 10 if vec_id % shift == 0 else label, [math.floor(256 * x) for x in vector]))
    out = []
    for a_id, a_label, a in kept:
        if a_id % every:
            continue
        met = sorted((-sum(x * y for x, y in zip(a, v)), i, label) for i, label, v in kept if i != a_id and len(v) == len(a))
        for p, positive, _ in [m for m in met if m[2] == a_label][:n_pos]:
            near = [m for m in met if m[2] != a_label and least * -p <= 100 * -m[0] <= most * -p][:n_neg]
            out += [(a_id, positive, k + 1, i, -p, -s) for k, (s, i, _) in enumerate(near)]
    return sorted(out)


def vectors(seed, n, dims=8):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(12, dims))
    rows = []
    for i in range(n):
        v = base[rng.integers(12)] + 0.3 * rng.normal(size=dims) if i % 3 else base[0]
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(4))))
    return rows


EMBEDDINGS = "vec_id long, embedding array<float>, label int"


@pytest.mark.parametrize("pass_bytes, parts", [(hard_negatives.PASS_BYTES, 1), (4000, 6)])
def test_negatives_against_brute_force(spark, pass_bytes, parts):
    """A third of all vectors are the same one; any number of passes and partitions gives the same rows."""
    rows = vectors(1, 900)
    df = spark.createDataFrame(rows, EMBEDDINGS).repartition(parts)
    got = hard_negatives.mine(df, 20, 7, 5, 5, 80, 100, pass_bytes=pass_bytes)
    assert sorted(tuple(r) for r in got.collect()) == brute_mine(rows, 20, 7, 5, 5, 80, 100)


def test_negatives_with_odd_rows(spark):
    rows = vectors(2, 60, 3) + [
        (100, [1.0, 2.0], 1), (101, [1.0, 2.5], 1), (102, [1.0, 2.0], 2), (200, [0.0, 0.0, 0.0], 0), (None, [1.0, 1.0, 1.0], 1),
        (300, None, 1), (400, [1.0, None, 2.0], 1), (500, [float("nan"), 1.0, 1.0], 1), (600, [float("inf"), 1.0, 1.0], 1),
        (700, [1.0, 1.0, 1.0], None), (800, [], 3), (801, [], 4), (802, [], 3), (900, [-3.0, -2.0, -1.0], 3), (901, [3.0, 2.0, 1.0], 3)]
    df = spark.createDataFrame([(*r, 1) for r in rows], EMBEDDINGS + ", rank int")
    got = hard_negatives.mine(df, 10, 7, 3, 2, 50, 110)
    assert sorted(tuple(r) for r in got.collect()) == brute_mine(rows, 10, 7, 3, 2, 50, 110)
    assert hard_negatives.mine(df.limit(0)).collect() == []
    huge = spark.createDataFrame([(0, [1e9], 1), (1, [1.0], 1)], EMBEDDINGS)
    assert hard_negatives.mine(huge).collect() == []


def test_a_walk_ends_before_its_list():
    """With well separated directions a cluster's walk reads a small part of the block."""
    rng = np.random.default_rng(4)
    base = rng.normal(size=(20, 16))
    made = np.floor(256 * (base[np.arange(6000) % 20] + 0.02 * rng.normal(size=(6000, 16)))).astype(np.int64)
    anchors = hard_negatives.Clustered(np.arange(100), np.zeros(100, np.int64), made[:100])
    block, seen = hard_negatives.Block(np.arange(6000), np.zeros(6000, np.int64), made), 0
    exact = hard_negatives.Clustered.products

    def counted(self, members, some, chosen):
        nonlocal seen
        seen += len(members) * len(chosen)
        return exact(self, members, some, chosen)

    search = hard_negatives.Positives(anchors)
    try:
        hard_negatives.Clustered.products = counted
        search.meet(block)
    finally:
        hard_negatives.Clustered.products = exact
    assert seen < 0.25 * 100 * 6000
    scores = made[:100] @ made.T
    scores[np.arange(100), np.arange(100)] = -(1 << 62)
    assert (search.best.scores == -np.sort(-scores, axis=1)[:, :5]).all()
