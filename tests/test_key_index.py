"""The id index against a plain dictionary of runs, and what a lookup reads."""

import random

import pytest

from postsift.session import shared_dir
from postsift.sinks.key_index import KeyIndex
from postsift.sinks.lead_store import LeadStore
from workload import tables as tb


def frame(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "post_id string")


def known(index, spark, ids, but_run=None):
    return sorted(r.post_id for r in index.known(frame(spark, ids), but_run).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_random_runs(spark, seed):
    """Adds, repeated runs that save less, folds and merges; a third of all ids is the same one."""
    rng, runs = random.Random(seed), {}
    index = KeyIndex(spark, shared_dir(spark, "index"), buckets=4, words=8)
    pool = ["hot"] * 20 + [f"p{i}" for i in range(40)]
    for step in range(5):
        run = f"r {rng.randrange(3)}/x"
        runs[run] = set(rng.sample(pool, rng.choice([0, 3, 12])))
        index.add(frame(spark, [*runs[run], None]), run)
        if rng.random() < 0.6:
            index.fold()
        if rng.random() < 0.3:
            index.merge()
        if step in (2, 4):
            everything = sorted(set(pool)) + ["never", None]
            assert known(index, spark, everything) == sorted(set().union(*runs.values()))
            but = [v for k, v in runs.items() if k != run]
            assert known(index, spark, everything, run) == sorted(set().union(*but))


def test_an_index_keeps_its_layout_and_starts_empty(spark):
    path = shared_dir(spark, "index")
    assert known(KeyIndex(spark, path, 8, 16), spark, ["a"]) == []
    again = KeyIndex(spark, path)
    assert (again.buckets, again.words) == (8, 16) and again.fold() == 0
    again.merge()
    again.add(frame(spark, []), "none")
    assert known(again, spark, ["a"]) == [] == known(again, spark, [])


def test_a_lookup_reads_what_its_ids_lead_to(spark):
    index = KeyIndex(spark, shared_dir(spark, "index"), buckets=32, words=512)
    index.add(frame(spark, [f"id{i}" for i in range(4000)]), "r1")
    index.fold()
    assert len(index._recent().inputFiles()) <= 1
    asked = index.asked(frame(spark, ["id7", "unknown"]))
    maybe = index.maybe(asked)
    plan = maybe._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1][:200]
    files = index.opened(maybe).select("post_id")
    read = files.count()
    assert 4000 / 32 / 2 < read < 3 * 4000 / 32
    assert known(index, spark, ["id7", "unknown"]) == ["id7"]
    # Few unknown ids pass the filters, so few buckets are opened for nothing.
    strangers = index.asked(frame(spark, [f"other{i}" for i in range(400)]))
    assert index.maybe(strangers).count() < 40


def test_a_store_with_an_index_saves_the_same(spark, sf_dir):
    rows = tb.leads(spark, sf_dir)
    base = shared_dir(spark, "stores")
    plain = LeadStore(spark, f"{base}/plain")
    fast = LeadStore(spark, f"{base}/fast", KeyIndex(spark, f"{base}/index", 16, 64))
    for number in range(3):
        part = rows.where(f"pmod(seq, 3) = {number}")
        counts = [store.append(part, f"r{number}", 5).first() for store in (plain, fast)]
        assert counts[0] == counts[1]
        if number == 0:
            fast.index.fold()
            assert fast.append(part, "r0", 5).first() == counts[0]
    keys = [sorted((r.seq, r.run_id) for r in s.stored().select("seq", "run_id").collect()) for s in (plain, fast)]
    assert keys[0] == keys[1]
