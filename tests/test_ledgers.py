"""Counts and numbers kept over runs against full counts and plain numbering."""

import random

import pytest

from postsift.operators import work_queue as wq
from postsift.session import shared_dir
from postsift.sinks.lead_store import LeadStore
from postsift.sinks.ledgers import CountLedger, PositionLedger, measures
from workload import tables as tb


def rows(df):
    return sorted((r.dimension, r.key, r.n) for r in df.collect())


def test_counts_follow_runs_and_changes(spark, sf_dir):
    """After every step the summed parts are the full count over the store's current state."""
    leads, base = tb.leads(spark, sf_dir), shared_dir(spark, "ledger")
    store, ledger = LeadStore(spark, f"{base}/store"), CountLedger(spark, f"{base}/counts")
    assert rows(ledger.read()) == []
    for run, part in (("a/1", "seq < 60"), ("b", "seq >= 60"), ("b", "seq >= 100")):  # the second b saves less
        store.append(leads.where(part), run)
        ledger.add_run(store.stored().where(f"run_id = '{run}'").drop("run_id"), run)
    assert rows(ledger.read()) == rows(measures(store.read()))
    ids = [r.post_id for r in store.stored().select("post_id").limit(6).collect()]
    for n, (status, day) in enumerate([("contacted", 5), ("replied", 9), ("ignored", 7)]):  # the last comes too late
        asked = spark.createDataFrame([(i, status, f"2024-03-{day:02d}") for i in ids], "post_id string, status string, at string")
        changes = wq.status_changes(store.stored(), asked.withColumn("at", asked.at.cast("timestamp")))
        ledger.add_changes(store.stored().drop("run_id"), store.log(), changes, f"c{n}")
        store.record(changes)
        assert rows(ledger.read()) == rows(measures(store.read()))
    sent = wq.sent_changes_by_text(store.stored(), ids[0], "2024-03-10 10:00:00")
    ledger.add_changes(store.stored().drop("run_id"), store.log(), sent, "sent")
    store.record(sent)
    assert rows(ledger.read()) == rows(measures(store.read())) == rows(measures(store.compact(f"{base}/v2").read()))


def test_numbers_over_runs(spark):
    rng, ledger = random.Random(2), PositionLedger(spark, shared_dir(spark, "numbers"))
    seqs = sorted(rng.sample(range(10**12), 130))
    frame = lambda part: spark.createDataFrame([(s,) for s in part], "seq long")
    runs = {"a": seqs[:7], "b": seqs[7:7], "c": seqs[7:90], "d": seqs[90:]}
    place = lambda part, run: sorted((r.seq, r.position, r.batch_no, r.batch_pos) for r in ledger.number(frame(part), run, size=4).collect())
    got = [row for run, part in runs.items() for row in place(part, run)]
    assert got == [(s, i + 1, i // 4, i % 4) for i, s in enumerate(seqs)]
    assert place(runs["c"], "c") == got[7:90]
    assert place(runs["d"] + [10**12 + 1], "d")[-1][1] == 131
    with pytest.raises(ValueError):
        place(runs["a"] + [10**12 + 2], "a")
