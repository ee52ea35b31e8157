"""Streams with keyed state against plain walks: several micro-batches, restarts, hot keys, odd rows."""

import random
import time
from datetime import datetime, timedelta

import pytest

from postsift.session import shared_dir
from postsift.sources.leads import read_table
from postsift.streaming import answers as an, late as lt, lifecycle as lc, posts_stream as st, remembered as rm

LEADS = "seq long, post_id string, signal_score int, title string"


class Feed:
    """A folder that a stream reads file by file, and its result over all starts so far."""

    def __init__(self, spark, schema, build):
        self.spark, self.schema, self.build = spark, schema, build
        self.path, self.out, self.checkpoint = (shared_dir(spark, n) for n in ("feed", "feed-out", "feed-checkpoint"))

    def put(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.path)

    def run(self):
        stream = self.build(st.post_stream(self.spark, self.path, self.spark.createDataFrame([], self.schema).schema, max_files=1))
        stream.writeStream.option("checkpointLocation", self.checkpoint).trigger(availableNow=True).format("parquet").option(
            "path", self.out).start().awaitTermination()
        return [tuple(r) for r in self.spark.read.parquet(self.out).collect()]


def test_a_hot_post_is_saved_once_over_restarts(spark):
    """Most rows are one post, and it passes the gate in the second micro-batch first."""
    rng = random.Random(1)
    feed = Feed(spark, LEADS, lambda s: rm.first_saved(s, 5, salts=2))
    batches, want, seq = [], {}, 0
    for number in range(3):
        rows = []
        for _ in range(120):
            post = rng.choice(["hot", "hot", f"p{rng.randrange(30)}", None])
            score = rng.choice([None, 0, 4, 5, 9]) if number or post != "hot" else 4
            rows.append((seq, post, score, f"t{seq}"))
            seq += 1
        for r in rows:
            if (r[2] or 0) >= 5:
                want.setdefault(r[1], r)
        rng.shuffle(rows)
        batches.append(rows)
    feed.put(batches[0])
    feed.put(batches[1])
    feed.run()
    feed.put(batches[2])
    got = feed.run()
    assert sorted(got) == sorted(want.values()) and len({r[1] for r in got}) == len(got)


def test_ids_are_forgotten_after_their_time(spark):
    """A time to live needs a trigger by the clock: with availableNow Spark would go on with empty batches."""
    feed = Feed(spark, LEADS, None)
    feed.put([(1, "a", 1, "x"), (2, "a", 1, "y")])
    leads = st.post_stream(spark, feed.path, spark.createDataFrame([], LEADS).schema, max_files=1)
    query = rm.first_saved(leads, ttl=1000, salts=1).writeStream.option("checkpointLocation", feed.checkpoint).trigger(
        processingTime="1 second").format("parquet").option("path", feed.out).start()
    try:
        for want in ([1], [1, 3]):
            until = time.monotonic() + 60
            while sorted(r.seq for r in read_table(spark, feed.out, leads.schema).collect()) != want:
                assert time.monotonic() < until
                time.sleep(1)
            time.sleep(3)
            if want == [1]:
                feed.put([(3, "a", 1, "z")])
    finally:
        query.stop()


def test_many_posts_are_handled_in_a_bounded_number_of_calls(spark, monkeypatch):
    """Python is called per shard, not per post: 3 posts of 4 come again in the second micro-batch."""
    monkeypatch.setattr(rm, "SHARDS", 3)
    feed = Feed(spark, LEADS, lambda s: rm.first_saved(s, 5, salts=2))
    feed.put([(i, f"p{i % 400}", 5 if i % 8 else None, None) for i in range(800)])
    feed.put([(2000 + i, f"p{i}", 7, "t") for i in range(400)])
    want = {f"p{i}": i if i % 8 else 2000 + i for i in range(400)}
    assert sorted(feed.run()) == sorted((n, p, 5 if n < 2000 else 7, None if n < 2000 else "t") for p, n in want.items())
    from postsift.streaming.remembered import FirstSaved

    class State:
        def __init__(self):
            self.held = {}

        def containsKey(self, key):
            return key in self.held

        def updateValue(self, key, value):
            self.held[key] = value

    import pandas as pd

    first = FirstSaved(["seq", "post_id"])
    first.saved = State()
    pieces = [pd.DataFrame({"seq": [9, 4, 7], "post_id": ["a", "b", None]}), pd.DataFrame({"seq": [3, 8], "post_id": ["a", None]})]
    out = pd.concat(first.handleInputRows((0,), iter(pieces), None))
    assert sorted(out["seq"]) == [3, 4, 7] and first.saved.held == {("a",): (3,), ("b",): (4,), (None,): (7,)}
    assert list(first.handleInputRows((0,), iter(pieces), None)) == []


def walk(requests, stale_days, newest, delay):
    """The same rules, one request after the other; requests come in order of time."""
    rows, held = [], {}
    for post, status, at in sorted(requests, key=lambda r: (r[2], r[1] or "")):
        before, since, stale = held.get(post, ("new", None, False))
        limit = since + timedelta(days=stale_days) if since else None
        if before in lc.WAITING and not stale and at > limit:
            rows.append((post, before, None, limit, "stale"))
            stale = True
        good = status in lc.FOLLOWS[before]
        rows.append((post, before, status or "", at, "applied" if good else "refused"))
        held[post] = (status, at, False) if good else (before, since, stale)
    for post, (before, since, stale) in held.items():
        if before in lc.WAITING and not stale and since + timedelta(days=stale_days) < newest - delay:
            rows.append((post, before, None, since + timedelta(days=stale_days), "stale"))
    return rows


def test_lifecycle_over_batches_and_a_restart(spark):
    rng, start = random.Random(4), datetime(2024, 1, 1)
    statuses = [*lc.FOLLOWS, "bogus", None]
    requests = [(rng.choice(["hot", f"p{rng.randrange(8)}"]), rng.choice(statuses), start + timedelta(seconds=i * 7000 + rng.randrange(6000))) for i in range(240)]
    feed = Feed(spark, "post_id string, status string, at timestamp", lambda s: lc.steps(s, "3 days", 2))
    for part in range(3):
        feed.put(rng.sample(requests[80 * part: 80 * part + 80], 80))
        if part == 1:
            feed.run()
    got, key = feed.run(), lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=key) == sorted(walk(requests, 2, requests[-1][2], timedelta(days=3)), key=key)
    assert {r[4] for r in got} == {"applied", "refused", "stale"}


def test_a_request_older_than_the_last_applied_one_is_late(spark):
    feed = Feed(spark, "post_id string, status string, at timestamp", lambda s: lc.steps(s, "30 days"))
    feed.put([("a", "contacted", datetime(2024, 1, 5)), (None, "ignored", datetime(2024, 1, 5)), ("b", "contacted", None)])
    feed.run()
    feed.put([("a", "replied", datetime(2024, 1, 2)), ("a", "replied", datetime(2024, 1, 6))])
    rows = spark.createDataFrame(feed.run(), lc.STEPS)
    assert sorted((r.post_id or "", r.asked, r.outcome) for r in rows.collect()) == [
        ("", "ignored", "applied"), ("a", "contacted", "applied"), ("a", "replied", "applied"), ("a", "replied", "late")]
    assert [r.asked for r in lc.refused(rows).collect()] == ["replied"]
    ids = spark.createDataFrame([(1, "a"), (2, "a"), (3, "c")], "seq long, post_id string")
    assert sorted((r.seq, r.value) for r in lc.status_log(rows, ids).collect()) == [(1, "contacted"), (1, "replied"), (2, "contacted"), (2, "replied")]


def test_silent_leads_of_one_shard_go_stale_each(spark, monkeypatch):
    """Leads of one shard wait for the same moment; one moved on, one waits anew from that moment, one is noted by a request."""
    monkeypatch.setattr(rm, "SHARDS", 1)
    t, day = datetime(2024, 1, 1), timedelta(days=1)
    feed = Feed(spark, "post_id string, status string, at timestamp", lambda s: lc.steps(s, "1 days", 2))
    first = [(p, "contacted", t) for p in ("a", "b", "c", "d", None)]
    second = [("b", "ignored", t + day), ("c", "replied", t + day), ("d", "bogus", t + 2 * day + timedelta(seconds=1)), ("e", "new", t + 2 * day)]
    third = [("z", "new", t + 30 * day)]
    for rows in (first, second, third):
        feed.put(rows)
    got, key = feed.run(), lambda r: tuple(str(v) for v in r)
    assert sorted(got, key=key) == sorted(walk([*first, *second, *third], 2, t + 30 * day, day), key=key)
    assert sorted((r[0] or "", r[3]) for r in got if r[4] == "stale") == [("", t + 2 * day), ("a", t + 2 * day), ("c", t + 3 * day), ("d", t + 2 * day)]


@pytest.mark.parametrize("restart", [False, True])
def test_missing_late_and_double_answers(spark, restart):
    rng, t0 = random.Random(7), datetime(2024, 1, 1)
    asked, given, want = [], [], []
    for i in range(60):
        at = t0 + timedelta(minutes=10 * i)
        asked.append((i, at))
        kind = i % 5
        if kind == 0:      # none
            want.append(i)
        elif kind == 1:    # unusable only
            given.append((i, "no json", at + timedelta(minutes=2)))
            want.append(i)
        elif kind == 2:    # usable, but late
            given.append((i, "[]", at + timedelta(minutes=61)))
            want.append(i)
        elif kind == 3:    # unusable, then usable, then usable again
            given += [(i, "sorry", at), (i, '[{"id":"x","score":1}]', at + timedelta(minutes=30)), (i, "{}", at + timedelta(minutes=60))]
        else:
            given.append((i, "{}", at + timedelta(minutes=rng.randrange(60))))
    asked += [(3, asked[3][1]), (None, t0), (7, None)]
    end = t0 + timedelta(days=9)
    a, g, out, checkpoint = (shared_dir(spark, n) for n in ("asked", "given", "retries", "retries-checkpoint"))
    kinds = ("batch_no long, asked_at timestamp", "batch_no long, raw string, answered_at timestamp")

    def put(path, rows, kind):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(path)

    def go():
        streams = [st.post_stream(spark, p, spark.createDataFrame([], k).schema, max_files=1) for p, k in zip((a, g), kinds)]
        an.retries(*streams).writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).format(
            "parquet").option("path", out).start().awaitTermination()

    given.sort(key=lambda r: r[2])
    put(a, asked[:30], kinds[0])
    put(g, given[: len(given) // 2], kinds[1])
    if restart:
        go()
    put(a, asked[30:], kinds[0])
    put(g, given[len(given) // 2:], kinds[1])
    put(a, [(-1, end)], kinds[0])
    put(g, [(-1, "{}", end)], kinds[1])
    go()
    assert sorted(r.batch_no for r in spark.read.parquet(out).collect()) == want


def test_late_rows_are_kept_and_folded(spark):
    """Three micro-batches, the middle one taken twice; totals and late rows together are the batch funnel."""
    rng, t0 = random.Random(9), 1_700_000_000
    verdicts = ["passed", "no_trigger", "excluded", "deleted_author"]
    rows = [(i, f"p{i}", None if i % 17 == 0 else float(t0 + rng.randrange(86400 * 3)), rng.choice(verdicts)) for i in range(300)]
    funnel = lt.WindowedFunnel(spark, shared_dir(spark, "late"), timedelta(hours=6), timedelta(hours=12))
    schema = "seq long, id string, created_utc double, verdict string"
    late, newest, n = set(), None, 0
    for part in range(3):
        some = rows[100 * part: 100 * part + 100]
        for _ in range(2 if part == 1 else 1):
            funnel.take(spark.createDataFrame(some, schema), part)
        if newest is not None:
            late |= {r[0] for r in some if r[2] is not None and r[2] // 21600 * 21600 + 21600 <= newest - 43200}
        newest = max([newest or 0] + [r[2] for r in some if r[2] is not None])
    assert {r.seq for r in funnel.late().collect()} == late and late
    assert all(r.lag_seconds > 0 for r in funnel.late().collect())
    want = {}
    for seq, _, at, verdict in rows:
        held = want.setdefault(None if at is None else int(at // 21600 * 21600), dict.fromkeys(["total", *verdicts, "late"], 0))
        held["total"] += 1
        held[verdict] += 1
        held["late"] += seq in late
    folded = funnel.folded().collect()
    assert {None if r.start is None else int((r.start - datetime(1970, 1, 1)).total_seconds()): {k: r[k] for k in ("total", *verdicts, "late")} for r in folded} == want
    assert sum(r.total for r in funnel.totals().collect()) == len(rows) - len(late)
