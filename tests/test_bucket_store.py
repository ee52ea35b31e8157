"""Bucketed leads against the plain store: random batches, folds in between, files that must not move."""

import os
import random

from pyspark.sql import functions as F

from postsift.operators.work_queue import resolve
from postsift.session import shared_dir
from postsift.sinks.bucket_store import BucketStore
from workload import tables as tb

LOG = "seq long, post_id string, field string, value string, at timestamp"


def state(df):
    return sorted((r.seq, r.post_id, r.status, r.sent, r.sent_date) for r in df.select("seq", "post_id", "status", "sent", "sent_date").collect())


def test_random_batches_and_folds(spark, sf_dir):
    """Changes come in any order of time, also for leads that are folded, and some batches are written twice."""
    rng, rows = random.Random(3), tb.leads(spark, sf_dir).where("seq < 40")
    store, logged, number = BucketStore(spark, shared_dir(spark, "buckets"), 4), [], 0
    for part in range(3):
        number += 1
        mine = rows.where(F.pmod("seq", F.lit(3)) == part)
        store.append(mine, number)
        number += 1
        changes = [(rng.randrange(40), "x", field, rng.choice(values), f"2024-01-{rng.randrange(1, 9):02d}")
                   for _ in range(25) for field, values in [rng.choice([("status", ["new", "replied"]), ("sent", ["yes", "no"]), ("sent_date", ["a", "b"])])]]
        frame = spark.createDataFrame(changes, LOG.replace("at timestamp", "at string")).withColumn("at", F.col("at").cast("timestamp"))
        for _ in range(2):
            store.record(frame, number)
        logged.append(frame)
        if part < 2:
            store.fold()
        log = logged[0]
        for more in logged[1:]:
            log = log.unionByName(more)
        assert state(store.read()) == state(resolve(rows.where(F.pmod("seq", F.lit(3)) <= part), log))


def files(store):
    base = store.data.removeprefix("file:")
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(base) for f in names if f.endswith(".parquet")}


def test_a_fold_leaves_other_buckets_and_readers_alone(spark, sf_dir):
    rows = tb.leads(spark, sf_dir)
    store = BucketStore(spark, shared_dir(spark, "buckets"), 16)
    store.append(rows, 1)
    assert len(store.fold()) == 16 and store.fold() == []
    before, reader = files(store), store.read().select("seq", "status")
    change = rows.limit(1).select("seq", "post_id", F.lit("status").alias("field"), F.lit("replied").alias("value"), F.lit("2024-05-01").cast("timestamp").alias("at"))
    seq = change.first().seq
    store.record(change, 2)
    assert len(store.fold()) == 1
    after = files(store)
    assert before.items() <= after.items() and len(after) == len(before) + 1
    # The plan of a reader from before the switch still finds all its files.
    assert reader.count() == rows.count() and {r.status for r in store.read().where(F.col("seq") == seq).collect()} == {"replied"}
    store.record(change, 3)
    assert len(store.fold()) == 1 and len(files(store)) == len(before) + 1
