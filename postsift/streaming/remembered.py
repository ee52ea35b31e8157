"""Streams that remember which posts were saved, in keyed state instead of the store."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from postsift.operators.outcomes import score_gate

SALTS = 32
# Groups that posts are handled in; part of what a checkpoint holds, so it stays as it is.
SHARDS = 1024
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def keep_state_on_disk(spark: SparkSession) -> None:
    """State stores of streams started from now on lie on the executors' disks (and in the checkpoint)."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def shard(*keys) -> Column:
    """The group that rows with these keys are handled in.

    Calling Python costs some milliseconds a group, so rows are grouped by shard, not by post, and each
    post has its own entry in the shard's map state. A shard is a bounded share of a micro-batch.
    """
    return F.pmod(F.xxhash64(*keys), F.lit(SHARDS)).cast("int")


class FirstSaved(StatefulProcessor):
    """Lets the first row of each post of a shard through and remembers its seq; later rows of the post stop here.

    Of the rows of one micro-batch the one with the smallest seq counts. What comes in for a shard is
    read piece by piece, and one row per post of it is held.
    """

    def __init__(self, columns: list[str], ttl_ms: int | None = None):
        self.columns, self.ttl_ms = columns, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.saved = handle.getMapState("saved", "post_id string", "seq long", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for some in rows:
            # A null in an integer column makes pandas floats of it, so rows are found by place and types stay.
            held = some if first is None else pd.concat([first, some], ignore_index=True)
            first = held.sort_values("seq", kind="stable").drop_duplicates("post_id")
        if first is None or first.empty:
            return
        ids = [post if isinstance(post, str) else None for post in first["post_id"]]
        new = [not self.saved.containsKey((post,)) for post in ids]
        for post, seq, is_new in zip(ids, first["seq"], new):
            if is_new:
                self.saved.updateValue((post,), (int(seq),))
        if any(new):
            yield first[new][self.columns]

    def close(self) -> None:
        pass


def first_saved(leads: DataFrame, min_score=None, ttl: int | None = None, salts=SALTS) -> DataFrame:
    """The leads to save: per post the first one that passes the gate, over the stream's whole life.

    Ids are remembered in state that the checkpoint holds, so neither the lead store nor anything
    stored is read, and a restart goes on where it stopped. ``ttl`` in milliseconds forgets an id so long
    after it was saved, and then wants a trigger by the clock (with availableNow Spark goes on with empty
    micro-batches for it); without it ids are kept for good. Leads without a post id are one post.
    A flood of one post is dealt by (post, salt) and thinned by many tasks before one task decides on what
    is left. Within a micro-batch the smallest seq counts, else the earlier micro-batch.
    """
    keep_state_on_disk(leads.sparkSession)
    passing = leads.where(score_gate(min_score))
    mode = "None" if ttl is None else "ProcessingTime"

    def first(rows, *keys):
        sharded = rows.withColumn("_shard", shard(*keys))
        return sharded.groupBy("_shard").transformWithStateInPandas(FirstSaved(rows.columns, ttl), rows.schema, "Append", mode)

    return first(first(passing, "post_id", F.pmod(F.xxhash64("seq"), F.lit(salts))), "post_id")
