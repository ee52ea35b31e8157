"""The life of a lead as a stream: status requests are applied or refused by rules, silence is noted."""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from postsift.operators.work_queue import STATUSES
from postsift.streaming.remembered import keep_state_on_disk, shard

# Which status may follow which. A lead starts as new; what is converted stays so.
FOLLOWS = {
    "new": ["contacted", "ignored"],
    "contacted": ["replied", "converted", "ignored"],
    "replied": ["converted", "ignored"],
    "converted": [],
    "ignored": ["new"],
}
# Statuses in which a lead waits for something, and goes stale if nothing comes.
WAITING = ["contacted", "replied"]
STALE_DAYS = 14

STEPS = "post_id string, before string, asked string, at timestamp, outcome string"


def _frame(steps: list[tuple]) -> pd.DataFrame:
    """Rows of ``STEPS`` from tuples with the moment in microseconds."""
    rows = pd.DataFrame(steps, columns=["post_id", "before", "asked", "at", "outcome"])
    return rows.assign(at=pd.to_datetime(rows["at"].astype("int64"), unit="us"))


class Machine(StatefulProcessor):
    """Status, since when, and whether silence was noted, per post of a shard, and which posts may go stale when.

    A timer names a moment, and ``due`` the posts that were to go stale then; one that has moved on
    meanwhile is passed over, so no timer is looked for to be deleted.
    """

    def __init__(self, follows, waiting, stale_us):
        self.follows, self.waiting, self.stale_us = follows, waiting, stale_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "post_id string", "status string, since long, stale boolean")
        self.due = handle.getMapState("due", "at_ms long", "posts array<string>")

    def _due_ms(self, since):
        return (since + self.stale_us) // 1000 + 1

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        asked = pd.concat([r[["post_id", "status", "at"]] for r in rows])
        moments = asked["at"].astype("datetime64[us]").astype("int64")
        requests: dict[str | None, list] = {}
        for post, wanted, at in zip(asked["post_id"], asked["status"], moments):
            requests.setdefault(post if isinstance(post, str) else None, []).append((at, wanted if isinstance(wanted, str) else ""))
        steps, due = [], {}
        for post, wishes in requests.items():
            held = self.held.getValue((post,)) if self.held.containsKey((post,)) else ("new", None, False)
            status, since, stale = held
            for at, wanted in sorted(wishes):
                if since is not None and at < since:
                    steps.append((post, status, wanted, at, "late"))
                    continue
                if status in self.waiting and not stale and at > since + self.stale_us:
                    steps.append((post, status, None, since + self.stale_us, "stale"))
                    stale = True
                good = wanted in self.follows[status]
                steps.append((post, status, wanted, at, "applied" if good else "refused"))
                if good:
                    status, since, stale = wanted, at, False
            if (status, since, stale) != tuple(held):
                self.held.updateValue((post,), (status, since, stale))
            if (status, since) != tuple(held)[:2] and status in self.waiting:
                due.setdefault(self._due_ms(since), []).append(post)
        for at_ms, posts in due.items():
            before = list(self.due.getValue((at_ms,))[0]) if self.due.containsKey((at_ms,)) else []
            self.due.updateValue((at_ms,), (before + [post for post in posts if post not in before],))
            self.handle.registerTimer(at_ms)
        yield _frame(steps)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        at_ms = expiredTimerInfo.getExpiryTimeInMs()
        steps = []
        for post in self.due.getValue((at_ms,))[0] if self.due.containsKey((at_ms,)) else []:
            status, since, stale = self.held.getValue((post,))
            if status in self.waiting and not stale and self._due_ms(since) == at_ms:
                self.held.updateValue((post,), (status, since, True))
                steps.append((post, status, None, since + self.stale_us, "stale"))
        self.due.removeKey((at_ms,))
        if steps:
            yield _frame(steps)

    def close(self) -> None:
        pass


def steps(requests: DataFrame, watermark="7 days", stale_days=STALE_DAYS, follows=FOLLOWS, waiting=WAITING) -> DataFrame:
    """What became of each of ``requests(post_id, status, at)``, a stream.

    Rows of (post_id, before, asked, at, outcome): ``applied``; ``refused`` where ``asked`` may not follow
    ``before`` (or is no status); ``late`` where it is older than the last applied one. When a lead in a
    waiting status hears nothing for ``stale_days``, one ``stale`` row without a request is given, as
    of the moment it went stale: at its next request, or when the watermark passes that moment. Requests
    of one micro-batch are taken in order of time, then name; a request at the very moment is not too
    late. Rows without a time are dropped, rows without a post id are one lead.
    """
    keep_state_on_disk(requests.sparkSession)
    timed = requests.select("post_id", "status", "at").where(F.col("at").isNotNull()).withWatermark("at", watermark)
    machine = Machine(follows, waiting, stale_days * 86_400_000_000)
    return timed.withColumn("_shard", shard("post_id")).groupBy("_shard").transformWithStateInPandas(machine, STEPS, "Append", "EventTime")


def applied(rows: DataFrame) -> DataFrame:
    return rows.where("outcome = 'applied'")


def refused(rows: DataFrame) -> DataFrame:
    """Requests that changed nothing, for whoever asked."""
    return rows.where("outcome IN ('refused', 'late')")


def status_log(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Log rows for the applied steps; ``ids(seq, post_id)`` names the stored leads of each post."""
    return applied(rows).join(ids.select("seq", "post_id"), "post_id").select(
        "seq", "post_id", F.lit("status").alias("field"), F.col("asked").alias("value"), "at")


assert set(FOLLOWS) == set(STATUSES)
