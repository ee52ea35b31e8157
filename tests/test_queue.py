import datetime as dt

import pytest
from pyspark.sql import functions as F

from postsift import schemas
from postsift.operators import counts, projections as pr, work_queue as wq
from test_outcomes import make_leads

PENDING = [
    ("yes", "text", "", True), ("YES", "text", "no", True), ("yes", "\t\n", "", False), ("yes", "text", "True", False),
    ("yes", "text", "1", False), ("no", "text", "", False), ("", "text", "", False), ("yes", None, None, False),
    (None, "text", None, False), ("yes", "text", None, True), ("yes", "\xa0\x1f", "", False),
]


def test_pending_text_rows(spark):
    df = spark.createDataFrame([(i, *row[:3]) for i, row in enumerate(PENDING)],
                               "n int, comment_worthy string, public_draft string, sent string")
    assert [r.n for r in df.where(wq.is_pending_text()).orderBy("n").collect()] == [i for i, r in enumerate(PENDING) if r[3]]


@pytest.fixture(scope="module")
def stored(spark):
    rows = make_leads(spark, [(i, f"p{i % 4}", i % 11, f"draft {i}\nmore") for i in range(8)])
    return rows.withColumns({
        "comment_worthy": F.when(F.col("seq") != 3, True), "sent": F.lit(False), "status": F.lit("new"),
        "post_url": F.concat(F.lit("https://reddit.com/r/x/comments/"), "post_id", F.lit("/t/")),
        "title": F.repeat(F.lit("t"), F.lit(90)), "subreddit": F.lit("x"), "language_detected": F.lit(None).cast("string")})


def at(hour):
    return dt.datetime(2024, 1, 1, hour)


def log_of(spark, rows):
    return spark.createDataFrame(rows, schemas.STATUS_LOG)


def test_latest_change_wins(spark, stored):
    log = log_of(spark, [
        (1, "p1", "status", "contacted", at(1)), (1, "p1", "status", "replied", at(3)), (1, "p1", "status", "ignored", at(2)),
        (2, "p2", "sent", "yes", at(1)), (2, "p2", "sent_date", "2024-01-01 01:00", at(1)),
        (4, "p0", "sent", "yes", at(1)), (4, "p0", "sent", "no", at(2))])
    rows = {r.seq: r for r in wq.resolve(stored, log).collect()}
    assert (rows[1].status, rows[0].status) == ("replied", "new")
    assert (rows[2].sent, rows[2].sent_date, rows[4].sent, rows[0].sent) == (True, "2024-01-01 01:00", False, False)


def test_status_change_touches_all_rows_of_the_id(spark, stored):
    asked = spark.createDataFrame([("p1", "contacted", at(1)), ("nope", "contacted", at(1)), ("p2", "odd", at(1))],
                                  "post_id string, status string, at timestamp")
    rows = {r.seq: r.status for r in wq.resolve(stored, wq.status_changes(stored, asked)).collect()}
    assert {s for s, v in rows.items() if v == "contacted"} == {1, 5} and "odd" not in rows.values()
    assert {r.post_id: r.found for r in wq.found(stored, asked.union(asked)).collect()} == {"p1": True, "nope": False, "p2": True}


def test_sent_marks_the_first_row_only(spark, stored):
    asked = spark.createDataFrame([("p1", at(9))], "post_id string, at timestamp")
    rows = {r.seq: r for r in wq.resolve(stored, wq.sent_changes(stored, asked)).collect()}
    assert rows[1].sent and rows[1].sent_date == "2024-01-01 09:00" and not rows[5].sent
    by_text = wq.resolve(stored, wq.sent_changes_by_text(stored, "comments/p", "2024-01-01 09:30:00"))
    assert [r.seq for r in by_text.where("sent").collect()] == [0]
    assert wq.remaining(by_text).first().remaining == wq.remaining(stored).first().remaining - 1
    assert wq.sent_changes_by_text(stored, "nowhere", "2024-01-01 09:30:00").count() == 0


def test_queue_views(stored):
    assert [(r.seq, r.place) for r in wq.numbered(stored).orderBy("place").collect()] == [
        (0, 1), (1, 2), (2, 3), (4, 4), (5, 5), (6, 6), (7, 7)]
    detail = pr.lead_detail(wq.next_pending(stored)).first()
    assert (detail.seq, detail.post_id) == (0, "p0")
    preview = pr.queue_preview(stored.where("seq = 1")).first()
    assert preview.title == "t" * 60 + "..." and preview.draft == "draft 1 more..." and preview.signal == "1/10 ()"
    assert pr.lead_preview(stored.where("seq = 0")).first().language == "unknown"


def test_counts(spark, stored):
    rows = {(r.dimension, r.key): r.n for r in counts.lead_counts(stored).collect()}
    assert rows == {("total", ""): 8, ("status", "new"): 8, ("subreddit", "x"): 8}
    assert [(r.dimension, r.n) for r in counts.lead_counts(stored.where("false")).collect()] == [("total", 0)]
    assert counts.action_stats(stored).first().asDict() == {"total": 8, "comment_worthy": 7, "sent": 0, "pending": 7}
    log = spark.createDataFrame([("a", at(1), True), ("b", at(2), False)], schemas.RUN_LOG)
    assert tuple(counts.run_counts(log).first()) == (1, 2)


def test_dict_times_are_iso(stored):
    timed = stored.withColumns({
        "created_at": F.timestamp_seconds(F.lit(1702800000)), "scraped_at": F.timestamp_micros(F.lit(1702800000000042)),
        "matched_triggers": F.array(F.lit("a"), F.lit("b"))})
    row = pr.lead_dicts(timed).first()
    assert (row.created_at, row.scraped_at, row.matched_triggers) == (
        "2023-12-17T08:00:00", "2023-12-17T08:00:00.000042", "a, b")
    assert '"language_detected":null' in pr.lead_json(timed).first().json


def test_export_blanks(stored):
    row = pr.export_rows(stored.where("seq = 0")).first()
    assert (row.signal_score, row.sent, row.mention_allowed, row.comment_worthy) == ("", "", "", "yes")
    assert pr.action_rows(stored.where("seq = 0")).first()["Signal"] == ""
    assert pr.action_rows(stored.where("seq = 7")).first()["Signal"] == "7/10"
