import time

import pytest
from pyspark.sql import functions as F

from postsift import schemas, session
from postsift.operators import enrichment as en, triage
from postsift.plans.triage_run import EVERY, RunOptions, monitored_names, run
from postsift.sinks.daily_sheet import DailySheet
from postsift.sinks.lead_store import LeadStore
from postsift.sources.posts import normalise
from postsift.streaming import posts_stream as st
from workload import checks, tables as tb

AS_OF = "2024-01-01 00:00:00"


@pytest.fixture(scope="module")
def posts(spark, sf_dir):
    """The test posts as a written table, so that every run sees the same files."""
    path = session.shared_dir(spark, "test-posts")
    tb.raw_posts(spark, sf_dir).select(schemas.POSTS.names).repartition(6).write.parquet(path)
    return spark.read.schema(schemas.POSTS).parquet(path), path


def options(run_id, **more):
    return RunOptions(**{"as_of": AS_OF, "run_id": run_id, "communities": EVERY, "dictionary": checks.SMALL,
                         "needles": checks.NEEDLES, **more})


def test_run_twice(spark, posts, tmp_path):
    store, sheet = LeadStore(spark, str(tmp_path / "s")), DailySheet(spark, str(tmp_path / "d"))
    first = run(posts[0], store, options("r1"), sheet).first()
    assert first.posts_fetched == posts[0].count()
    assert first.passed == first.leads_found == first.leads_saved + first.leads_skipped
    assert first.passed + first.no_trigger + first.excluded + first.deleted_author == first.posts_fetched
    assert (first.leads_filtered, first.high_signal_leads, first.sheet_filtered) == (0, 0, first.leads_found)
    second = run(posts[0], store, options("r2"), sheet).first()
    assert (second.leads_saved, second.leads_skipped) == (0, first.leads_found)
    early = run(posts[0], store, options("r3", dedupe_early=True), sheet).first()
    assert (early.leads_found, early.leads_saved) == (0, 0)


def test_gate_without_scores_filters_everything(spark, posts, tmp_path):
    store = LeadStore(spark, str(tmp_path))
    closed = run(posts[0], store, options("r1", analyse=True)).first()
    assert (closed.leads_saved, closed.leads_filtered) == (0, closed.leads_found)
    opened = run(posts[0], store, options("r2", analyse=True, gate_when_unscored=False)).first()
    assert opened.leads_saved > 0 and opened.leads_filtered == 0


def test_full_run(spark, posts, tmp_path):
    store, sheet = LeadStore(spark, str(tmp_path / "s")), DailySheet(spark, str(tmp_path / "d"))
    judged = spark.createDataFrame([(i, '{"worthy":false}') for i in range(0, 200, 2)], "seq long, raw string")
    row = run(posts[0], store, options(
        "r1", analyse=True, threshold=7,
        score=lambda leads: en.rubric(leads, checks.SMALL),
        judge=lambda leads: en.apply_worthiness(leads, judged),
        draft=lambda leads: leads.withColumn("public_draft", F.lit("Re"))), sheet).first()
    stored = store.read()
    assert row.leads_saved == stored.count() > 0
    assert stored.where("signal_score < 7 or signal_score is null").count() == 0
    assert stored.where("comment_worthy and public_draft is null").count() == 0
    assert stored.where("not comment_worthy and public_draft is not null").count() == 0
    assert row.comment_worthy_leads == row.high_signal_leads - row.skipped_unworthy
    assert sheet.read().count() == row.sheet_saved == sheet.read_actions().count()


def test_empty_run(spark, posts, tmp_path):
    row = run(posts[0].where("false"), LeadStore(spark, str(tmp_path)), options("r1")).first()
    assert (row.posts_fetched, row.leads_found, row.leads_saved, row.pass_rate_text) == (0, 0, 0, "N/A")


def test_limit_and_communities(spark, posts, tmp_path):
    store = LeadStore(spark, str(tmp_path))
    assert run(posts[0], store, options("r1", communities=["SRC1", "src2"], limit=7)).first().posts_fetched == 7
    want = posts[0].where("subreddit in ('src1', 'src2')").count()
    assert run(posts[0], store, options("r2", communities=["SRC1", "src2"])).first().posts_fetched == want
    for limit in (5, None):
        assert run(posts[0], store, options("r3", communities=None, limit=limit)).first().posts_fetched == 0  # none is monitored
    assert len(monitored_names()) == 36


def stream_of(spark, path):
    return normalise(st.post_stream(spark, path, max_files=1))


def test_stream_equals_batch(spark, posts, tmp_path):
    leads = triage.to_leads(triage.classify(stream_of(spark, posts[1]), checks.SMALL, checks.NEEDLES), AS_OF)
    store, sheet = LeadStore(spark, str(tmp_path / "s")), DailySheet(spark, str(tmp_path / "d"))
    st.start_sinks(leads, str(tmp_path / "c"), store, sheet, AS_OF).awaitTermination()
    batch = LeadStore(spark, str(tmp_path / "b"))
    run(posts[0], batch, options("r1"))
    # several micro-batches: which copy of a post comes first depends on the files, the posts do not
    got, want = ([r.post_id for r in s.stored().orderBy("post_id").collect()] for s in (store, batch))
    assert got == want and len(got) == len(set(got))
    assert store.stored().select("run_id").distinct().count() > 1


def test_stream_resumes_without_repeating(spark, posts, tmp_path):
    store = LeadStore(spark, str(tmp_path / "s"))
    sizes = []
    for _ in range(2):
        leads = triage.to_leads(triage.classify(stream_of(spark, posts[1]), checks.SMALL, checks.NEEDLES), AS_OF)
        st.start_sinks(leads, str(tmp_path / "c"), store).awaitTermination()
        sizes.append(store.stored().count())
    assert sizes[0] == sizes[1] > 0


def test_stream_dedup_over_several_batches(spark, posts):
    rows = st.to_table(st.dedup(stream_of(spark, posts[1]), "40 days").select("id"), "dedup")
    ids = [r.id for r in rows.collect()]
    assert len(ids) == len(set(ids)) and set(ids) == {r.id for r in posts[0].select("id").distinct().collect()}


def test_late_rows_are_counted(spark, tmp_path):
    """One row behind the watermark, over three starts of one stream."""
    def drop(number, at):
        row = (number, f"p{number}", "s", "a", "t", "b", "u", "/r/", float(at), 1, 1)
        spark.createDataFrame([row], schemas.POSTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    listener = st.LateRows(spark, str(tmp_path / "late"))
    spark.streams.addListener(listener)
    try:
        for number, at in ((1, 1_700_000_000), (2, 1_690_000_000), (3, 1_700_000_100)):
            drop(number, at)
            posts = st.dedup(stream_of(spark, str(tmp_path / "in")), "1 day").select("id")
            (posts.writeStream.option("checkpointLocation", str(tmp_path / "c")).format("parquet")
             .option("path", str(tmp_path / "out")).trigger(**st.trigger()).start()).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        for _ in range(50):  # the listener writes on a thread of its own
            if st.late_rows(spark, str(tmp_path / "late")).first().late:
                break
            time.sleep(0.2)
        assert st.late_rows(spark, str(tmp_path / "late")).first().late == 1
    finally:
        spark.streams.removeListener(listener)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["p1", "p3"]


def test_no_part_of_a_stream_is_returned(spark, posts):
    slow = stream_of(spark, posts[1]).select("id")
    with pytest.raises(TimeoutError):
        st.to_table(slow, "slow", timeout=0.01)


def test_update_mode_on_nothing(spark, tmp_path):
    spark.createDataFrame([], schemas.POSTS).write.parquet(str(tmp_path / "in"))
    counts = stream_of(spark, str(tmp_path / "in")).groupBy("id").count()
    assert st.to_table(counts, "none", "update", ["id"]).collect() == []


def test_two_streams_into_one_store(spark, posts, tmp_path):
    store, sheet = LeadStore(spark, str(tmp_path / "s")), DailySheet(spark, str(tmp_path / "d"))
    days = iter(f"2024-01-0{1 + i % 2} 10:00:00" for i in range(100))
    found = set()
    for half in (0, 1):
        part = posts[0].where(F.col("seq") % 2 == half)
        part.write.parquet(str(tmp_path / f"in{half}"))
        leads = triage.to_leads(triage.classify(stream_of(spark, str(tmp_path / f"in{half}")), checks.SMALL, checks.NEEDLES), None)
        st.start_sinks(leads.withColumn("public_draft", F.lit("d")).withColumn("signal_score", F.lit(9)),
                       str(tmp_path / f"c{half}"), store, sheet, lambda: next(days)).awaitTermination()
        found |= {r.post_id for r in store.stored().select("post_id").collect()}
        assert {r.post_id for r in store.stored().select("post_id").collect()} == found
    assert store.stored().count() == len(found) > 0 and store.stored().where("scraped_at is null").isEmpty()
    assert [r.name for r in sheet.list_sheets().collect()] == ["Leads-2024-01-01", "Leads-2024-01-02"]


def test_retry_with_early_dedupe_fills_the_sheet(spark, posts, tmp_path):
    store, sheet = LeadStore(spark, str(tmp_path / "s")), DailySheet(spark, str(tmp_path / "d"))
    again = options("r1", dedupe_early=True)
    first = run(posts[0], store, again).first().leads_saved
    assert run(posts[0], store, again, sheet).first().leads_saved == first > 0


def test_triggers():
    assert st.trigger() == {"availableNow": True}
    assert st.trigger(once=False, minutes=30) == {"processingTime": "30 minutes"}


def test_shared_dir_uses_the_session_setting(spark):
    base = spark.conf.get(session.CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    first, second = session.shared_dir(spark, "x"), session.shared_dir(spark, "x")
    assert first != second and (base is None or first.startswith(base))
