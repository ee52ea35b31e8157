import pytest
from pyspark.sql import functions as F

from postsift import schemas
from postsift.operators.projections import export_rows
from postsift.sinks import lead_store as store_module
from postsift.sinks.daily_sheet import DailySheet, sheet_name, skipped_counts
from postsift.sinks.lead_store import LeadStore
from postsift.sources.leads import read_lead_csv
from test_outcomes import make_leads


def leads_for(spark, rows):
    return make_leads(spark, rows).withColumns({
        "post_url": F.concat(F.lit("https://reddit.com/r/x/comments/"), "post_id", F.lit("/t/")),
        "title": F.lit('say "hi",\nthere'), "subreddit": F.lit("x"), "author": F.lit("null"), "status": F.lit("new"),
        "sent": F.lit(False), "comment_worthy": F.col("seq") % 2 == 0, "matched_triggers": F.array(F.lit("a"), F.lit("b")),
        "scraped_at": F.timestamp_seconds(F.lit(1702800000)), "created_at": F.timestamp_seconds(F.lit(1702800000)),
        "score": F.lit(1), "num_comments": F.lit(0)})


def counts(row):
    return tuple(row.first()[n] for n in ("saved", "skipped", "filtered"))


ROWS = [(1, "a", 9, "d"), (2, "a", 9, "d"), (3, "b", 5, "d"), (4, "c", 8, "")]


def test_store_append(spark, tmp_path):
    store = LeadStore(spark, str(tmp_path))
    assert counts(store.append(leads_for(spark, ROWS), "r1", 8)) == (2, 1, 1)
    assert counts(store.append(leads_for(spark, ROWS), "r2", 8)) == (0, 3, 1)
    # a post filtered earlier may be saved by a later run
    assert counts(store.append(leads_for(spark, [(9, "b", 9, "d")]), "r3", 8)) == (1, 0, 0)
    assert sorted(r.post_id for r in store.read().collect()) == ["a", "b", "c"]
    assert store.read().schema.names == schemas.LEADS.names


def test_repeated_run_changes_nothing(spark, tmp_path):
    store = LeadStore(spark, str(tmp_path))
    for _ in range(2):
        assert counts(store.append(leads_for(spark, ROWS), "r1", 8)) == (2, 1, 1)
    assert store.stored().count() == 2


def test_repeated_run_that_saves_less_or_on_another_day(spark, tmp_path):
    store, sheet = LeadStore(spark, str(tmp_path / "s")), DailySheet(spark, str(tmp_path / "d"))
    leads = leads_for(spark, ROWS)
    store.append(leads, "run 1/a", 8)
    assert counts(store.append(leads, "run 1/a", 10)) == (0, 0, 4) and store.stored().count() == 0
    sheet.append(leads, "2024-01-01 10:00:00", "run 1/a")
    sheet.append(leads, "2024-01-02 10:00:00", "run 1/a")
    assert sheet.read("2024-01-01 10:00:00").count() == sheet.read_actions("2024-01-01 10:00:00").count() == 0
    assert [r.run_id for r in sheet.read().collect()] == ["run 1/a"]
    assert counts(sheet.append(leads, "2024-01-02 10:00:00", "run 1/a", 10)) == (0, 0, 4) and sheet.read().count() == 0


def test_changes_and_compaction(spark, tmp_path):
    store = LeadStore(spark, str(tmp_path / "v1"))
    assert store.set_status("a", "replied", "2024-01-01 00:00:00") is False
    store.append(leads_for(spark, [(2, "a", 9, "d"), (4, "c", 9, "d")]), "r1")
    assert store.set_status("a", "replied", "2024-01-01 00:00:00") is True
    assert store.set_status("zzz", "replied", "2024-01-01 00:00:00") is False
    with pytest.raises(ValueError):
        store.set_status("a", "odd", "2024-01-01 00:00:00")
    assert store.mark_sent("comments/c", "2024-01-02 03:04:05") == 1
    assert store.mark_sent("nowhere", "2024-01-02 03:04:05") is None
    state = {r.post_id: (r.status, r.sent, r.sent_date) for r in store.read().collect()}
    assert state == {"a": ("replied", False, None), "c": ("new", True, "2024-01-02 03:04")}
    fresh = store.compact(str(tmp_path / "v2"))
    assert {r.post_id: (r.status, r.sent, r.sent_date) for r in fresh.stored().collect()} == state
    assert counts(fresh.append(leads_for(spark, [(9, "a", 9, "d")]), "r2")) == (0, 1, 0)


def test_daily_sheet(spark, tmp_path):
    sheet = DailySheet(spark, str(tmp_path))
    rows = [(1, "a", 9, "d"), (2, "b", 9, "d"), (3, "c", 6, "d"), (4, "d", 9, None), (6, "b", 8, "d")]
    assert counts(sheet.append(leads_for(spark, rows), "2024-01-01 10:00:00", "r1")) == (2, 1, 2)
    assert counts(sheet.append(leads_for(spark, rows), "2024-01-01 11:00:00", "r2")) == (0, 3, 2)
    # another day starts an empty sheet
    assert counts(sheet.append(leads_for(spark, rows), "2024-01-02 10:00:00", "r3")) == (2, 1, 2)
    assert [r.name for r in sheet.list_sheets().collect()] == ["Leads-2024-01-01", "Leads-2024-01-02"]
    day = sheet.read("2024-01-01 23:00:00")
    assert day.columns[:18] == schemas.SHEET_COLUMNS and day.count() == 2
    actions = sheet.read_actions("2024-01-01 10:00:00").collect()
    assert [r["Signal"] for r in actions] == ["9/10"] and "/b/" in actions[0]["Post URL"]
    # the single-lead form has no gate
    assert counts(sheet.append(leads_for(spark, [(3, "c", 1, None)]), "2024-01-01 12:00:00", "r4", gated=False)) == (1, 0, 0)


def test_only_the_day_is_read(spark, tmp_path):
    sheet = DailySheet(spark, str(tmp_path))
    sheet.append(leads_for(spark, ROWS), "2024-01-01 10:00:00", "r1")
    plan = sheet.read("2024-01-01 10:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sheet_date" in plan


def test_fixed_sheet_name(spark, tmp_path):
    assert sheet_name("L", "2024-01-01 10:00:00") == "L-2024-01-01" and sheet_name("L", "2024-01-01", False) == "L"
    sheet = DailySheet(spark, str(tmp_path), auto_date=False)
    sheet.append(leads_for(spark, ROWS), "2024-01-01 10:00:00", "r1")
    assert counts(sheet.append(leads_for(spark, ROWS), "2024-01-02 10:00:00", "r2")) == (0, 2, 2)
    assert counts(skipped_counts(leads_for(spark, ROWS))) == (0, 4, 0)


def test_csv_round_trip(spark, tmp_path):
    leads = leads_for(spark, ROWS)
    store_module.write_lead_csv(leads, str(tmp_path / "csv"))
    back = read_lead_csv(spark, str(tmp_path / "csv")).collect()
    texts = lambda rows: sorted(tuple(v or "" for v in r) for r in rows)
    assert texts(back) == texts(export_rows(leads).collect())
    assert back[0].author == "null" and back[0].language is None and back[0].title == 'say "hi",\nthere'


def test_action_export(spark, tmp_path):
    leads = leads_for(spark, ROWS).withColumn("status", F.when(F.col("seq") == 1, "replied").otherwise("new"))
    path = store_module.export_for_action(leads, str(tmp_path), "2024-03-05 10:00:00")
    assert path.endswith("leads_action_20240305")
    rows = spark.read.option("header", "true").option("multiLine", "true").option("escape", '"').csv(path)
    assert rows.columns == schemas.ACTION_EXPORT_COLUMNS and rows.count() == 3


def test_a_sheet_append_opens_its_own_folders_only(spark, tmp_path):
    from pyspark.sql import functions as F
    from postsift import schemas
    from postsift.sinks.daily_sheet import DailySheet

    sheet = DailySheet(spark, str(tmp_path))
    values = {"post_url": "https://reddit.com/r/s/comments/{}/x/", "signal_score": 9, "comment_worthy": True, "public_draft": "d"}

    def lead(n):
        row = {name: values.get(name) for name in schemas.LEADS.names} | {"seq": n, "post_id": f"p{n}"}
        return spark.createDataFrame([row | {"post_url": values["post_url"].format(f"p{n}")}], schemas.LEADS)

    odd = "run {1}*/a=b"
    for n, (day, run_id) in enumerate([("2024-02-01 10:00:00", "other"), ("2024-02-01 11:00:00", odd), ("2024-02-02 09:00:00", odd)]):
        assert sheet.append(lead(n), day, run_id).first()["saved"] == 1
    assert sorted((r.sheet_date[-2:], r.run_id) for r in sheet.read().collect()) == [("01", "other"), ("02", odd)]
    assert sorted((r.sheet_date[-2:], r.run_id) for r in sheet.read_actions().collect()) == [("01", "other"), ("02", odd)]
    read = sheet.read("2024-02-01 10:00:00")
    assert len(read.inputFiles()) >= 1 and all("2024-02-01" in f for f in read.inputFiles())
    assert sheet.read("2030-01-01 00:00:00").where(F.col("run_id") == odd).collect() == []
