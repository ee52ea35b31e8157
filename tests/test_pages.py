"""The listing-page source: odd lines, pushed filters, restarts."""

import json

import pytest

from postsift.session import shared_dir
from postsift.sources import pages as pg


@pytest.fixture
def folder(spark, tmp_path):
    pg.use_pages(spark)
    for n in range(5):
        lines = [json.dumps({"id": f"p{n}{i}", "subreddit": "ab"[i % 2], "created_utc": 1e9 + n * 100 + i, "score": i}) for i in range(6)]
        (tmp_path / f"{n:04d}.json").write_text("\n".join(lines) + "\nbroken\n[1]\n")
    (tmp_path / "notes.txt").write_text("no page")
    (tmp_path / "12-odd.json").write_text('{"id": 5, "subreddit": null, "score": "x", "created_utc": true}\n\n{"id": "ü ", "score": 2.0}')
    return tmp_path


def load(spark, folder, **options):
    return spark.read.format("listing_pages").options(path=f"file://{folder}", **options).load()


def test_batch_reads_pages_and_pushes_filters(spark, folder):
    df = load(spark, folder, pagesPerTask=2)
    assert df.count() == 32 and df.rdd.getNumPartitions() == 3
    some = df.where("subreddit = 'a' AND created_utc >= 1000000200 AND score > 1")
    assert sorted(r.id for r in some.collect()) == sorted(f"p{n}{i}" for n in (2, 3, 4) for i in (2, 4))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "score" in plan.split("Filter")[1] and "= a" not in plan
    assert sorted((r.id or "", r.score) for r in df.where("created_utc IS NULL").collect()) == [("", None), ("ü ", 2)]
    assert df.where("subreddit IN ('b', 'c') AND created_utc < 1000000100").count() == 3


def test_stream_goes_on_behind_the_last_page(spark, folder):
    out, checkpoint = shared_dir(spark, "out"), shared_dir(spark, "checkpoint")

    def go(**options):
        posts = spark.readStream.format("listing_pages").options(path=f"file://{folder}", **options).load()
        posts.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).format("parquet").option("path", out).start().awaitTermination()
        return sorted(r.id or "" for r in spark.read.parquet(out).collect())

    assert len(go(pagesPerBatch=2)) == 12
    assert len(go()) == 32 == len(go())
    (folder / "13.json").write_text('{"id": "new"}')
    got = go()
    assert len(got) == 33 and "new" in got and len(set(got)) == 33


def test_written_pages_come_back(spark, tmp_path):
    pg.use_pages(spark)
    posts = spark.createDataFrame([(i * 3, f"p{i}", "s", i / 2) for i in range(23)], "seq long, id string, subreddit string, created_utc double")
    written = sorted(tuple(r) for r in pg.write_pages(posts, f"file://{tmp_path}/x", 10, 7).collect())
    assert written == [(7, 10), (8, 10), (9, 3)]
    got = load(spark, tmp_path / "x").select("seq", "id", "subreddit", "created_utc")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, posts.collect()))
    assert load(spark, tmp_path / "nothing").count() == 0
