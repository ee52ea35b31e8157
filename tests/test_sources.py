import json

import pytest
from pyspark.sql import functions as F

from postsift import schemas
from postsift.sources import leads as ls, posts as ps


@pytest.fixture(scope="module")
def posts(spark):
    rows = [
        (i, f"p{i}", ["alpha", "Beta", "gamma"][i % 3], "u", f"title {i}", "that thing with that" if i % 2 else "with that",
         "u", "/r/", 1706659200.0 - 3600.0 * i, i % 4, i % 5)
        for i in range(30)
    ]
    return spark.createDataFrame(rows, schemas.POSTS)


def test_json_posts_with_quarantine(spark, tmp_path):
    lines = [json.dumps({"id": "a", "title": "t", "created_utc": 1.0, "score": 3}), "{broken", json.dumps({"id": "b", "score": "x"})]
    (tmp_path / "posts.json").write_text("\n".join(lines))
    good, bad = ps.read_json_posts(spark, str(tmp_path))
    row = ps.normalise(good).collect()
    assert [(r.id, r.author, r.selftext, r.score) for r in row] == [("a", "[deleted]", "", 3)]
    assert sorted(r[0] for r in bad.collect()) == sorted(lines[1:])


def test_open_posts(spark, posts, tmp_path):
    path = str(tmp_path / "posts")
    posts.write.parquet(path)
    assert ps.open_posts(spark, path).count() == 30
    assert ps.open_posts(spark, posts) is posts
    posts.createOrReplaceTempView("some_posts")
    assert ps.open_posts(spark, "some_posts").count() == 30
    assert ps.open_posts(spark, "sample").count() == 7


def test_community_list():
    assert ps.parse_communities(" a, b ,,c", ["d"]) == ["a", "b", "c"]
    assert ps.parse_communities("", ["d"]) == ps.parse_communities(None, ["d"]) == ps.parse_communities(" , ", ["d"]) == ["d"]


def test_newest_counts_over_all_communities(spark, posts):
    assert [r.seq for r in ps.newest_posts(posts, ["ALPHA", "beta"], 4).collect()] == [0, 1, 3, 4]
    names = spark.createDataFrame([("ALPHA",), ("beta",), ("Beta",)], "name string")
    assert [r.seq for r in ps.newest_posts(posts, names, 4).collect()] == [0, 1, 3, 4]
    each = ps.newest_posts(posts, ["alpha", "Beta", "gamma"], 2, per_community=True)
    assert sorted(r.seq for r in each.collect()) == [0, 1, 2, 3, 4, 5]


def test_a_table_of_names_is_joined(spark, posts):
    names = spark.createDataFrame([("ALPHA",), ("beta",), ("Beta",), ("delta",)], "name string")
    got = ps.in_communities(posts, names)
    assert got.columns == posts.columns
    assert sorted(r.seq for r in got.collect()) == [i for i in range(30) if i % 3 < 2]


def test_rank_limit_is_applied_before_the_shuffle(posts):
    plan = ps.newest_posts(posts, ["alpha"], 2, per_community=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_hot(posts):
    rows = ps.hot_posts(posts, ["alpha", "beta", "gamma"], 3).collect()
    assert [(r.seq, r.score, r.num_comments) for r in rows] == [(19, 3, 4), (3, 3, 3), (23, 3, 3)]


def test_search(posts):
    names = ["alpha", "beta", "gamma"]
    as_of = "2024-01-31 00:00:00"
    found = lambda **kw: [r.seq for r in ps.search_posts(posts, names, "THAT with", as_of, **kw).collect()]
    assert found(time_filter="hour") == [0, 1]
    assert len(found(time_filter="day")) == 25 and len(found(time_filter="all")) == 30
    assert found(sort="relevance", limit=3) == [1, 3, 5]
    assert found(sort="comments", limit=2) == [4, 9]
    assert found(sort="top", limit=2) == [3, 7] and found(sort="hot", limit=1) == [19]
    assert ps.search_posts(posts, names, "absent", as_of).count() == 0


def test_missing_table_is_empty(spark, tmp_path):
    empty = ls.read_table(spark, str(tmp_path / "nothing"))
    assert empty.count() == 0 and empty.schema == schemas.LEADS


def test_stored_ids(spark):
    urls = ["https://reddit.com/r/a/comments/x1/t/", "https://reddit.com/r/a/comments/x1/t/", "https://example.org/",
            "https://reddit.com/r/a/comments/", "a/comments/b/comments/c", None]
    df = spark.createDataFrame([(u,) for u in urls], "post_url string")
    assert sorted(r.post_id for r in ls.stored_ids(df).collect()) == ["b", "x1"]


def test_not_stored(spark):
    df = spark.createDataFrame([(i, "hot" if i % 2 else f"p{i}") for i in range(40)], "seq long, post_id string")
    stored = spark.createDataFrame([("hot",), ("hot",), ("p4",), ("zz",)], "post_id string")
    got = ls.not_stored(df, stored)
    assert set(got.columns) == {"seq", "post_id"}
    assert sorted(r.seq for r in got.collect()) == [i for i in range(0, 40, 2) if i != 4]


def test_lead_filters(spark):
    df = spark.createDataFrame([(3, "new", "fr"), (1, "new", "fr"), (2, "new", None), (4, "sent", "fr")],
                               "seq long, status string, language_detected string")
    ids = lambda *a: [r.seq for r in ls.select_leads(df, *a).collect()]
    assert ids("new", "fr", 1) == [1] and len(ids("", None, 0)) == 4 and ids(None, None, 2) == [1, 2]
