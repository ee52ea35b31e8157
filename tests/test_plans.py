import pytest

import __spark_entry__ as entry_points

# These queries start streams or write tables while they are built.
EAGER = {"run_summary", "stream_dedup", "stream_funnel", "stream_sinks", "lifecycle_stream"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(entry_points.queries()) - EAGER))
def test_no_pairing_of_all_rows(spark, sf_dir, name):
    plan = plan_of(entry_points.queries()[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_only_needed_columns_are_read(spark, sf_dir):
    plan = plan_of(entry_points.queries()["batch_count"](spark, sf_dir))
    assert "ReadSchema: struct<>" in plan
    plan = plan_of(entry_points.queries()["post_id_from_url"](spark, sf_dir))
    assert "html" not in plan


def test_stored_lead_filters_reach_the_scan(spark, tmp_path):
    from postsift import schemas
    from postsift.sources.leads import read_table, select_leads
    path = str(tmp_path / "leads")
    spark.createDataFrame([], schemas.LEADS).write.parquet(path)
    plan = plan_of(select_leads(read_table(spark, path), "new", "fr").select("post_id"))
    assert "EqualTo(status,new)" in plan and "EqualTo(language_detected," in plan
    assert "ReadSchema: struct<post_id:string,language_detected:string,status:string>" in plan
