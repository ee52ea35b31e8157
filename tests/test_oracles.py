import pytest

import __spark_entry__ as entry_points
import oracle


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_query_equals_sql(spark, sf_dir, con, name):
    df = entry_points.queries()[name](spark, sf_dir)
    assert oracle.compare(df, entry_points.oracle_sql()[name], con) is None


def test_entry_gives_one_row(spark):
    assert entry_points.entry(spark).count() == 1
