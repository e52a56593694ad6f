import pytest

from placeloom.catalogue import ORACLE, QUERIES
from tests.compare import DATA, both

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    mine, theirs = both(spark, QUERIES[name], ORACLE[name])
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_runs(spark, name):
    df = QUERIES[name](spark, str(DATA))
    rows = df.count()
    # Only texts that state hours may be wanting in the smallest tables.
    assert len(set(df.columns)) == len(df.columns) and (rows > 0 or name == "spoken_hours")


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_hot_paths_are_joined_without_nested_loops(spark):
    for name in ("spatial_anti", "spatial_argmin", "combined_listing", "page_join", "release_difference"):
        plan = QUERIES[name](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name


def test_scan_reads_only_what_it_needs(spark):
    plan = QUERIES["in_box_category"](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:string,category:string,lat:double,lng:double>" in plan and "GreaterThanOrEqual(lat" in plan
