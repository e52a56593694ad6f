import pytest

from placeloom.llm.catalogue import ORACLE, QUERIES
from tests.compare import DATA, both

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    mine, theirs = both(spark, QUERIES[name], ORACLE[name])
    assert mine == theirs


@pytest.mark.parametrize("name", ["p3_found", "p4_found", "p5_confidence", "p5_found", "p6_ids", "p7_found", "p7_scrubbed"])
def test_query_runs(spark, name):
    df = QUERIES[name](spark, str(DATA))
    assert df.distinct().count() == df.count() if "ids" not in df.columns else df.count() > 0
