import pytest

import __spark_entry__ as entry_points
from tests.oracle import both, connect
from workload.catalog import QUERIES
from workload.oracles import ORACLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.oracle_sql())
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    (columns, ours), (sql_columns, theirs) = both(spark, duck, name, SF)
    assert columns == sql_columns
    assert ours and ours == theirs


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns[-1] == "congestion_status"
    assert not df.isEmpty()
