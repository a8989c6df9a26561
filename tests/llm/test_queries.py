"""The registered queries on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from corpus_pipeline import QUERIES
from fleetgrid.llm.oracles import ORACLES
from tests.oracle import connect, normal

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {f"op{n}" for n in range(1, 14)} | {"pipeline"} == {x.split("_")[0] for x in QUERIES}
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLES.items() <= entry_points.oracle_sql().items()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_sql(spark, duck: duckdb.DuckDBPyConnection, name):
    df = QUERIES[name](spark, SF)
    cursor = duck.execute(ORACLES[name])
    want = normal([d[0] for d in cursor.description], cursor.fetchall())
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == want


@pytest.mark.parametrize("name", [x for x in QUERIES if x not in ORACLES])
def test_query_runs(spark, name):
    assert not QUERIES[name](spark, SF).isEmpty()
