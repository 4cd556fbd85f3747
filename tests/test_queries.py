"""Every registered query against its DuckDB twin, and the shape of its plan, on the smallest inputs."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks import addresses, hail, ingest, leads
from checks.compare import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


#: Queries of the package proper; those of an optional subpackage are tested beside it.
OWN = [name for part in (hail, addresses, ingest, leads) for name in part.QUERIES]


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    ok, note = compare(spark, con, SF, queries()[name], oracle_sql().get(name))
    assert ok, note
    plan = queries()[name](spark, SF)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan      # no row-at-a-time Python


def test_entry(spark):
    assert entry(spark).count() == 4


def test_every_query_has_a_twin():
    assert set(OWN) <= set(oracle_sql()) <= set(queries())
