"""Every registered query against its independent DuckDB oracle on the smallest driver tables,
and the driver contract of ``__spark_entry__``."""

import duckdb
import pytest

import __spark_entry__ as E
from periodix.catalog import REGISTRY
from tests.conftest import SF_SMALL
from tools.oracle_check import TABLES, compare


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_contract_keys():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(REGISTRY) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "SMRFull" in df.columns and "start_month" in df.columns


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, SF_SMALL)
    assert res["status"] == "ok", res
