"""Driver contract: flagship runs; every registered query equals its DuckDB oracle."""

import duckdb
import pytest

import __spark_entry__ as se
from finpanel.plans import registry
from tools.check_oracle import TABLES, rows_of

SF = "/root/testdata/sf0.001"
#: All of the library's own; those of the optional subpackage are tested beside it.
registry.load_all()
NAMES = sorted(registry.ORACLES)


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.count() > 0
    assert "target_class_next" in df.columns


def test_every_oracle_has_a_query():
    assert set(se.oracle_sql()) <= set(se.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_oracle(spark, con, name):
    sdf = se.queries()[name](spark, SF)
    res = con.execute(se.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(ocols, res.fetchall())
