"""Every registered query against its oracle SQL on the smallest sample."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, rows_of  # noqa: E402

BASE = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not BASE.exists(), reason="sample tables are absent")
duckdb = pytest.importorskip("duckdb")
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{BASE}/{t}.parquet'")
    return con


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle(spark, oracle, key):
    df = QUERIES[key](spark, str(BASE))
    got, names = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cursor = oracle.execute(ORACLE[key])
    want, wanted_names = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert names == wanted_names
    assert got == want


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_oracle_returns_rows(spark, key):
    assert QUERIES[key](spark, str(BASE)).count() > 0


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_oracle_has_its_query():
    assert set(ORACLE) <= set(QUERIES)
