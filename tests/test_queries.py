"""Every query with SQL gives the rows of the SQL, on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__
from fareloom.plans import catalog, catalog_sql, contracts, contracts_sql, round_trips, round_trips_sql, training, training_sql

QUERIES = catalog.QUERIES | contracts.QUERIES | round_trips.QUERIES | training.QUERIES
ORACLE = catalog_sql.ORACLE | contracts_sql.ORACLE | round_trips_sql.ORACLE | training_sql.ORACLE

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="needs the test tables")


def plain(rows, columns):
    """Rows as sorted tuples of text, numbers to nine digits."""
    def one(v):
        if v is None or v != v:
            return "null"
        if isinstance(v, bool):
            return str(v)
        if isinstance(v, (int, float)) or type(v).__name__ in ("Decimal", "int64", "float64"):
            return "inf" if math.isinf(v) else f"{float(v):.9g}"
        return str(v)

    return sorted(tuple(one(r[c]) for c in columns) for r in rows)


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, sql, name):
    df = __spark_entry__.queries()[name](spark, str(FOLDER))
    cursor = sql.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    got = plain([r.asDict() for r in df.collect()], sorted(names))
    want = plain([dict(zip(names, r, strict=True)) for r in cursor.fetchall()], sorted(names))
    assert got == want


@pytest.mark.parametrize("name", sorted(QUERIES.keys() - ORACLE.keys()))
def test_other_queries_run(spark, name):
    assert __spark_entry__.queries()[name](spark, str(FOLDER)).count() > 0


def test_contract(spark):
    assert __spark_entry__.oracle_sql().keys() <= __spark_entry__.queries().keys()
    assert __spark_entry__.entry(spark).count() > 0
