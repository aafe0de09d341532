"""Every registered query against its DuckDB twin at sf0.001
(the driver runs the same comparison at sf0.01)."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from tripmart.plans import catalog

QUERIES, ORACLE = catalog.load()
TABLES = ("region nation customer supplier part orders lineitem events").split()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return f"{round(v, 6):.6f}"
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES) <= set(E.queries())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_matches_duckdb(spark, sf_small, duck, key):
    sdf = E.queries()[key](spark, sf_small)
    srows = [tuple(r) for r in sdf.collect()]
    cur = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert len(srows) == len(drows)
    assert sorted(sdf.columns) == sorted(dcols)
    assert _digest(sdf.columns, srows) == _digest(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "revenue_zone" in df.columns
