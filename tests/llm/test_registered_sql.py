"""Registered queries of the operators against their DuckDB twins, at sf0.001
(the driver runs the same comparison at sf0.01)."""

import math
from pathlib import Path

import duckdb
import pytest

from tripmart.llm import queries


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6)
    return str(value) if not isinstance(value, (bool, int)) else int(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(Path(sf_small).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_which_queries_have_sql():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.ORACLE)
    assert numbers == [1, 3, 7, 9, 10] and set(queries.ORACLE) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, sf_small, duck, name):
    found = queries.QUERIES[name](spark, sf_small)
    cursor = duck.execute(queries.ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(found.columns) == sorted(columns)
    assert rows_of(found.columns, found.collect()) == rows_of(columns, cursor.fetchall())
