"""Each query with an oracle gives the rows that DuckDB gives."""

import math
import os
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from quillmark import oracles, queries

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")


def plain(x):
    if isinstance(x, float):
        return "nan" if math.isnan(x) else round(x, 5)
    return x


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(oracles.ORACLE_SQL))
def test_oracle(spark, duck, name):
    frame = queries.QUERIES[name](spark, SF)
    got = rows_of(frame.columns, frame.collect())
    result = duck.execute(oracles.ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    want = rows_of(columns, result.fetchall())
    assert sorted(frame.columns) == sorted(columns)
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(oracles.ORACLE_SQL)))
def test_query_without_oracle_runs(spark, name):
    queries.QUERIES[name](spark, SF).collect()
