"""Every bound query that SQL can state, against DuckDB on the same tables."""

import datetime as dt
import math

import duckdb
import pytest

from delaylens.plans import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 9) + 0.0)
    return str(value) if isinstance(value, (dt.date, dt.datetime)) else value


def rows(columns, data):
    order = [columns.index(c) for c in sorted(columns)]
    return sorted(
        (tuple(plain(r[i]) for i in order) for r in data),
        key=lambda r: tuple((v is None, str(v)) for v in r),
    )


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(name, spark, folder, duck):
    frame = QUERIES[name](spark, folder)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows(frame.columns, frame.collect()) == rows(columns, cursor.fetchall())


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
