"""Every query with an oracle returns the oracle's rows."""

import datetime as dt
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(plain(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((v is None, str(v)) for v in row),
    )


def kinds(row):
    return [type(v) for v in row]


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    got = table(result.columns, result.collect())
    if name not in ORACLES:
        assert got, "no rows"
        return
    answer = duck.execute(ORACLES[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == sorted(result.columns)
    want = table(columns, answer.fetchall())
    assert len(got) == len(want)
    wrong = [(g, w) for g, w in zip(got, want) if g != w or kinds(g) != kinds(w)]
    assert not wrong, wrong[:3]


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
