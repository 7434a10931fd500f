"""Every query against its SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from conftest import SMALL
from tools.check_oracle import TABLES, close, plain, rows_of

QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_same_as_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    got, names = rows_of(df.columns, [tuple(plain(v) for v in r) for r in df.collect()])
    cursor = duck.execute(ORACLES[name])
    want, wanted_names = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    assert names == wanted_names
    assert len(got) == len(want) and len(got) > 0
    differing = [(a, b) for a, b in zip(got, want) if not close(a, b)]
    assert not differing[:3]


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_rows_only(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert {r["prefix"] for r in entry(spark).collect()} == {"DIAG", "LAB", "PROC", "VITAL"}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
