"""Every registered query against its SQL on the same tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from tableloom.queries.registry import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
#: Queries whose column order is what they are about.
IN_ORDER = ("key_first_projection", "contract_projection")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    yield con
    con.close()


def canonical(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def text(v):
        if v is None or v is pd.NaT:
            return "∅"
        if isinstance(v, float):
            return repr(v)
        return f"{type(v).__name__}:{v}"

    return [names[i] for i in order], sorted(tuple(text(row[i]) for i in order) for row in data)


def test_every_query_has_sql():
    """The rest is tested against brute force, in tests/llm."""
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = canonical(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(entry.oracle_sql()[name])
    want = canonical([d[0] for d in cur.description], cur.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert got[1], "an empty result proves nothing"
    if name in IN_ORDER:
        assert df.columns == [d[0] for d in cur.description]


def test_entry(spark):
    assert entry.entry(spark).count() > 0
