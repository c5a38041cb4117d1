"""Registered queries vs their DuckDB SQL on the smallest driver tables
(the same comparison the correctness gate uses)."""
import os
import sys

import duckdb
import pytest
from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import canon  # noqa: E402

from parcelkit.sources.tables import TABLES  # noqa: E402

NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    c1, r1 = canon(df.columns, rows)
    c2, r2 = canon(ocols, res.fetchall())
    assert c1 == c2
    assert len(r1) == len(r2)
    assert r1 == r2


def test_every_oracle_has_a_query_and_entry_runs(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    out = entry.entry(spark)
    rows = out.collect()
    assert {r["level"] for r in rows} == {"group", "overall"} and all(r["rmse"] > 0 for r in rows)
