"""Every registered query next to its SQL, on the smallest tables."""

from __future__ import annotations

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from tools.check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    assert got
    if name in oracle_sql():
        cur = duck.execute(oracle_sql()[name])
        columns = [d[0] for d in cur.description]
        assert sorted(columns) == sorted(df.columns)
        assert got == rows_of(columns, cur.fetchall())


def test_entry(spark):
    assert entry(spark).columns == ["query", "part", "family", "score", "matched_field", "rank"]
