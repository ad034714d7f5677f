"""The driver's gate in the suite: every registered query against its DuckDB
oracle SQL on the smallest data set (row count, columns, values)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, _rows  # noqa: E402
from tickrisk.plans.queries import QUERIES  # noqa: E402
from tickrisk.plans.stream_queries import STREAM_QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


NAMES = sorted({**QUERIES, **STREAM_QUERIES})


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    exp = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp) > 0
    assert _rows(got) == _rows(exp)
