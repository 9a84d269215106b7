"""Every batch query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

from conftest import SF_SMALL  # noqa: E402

STREAMING = {"pipeline_run", "fan_out", "custom_source", "custom_sink", "write_metadata", "bounded_admission",
             "sink_failure_continue", "source_failure_drain", "pipeline_statements", "pipeline_calendar",
             "pipeline_markets", "init_schema", "two_runs",
             "paced_polling", "subscribed_run"}
NAMES = sorted(n for n in E.oracle_sql() if n not in STREAMING)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_is_registered():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.queries()) >= 60


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(res.columns, res.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "price_change_percent" in df.columns
