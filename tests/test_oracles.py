"""A representative set of registered queries against their DuckDB oracle
SQL at sf0.001 (the full set runs in scripts/oracle_check.py)."""

import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NAMES = ["supervised_table", "interpolate_chunked", "future_targets_chunked", "event_future_skewed",
         "local_weighted_fill", "lagged_left_join", "station_pivot_join", "holdout_split",
         "forecast_dates", "corr_matrix", "histogram_100", "error_outliers", "head_weighted_fill",
         "ols_models", "split_sweep", "dense_score"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("lineitem", "orders", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted("|".join(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.sql(E.oracle_sql()[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = sorted("|".join(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want
