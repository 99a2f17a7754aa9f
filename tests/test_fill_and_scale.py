import math

import pytest

from conftest import series_df
from stationkit.operators.impute import (local_weighted_fill, mean_impute, minmax_scale,
                                         sentinel_mean_impute)
from stationkit.operators.series_window import Ordering

O = Ordering(partition=("series_id",), order=("obs_date",), mode="series")


def test_local_weighted_fill_isolated_gap(spark):
    df = series_df(spark, [("s", 0, 1.0), ("s", 1, None), ("s", 2, 3.0)])
    out = [r.v for r in local_weighted_fill(df, ["v"], O).orderBy("obs_date").collect()]
    assert out == [1.0, pytest.approx(2.0), 3.0]


def test_local_weighted_fill_weights_and_missing_column(spark):
    df = series_df(spark, [("s", 0, 1.0), ("s", 1, None), ("s", 2, None), ("s", 3, 7.0),
                           ("t", 0, None), ("t", 1, None)])
    out = {(r.series_id, r.obs_date.day): r.v for r in local_weighted_fill(df, ["v"], O).collect()}
    w1, w2 = math.exp(-0.1), math.exp(-0.2)
    assert out[("s", 2)] == pytest.approx((1.0 * w1 + 7.0 * w2) / (w1 + w2))
    assert out[("t", 1)] is None and out[("t", 2)] is None


def test_sentinel_column_means(spark):
    df = spark.createDataFrame([(-999.0, 2.0), (1.0, -999.0), (3.0, 4.0)], "a double, b double")
    rows = sentinel_mean_impute(df, ["a", "b"]).collect()
    assert rows[0].a == 2.0 and rows[1].b == 3.0 and rows[2].a == 3.0


def test_mean_impute_per_series(spark):
    df = series_df(spark, [("s", 0, 1.0), ("s", 1, None), ("s", 2, 3.0), ("t", 0, None), ("t", 1, 10.0)])
    out = {(r.series_id, r.obs_date.day): r.v for r in mean_impute(df, ["v"], by=["series_id"]).collect()}
    assert out[("s", 2)] == 2.0 and out[("t", 1)] == 10.0


def test_minmax_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 7.0)], "a double, b double")
    rows = minmax_scale(df, ["a", "b"]).collect()
    assert [r.a for r in rows] == [0.0, 0.0, 0.0]
    assert [r.b for r in rows] == [0.0, pytest.approx(0.2), 1.0]
