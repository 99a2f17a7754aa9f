import math


from conftest import series_df
from stationkit.operators.clean import drop_sparse_columns, missing_share, sentinel_to_null
from stationkit.operators.series_window import Ordering
from stationkit.operators.shift import forecast_dates, tail_trim
from stationkit.operators.stats import exact_quantile


def test_sentinel_and_nan_become_null(spark):
    df = spark.createDataFrame([(-999.0, 1.0), (float("nan"), 2.0), (3.0, -999.0)], "a double, b double")
    rows = sentinel_to_null(df).collect()
    assert [r.a for r in rows] == [None, None, 3.0] and [r.b for r in rows] == [1.0, 2.0, None]


def test_missing_share_and_drop_sparse(spark):
    df = spark.createDataFrame([(None, 1.0, 1.0), (None, 2.0, None), (1.0, 3.0, 1.0), (None, 4.0, 1.0)],
                               "a double, b double, c double")
    share = {r.column_name: r.missing_share for r in missing_share(df, ["a", "b", "c"]).collect()}
    assert share == {"a": 0.75, "b": 0.0, "c": 0.25}
    assert drop_sparse_columns(df, ["a", "b", "c"], 0.5).columns == ["b", "c"]


def test_tail_trim_per_series_and_global(spark):
    df = series_df(spark, [(s, d, float(d)) for s in ("a", "b") for d in range(5)])
    per = Ordering(("series_id",), ("obs_date",))
    got = sorted((r.series_id, r.v) for r in tail_trim(df, 2, per).collect())
    assert got == [(s, float(d)) for s in ("a", "b") for d in range(3)]
    glob = Ordering((), ("obs_date", "series_id"))
    assert tail_trim(df, 3, glob).count() == 7


def test_forecast_dates_are_the_dates_k_rows_later(spark):
    df = series_df(spark, [("s", d, 0.0) for d in (0, 1, 5)])
    o = Ordering((), ("obs_date",))
    rows = forecast_dates(df, "obs_date", 2, o).orderBy("obs_date").collect()
    assert [(r.date_day1 and r.date_day1.day, r.date_day2 and r.date_day2.day) for r in rows] == \
        [(2, 6), (6, None), (None, None)]


def test_quantile_of_constant_and_single_values(spark):
    one = spark.createDataFrame([(4.0,)], "e double")
    same = spark.createDataFrame([(2.0,)] * 50, "e double")
    assert exact_quantile(one, "e", 0.95) == 4.0
    assert exact_quantile(same, "e", 0.3) == 2.0
    assert exact_quantile(spark.createDataFrame([(None,)], "e double"), "e", 0.5) is None
    two = spark.createDataFrame([(0.0,), (10.0,)], "e double")
    assert math.isclose(exact_quantile(two, "e", 0.95), 9.5)
