import pytest

from conftest import series_df
from stationkit.operators.joins import join_series, suffix_join


def test_date_shift_join(spark):
    df = series_df(spark, [("t", 1, 1.0), ("t", 2, 2.0), ("t", 5, 5.0),
                           ("n", 1, 10.0), ("n", 2, 20.0), ("n", 5, 50.0)])
    out = join_series(df, "series_id", "obs_date", ["t", "n"], "left", cols=["v"], offsets={"n": 3})
    got = {r.obs_date.day: r.n_v for r in out.collect()}
    assert got == {2: None, 3: None, 6: 20.0}


def test_duplicate_dates_multiply_and_null_dates_never_match(spark):
    df = series_df(spark, [("a", 1, 1.0), ("b", 1, 2.0), ("b", 1, 3.0)])
    assert join_series(df, "series_id", "obs_date", ["a", "b"], "inner", cols=["v"]).count() == 2
    nulls = spark.createDataFrame([("a", None, 1.0), ("b", None, 2.0)], "series_id string, obs_date date, v double")
    assert join_series(nulls, "series_id", "obs_date", ["a", "b"], "inner", cols=["v"]).count() == 0


def test_suffix_only_colliding(spark):
    a = spark.createDataFrame([(1, 1.0, 5.0)], "k int, x double, only_a double")
    b = spark.createDataFrame([(1, 2.0)], "k int, x double")
    assert sorted(suffix_join(a, b, "k", ("_l", "_r")).columns) == ["k", "only_a", "x_l", "x_r"]


def test_pivot_layout_equals_inner_join_on_unique_cells(spark):
    from stationkit.operators.joins import pivot_series
    df = series_df(spark, [("a", 1, 1.0), ("b", 1, 2.0), ("a", 2, 3.0), ("b", 3, 4.0), ("a", 3, None)])
    piv = {(r.obs_date.day, r.a_v, r.b_v) for r in pivot_series(df, "series_id", "obs_date", ["a", "b"], ["v"]).collect()}
    joined = {(r.obs_date.day, r.a_v, r.b_v) for r in
              join_series(df, "series_id", "obs_date", ["a", "b"], "inner", cols=["v"]).collect()}
    assert piv == joined == {(2, 1.0, 2.0), (4, None, 4.0)}
    dup = series_df(spark, [("a", 1, 1.0), ("a", 1, 5.0), ("b", 1, 2.0)])
    # the join gives two rows there; a cell of the pivot holds one, so it refuses
    with pytest.raises(Exception, match="several rows on one date"):
        pivot_series(dup, "series_id", "obs_date", ["a", "b"], ["v"]).collect()
