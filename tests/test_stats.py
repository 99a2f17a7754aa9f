import random

import numpy as np
import pytest

from stationkit.operators.stats import arg_min, corr_long, exact_quantile, goal_series_long, histogram


def test_pairwise_null_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0, 1.0), (2.0, None, 5.0), (3.0, 6.0, 2.0), (None, 7.0, 2.0)],
                               "a double, b double, c double")
    r = {(x.col_a, x.col_b): x.corr for x in corr_long(df, ["a", "b", "c"]).collect()}
    assert r[("a", "b")] == pytest.approx(1.0)
    assert r[("a", "c")] == pytest.approx(0.2402, abs=1e-4)
    assert r[("b", "c")] == pytest.approx(0.982, abs=1e-3)


def test_constant_column_gives_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 7.0)], "a double, b double")
    r = {(x.col_a, x.col_b): x.corr for x in corr_long(df, ["a", "b"]).collect()}
    assert r[("a", "b")] is None


def test_histogram_maximum_in_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    h = {r.bin: r.n for r in histogram(df, ["x"], 10).collect()}
    assert len(h) == 10 and h[9] == 2 and sum(h.values()) == 11


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
def test_exact_quantile_matches_numpy(spark, q):
    rnd = random.Random(3)
    vals = [rnd.gauss(0, 1) for _ in range(3000)] + [2.5] * 1500  # a value holding a third of rows
    df = spark.createDataFrame([(v,) for v in vals], "e double")
    assert exact_quantile(df, "e", q) == pytest.approx(float(np.quantile(vals, q)))


def test_arg_min_tie_prefers_smaller_size_then_target(spark):
    df = spark.createDataFrame([(0.2, "b", 1.0), (0.1, "b", 1.0), (0.1, "a", 1.0), (0.3, "a", 2.0)],
                               "test_size double, target string, mse_avg double")
    assert arg_min(df, "mse_avg", "test_size", ["test_size", "target"]).collect()[0].test_size == 0.1


def test_goal_label_parsing(spark):
    df = spark.createDataFrame([(1, 2.0)], "d int, `R_air_temp_future_3Day` double")
    r = goal_series_long(df, "d", ["R_air_temp_future_3Day"]).collect()[0]
    assert (r.target, r.horizon, r.value) == ("air_temp", 3, 2.0)


def test_pairwise_correlation_matches_pandas(spark):
    import pandas as pd
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 4))
    x[:, 1] = 0.7 * x[:, 0] + 0.3 * x[:, 1]
    x[:, 3] = 1e4 + 0.001 * x[:, 3]          # large mean, tiny spread
    x[rng.random(x.shape) < 0.2] = np.nan    # holes everywhere
    pdf = pd.DataFrame(x, columns=list("abcd"))
    df = spark.createDataFrame([tuple(None if np.isnan(v) else float(v) for v in row) for row in x],
                               "a double, b double, c double, d double")
    got = {(r.col_a, r.col_b): r.corr for r in corr_long(df, list("abcd")).collect()}
    ref = pdf.corr()
    for (a, b), v in got.items():
        assert v == pytest.approx(ref.loc[a, b], abs=1e-9)
