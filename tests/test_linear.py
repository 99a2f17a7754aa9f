import hashlib
import math

import numpy as np
import pytest

from stationkit.operators.linear import ols_models, predict, split_sweep


def _data(spark, n=200, seed=0, collinear=False):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [1.0, 3.0, 0.5] + [10.0, -2.0, 0.0]
    if collinear:
        x[:, 2] = 2 * x[:, 0]
    y1 = 1.5 + x @ [0.5, -1.0, 2.0] + rng.normal(scale=0.3, size=n)
    y2 = rng.normal(size=n)
    rows = [(int(i), *map(float, x[i]), float(y1[i]), float(y2[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "row_id long, x0 double, x1 double, x2 double, y1 double, y2 double")
    return df, x, np.c_[y1, y2]


def _fit(x, y):
    a = np.c_[np.ones(len(x)), x]
    w, *_ = np.linalg.lstsq(a, y, rcond=None)
    return w


def test_ols_matches_numpy(spark):
    df, x, y = _data(spark)
    m = {(r.model_key, r.term): r.coef for r in
         ols_models(df, ["x0", "x1", "x2"], {"m1": "y1", "m2": "y2"}).collect()}
    for k, mk in enumerate(["m1", "m2"]):
        w = _fit(x, y[:, k])
        assert m[(mk, "intercept")] == pytest.approx(w[0], abs=1e-8)
        for j in range(3):
            assert m[(mk, f"x{j}")] == pytest.approx(w[j + 1], abs=1e-8)


def test_collinear_features_give_finite_fit_and_same_predictions(spark):
    df, x, y = _data(spark, collinear=True)
    models = ols_models(df, ["x0", "x1", "x2"], {"m1": "y1"})
    p = np.array([r.p for r in predict(df, models, ["x0", "x1", "x2"], "m1", "p").orderBy("row_id").collect()])
    assert np.all(np.isfinite(p))
    w = _fit(x[:, :2], y[:, 0])
    ref = np.c_[np.ones(len(x)), x[:, :2]] @ w
    assert np.allclose(p, ref, atol=1e-6)


def _h(seed, key):
    return int(hashlib.md5(f"{seed}:{key}".encode()).hexdigest()[:8], 16)


def test_split_sweep_equals_brute_force(spark):
    df, x, y = _data(spark, n=150, seed=2)
    sizes = [0.1, 0.3, 0.5]
    out = split_sweep(df, "row_id", ["x0", "x1", "x2"], [(1, "y1", "y1"), (2, "y2", "y2")], 3, sizes)
    got = {(r.iteration, r.target, r.test_size): r for r in out.collect()}
    assert len(got) == 3 * 2 * 3
    n = len(x)
    for it in range(3):
        order = sorted(range(n), key=lambda i: (_h(it, i), i))
        for f in sizes:
            t = set(order[:math.ceil(f * n)])
            te = np.array([i in t for i in range(n)])
            for k, name in enumerate(["y1", "y2"]):
                w = _fit(x[~te], y[~te, k])
                a = np.c_[np.ones(n), x]
                for mask, mse_name, r2_name in ((~te, "mse_train", "r2_train"), (te, "mse_test", "r2_test")):
                    e = y[mask, k] - a[mask] @ w
                    mse = float(np.mean(e ** 2))
                    r2 = 1 - np.sum(e ** 2) / np.sum((y[mask, k] - y[mask, k].mean()) ** 2)
                    row = got[(it, name, f)]
                    assert row[mse_name] == pytest.approx(mse, rel=1e-6)
                    assert row[r2_name] == pytest.approx(r2, rel=1e-6, abs=1e-9)
