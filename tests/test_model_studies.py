"""QR, tiled normal equations, lasso and trees against plain NumPy."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationkit.operators import gram_tiles as GT
from stationkit.operators import lasso as LS
from stationkit.operators import linear as LN
from stationkit.operators import tall_qr as QR
from stationkit.operators import trees as TR

FEATS = ["a", "b", "c"]


def frame(spark, n=200, seed=1, shape=None):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 3))
    if shape:
        x = shape(x)
    y = 2 + x @ [1.0, -2.0, 0.5] + 0.3 * x[:, 0] * x[:, 1] + rng.normal(0, 0.1, n)
    z = x[:, 2] ** 2 - x[:, 0]
    rows = [(i, "test" if i % 5 == 0 else "train", *map(float, r), float(p), float(q))
            for i, (r, p, q) in enumerate(zip(x, y, z))]
    return spark.createDataFrame(rows, "row_id long, split string, a double, b double, c double, y double, z double"), \
        x, np.column_stack([y, z]), np.array([i % 5 != 0 for i in range(n)])


def coefs(df, key="model_key"):
    out = {}
    for r in df.collect():
        out.setdefault(r[key], {})[r["term"]] = r["coef"]
    return out


def test_qr_equals_lstsq_on_nearly_collinear_columns(spark):
    def shape(x):
        return np.column_stack([1000 + x[:, 0], 1000 + x[:, 0] + 1e-6 * x[:, 1], x[:, 2]])
    df, x, y, train = frame(spark, 400, 3, shape)
    got = coefs(QR.qr_models(df.repartition(7), FEATS, {"m": "z"}, "split = 'train'"))["m"]
    m = x[train].mean(0)
    want, *_ = np.linalg.lstsq(x[train] - m, y[train, 1] - y[train, 1].mean(), rcond=None)
    pred = x @ [got[f] for f in FEATS] + got["intercept"]
    ref = (x - m) @ want + y[train, 1].mean()
    assert np.abs(pred - ref).max() < 1e-6


def test_qr_least_norm_on_a_repeated_and_a_constant_column(spark):
    def shape(x):
        return np.column_stack([x[:, 0], x[:, 0], np.full(len(x), 4.0)])
    df, x, y, train = frame(spark, 100, 5, shape)
    got = coefs(QR.qr_models(df, FEATS, {"m": "y"}, "split = 'train'"))["m"]
    assert got["a"] == pytest.approx(got["b"]) and abs(got["c"]) < 1e-12


def reference_metrics(x, y, train, degree, ridge=None):
    lo, hi = x.min(0), x.max(0)
    s = np.where(hi > lo, 2 * (x - lo) / np.where(hi > lo, hi - lo, 1) - 1, 0.0)
    d = np.column_stack([np.ones(len(s)), QR.design(s, QR.poly_combos(3, degree))])
    w, *_ = np.linalg.lstsq(d[train], y[train], rcond=1e-13)
    out = {}
    for name, rows in (("train", train), ("test", ~train)):
        out[name] = ((y[rows] - d[rows] @ w) ** 2).mean(0)
    return out


@pytest.mark.parametrize("degree", [1, 2, 4])
def test_polynomials_by_qr_and_by_tiles(spark, degree):
    df, x, y, train = frame(spark, 300, 7)
    want = reference_metrics(x, y, train, degree)
    goals = {"my": "y", "mz": "z"}
    qr = QR.poly_family(df.repartition(5), "split", FEATS, goals, degree).collect()
    tiles = GT.poly_family_tiled(df, "split", FEATS, goals, degree, tile=6, ridge=1e-13).collect()
    assert len(qr) == len(tiles) == 4
    for r in [*qr, *tiles]:
        k = 0 if r["model_key"] == "my" else 1
        assert r["mse"] == pytest.approx(want[r["split"]][k], rel=1e-5, abs=1e-10), (r, degree)
        rows = train if r["split"] == "train" else ~train
        assert r["n"] == rows.sum() and r["rmse"] == pytest.approx(math.sqrt(r["mse"]))
        assert r["r2"] == pytest.approx(1 - want[r["split"]][k] / y[rows, k].var(), rel=1e-5, abs=1e-9)


def test_more_terms_than_rows_fit_the_training_rows(spark):
    df, x, y, train = frame(spark, 40, 9)
    for r in GT.poly_family_tiled(df, "split", FEATS, {"m": "y"}, 4, tile=10).where("split = 'train'").collect():
        assert r["mse"] < 1e-4


def test_tiles_hold_the_whole_matrix(spark):
    df, x, y, _ = frame(spark, 120, 11)
    rows = QR.scaled_to_unit(df, FEATS, [F.col("y").alias("_y0")])
    blocks = GT.poly_blocks(3, 3, 1, tile=7)
    got = {r["term"]: r for r in GT.tile_sums(GT.gram_tiles(rows, blocks, 3), blocks).collect()}
    s = 2 * (x - x.min(0)) / (x.max(0) - x.min(0)) - 1
    d = QR.design(s, blocks.terms)
    g = d.T @ d
    for k, t in enumerate(blocks.terms):
        r = got[QR.term_name(t)]
        assert r["sum_sq"] == pytest.approx(g[k, k]) and r["row_sum"] == pytest.approx(g[k].sum(), abs=1e-8)
        assert r["xy0"] == pytest.approx((d[:, k] * y[:, 0]).sum(), abs=1e-8)


def test_lasso_meets_its_optimality_conditions(spark):
    df, x, y, train = frame(spark, 300, 13)
    x, y = x[train], y[train]
    z = (x - x.mean(0)) / x.std(0)
    for r, k in (("my", 0), ("mz", 1)):
        rows = LS.lasso_models(df, FEATS, {"my": "y", "mz": "z"}, [0.5, 0.05, 0.0], "split = 'train'").where(
            F.col("model_key") == r)
        for penalty in (0.5, 0.05, 0.0):
            c = coefs(rows.where(F.col("penalty") == penalty))[r]
            b = np.array([c[f] for f in FEATS]) * x.std(0)
            left = y[:, k] - c["intercept"] - x @ [c[f] for f in FEATS]
            slope = z.T @ left / len(z)
            for j in range(3):
                if b[j]:
                    assert slope[j] == pytest.approx(penalty * np.sign(b[j]), abs=1e-9)
                else:
                    assert abs(slope[j]) <= penalty + 1e-9
            assert left.mean() == pytest.approx(0, abs=1e-9)
    ols = coefs(LN.ols_models(df, FEATS, {"my": "y"}, fit_filter=F.col("split") == "train"))["my"]
    free = coefs(LS.lasso_models(df, FEATS, {"my": "y"}, [0.0], "split = 'train'"))["my"]
    assert all(free[t] == pytest.approx(ols[t], abs=1e-8) for t in ols)


def test_lasso_with_a_constant_feature(spark):
    df, *_ = frame(spark, 60, 15, lambda x: np.column_stack([x[:, 0], x[:, 1], np.ones(len(x))]))
    assert coefs(LS.lasso_models(df, FEATS, {"m": "y"}, [0.01]))["m"]["c"] == 0.0


def brute_tree(x, y, bins, depth, least):
    lo, hi = x.min(0), x.max(0)
    b = np.stack([np.zeros(len(x), int) if h == a else np.clip(np.floor((v - a) / (h - a) * bins), 0, bins - 1).astype(int)
                  for v, a, h in zip(x.T, lo, hi)], 1)
    nodes = {}

    def split(rows, node, level):
        best = None
        if level < depth:
            for f in range(x.shape[1]):
                for cut in sorted(set(b[rows, f])):
                    left = rows[b[rows, f] <= cut]
                    right = rows[b[rows, f] > cut]
                    if len(left) < least or len(right) < least:
                        continue
                    gain = round(y[left].sum() ** 2 / len(left) + y[right].sum() ** 2 / len(right)
                                 - y[rows].sum() ** 2 / len(rows), 6)
                    if gain > 0 and (best is None or gain > best[0]):
                        best = (gain, f, cut, left, right)
        nodes[node] = (len(rows), y[rows].mean(), *(best[1:3] if best else (None, None)))
        if best:
            split(best[3], 2 * node, level + 1)
            split(best[4], 2 * node + 1, level + 1)
    split(np.arange(len(x)), 1, 0)
    return nodes, b


def test_tree_equals_recursive_splitting(spark):
    df, x, y, train = frame(spark, 250, 17)
    model = TR.grow(df, FEATS, {"my": "y", "mz": "z"}, "split = 'train'", depth=3, bins=8, least_rows=4.0)
    for mk, k in (("my", 0), ("mz", 1)):
        want, _ = brute_tree(x[train], y[train, k], 8, 3, 4)
        got = {r["node"]: (r["n"], r["mean"], r["feature_no"], r["bin"]) for r in model.collect() if r["model_key"] == mk}
        assert got.keys() == want.keys()
        for n in want:
            assert got[n][0] == want[n][0] and got[n][2:] == want[n][2:] and got[n][1] == pytest.approx(want[n][1])
    pred = {(r["row_id"], r["model_key"]): r["p"]
            for r in TR.predict(df, model, FEATS, {"my": "y", "mz": "z"}, "split = 'train'", ["row_id"], 8).collect()}
    assert len(pred) == 500
    nodes = {(r["model_key"], r["node"]): r for r in model.collect()}
    lo, hi = x[train].min(0), x[train].max(0)
    for i in random.Random(1).sample(range(250), 60):
        node = 1
        while nodes["my", node]["bin"] is not None:
            r = nodes["my", node]
            f = r["feature_no"]
            place = min(7, max(0, math.floor((x[i, f] - lo[f]) / (hi[f] - lo[f]) * 8)))
            node = 2 * node + (place > r["bin"])
        assert pred[i, "my"] == pytest.approx(nodes["my", node]["mean"])


def test_forest_averages_trees_on_repeatable_draws(spark):
    df, x, y, train = frame(spark, 150, 19)
    draws = df.select(*[TR.poisson_draws(3, t, "row_id").alias(f"d{t}") for t in range(2)]).toPandas()
    assert set(draws.to_numpy().ravel()) <= {0.0, 1.0, 2.0, 3.0, 4.0} and 0.7 < draws.to_numpy().mean() < 1.3
    args = dict(fit_filter="split = 'train'", depth=2, bins=8, least_rows=3.0, trees=2, seed=3)
    a = TR.grow(df, FEATS, {"m": "y"}, **args)
    b = TR.grow(df.repartition(6), FEATS, {"m": "y"}, **args)
    key = ["tree", "node", "n", "feature_no", "bin"]
    assert sorted(map(str, a.select(*key).collect())) == sorted(map(str, b.select(*key).collect()))
    root = {r["tree"]: r["n"] for r in a.where("node = 1").collect()}
    assert root == {t: draws[f"d{t}"][train].sum() for t in range(2)}
    assert TR.predict(df, a, FEATS, {"m": "y"}, "split = 'train'", ["row_id"], 8).count() == 150


def test_trees_of_a_constant_goal_and_too_many_nodes(spark):
    df, *_ = frame(spark, 40, 21)
    model = TR.grow(df.withColumn("y", F.lit(2.5)), FEATS, {"m": "y"}, "split = 'train'", depth=3, bins=4)
    assert [(r["node"], r["mean"], r["feature"], r["threshold"]) for r in model.collect()] == [(1, 2.5, None, None)]
    with pytest.raises(ValueError):
        TR.grow(df, FEATS, {"m": "y"}, "split = 'train'", depth=20)
