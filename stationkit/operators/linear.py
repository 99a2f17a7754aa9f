"""Least squares from Gram sums (M1-M4, M11 support, E1-E3 from sums).

``X'X``, ``X'y``, ``y'y``, ``sum x``, ``sum y`` and ``n`` are sums: every task
adds up its batches (``functions/moments.gram_parts``) and a grouped sum
combines the tasks, so only terms^2 numbers per group reach the solve.
Many fits that share X (all goals, all iterations and test sizes of the
sweep) come out of one scan.  Columns are centred by their means (scalar
subqueries) first to limit cancellation.  Solves are tiny (features^2) and
run in ``applyInPandas``, one group per fit family, with a least-norm solve
when X is singular.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.moments import gram_parts
from ..functions.scalars import attach_scalars, with_scalars
from .rows import hash32


def _terms(features: list[str], goals: list[str]) -> list[str]:
    return ["1"] + list(features) + list(goals)


def _centred(df: DataFrame, cols: list[str], centre: dict) -> DataFrame:
    return df.select("*", *[(F.col(c).cast("double") - centre[c]).alias(f"_c_{k}")
                            for k, c in enumerate(cols)])


def gram_long(df: DataFrame, features: list[str], goals: list[str]) -> DataFrame:
    """Uncentred Gram sums in long form ``(term_a, term_b, value)`` (M1 data)."""
    terms = _terms(features, goals)
    g = gram_parts(df, features + goals)
    names = F.array(*[F.lit(t) for t in terms])
    return g.select(F.element_at(names, F.col("i") + 1).alias("term_a"),
                    F.element_at(names, F.col("j") + 1).alias("term_b"), "value")


def to_matrix(rows, n_terms: int) -> np.ndarray:
    """Symmetric Gram matrix from long ``(i, j, value)`` rows (pandas frame)."""
    G = np.zeros((n_terms, n_terms))
    i = rows["i"].to_numpy(int)
    j = rows["j"].to_numpy(int)
    v = rows["value"].to_numpy(float)
    G[i, j] = v
    G[j, i] = v
    return G


def solve(G: np.ndarray, p: int, k: int, alpha: float = 0.0) -> np.ndarray:
    """Coefficients [a, b_1..b_p] for goal k from Gram G over [1, x, y].

    Like an ordinary least-squares fit with intercept: the features are
    centred on the fitting rows' means, then a least-norm solve.  ``alpha``
    adds a ridge penalty on the slopes (not on the intercept)."""
    n = G[0, 0]
    if n <= 0:
        return np.full(p + 1, np.nan)
    yk = 1 + p + k
    sx = G[0, 1:p + 1]
    sy = G[0, yk]
    xx = G[1:p + 1, 1:p + 1] - np.outer(sx, sx) / n
    xy = G[1:p + 1, yk] - sx * sy / n
    b, *_ = np.linalg.lstsq(xx + alpha * np.eye(p), xy, rcond=None)
    a = sy / n - sx @ b / n
    return np.concatenate([[a], b])


def sse_sst(G: np.ndarray, p: int, k: int, w: np.ndarray) -> tuple[float, float, float]:
    """(SSE, SST, n) of coefficients ``w`` on the rows summarised by G."""
    n = G[0, 0]
    yk = 1 + p + k
    idx = list(range(p + 1)) + [yk]
    v = np.concatenate([w, [-1.0]])
    sub = G[np.ix_(idx, idx)]
    sse = float(v @ sub @ v)
    sst = float(G[yk, yk] - G[0, yk] ** 2 / n) if n > 0 else float("nan")
    return max(sse, 0.0), max(sst, 0.0), float(n)


def r2_from(sse: float, sst: float) -> float:
    if sst == 0.0:
        return 1.0 if sse == 0.0 else 0.0
    return 1.0 - sse / sst


# --------------------------------------------------------------------------
# split-size sweep
# --------------------------------------------------------------------------

SWEEP_SCHEMA = ("iteration int, lag int, target string, test_size double, mse_train double, "
                "mse_test double, r2_train double, r2_test double")


def _band_thresholds(df: DataFrame, key: str, iterations: int, sizes: list[float],
                     bits: int = 16) -> tuple[dict, int]:
    """Threshold key (hash, key) per (iteration, size): the ceil(f*n)-th
    smallest (hash_i, key).  Two jobs for all of them: bucket counts on the
    hash prefix, then a rank inside each boundary bucket only."""
    shift = 32 - bits
    x = df.select(F.col(key).cast("long").alias("k"),
                  *[hash32(i, key).alias(f"h{i}") for i in range(iterations)])
    exp = x.select("k", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"h{i}").alias("h"))
                                            for i in range(iterations)])).alias("e"))
    exp = exp.select("k", "e.i", "e.h", F.shiftright("e.h", shift).alias("b"))
    counts = {}
    for r in exp.groupBy("i", "b").count().collect():
        counts.setdefault(r["i"], []).append((r["b"], r["count"]))
    n = sum(c for _, c in counts.get(0, []))
    def located(found: dict, need: list) -> list:
        """(i, f_idx, bucket, rank inside it) of every wanted rank."""
        out = []
        for i, fi, t in need:
            cum = 0
            for b, c in sorted(found.get((i, fi), found.get(i, []))):
                if cum + c >= t:
                    out.append((i, fi, b, t - cum))
                    break
                cum += c
        return out

    want = located(counts, [(i, fi, int(math.ceil(f * n))) for i in range(iterations)
                            for fi, f in enumerate(sizes)])
    if not want:
        return {}, n
    spark = df.sparkSession
    from pyspark.sql import Window

    def inside(want, frame, bucket):
        wdf = spark.createDataFrame(want, f"i int, fi int, {bucket} long, need long")
        return frame.join(F.broadcast(wdf), ["i", bucket])  # want has iterations*sizes rows

    # eight more bits of the hash inside the boundary buckets, so that the
    # ranked rest is a row in 2**24 of the table
    fine = {}
    narrow = exp.withColumn("b2", F.shiftright("h", max(0, shift - 8)))
    for r in inside(want, narrow, "b").groupBy("i", "fi", "b2").count().collect():
        fine.setdefault((r["i"], r["fi"]), []).append((r["b2"], r["count"]))
    cand = inside(located(fine, [(i, fi, need) for i, fi, _, need in want]), narrow, "b2")
    w = Window.partitionBy("i", "fi").orderBy("h", "k")
    hit = cand.withColumn("r", F.row_number().over(w)).where(F.col("r") == F.col("need"))
    return {(r["i"], r["fi"]): (r["h"], r["k"]) for r in hit.select("i", "fi", "h", "k").collect()}, n


def split_sweep(df: DataFrame, key: str, features: list[str], goals: list[tuple[int, str, str]],
                iterations: int, sizes: list[float]) -> DataFrame:
    """M4: ``iterations x len(goals) x len(sizes)`` OLS fits with exact
    random hold-outs (test = ceil(f*n) rows, seed = iteration), in one scan.

    ``goals`` is a list of ``(lag, target, column)``.  Test sets of one
    iteration are nested (same hash order, growing threshold), so each row
    gets one band tag per iteration: the smallest size whose test set holds
    it.  Gram sums per (iteration, band) then add up to every test Gram,
    and train = total - test."""
    thr, n = _band_thresholds(df, key, iterations, sizes)
    goal_cols = [g[2] for g in goals]
    cols = features + goal_cols
    base, centre = with_scalars(df, {t: F.avg(F.col(t).cast("double")) for t in cols})
    bands = []
    for i in range(iterations):
        h = hash32(i, key)
        band = F.lit(len(sizes))
        for fi in reversed(range(len(sizes))):
            if (i, fi) not in thr:
                continue
            th, tk = thr[(i, fi)]
            inside = (h < F.lit(th)) | ((h == F.lit(th)) & (F.col(key) <= F.lit(tk)))
            band = F.when(inside, F.lit(fi)).otherwise(band)
        bands.append(band.cast("long").alias(f"_b{i}"))
    x = _centred(base.select(*cols, *bands, "_sk_scalars"), cols, centre)
    grams = gram_parts(x, [f"_c_{k}" for k in range(len(cols))], tags=[f"_b{i}" for i in range(iterations)])
    p, nt = len(features), 1 + len(cols)
    sizes_l = list(sizes)
    goals_l = list(goals)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        it = int(pdf["tag"].iloc[0])
        by_band = {int(b): to_matrix(g, nt) for b, g in pdf.groupby("tag_value")}
        total = sum(by_band.values())
        out = []
        test = np.zeros((nt, nt))
        for fi, f in enumerate(sizes_l):
            test = test + by_band.get(fi, 0)
            train = total - test
            for k, (lag, target, _) in enumerate(goals_l):
                w = solve(train, p, k)
                e_tr, t_tr, n_tr = sse_sst(train, p, k, w)
                e_te, t_te, n_te = sse_sst(test, p, k, w)
                nan = float("nan")
                out.append((it, lag, target, f, e_tr / n_tr if n_tr else nan, e_te / n_te if n_te else nan,
                            r2_from(e_tr, t_tr) if n_tr else nan, r2_from(e_te, t_te) if n_te else nan))
        return pd.DataFrame(out, columns=["iteration", "lag", "target", "test_size", "mse_train",
                                          "mse_test", "r2_train", "r2_test"])

    return grams.groupBy("tag").applyInPandas(fit, SWEEP_SCHEMA)


# --------------------------------------------------------------------------
# one family of fits (all goals at once), optionally on a split column
# --------------------------------------------------------------------------

MODEL_SCHEMA = "model_key string, term string, coef double"


def ols_models(df: DataFrame, features: list[str], goals: dict[str, str],
               fit_filter=None, alpha: float = 0.0) -> DataFrame:
    """M1/M3 (M11 with ``alpha``, the ridge penalty): coefficients of one OLS model per goal, keyed by model name
    (``goals = {model_key: goal_column}``), long form (model_key, term, coef).
    ``fit_filter`` restricts the fitting rows (e.g. the train split)."""
    fit_rows = df.where(fit_filter) if fit_filter is not None else df
    goal_cols = list(goals.values())
    cols = list(features) + goal_cols
    # centre on the fitting rows' means (scalar subquery); the centre values
    # travel as extra rows (i = -1) so the intercept can be moved back
    aggs = {t: F.avg(F.col(t).cast("double")) for t in cols}
    base, centre = with_scalars(fit_rows, aggs)
    x = _centred(base, cols, centre)
    g = gram_parts(x, [f"_c_{k}" for k in range(len(cols))])
    one, centre = attach_scalars(fit_rows.sparkSession.range(1), fit_rows, aggs)
    cen = one.select(F.explode(F.array(*[
        F.struct(F.lit(-1).alias("i"), F.lit(k).alias("j"), centre[t].alias("value"))
        for k, t in enumerate(cols)])).alias("c")).select("c.*")
    g = g.unionByName(cen).withColumn("_grp", F.lit(0))
    p, nt = len(features), 1 + len(features) + len(goal_cols)
    keys = list(goals.keys())
    feats = list(features)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        cen_rows = pdf[pdf["i"] < 0].sort_values("j")
        G = to_matrix(pdf[pdf["i"] >= 0], nt)
        cvals = cen_rows["value"].to_numpy(float)
        cx = cvals[:p]
        out = []
        for k, mk in enumerate(keys):
            w = solve(G, p, k, alpha)
            cy = float(cvals[p + k])
            a = float(w[0]) + cy - float(cx @ w[1:])
            out.append((mk, "intercept", a))
            for t, c in zip(feats, w[1:]):
                out.append((mk, t, float(c)))
        return pd.DataFrame(out, columns=["model_key", "term", "coef"])

    return g.groupBy("_grp").applyInPandas(fit, MODEL_SCHEMA)


def predict_all(df: DataFrame, models: DataFrame, features: list[str], goals: dict[str, str],
                keep: list[str], out: str = "p") -> DataFrame:
    """M2 for every model of a family in one scan of ``df``: ``keep``,
    ``model_key``, the goal's value ``y`` and the prediction, one row per input
    row and model.  All coefficients (models x terms) are one scalar subquery."""
    terms = ["intercept"] + list(features)
    aggs = {f"{k}_{t}": F.max(F.when((F.col("model_key") == mk) & (F.col("term") == term), F.col("coef")))
            for k, mk in enumerate(goals) for t, term in enumerate(terms)}
    x, coefs = attach_scalars(df, models, aggs, "_sk_coef")
    cells = []
    for k, (mk, goal) in enumerate(goals.items()):
        pred = coefs[f"{k}_0"]
        for t, f in enumerate(features, start=1):
            pred = pred + coefs[f"{k}_{t}"] * F.col(f)
        cells.append(F.struct(F.lit(mk).alias("model_key"), F.col(goal).alias("y"), pred.alias(out)))
    return x.select(*keep, F.explode(F.array(*cells)).alias("_m")).select(*keep, "_m.*")


def predict(df: DataFrame, models: DataFrame, features: list[str], model_key: str,
            out: str = "prediction") -> DataFrame:
    """M2: add ``out`` = intercept + sum(coef * x) for one model.  The
    model's coefficient row (features + 1 values) is one scalar subquery."""
    m = models.where(F.col("model_key") == model_key)
    x, coefs = attach_scalars(df, m, {t: F.max(F.when(F.col("term") == t, F.col("coef")))
                                      for t in ["intercept"] + list(features)}, "_sk_coef")
    pred = coefs["intercept"]
    for t in features:
        pred = pred + coefs[t] * F.col(t)
    return x.withColumn(out, pred).drop("_sk_coef")
