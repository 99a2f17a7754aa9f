"""Lasso by coordinate descent on Gram sums.

One scan gives the Gram matrix of features and goals; the descent itself needs
nothing but that matrix.  Features are standardised on the fitting rows, the
penalty is on the standardised slopes,

    1 / (2 n) * |y - a - Z b|^2 + penalty * |b|_1 ,

and each step sets one slope to its best value given the others: the
soft-thresholded correlation of its column with what the others leave.  A path
of penalties runs from the largest down, each starting at the one before.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.moments import gram_parts
from ..functions.scalars import attach_scalars, with_scalars
from .linear import _centred, to_matrix

LASSO_SCHEMA = "model_key string, penalty double, term string, coef double"


def soft(x: float, t: float) -> float:
    return x - t if x > t else x + t if x < -t else 0.0


def descend(a: np.ndarray, c: np.ndarray, penalty: float, b: np.ndarray, tol: float = 1e-13,
            sweeps: int = 100_000) -> np.ndarray:
    """Slopes for correlations ``a`` among the columns and ``c`` with the goal."""
    b = b.copy()
    for _ in range(sweeps):
        moved = 0.0
        for j in range(len(b)):
            if a[j, j] <= 0:
                continue
            new = soft(c[j] - a[j] @ b + a[j, j] * b[j], penalty) / a[j, j]
            moved = max(moved, abs(new - b[j]))
            b[j] = new
        if moved <= tol * max(1.0, np.abs(b).max(initial=0.0)):
            break
    return b


def lasso_models(df: DataFrame, features: list[str], goals: dict[str, str], penalties: list[float],
                 fit_filter=None) -> DataFrame:
    """``model_key, penalty, term, coef`` of every goal and penalty, in the
    features' own units; a feature constant on the fitting rows gets 0."""
    rows = df.where(fit_filter) if fit_filter is not None else df
    cols = [*features, *goals.values()]
    aggs = {c: F.avg(F.col(c).cast("double")) for c in dict.fromkeys(cols)}
    base, centre = with_scalars(rows, aggs)
    g = gram_parts(_centred(base, cols, centre), [f"_c_{k}" for k in range(len(cols))])
    one, centre = attach_scalars(rows.sparkSession.range(1), rows, aggs)
    means = one.select(F.explode(F.array(*[
        F.struct(F.lit(-1).alias("i"), F.lit(k).alias("j"), centre[t].alias("value"))
        for k, t in enumerate(cols)])).alias("c")).select("c.*")
    p, keys, feats = len(features), list(goals), list(features)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        mean = pdf[pdf["i"] < 0].sort_values("j")["value"].to_numpy(float)
        m = to_matrix(pdf[pdf["i"] >= 0], 1 + len(cols))
        n = m[0, 0]
        out = []
        if n > 0:
            s = m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]) / n
            width = np.sqrt(np.maximum(np.diag(s)[:p], 0.0) / n)
            unit = np.where(width > 0, width, 1.0)
            a = s[:p, :p] / n / np.outer(unit, unit)
            a[width <= 0] = a[:, width <= 0] = 0.0
            for k, mk in enumerate(keys):
                c, b = np.where(width > 0, s[:p, p + k] / n / unit, 0.0), np.zeros(p)
                for penalty in sorted(penalties, reverse=True):
                    b = descend(a, c, penalty, b)
                    slope = b / unit
                    out.append((mk, float(penalty), "intercept", float(mean[p + k] - mean[:p] @ slope)))
                    out += [(mk, float(penalty), t, float(v)) for t, v in zip(feats, slope)]
        return pd.DataFrame(out, columns=["model_key", "penalty", "term", "coef"])

    return g.unionByName(means).withColumn("_one", F.lit(0)).groupBy("_one").applyInPandas(fit, LASSO_SCHEMA)
