"""Model fitting and scoring with Spark ML and Arrow batches.

Polynomial, tree and regularised models are Spark ML estimators (their
statistics are tree-aggregated across executors).  Dense-network scoring
with given weights is a ``mapInPandas`` over Arrow batches: one matrix
product per layer per batch, the weights shipped once with the function.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import PolynomialExpansion, VectorAssembler
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .metrics import regression_metrics


def poly_terms(features: list[str], degree: int, bias: bool = True) -> list[tuple[str, Column]]:
    """M5: all monomials up to ``degree`` (bias first, then by degree, each
    degree in combinations-with-replacement order) as named columns."""
    out: list[tuple[str, Column]] = []
    if bias:
        out.append(("t_bias", F.lit(1.0)))
    for d in range(1, degree + 1):
        for combo in combinations_with_replacement(range(len(features)), d):
            expr = F.col(features[combo[0]]).cast("double")
            for i in combo[1:]:
                expr = expr * F.col(features[i])
            out.append(("t_" + "_".join(str(i) for i in combo), expr))
    return out


def poly_expand(df: DataFrame, features: list[str], degree: int, keep: list[str]) -> DataFrame:
    return df.select(*keep, *[e.alias(n) for n, e in poly_terms(features, degree)])


def _fit_eval(train: DataFrame, test: DataFrame, est, features_col: str, label: str,
              keys: dict) -> DataFrame:
    model = est.fit(train)
    parts = []
    for split, d in (("train", train), ("test", test)):
        pred = model.transform(d).select(F.col(label).alias("y"), F.col("prediction").alias("p"))
        m = regression_metrics(pred, [], "y", "p").withColumn("split", F.lit(split))
        for k, v in keys.items():
            m = m.withColumn(k, F.lit(v))
        parts.append(m)
    return parts[0].unionByName(parts[1])


def fit_family(df: DataFrame, split_col: str, features: list[str], goals: dict[str, str],
               kind: str, degree: int = 1, seed: int = 0, reg: float = 0.0,
               elastic: float = 0.0, parallelism: int = 4) -> DataFrame:
    """Fit one estimator per goal on the train rows, report metrics on train
    and test: (model_key, family, degree, split, n, mse, rmse, r2).

    The assembled (and expanded) feature table is cached once and shared
    by all goals, like the reference's single X for six targets.  The goals'
    fits are independent, so up to ``parallelism`` of them are submitted at
    once from driver threads (as Spark ML's tuning classes do), which keeps
    the executors busy when one fit's jobs are small."""
    asm = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="error")
    stages = [asm]
    fcol = "_x"
    if degree > 1:
        stages.append(PolynomialExpansion(degree=degree, inputCol="_x", outputCol="_xp"))
        fcol = "_xp"
    prep = Pipeline(stages=stages).fit(df)
    data = prep.transform(df).select(split_col, fcol, *dict.fromkeys(goals.values())).persist()
    try:
        train = data.where(F.col(split_col) == "train")
        test = data.where(F.col(split_col) == "test")
        def one(key: str, goal: str) -> DataFrame:
            if kind == "ols":
                est = LinearRegression(featuresCol=fcol, labelCol=goal, solver="normal",
                                       regParam=reg, elasticNetParam=elastic, standardization=False)
            elif kind == "regularised":
                est = LinearRegression(featuresCol=fcol, labelCol=goal, regParam=reg,
                                       elasticNetParam=elastic, standardization=True)
            elif kind == "tree":
                est = DecisionTreeRegressor(featuresCol=fcol, labelCol=goal, seed=seed, maxDepth=5)
            elif kind == "forest":
                est = RandomForestRegressor(featuresCol=fcol, labelCol=goal, seed=seed, numTrees=20,
                                            maxDepth=5)
            elif kind == "gbt":
                est = GBTRegressor(featuresCol=fcol, labelCol=goal, seed=seed, maxIter=20, maxDepth=4)
            else:
                raise ValueError(kind)
            m = _fit_eval(train, test, est, fcol, goal,
                          {"model_key": key, "family": kind, "degree": degree})
            return cut_lineage(m)  # metrics are tiny; cut lineage before releasing the cache

        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            parts = list(pool.map(lambda kv: one(*kv), goals.items()))
        out = parts[0]
        for m in parts[1:]:
            out = out.unionByName(m)
        return out
    finally:
        data.unpersist()


# --------------------------------------------------------------------------
# dense network scoring
# --------------------------------------------------------------------------

def dense_weights(n_in: int, layers, seed: int = 0) -> list[tuple[np.ndarray, np.ndarray, str]]:
    """Given weights for a 64-32-3 style network (Glorot-uniform draws from
    a fixed seed; the reference trains them, we only score)."""
    rng = np.random.default_rng(seed)
    out = []
    prev = n_in
    for width, act in layers:
        lim = np.sqrt(6.0 / (prev + width))
        out.append((rng.uniform(-lim, lim, size=(prev, width)), np.zeros(width), act))
        prev = width
    return out


def _act(x: np.ndarray, act: str) -> np.ndarray:
    if act == "relu":
        return np.maximum(x, 0.0)
    if act == "elu":
        return np.where(x > 0, x, np.expm1(np.minimum(x, 0.0)))
    return x


def dense_forward(x: np.ndarray, weights) -> np.ndarray:
    h = x
    for w, b, act in weights:
        h = _act(h @ w + b, act)
    return h


def dense_score(df: DataFrame, features: list[str], keep: list[str], weights,
                out_names: list[str]) -> DataFrame:
    """Score every row with the network, batch by batch in Arrow."""
    schema = ", ".join([f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep] +
                       [f"`{o}` double" for o in out_names])
    feats = list(features)

    def score(batches):
        for pdf in batches:
            x = pdf[feats].to_numpy(dtype=np.float64)
            y = dense_forward(x, weights)
            res = pdf[keep].copy()
            for i, o in enumerate(out_names):
                res[o] = y[:, i]
            yield res

    return df.select(*keep, *feats).mapInPandas(score, schema)
