"""Least squares by a tall-skinny QR (M1, M6, M7).

The rows ``[1, x, y]`` are factorised, not multiplied: each task keeps the
triangular factor R of the rows it has seen (new rows are stacked below R and
factorised again), and the tasks' factors are merged ``FAN`` at a time, level
by level.  R holds all that least squares needs, without the squared condition
number of Gram sums, so nearly collinear columns and polynomial terms keep
their digits.  A factor has (columns)^2 numbers, whatever the row count.

With the ones in front, the rows of R below the first one belong to the
centred columns: they give the slopes (least-norm where columns depend on each
other), and the factor of any other set of rows gives that set's errors and
spread, so one scan serves fitting and scoring.

Polynomials are written in Legendre polynomials of the features scaled to
-1..1: products of total degree up to d span the same space as the monomials,
with columns far from collinear.
"""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import SCALARS, with_scalars
from ..session import cut_lineage
from .linear import MODEL_SCHEMA, r2_from

#: factors merged at a time
FAN = 16
#: rows that a task factorises at a time
BATCH = 4096

Term = tuple[int, ...]  # feature numbers, one for each degree

METRIC_SCHEMA = "model_key string, family string, degree int, split string, n long, mse double, rmse double, r2 double"


def poly_combos(features: int, degree: int) -> list[Term]:
    """All products of total degree 1..``degree``, by degree."""
    return [c for d in range(1, degree + 1) for c in combinations_with_replacement(range(features), d)]


def term_name(term: Term) -> str:
    return "t_" + "_".join(map(str, term)) if term else "t_bias"


def design(x: np.ndarray, terms: list[Term]) -> np.ndarray:
    """Columns of ``terms`` as products of Legendre polynomials, a feature that
    occurs e times as the polynomial of degree e."""
    top = max((len(t) for t in terms), default=0)
    p = [np.ones_like(x), x]
    for n in range(1, top):
        p.append(((2 * n + 1) * x * p[n] - n * p[n - 1]) / (n + 1))
    out = np.empty((len(x), len(terms)))
    for k, t in enumerate(terms):
        col = 1.0
        for f in sorted(set(t)):
            col = col * p[t.count(f)][:, f]
        out[:, k] = col
    return out


def scaled_to_unit(df: DataFrame, features: list[str], keep: list[Column]) -> DataFrame:
    """``keep`` and ``_x0.._xn``: the features scaled to -1..1 over all rows, a
    constant one to 0."""
    base, b = with_scalars(df, {f"{p}{k}": fn(F.col(f).cast("double")) for k, f in enumerate(features)
                                for p, fn in (("lo", F.min), ("hi", F.max))})
    cols = []
    for k, f in enumerate(features):
        lo, hi = b[f"lo{k}"], b[f"hi{k}"]
        cols.append(F.when(hi == lo, F.when(F.col(f).isNotNull(), F.lit(0.0)))
                    .otherwise(2 * (F.col(f).cast("double") - lo) / (hi - lo) - 1).alias(f"_x{k}"))
    return base.select(*keep, *cols).drop(SCALARS)


def _merged(blocks: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(blocks), mode="r")


_FACTOR = "`_by` string, part long, n long, r binary"


def qr_factors(df: DataFrame, x_cols: list[str], y_cols: list[str], by: Column,
               terms: list[Term] | None = None) -> DataFrame:
    """``_by, n, r``: row count and factor of ``[1, x, y]`` (``terms`` of x, if
    given) for each value of ``by``; rows with a missing value are left out."""
    width = 1 + len(terms if terms is not None else x_cols) + len(y_cols)
    cols = [f"_v{k}" for k in range(len(x_cols) + len(y_cols))]
    nx = len(x_cols)
    rows = (df.select(by.cast("string").alias("_by"),
                      *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(v)
                        for c, v in zip([*x_cols, *y_cols], cols)]).dropna(subset=["_by", *cols]))

    def factorise(batches):
        seen: dict[str, tuple[int, np.ndarray]] = {}
        for pdf in batches:
            for at in range(0, len(pdf), BATCH):
                some = pdf.iloc[at:at + BATCH]
                for key, g in some.groupby("_by", sort=False):
                    v = g[cols].to_numpy(np.float64)
                    x = v[:, :nx] if terms is None else design(v[:, :nx], terms)
                    block = np.hstack([np.ones((len(v), 1)), x, v[:, nx:]])
                    n, r = seen.get(key, (0, np.zeros((0, width))))
                    seen[key] = n + len(v), _merged([r, block])
        part = TaskContext.get().partitionId()
        if seen:
            yield pd.DataFrame([(k, part, n, r.tobytes()) for k, (n, r) in seen.items()],
                               columns=["_by", "part", "n", "r"])

    def merge(key, pdf):
        blocks = [np.frombuffer(r).reshape(-1, width) for r in pdf["r"]]
        return pd.DataFrame([(key[0], key[1], int(pdf["n"].sum()), _merged(blocks).tobytes())],
                            columns=["_by", "part", "n", "r"])

    parts = cut_lineage(rows.mapInPandas(factorise, _FACTOR), "qr-factors")
    last = parts.agg(F.max("part")).first()[0] or 0
    while True:
        parts = (parts.withColumn("part", F.floor(F.col("part") / FAN)).groupBy("_by", "part")
                 .applyInPandas(merge, _FACTOR))
        last //= FAN
        if not last:
            return parts.select("_by", "n", "r")


def solve_factor(r: np.ndarray, n: int, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Intercepts (one a goal) and slopes (p x goals) from the factor of [1, x, y]."""
    b, *_ = np.linalg.lstsq(r[1:, 1:p + 1], r[1:, p + 1:], rcond=np.finfo(float).eps * max(n, p))
    return (r[0, p + 1:] - r[0, 1:p + 1] @ b) / r[0, 0], b


def qr_models(df: DataFrame, features: list[str], goals: dict[str, str], fit_filter=None) -> DataFrame:
    """M1: coefficients of one least-squares model per goal (model_key, term,
    coef), as ``linear.ols_models``, by QR."""
    rows = df.where(fit_filter) if fit_filter is not None else df
    p, keys, feats = len(features), list(goals), list(features)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        r = np.frombuffer(pdf["r"].iloc[0]).reshape(-1, 1 + p + len(keys))
        a, b = solve_factor(r, int(pdf["n"].iloc[0]), p)
        return pd.DataFrame([(mk, t, float(c)) for k, mk in enumerate(keys)
                             for t, c in [("intercept", a[k]), *zip(feats, b[:, k])]],
                            columns=["model_key", "term", "coef"])

    return qr_factors(rows, feats, list(goals.values()), F.lit("all")).groupBy("_by").applyInPandas(fit, MODEL_SCHEMA)


def poly_family(df: DataFrame, split_col: str, features: list[str], goals: dict[str, str],
                degree: int) -> DataFrame:
    """M6/M7: polynomial least squares of all goals, fitted on the rows whose
    ``split_col`` is ``train``; metrics on every split from the factors."""
    names = list(dict.fromkeys(goals.values()))
    x = scaled_to_unit(df, features, [F.col(split_col).alias("_split"),
                                      *[F.col(g).cast("double").alias(f"_y{k}") for k, g in enumerate(names)]])
    terms = poly_combos(len(features), degree)
    factors = qr_factors(x, [f"_x{k}" for k in range(len(features))], [f"_y{k}" for k in range(len(names))],
                         F.col("_split"), terms)
    p, where = len(terms), {mk: names.index(g) for mk, g in goals.items()}

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        by = {s: (int(n), np.frombuffer(r).reshape(-1, 1 + p + len(names)))
              for s, n, r in zip(pdf["_by"], pdf["n"], pdf["r"])}
        out = []
        if "train" in by:
            a, b = solve_factor(by["train"][1], by["train"][0], p)
            for s, (n, r) in by.items():
                for mk, k in where.items():
                    off = r[:, p + 1 + k] - r[:, 0] * a[k] - r[:, 1:p + 1] @ b[:, k]
                    sse, sst = float(off @ off), float(r[1:, p + 1 + k] @ r[1:, p + 1 + k])
                    out.append((mk, "ols", degree, s, n, sse / n, math.sqrt(sse / n), r2_from(sse, sst)))
        return pd.DataFrame(out, columns=["model_key", "family", "degree", "split", "n", "mse", "rmse", "r2"])

    return factors.withColumn("_one", F.lit(0)).groupBy("_one").applyInPandas(fit, METRIC_SCHEMA)
