"""Least squares with thousands of terms: tiled Gram sums and a block Cholesky.

The terms are cut into blocks of ``TILE``; a tile (i, j), i >= j, holds the
products of block i with block j, and block row B the products with the goals.

* *Sums.*  One branch for each block column j scans the (narrow) rows, makes
  the terms batch by batch and adds up that column's tiles, so a task holds
  ``TILE`` x terms numbers at most, never the whole matrix.  The tasks' tiles
  are added in two levels.
* *Solve.*  Block column k is factorised in one task, then every other tile
  (i, j) meets the tiles (i, k) and (j, k) by joins and is updated on its own.
  The goals' block row goes along, which is the forward substitution; the
  backward one takes a block column a step.  Only coefficients (terms x goals)
  reach the driver.
* *Ridge.*  ``ridge`` times the mean of the diagonal is added to it: with more
  terms than rows, or dependent ones, the fit is the least-norm one up to that
  shift, and with many rows it changes nothing that the digits show.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .tall_qr import METRIC_SCHEMA, Term, design, poly_combos, scaled_to_unit, term_name

TILE = 512
#: rows whose terms a task makes at a time
BATCH = 1024
#: first level of the sums of tiles
SALTS = 16
RIDGE = 1e-8

_TILE = "i int, j int, data binary"


def _matrix(data: bytes, cols: int) -> np.ndarray:
    return np.frombuffer(data).reshape(-1, cols)


class Blocks:
    """Terms cut into blocks; block ``count`` stands for the goals."""

    def __init__(self, terms: list[Term], goals: int, tile: int = TILE):
        self.terms, self.goals, self.tile = terms, goals, tile
        self.parts = [terms[at:at + tile] for at in range(0, len(terms), tile)]
        self.count = len(self.parts)

    def width(self, j: int) -> int:
        return len(self.parts[j])


def gram_tiles(rows: DataFrame, blocks: Blocks, features: int) -> DataFrame:
    """``i, j, data`` for i >= j over ``rows`` (_x0.., _y0..)."""
    xs, ys = [f"_x{k}" for k in range(features)], [f"_y{k}" for k in range(blocks.goals)]
    rows = rows.select(*xs, *ys).dropna()

    def column(j: int):
        def run(batches):
            sums: dict[int, np.ndarray] = {}
            for pdf in batches:
                for at in range(0, len(pdf), BATCH):
                    some = pdf.iloc[at:at + BATCH]
                    x = some[xs].to_numpy(np.float64)
                    left = design(x, blocks.parts[j])
                    for i in range(j, blocks.count + 1):
                        other = (some[ys].to_numpy(np.float64) if i == blocks.count
                                 else left if i == j else design(x, blocks.parts[i]))
                        g = other.T @ left
                        sums[i] = sums[i] + g if i in sums else g
            part = TaskContext.get().partitionId()
            for i, g in sums.items():
                yield pd.DataFrame({"i": [i], "j": [j], "part": [part], "data": [g.tobytes()]})
        return rows.mapInPandas(run, "i int, j int, part long, data binary")

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = reduce(np.add, (np.frombuffer(d) for d in pdf["data"]))
        return pd.DataFrame({"i": [pdf["i"].iloc[0]], "j": [pdf["j"].iloc[0]], "data": [total.tobytes()]})

    every = reduce(DataFrame.unionByName, [column(j) for j in range(blocks.count)])
    some = every.groupBy("i", "j", (F.col("part") % SALTS).alias("part")).applyInPandas(add, _TILE)
    return some.groupBy("i", "j").applyInPandas(add, _TILE)


def tile_sums(tiles: DataFrame, blocks: Blocks) -> DataFrame:
    """``term, sum_sq, row_sum, xy0..``: the matrix seen term by term, every
    tile having a part in it: diagonal, row sums and products with the goals."""
    names = [term_name(t) for t in blocks.terms]

    def run(batches):
        for pdf in batches:
            for i, j, data in zip(pdf["i"], pdf["j"], pdf["data"]):
                g = _matrix(data, blocks.width(j))
                here = names[j * blocks.tile:j * blocks.tile + g.shape[1]]
                if i == blocks.count:
                    for k in range(len(g)):
                        yield pd.DataFrame({"term": here, "kind": f"xy{k}", "value": g[k]})
                    continue
                yield pd.DataFrame({"term": here, "kind": "row_sum", "value": g.sum(0)})
                if i == j:
                    yield pd.DataFrame({"term": here, "kind": "sum_sq", "value": np.diag(g)})
                else:
                    below = names[i * blocks.tile:i * blocks.tile + len(g)]
                    yield pd.DataFrame({"term": below, "kind": "row_sum", "value": g.sum(1)})

    kinds = ["sum_sq", "row_sum", *[f"xy{k}" for k in range(blocks.goals)]]
    long = tiles.mapInPandas(run, "term string, kind string, value double")
    return long.groupBy("term").agg(*[F.sum(F.when(F.col("kind") == k, F.col("value"))).alias(k) for k in kinds])


def _factor_panel(blocks: Blocks, ridge: float):
    def factor(pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(pdf["j"].iloc[0])
        w = blocks.width(k)
        by = {int(i): _matrix(d, w) for i, d in zip(pdf["i"], pdf["data"])}
        low = np.linalg.cholesky(by[k] + ridge * np.eye(w))
        out = [(i, k, (low if i == k else np.linalg.solve(low, g.T).T.copy()).tobytes()) for i, g in by.items()]
        return pd.DataFrame(out, columns=["i", "j", "data"])
    return factor


def _update(blocks: Blocks, k: int):
    w = blocks.width(k)

    def update(batches):
        for pdf in batches:
            out = [(i, j, (_matrix(d, blocks.width(j)) - _matrix(a, w) @ _matrix(b, w).T).tobytes())
                   for i, j, d, a, b in zip(pdf["i"], pdf["j"], pdf["data"], pdf["a"], pdf["b"])]
            yield pd.DataFrame(out, columns=["i", "j", "data"])
    return update


def _solve_panel(blocks: Blocks, known: dict[int, np.ndarray]):
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        k = int(pdf["j"].iloc[0])
        by = {int(i): _matrix(d, blocks.width(k)) for i, d in zip(pdf["i"], pdf["data"])}
        right = by[blocks.count].T - sum((by[i].T @ w for i, w in known.items()), np.zeros((blocks.width(k), blocks.goals)))
        return pd.DataFrame({"i": [k], "j": [k], "data": [np.linalg.solve(by[k].T, right).copy().tobytes()]})
    return solve


def solve_tiles(tiles: DataFrame, blocks: Blocks, ridge: float = RIDGE) -> np.ndarray:
    """Coefficients (terms x goals) of the normal equations held as tiles."""
    tiles = cut_lineage(tiles, "gram-tiles")

    def traces(batches):
        for pdf in batches:
            yield pd.DataFrame({"t": [np.trace(_matrix(d, blocks.width(j))) for j, d in zip(pdf["j"], pdf["data"])]})

    total = tiles.where("i = j").mapInPandas(traces, "t double").agg(F.sum("t")).first()[0]
    shift = ridge * (total or 0.0) / max(1, len(blocks.terms))
    panels = []
    for k in range(blocks.count):
        panel = cut_lineage(tiles.where(F.col("j") == k).groupBy("j").applyInPandas(
            _factor_panel(blocks, shift), _TILE), "gram-panel")
        panels.append(panel)
        if k + 1 < blocks.count:
            a = panel.select("i", F.col("data").alias("a"))
            b = panel.select(F.col("i").alias("j"), F.col("data").alias("b"))
            tiles = cut_lineage(tiles.where(F.col("j") > k).join(a, "i").join(b, "j").select("i", "j", "data", "a", "b")
                                .mapInPandas(_update(blocks, k), _TILE), "gram-tiles")
    known: dict[int, np.ndarray] = {}
    for k in reversed(range(blocks.count)):
        row = panels[k].groupBy("j").applyInPandas(_solve_panel(blocks, dict(known)), _TILE).first()
        known[k] = _matrix(bytes(row["data"]), blocks.goals)
    return np.vstack([known[k] for k in range(blocks.count)])


def poly_blocks(features: int, degree: int, goals: int, tile: int = TILE) -> Blocks:
    """Blocks of all terms up to ``degree``, the constant first."""
    return Blocks([(), *poly_combos(features, degree)], goals, tile)


def poly_family_tiled(df: DataFrame, split_col: str, features: list[str], goals: dict[str, str], degree: int,
                      tile: int = TILE, ridge: float = RIDGE) -> DataFrame:
    """M7: as ``tall_qr.poly_family`` for any number of terms."""
    names = list(dict.fromkeys(goals.values()))
    x = cut_lineage(scaled_to_unit(df, features, [
        F.col(split_col).alias("_split"), *[F.col(g).cast("double").alias(f"_y{k}") for k, g in enumerate(names)]]),
        "poly-rows")
    blocks = poly_blocks(len(features), degree, len(names), tile)
    train = x.where(F.col("_split") == "train")
    if train.isEmpty():
        return df.sparkSession.createDataFrame([], METRIC_SCHEMA)
    w = solve_tiles(gram_tiles(train, blocks, len(features)), blocks, ridge)
    xs, ys = [f"_x{k}" for k in range(len(features))], [f"_y{k}" for k in range(len(names))]
    keys = [(mk, names.index(g)) for mk, g in goals.items()]

    def score(batches):
        for pdf in batches:
            for at in range(0, len(pdf), BATCH):
                for s, g in pdf.iloc[at:at + BATCH].groupby("_split", sort=False):
                    v, y = g[xs].to_numpy(np.float64), g[ys].to_numpy(np.float64)
                    off = y.copy()
                    for j, part in enumerate(blocks.parts):
                        off -= design(v, part) @ w[j * blocks.tile:j * blocks.tile + len(part)]
                    mean = y.mean(0)
                    yield pd.DataFrame([(mk, s, len(y), float(off[:, k] @ off[:, k]), float(mean[k]),
                                         float(((y[:, k] - mean[k]) ** 2).sum())) for mk, k in keys],
                                       columns=["model_key", "split", "m", "sse", "mean", "spread"])

    sums = (x.dropna().mapInPandas(score, "model_key string, split string, m long, sse double, mean double, spread double")
            .groupBy("model_key", "split").agg(
                F.sum("m").alias("n"), F.sum("sse").alias("sse"),
                (F.sum("spread") + F.sum(F.col("m") * F.col("mean") * F.col("mean"))
                 - F.pow(F.sum(F.col("m") * F.col("mean")), 2) / F.sum("m")).alias("sst")))
    mse = F.col("sse") / F.col("n")
    r2 = F.when(F.col("sst") <= 0, F.when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(
        1 - F.col("sse") / F.col("sst"))
    return sums.select("model_key", F.lit("ols").alias("family"), F.lit(degree).alias("degree"), "split", "n",
                       mse.alias("mse"), F.sqrt(mse).alias("rmse"), r2.alias("r2"))
