"""Regression trees and forests grown level by level (M8).

A level is one aggregate over all rows: the (weighted) count and sum of the
goal for every model, tree, node, feature and bin, added up on each executor
before the shuffle.  Running sums over a feature's bins give every split's gain

    sum_left^2 / n_left + sum_right^2 / n_right - sum^2 / n ,

and the best split of each node (ties: first feature, lowest bin) moves the
rows on.  Goals, trees and nodes of a level are groups of the same aggregate.
The model is a table of nodes; no more than models x trees x 2^depth rows of
it are ever joined to the data, and that bound is checked.

Features are cut into equal-width bins between their bounds on the fitting
rows, a constant feature into one.  A tree of a forest weighs each row by a
draw from a Poisson distribution of mean 1, read from a hash of (seed, tree,
row key), so that growing it again gives the same tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import SCALARS, attach_scalars
from ..session import cut_lineage
from .rows import hash32

#: nodes that may be joined to the rows by broadcast
MAX_NODES = 200_000
# cumulative Poisson(1) shares below 0, 1, 2, 3 draws (fixed values); 4 beyond
POISSON = (0.367879441171442, 0.735758882342885, 0.919698602928606, 0.981011843123846)

_NODE = ["model_key", "tree", "node"]


def poisson_draws(seed: int, tree: int, key: str) -> Column:
    """0 to 4 draws for the row ``key`` in ``tree``."""
    u = hash32(f"{seed}:{tree}", key).cast("double") / F.lit(4294967296.0)
    out = F.lit(4.0)
    for k in reversed(range(len(POISSON))):
        out = F.when(u < F.lit(POISSON[k]), F.lit(float(k))).otherwise(out)
    return out


def binned(df: DataFrame, fit_rows: DataFrame, features: list[str], bins: int) -> DataFrame:
    """``df`` with ``_bins``, the bin of every feature, and ``_edges``, the
    bounds of every feature on ``fit_rows``."""
    x, b = attach_scalars(df, fit_rows, {f"{p}{k}": fn(F.col(f).cast("double")) for k, f in enumerate(features)
                                         for p, fn in (("lo", F.min), ("hi", F.max))})
    cells = []
    for k, f in enumerate(features):
        lo, hi = b[f"lo{k}"], b[f"hi{k}"]
        place = F.floor((F.col(f).cast("double") - lo) / (hi - lo) * F.lit(float(bins)))
        cells.append(F.when(hi == lo, F.lit(0)).otherwise(F.greatest(F.lit(0), F.least(place, F.lit(bins - 1)))).cast("int"))
    edges = F.array(*[F.struct(b[f"lo{k}"].alias("lo"), b[f"hi{k}"].alias("hi")) for k in range(len(features))])
    return x.withColumn("_bins", F.array(*cells)).withColumn("_edges", edges).drop(SCALARS)


def _spread(rows: DataFrame, keep: list[str], goals: dict[str, str], trees: int, seed: int | None, key: str) -> DataFrame:
    """One row for each row, model and tree: ``keep, _bins, model_key, tree, node, y, w``."""
    cells = [F.struct(F.lit(mk).alias("model_key"), F.col(g).cast("double").alias("y")) for mk, g in goals.items()]
    draws = [F.named_struct(F.lit("tree"), F.lit(t), F.lit("w"), F.lit(1.0) if seed is None else poisson_draws(seed, t, key))
             for t in range(trees)]
    return (rows.select(*keep, "_bins", F.explode(F.array(*cells)).alias("_m"), F.array(*draws).alias("_d"))
            .select(*keep, "_bins", "_m.*", F.explode("_d").alias("_t"))
            .select(*keep, "_bins", "model_key", "y", "_t.*", F.lit(1).cast("long").alias("node")))


def _moved(rows: DataFrame, splits: DataFrame, how: str) -> DataFrame:
    """Rows with the child that their node's split sends them to; node k has the
    children 2k (bin up to the split's) and 2k + 1."""
    go = rows.join(F.broadcast(splits.select(*_NODE, F.col("feature_no").alias("_f"), F.col("bin").alias("_b"))), _NODE, how)
    right = (F.element_at("_bins", F.col("_f") + 1) > F.col("_b")).cast("long")
    return go.withColumn("node", F.coalesce(F.col("node") * 2 + right, F.col("node"))).drop("_f", "_b")


def grow(df: DataFrame, features: list[str], goals: dict[str, str], fit_filter: Column | str, depth: int = 4, bins: int = 32,
         least_rows: float = 5.0, trees: int = 1, seed: int | None = None, key: str = "row_id") -> DataFrame:
    """The model: ``model_key, tree, node, depth, n, mean, feature, feature_no,
    bin, threshold`` (the last four null in a leaf).  Rows with a missing
    feature or goal are left out.  ``seed`` None: one tree on all rows alike."""
    if len(goals) * trees * 2 ** depth > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} nodes would be joined to the rows")
    whole = df.dropna(subset=[*features, *goals.values()])
    fit_rows = whole.where(fit_filter)
    rows = _spread(binned(fit_rows, fit_rows, features, bins), [key], goals, trees, seed, key).where("w > 0")
    rows = cut_lineage(rows, "tree-rows")
    by = Window.partitionBy(*_NODE, "feature_no").orderBy("bin")
    known, levels = [], depth + 1
    for level in range(levels):
        if level == depth:
            known.append(rows.groupBy(*_NODE).agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("s"))
                         .select(*_NODE, F.lit(level).alias("depth"), "n", (F.col("s") / F.col("n")).alias("mean"),
                                 F.lit(None).cast("int").alias("feature_no"), F.lit(None).cast("int").alias("bin")))
            break
        counts = (rows.select(*_NODE, "y", "w", F.posexplode("_bins").alias("feature_no", "bin"))
                  .groupBy(*_NODE, "feature_no", "bin").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("s")))
        total = Window.partitionBy(*_NODE, "feature_no")
        run = counts.select(*_NODE, "feature_no", "bin", F.sum("n").over(by).alias("nl"), F.sum("s").over(by).alias("sl"),
                            F.sum("n").over(total).alias("n"), F.sum("s").over(total).alias("s"))
        nr, sr = F.col("n") - F.col("nl"), F.col("s") - F.col("sl")
        gain = F.when((F.col("nl") >= least_rows) & (nr >= least_rows), F.round(
            F.col("sl") * F.col("sl") / F.col("nl") + sr * sr / nr - F.col("s") * F.col("s") / F.col("n"), 6))
        best = run.withColumn("gain", gain).groupBy(*_NODE).agg(
            F.max_by(F.struct("feature_no", "bin"), F.when(F.col("gain") > 0, F.struct(
                "gain", (-F.col("feature_no")).alias("f"), (-F.col("bin")).alias("b")))).alias("split"),
            F.max(F.when(F.col("feature_no") == 0, F.col("n"))).alias("n"),
            F.max_by("s", F.when(F.col("feature_no") == 0, F.col("bin"))).alias("s"))
        level_nodes = cut_lineage(best.select(
            *_NODE, F.lit(level).alias("depth"), "n", (F.col("s") / F.col("n")).alias("mean"), "split.feature_no",
            "split.bin"), "tree-level")
        known.append(level_nodes)
        splits = level_nodes.where("bin is not null")
        rows = _moved(rows, splits, "inner")
    nodes = known[0]
    for part in known[1:]:
        nodes = nodes.unionByName(part)
    names = F.array(*[F.lit(f) for f in features])
    named, b = attach_scalars(nodes, fit_rows, {f"{p}{k}": fn(F.col(f).cast("double")) for k, f in enumerate(features)
                                                for p, fn in (("lo", F.min), ("hi", F.max))})
    lows, highs = (F.array(*[b[f"{p}{k}"] for k in range(len(features))]) for p in ("lo", "hi"))
    at = F.col("feature_no") + 1
    width = (F.element_at(highs, at) - F.element_at(lows, at)) / F.lit(float(bins))
    inner = F.col("bin").isNotNull()  # an array of literals gives an element even for a null place
    return cut_lineage(named.withColumn("feature", F.when(inner, F.element_at(names, at))).withColumn(
        "threshold", F.when(inner, F.element_at(lows, at) + (F.col("bin") + 1) * width)).drop(SCALARS), "tree-nodes")


def predict(df: DataFrame, nodes: DataFrame, features: list[str], goals: dict[str, str], fit_filter: Column | str,
            keep: list[str], bins: int = 32, out: str = "p") -> DataFrame:
    """``keep, model_key, y`` and the prediction, the mean of a model's trees,
    for every row and model; ``bins`` and ``fit_filter`` as when grown."""
    whole = df.dropna(subset=[*features, *goals.values()])
    shape = nodes.agg(F.max("depth"), F.max("tree"), F.count(F.lit(1))).first()
    depth, trees = shape[0] or 0, (shape[1] or 0) + 1
    if (shape[2] or 0) > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} nodes would be joined to the rows")
    rows = binned(whole, whole.where(fit_filter), features, bins).withColumn("_row", F.struct(*keep))
    rows = _spread(rows, ["_row"], goals, trees, None, keep[0])
    splits = nodes.where("bin is not null")
    for level in range(depth):
        rows = _moved(rows, splits.where(F.col("depth") == level), "left")
    ends = rows.join(F.broadcast(nodes.select(*_NODE, "mean")), _NODE)
    if trees > 1:
        ends = ends.groupBy("_row", "model_key", "y").agg(F.avg("mean").alias("mean"))
    return ends.select("_row.*", "model_key", "y", F.col("mean").alias(out))
