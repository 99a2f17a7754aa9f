"""Second-moment sums (Gram matrices, pairwise moments) per Arrow batch.

Each task adds up NumPy matrix products over all of its Arrow batches and
emits its partial sums once, one small long row per matrix entry (and
group); a grouped ``sum`` then adds the tasks.  The work splits with the
data and the shuffle carries only ``tasks x groups x terms^2`` numbers,
whatever the row count.  The alternative, one SQL
aggregate per matrix entry, gives plans of hundreds of aggregate functions
whose compilation dominates the run time.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _upper(g: np.ndarray):
    i, j = np.triu_indices(g.shape[0])
    return i, j, g[i, j]


def gram_parts(df: DataFrame, cols: list[str], by: list[str] | None = None,
               tags: list[str] | None = None) -> DataFrame:
    """Sum of t_i * t_j over rows, for terms t = [1, cols...], upper triangle.

    * ``by``: one Gram per group -> ``(by..., i, j, value)``.
    * ``tags``: several groupings of the same rows at once (e.g. the split
      band of each sweep iteration) -> ``(tag, tag_value, i, j, value)``.
    Rows with a missing term are left out."""
    by = list(by or [])
    tags = list(tags or [])
    cols = list(cols)
    complete = F.lit(True)
    for c in cols:
        complete = complete & F.col(c).isNotNull()
    x = df.where(complete).select(*by, *tags, *[F.col(c).cast("double").alias(f"_v{k}")
                                                for k, c in enumerate(cols)])
    vcols = [f"_v{k}" for k in range(len(cols))]

    if tags:
        schema = "tag int, tag_value long, i int, j int, value double"

        def run(batches):
            acc: dict[tuple[int, int], np.ndarray] = {}
            for pdf in batches:
                if pdf.empty:
                    continue
                X = np.column_stack([np.ones(len(pdf)), pdf[vcols].to_numpy(np.float64)])
                for t, tc in enumerate(tags):
                    keys = pdf[tc].to_numpy()
                    for key in np.unique(keys):
                        sub = X[keys == key]
                        g = sub.T @ sub
                        k = (t, int(key))
                        acc[k] = acc[k] + g if k in acc else g
            out = []
            for (t, key), g in acc.items():
                i, j, v = _upper(g)
                out.append(pd.DataFrame({"tag": t, "tag_value": key, "i": i, "j": j, "value": v}))
            if out:
                yield pd.concat(out, ignore_index=True)

        parts = x.mapInPandas(run, schema)
        return parts.groupBy("tag", "tag_value", "i", "j").agg(F.sum("value").alias("value"))

    types = {f.name: f.dataType.simpleString() for f in x.schema.fields}
    schema = ", ".join([f"`{b}` {types[b]}" for b in by] + ["i int", "j int", "value double"])

    def run_by(batches):
        acc: dict[tuple, np.ndarray] = {}
        for pdf in batches:
            if pdf.empty:
                continue
            groups = pdf.groupby(by, dropna=False, sort=False) if by else [((), pdf)]
            for key, g in groups:
                X = np.column_stack([np.ones(len(g)), g[vcols].to_numpy(np.float64)])
                key = key if isinstance(key, tuple) else (key,)
                m = X.T @ X
                acc[key] = acc[key] + m if key in acc else m
        out = []
        for key, m in acc.items():
            i, j, v = _upper(m)
            part = pd.DataFrame({"i": i, "j": j, "value": v})
            for b, kv in zip(by, key):
                part.insert(0, b, kv)
            out.append(part)
        if out:
            yield pd.concat(out, ignore_index=True)[by + ["i", "j", "value"]]

    parts = x.mapInPandas(run_by, schema)
    return parts.groupBy(*by, "i", "j").agg(F.sum("value").alias("value"))


def pairwise_moments(df: DataFrame, cols: list[str], pairs: list[tuple[str, str]]) -> DataFrame:
    """Per column pair, over the rows where both are present: ``(col_a, col_b,
    n, ma, mb, maa, mbb, mab, lo_a, hi_a, lo_b, hi_b)``, m being sums of
    squared (and mixed) deviations from the pair's means, lo and hi bounds.

    Tasks take deviations from each batch's own means and merge batches by the
    parallel update; the tasks' parts (one row per pair) are merged the same
    way against the pair's overall means."""
    cols = list(cols)
    idx = {c: k for k, c in enumerate(cols)}
    pa = np.array([idx[a] for a, _ in pairs])
    pb = np.array([idx[b] for _, b in pairs])
    names_a = [a for a, _ in pairs]
    names_b = [b for _, b in pairs]
    x = df.select(*[F.col(c).cast("double").alias(f"_v{k}") for k, c in enumerate(cols)])
    vcols = [f"_v{k}" for k in range(len(cols))]
    names = ["n", "ma", "mb", "maa", "mbb", "mab", "lo_a", "hi_a", "lo_b", "hi_b"]
    schema = "col_a string, col_b string, " + ", ".join(f"{c} double" for c in names)

    def of_batch(v):
        m = ~np.isnan(v)
        w = m.astype(np.float64)
        shift = np.where(m.any(0), np.where(m, v, 0.0).sum(0) / np.maximum(w.sum(0), 1), 0.0)
        d = np.where(m, v - shift, 0.0)
        n = (w.T @ w)[pa, pb]
        k = np.maximum(n, 1)
        sa, sb = (d.T @ w)[pa, pb], (d.T @ w)[pb, pa]
        saa, sbb = ((d * d).T @ w)[pa, pb], ((d * d).T @ w)[pb, pa]
        sab = (d.T @ d)[pa, pb]
        low = np.where(m, v, np.inf)
        high = np.where(m, v, -np.inf)
        out = [n, shift[pa] + sa / k, shift[pb] + sb / k, saa - sa * sa / k, sbb - sb * sb / k, sab - sa * sb / k]
        bounds = []
        for i, j in ((pa, pb), (pb, pa)):  # of a over the rows that have b, and the other way round
            lo, hi = np.empty(len(i)), np.empty(len(i))
            for other in np.unique(j):
                here = np.flatnonzero(j == other)
                rows = m[:, other]
                lo[here] = low[rows].min(0, initial=np.inf)[i[here]]
                hi[here] = high[rows].max(0, initial=-np.inf)[i[here]]
            bounds += [lo, hi]
        return [*out, *bounds]

    def merged(s, t):
        n = s[0] + t[0]
        k = np.maximum(n, 1)
        da, db, f = t[1] - s[1], t[2] - s[2], s[0] * t[0] / k
        da, db = np.where(s[0] * t[0] > 0, da, 0.0), np.where(s[0] * t[0] > 0, db, 0.0)
        return [n, (s[1] * s[0] + t[1] * t[0]) / k, (s[2] * s[0] + t[2] * t[0]) / k,
                s[3] + t[3] + da * da * f, s[4] + t[4] + db * db * f, s[5] + t[5] + da * db * f,
                np.minimum(s[6], t[6]), np.maximum(s[7], t[7]), np.minimum(s[8], t[8]), np.maximum(s[9], t[9])]

    def run(batches):
        acc = None
        for pdf in batches:
            if pdf.empty:
                continue
            part = of_batch(pdf[vcols].to_numpy(np.float64))
            acc = part if acc is None else merged(acc, part)
        if acc is not None:
            yield pd.DataFrame({"col_a": names_a, "col_b": names_b, **dict(zip(names, acc))})

    pair = Window.partitionBy("col_a", "col_b")  # one row per task
    n = F.col("n")
    parts = x.mapInPandas(run, schema)
    total = F.greatest(F.sum(n).over(pair), F.lit(1.0))
    about = parts.withColumns({"ga": F.sum(F.col("ma") * n).over(pair) / total,
                               "gb": F.sum(F.col("mb") * n).over(pair) / total})
    da, db = F.col("ma") - F.col("ga"), F.col("mb") - F.col("gb")
    return about.groupBy("col_a", "col_b").agg(
        F.sum("n").alias("n"), F.first("ga").alias("ma"), F.first("gb").alias("mb"),
        F.sum(F.col("maa") + n * da * da).alias("maa"), F.sum(F.col("mbb") + n * db * db).alias("mbb"),
        F.sum(F.col("mab") + n * da * db).alias("mab"),
        F.min("lo_a").alias("lo_a"), F.max("hi_a").alias("hi_a"), F.min("lo_b").alias("lo_b"), F.max("hi_b").alias("hi_b"))
