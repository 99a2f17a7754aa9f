"""Statistics.

Correlations are one pass: per-batch pairwise moment sums, added up by a
grouped sum (one row per column pair).  Histograms use scalar-subquery bounds and one grouped count.
The exact quantile is found by radix selection (``operators/radix``).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.moments import pairwise_moments
from ..functions.scalars import attach_scalars, with_scalars
from .radix import exact_quantiles


def corr_long(df: DataFrame, left: list[str], right: list[str] | None = None,
              upper_only: bool = True) -> DataFrame:
    """A1/A2: pairwise Pearson correlation as ``(col_a, col_b, corr, n_pairs)``,
    each pair over the rows where both are present (pandas' rule).

    With ``right=None`` all pairs a <= b of ``left`` (A1); otherwise
    ``left x right`` (A2, the matrix cut to the goal columns).  One
    scan: the pairs' moments are taken about the means of each batch and merged
    (``functions/moments``), so no digits are lost to a column's offset.  A
    column that is constant over a pair's rows gives null; a correlation is
    never outside -1 to 1."""
    if right is None:
        pairs = [(a, b) for i, a in enumerate(left) for b in left[i if upper_only else 0:]]
    else:
        pairs = [(a, b) for a in left for b in right]
    cols = list(dict.fromkeys([c for p in pairs for c in p]))
    m = pairwise_moments(df, cols, pairs)
    ok = (F.col("lo_a") < F.col("hi_a")) & (F.col("lo_b") < F.col("hi_b")) & (F.col("maa") > 0) & (F.col("mbb") > 0)
    r = F.col("mab") / (F.sqrt("maa") * F.sqrt("mbb"))
    return m.select("col_a", "col_b", F.when(ok, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("corr"),
                    F.col("n").cast("long").alias("n_pairs"))


def histogram(df: DataFrame, cols: list[str], bins: int = 100) -> DataFrame:
    """A3: equal-width bins between each column's min and max, the maximum
    in the last bin, empty bins included; long form
    ``(column_name, bin, lo, hi, n)``.  Nulls and NaN are missing."""
    df = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    aggs = {f"{p}_{c}": (F.min(c) if p == "lo" else F.max(c)) for c in cols for p in ("lo", "hi")}
    x, bounds = with_scalars(df, aggs)
    # one pass: every row contributes one (column, bin) cell per column
    cells = []
    for c in cols:
        lo, hi = bounds[f"lo_{c}"], bounds[f"hi_{c}"]
        width = (hi - lo) / F.lit(float(bins))
        b = F.when(hi == lo, F.lit(0)).otherwise(
            F.least(F.floor((F.col(c) - lo) / width), F.lit(bins - 1))).cast("int")
        cells.append(F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("column_name"), b.alias("bin"))))
    counted = (x.select(F.explode(F.array(*cells)).alias("x")).where(F.col("x").isNotNull())
               .groupBy("x.column_name", "x.bin").agg(F.count(F.lit(1)).alias("n")))
    # all (column, bin) cells, so empty bins appear with n = 0
    grid = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string") \
        .select("column_name", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out, bounds = attach_scalars(grid.join(counted, ["column_name", "bin"], "left"), df, aggs)
    los = F.lit(None).cast("double")
    his = F.lit(None).cast("double")
    for c in cols:
        lo, hi = bounds[f"lo_{c}"], bounds[f"hi_{c}"]
        width = (hi - lo) / F.lit(float(bins))
        los = F.when(F.col("column_name") == c, lo + F.col("bin") * width).otherwise(los)
        his = F.when(F.col("column_name") == c, lo + (F.col("bin") + 1) * width).otherwise(his)
    return out.select("column_name", "bin", los.alias("lo"), his.alias("hi"),
                      F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"))


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """Linear-interpolated quantile of a column, null and NaN left out, by
    radix selection (``operators/radix``): four passes whatever the values."""
    row = exact_quantiles(df, col, [q]).first()
    return None if row is None else row["value"]


def group_mean(df: DataFrame, by: list[str], cols: dict[str, str]) -> DataFrame:
    """A4/A5: mean of each column per group, renamed ``{out: src}``."""
    return df.groupBy(*by).agg(*[F.avg(src).alias(out) for out, src in cols.items()])


def arg_min(df: DataFrame, value: str, ret: str, tie: list[str]) -> DataFrame:
    """``ret`` of the row with the smallest ``value``; ties broken by
    ``tie`` in order (first in that order wins).  One aggregate row."""
    key = F.struct(F.col(value), *[F.col(t) for t in tie])
    return df.agg(F.min_by(F.col(ret), key).alias(ret), F.min(value).alias(value))


def goal_series_long(df: DataFrame, date_col: str, goal_cols: list[str],
                     targets: tuple[str, ...] = DEFAULT.targets) -> DataFrame:
    """E9 + P11: goals to long form with target and horizon parsed from the
    label ``{series}_{target}_future_{k}Day``; series and target may both
    contain '_', so the label is matched on the configured targets."""
    long = df.unpivot([date_col], goal_cols, "goal", "value")
    known = "|".join(re.escape(t) for t in sorted(targets, key=len, reverse=True))
    pat = rf"^(.+?)_({known})_future_([0-9]+)Day$"
    return long.select(date_col, "goal",
                       F.regexp_extract("goal", pat, 2).alias("target"),
                       F.regexp_extract("goal", pat, 3).cast("int").alias("horizon"),
                       "value")
