"""Gap filling and scaling."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FILL_DECAY, FILL_RADIUS
from ..functions.scalars import free_prefix, with_scalars
from .series_window import Ordering, neighbours, shift_rows


def interpolate_linear(df: DataFrame, cols: list[str], o: Ordering) -> DataFrame:
    """Linear interpolation with equal spacing by row, per series.

    Interior gaps lie on the line between the nearest non-missing rows;
    a leading gap stays missing; a trailing gap repeats the last value.
    """
    lead = free_prefix(df)
    name = {(c, k): f"{lead}{k}_{i}" for i, c in enumerate(cols) for k in ("pv", "pp", "nv", "np")}
    x = neighbours(df, cols, o, pos_name=f"{lead}at", names=name)
    out = {}
    for c in cols:
        pv, pp, nv, np_ = (F.col(name[c, k]) for k in ("pv", "pp", "nv", "np"))
        pos = F.col(f"{lead}at")
        out[c] = (F.when(F.col(c).isNotNull(), F.col(c))
                  .when(pv.isNull(), F.lit(None).cast("double"))
                  .when(nv.isNull(), pv)
                  .otherwise(pv + (nv - pv) * (pos - pp).cast("double") / (np_ - pp).cast("double")))
    return x.withColumns(out).drop(f"{lead}at", *name.values())


def local_weighted_fill(df: DataFrame, cols: list[str], o: Ordering,
                        radius: int = FILL_RADIUS, decay: float = FILL_DECAY) -> DataFrame:
    """A missing cell gets the weighted mean of the non-missing cells
    within ``radius`` rows of the same series, weight ``exp(-decay*d)``.
    No neighbour present -> stays missing.  No frames, no UDF: 2*radius
    shifted copies and one arithmetic expression."""
    lead = free_prefix(df)
    name = {(c, k): f"{lead}{i}_{k + radius}" for i, c in enumerate(cols) for k in range(-radius, radius + 1)}
    specs = [(name[c, k], c, k) for c in cols for k in range(-radius, radius + 1) if k != 0]
    x = shift_rows(df, specs, o)
    out = {}
    for c in cols:
        num: Column = F.lit(0.0)
        den: Column = F.lit(0.0)
        for k in range(-radius, radius + 1):
            if k == 0:
                continue
            v = F.col(name[c, k])
            w = math.exp(-decay * abs(k))
            num = num + F.coalesce(v * F.lit(w), F.lit(0.0))
            den = den + F.when(v.isNotNull(), F.lit(w)).otherwise(F.lit(0.0))
        out[c] = F.when(F.col(c).isNotNull(), F.col(c)).otherwise(
            F.when(den > 0, num / den))
    return x.withColumns(out).drop(*[s[0] for s in specs])


def mean_impute(df: DataFrame, cols: list[str], by: list[str] | None = None) -> DataFrame:
    """Missing -> mean of the column (per group ``by`` if given).

    Without ``by`` the means are one scalar subquery.  With ``by`` they are
    a grouped aggregate (partial aggregation before the shuffle, one row per
    group) joined back on the group keys: AQE broadcasts it when small and
    splits a hot group's partition when the join stays a shuffle join, so no
    single task holds a whole large group."""
    lead = free_prefix(df)
    if by:
        key, mean = f"{lead}key", {c: f"{lead}{i}" for i, c in enumerate(cols)}
        keyed = df.withColumn(key, F.struct(*[F.col(c) for c in by]))  # a struct of nulls equals its like
        means = keyed.groupBy(key).agg(*[F.avg(c).alias(mean[c]) for c in cols])
        x = keyed.join(means, key, "left")
        return x.withColumns({c: F.coalesce(F.col(c), F.col(mean[c])) for c in cols}).select(*[
            F.col(f"`{c}`") for c in df.columns])
    x, means = with_scalars(df, {c: F.avg(c) for c in cols}, f"{lead}s")
    return x.withColumns({c: F.coalesce(F.col(c), means[c]) for c in cols}).drop(f"{lead}s")


def sentinel_mean_impute(df: DataFrame, cols: list[str], sentinel: float = -999.0) -> DataFrame:
    """Sentinel -> column mean taken without the sentinels (A8 inside)."""
    name = f"{free_prefix(df)}s"
    x, means = with_scalars(df, {c: F.avg(F.when(F.col(c) != F.lit(sentinel), F.col(c))) for c in cols}, name)
    return x.withColumns({c: F.when(F.col(c) == F.lit(sentinel), means[c]).otherwise(F.col(c))
                          for c in cols}).drop(name)


def minmax_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """(x - min) / (max - min); a constant column becomes 0."""
    name = f"{free_prefix(df)}s"
    x, mm = with_scalars(df, {f"{p}_{c}": (F.min(c) if p == "lo" else F.max(c))
                              for c in cols for p in ("lo", "hi")}, name)
    out = {}
    for c in cols:
        lo, hi = mm[f"lo_{c}"], mm[f"hi_{c}"]
        out[c] = F.when(hi == lo, F.when(F.col(c).isNotNull(), F.lit(0.0))).otherwise(
            (F.col(c) - lo) / (hi - lo))
    return x.withColumns(out).drop(name)


# --------------------------------------------------------------------------
# Head-weighted fill (what the older notebook's cell loop computes)
# --------------------------------------------------------------------------

def _weighted(values: Column, distances: Column, m: Column, decay: float) -> Column:
    """Mean of the first ``m`` values, the k-th weighted by the (m - 1 - k)-th distance."""
    w = F.transform(F.reverse(F.slice(distances, F.lit(1), m)), lambda d: F.exp(-decay * d))
    add = (F.lit(0.0), lambda s, v: s + v)
    return (F.aggregate(F.zip_with(F.slice(values, F.lit(1), m), w, lambda v, x: v * x), *add) / F.aggregate(w, *add))


def _filled_head(head: Column, firsts: Column, present: Column, n: Column, radius: int, decay: float,
                 sentinel: float) -> Column:
    """Rows 0..2*radius after the loop, as a fold over the rows: a missing cell at
    row r takes the first m non-missing values of the column *as filled so far*
    (earlier rows filled, later rows original), weighted by the distances of
    the first m slots of its window r-radius..r+radius (clipped to the table),
    in reversed order."""
    s = F.lit(float(sentinel))

    def step(filled: Column, r: Column) -> Column:
        own = F.element_at(head, r + 1)
        later = F.filter(firsts, lambda x: x["p"] > r)
        n_later = present - F.size(F.filter(firsts, lambda x: x["p"] <= r))
        count = n_later + F.when(F.try_element_at(filled, F.lit(1)) != s, r).otherwise(0)
        values = F.concat(F.filter(filled, lambda v: v != s), F.transform(later, lambda x: x["v"]))
        start = F.greatest(F.lit(0), r - radius)
        distances = F.transform(F.sequence(start, F.least(n, r + radius + 1) - 1), lambda i: F.abs(i - r).cast("double"))
        m = F.least(F.size(distances), count.cast("int"))
        value = F.when(own != s, own).when(count <= 0, s).otherwise(_weighted(values, distances, F.greatest(m, F.lit(1)), decay))
        return F.concat(filled, F.array(value))

    rows = F.sequence(F.lit(0), F.least(n, F.lit(2 * radius + 1)).cast("int") - 1)
    return F.aggregate(rows, F.array().cast("array<double>"), step)


def head_weighted_fill(df: DataFrame, cols: list[str], row_id: str, sentinel: float = -999.0,
                       radius: int = FILL_RADIUS, decay: float = FILL_DECAY, by: list[str] | None = None) -> DataFrame:
    """Fill sentinel cells as the older notebook's in-place loop does, in
    each series of ``by`` (none: the whole table is one).

    ``row_id`` is the 0-based position in the series.  From row 2*radius+1 on
    the first values are always the filled head, so only the window length
    (shorter near the end) still varies: one value per length.  All of it
    follows from a series' first 2*radius+1 rows and first 2*(2*radius+1)
    non-missing values of a column: they are gathered by one aggregate (of the
    values, each task keeps the first ones), the fill is a fold over them as a
    column expression, and its result, some 20 numbers a column, is joined back by
    series.  Nothing is read back to the driver.  A column without any
    non-missing value keeps the sentinel."""
    from pyspark.sql import Window

    span, s = 2 * radius + 1, F.lit(float(sentinel))
    lead = free_prefix(df)
    key, place = f"{lead}key", F.col(row_id)
    keyed = df.withColumn(key, F.struct(*[F.col(c) for c in by or []]) if by else F.lit(0))
    value = {c: F.col(c).cast("double") for c in cols}
    whole = keyed.groupBy(key).agg(
        F.count(F.lit(1)).cast("int").alias("n"), *[F.count_if(value[c] != s).alias(f"present{i}") for i, c in enumerate(cols)],
        *[F.array(*[F.max(F.when(place == r, value[c])) for r in range(span)]).alias(f"head{i}") for i, c in enumerate(cols)])
    cells = keyed.select(key, place.cast("long").alias("p"), F.explode(F.array(*[
        F.when(value[c] != s, F.struct(F.lit(i).alias("i"), value[c].alias("v"))) for i, c in enumerate(cols)])).alias("x"))
    ranked = (cells.where(F.col("x").isNotNull()).select(key, "p", "x.i", "x.v")
              .withColumn("r", F.row_number().over(Window.partitionBy(key, "i").orderBy("p"))).where(F.col("r") <= 2 * span))
    firsts = ranked.groupBy(key, "i").agg(F.sort_array(F.collect_list(F.struct("p", "v"))).alias("firsts"))
    # one row for each series and column, so that the plan holds one fold
    heads = whole.select(key, "n", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(f"present{i}").alias("present"), F.col(f"head{i}").alias("head"))
        for i in range(len(cols))])).alias("x")).select(key, "n", "x.*")
    parts = heads.unionByName(firsts, allowMissingColumns=True).groupBy(key, "i").agg(*[
        F.first(c, ignorenulls=True).alias(c) for c in ("n", "present", "head", "firsts")])
    none = F.array().cast("array<struct<p:bigint,v:double>>")
    filled = parts.select(key, "i", "n", _filled_head(F.col("head"), F.coalesce("firsts", none), F.col("present"), F.col("n"),
                                                      radius, decay, sentinel).alias("head"))
    shape = F.array(*[F.lit(float(abs(i - radius))) for i in range(span)])
    tail = F.transform(F.sequence(F.lit(radius + 1), F.lit(span)),
                       lambda m: _weighted(F.col("head"), F.slice(shape, F.lit(1), m), m, decay))
    tail = F.when((F.col("n") > span) & (F.element_at("head", 1) != s), tail)
    plan = (filled.select(key, "n", F.struct("i", F.struct("head", tail.alias("tail")).alias("plan")).alias("e")).groupBy(key)
            .agg(F.struct(F.max("n").alias("n"), F.map_from_entries(F.collect_list("e")).alias("of")).alias("plan")))
    plan_col = f"{lead}plan"
    if by:
        x = keyed.join(plan.withColumnRenamed("plan", plan_col), key)
    else:
        x = keyed.withColumn(plan_col, plan.agg(F.first("plan")).scalar())
    out = {}
    for i, c in enumerate(cols):
        head, rest = F.col(plan_col)["of"][i]["head"], F.col(plan_col)["of"][i]["tail"]
        length = F.least(F.lit(span), F.col(plan_col)["n"] - place + radius).cast("int")
        fill = F.when(place < span, F.try_element_at(head, (place + 1).cast("int"))).otherwise(
            F.coalesce(F.try_element_at(rest, length - radius), s))
        out[c] = F.when(value[c] == s, fill).otherwise(F.col(c))
    return x.withColumns(out).select(*[F.col(f"`{c}`") for c in df.columns])
