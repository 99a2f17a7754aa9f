"""Exact order statistics by radix selection.

A double is turned into a 64-bit number that grows with it, and the wanted
rank is found 16 bits at a time: one aggregate counts the values under each
wanted prefix by their next 16 bits, the running sum picks the bucket that
holds the rank, and the prefix grows by it.  Four passes find any value,
however the values are spread, for many ranks and groups at once; a value that
a third of all rows share is one count.  Quantiles of groups that one task can
sort are read off the sorted group instead: one shuffle, not one for each pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_MANTISSA = 1 << 52
_BIAS = 1023
_TOP = 2047 * _MANTISSA  # infinity
_HALF = float(2.0 ** 537)


def ordered_key(x: Column) -> Column:
    """Sign times (exponent, mantissa) of a double: a BIGINT of the same order;
    both zeros are 0, infinities lie outside all numbers; NaN has no key."""
    a = F.abs(x)
    guess = F.floor(F.log2(a)).cast("int")
    two = F.lit(2.0)
    e = F.when(F.pow(two, guess) > a, guess - 1).when(F.pow(two, guess + 1) <= a, guess + 1).otherwise(guess)
    mantissa = ((a / F.pow(two, e) - 1) * float(_MANTISSA)).cast("long")
    size = (F.when(a == 0, F.lit(0).cast("long"))
            .when(a == float("inf"), F.lit(_TOP))
            .when(a < 2.0 ** -1022, (a * _HALF * _HALF).cast("long"))  # subnormal
            .otherwise((e + _BIAS).cast("long") * _MANTISSA + mantissa))
    return F.when(x < 0, -size).otherwise(size)


def from_key(key: Column) -> Column:
    """The double of an ``ordered_key``."""
    size = F.abs(key)
    e, m = F.shiftright(size, 52), size % F.lit(_MANTISSA)
    v = (F.when(size >= _TOP, F.lit(float("inf")))
         .when(e == 0, size.cast("double") / _HALF / _HALF)
         .otherwise((1 + m.cast("double") / float(_MANTISSA)) * F.pow(F.lit(2.0), (e - _BIAS).cast("double"))))
    return F.when(key < 0, -v).otherwise(v)


def keys_at(keyed: DataFrame, wanted: DataFrame) -> DataFrame:
    """``g, r, key``: the key of 0-based rank ``r`` among the ``key`` of group
    ``g`` (any type; null is a group too) for every (g, r) of ``wanted``."""
    state = wanted.select(F.struct("g").alias("g"), "r", F.col("r").alias("left"), F.lit(0).cast("long").alias("prefix"))
    rows = keyed.select(F.struct("g").alias("g"), "key")
    for shift in (48, 32, 16, 0):
        digits = F.shiftright("key", shift)
        if shift == 48:
            some = rows.select("g", F.lit(0).cast("long").alias("prefix"), digits.alias("bucket"))
        else:
            open_ = state.select("g", "prefix").distinct()
            some = rows.select("g", F.shiftright("key", shift + 16).alias("prefix"), digits.alias("bucket")) \
                .join(open_, ["g", "prefix"], "left_semi")
        counts = some.groupBy("g", "prefix", "bucket").agg(F.count(F.lit(1)).alias("n"))
        below = Window.partitionBy("g", "prefix").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("below", F.coalesce(F.sum("n").over(below), F.lit(0)))
        hit = (F.col("left") >= F.col("below")) & (F.col("left") < F.col("below") + F.col("n"))
        state = cut_lineage(state.join(counts, ["g", "prefix"]).where(hit).select(
            "g", "r", (F.col("left") - F.col("below")).alias("left"), F.col("bucket").alias("prefix")), "radix")
    return state.select(F.col("g.g").alias("g"), "r", F.col("prefix").alias("key"))


def _sorted_quantiles(x: DataFrame, qs: list[float]) -> DataFrame:
    """``g, q, a, b, part`` of groups of few rows: the values at the ranks
    around each quantile, from every group sorted in one task."""
    placed = x.select("g", F.when(F.col("x") == 0, 0.0).otherwise(F.col("x")).alias("x"),
                      F.count(F.lit(1)).over(Window.partitionBy("g")).alias("n"),
                      (F.row_number().over(Window.partitionBy("g").orderBy("x")) - 1).alias("r"))
    ends = []
    for i, q in enumerate(qs):
        at = F.lit(float(q)) * (F.col("n") - 1)
        ends += [F.max(F.when(F.col("r") == f(at), F.col("x"))).alias(f"{e}{i}") for e, f in (("a", F.floor), ("b", F.ceil))]
    found = placed.groupBy("g").agg(F.first("n").alias("n"), *ends)
    each = [F.struct(F.lit(float(q)).alias("q"), F.col(f"a{i}").alias("a"), F.col(f"b{i}").alias("b")) for i, q in enumerate(qs)]
    at = F.col("e.q") * (F.col("n") - 1)
    return found.select("g", "n", F.explode(F.array(*each)).alias("e")).select("g", "e.*", (at - F.floor(at)).alias("part"))


def _radix_quantiles(x: DataFrame, counts: DataFrame, qs: list[float]) -> DataFrame:
    """The same of groups of any size, whose sizes are ``counts``."""
    keyed = x.select("g", ordered_key(F.col("x")).alias("key"))
    at = F.col("q") * (F.col("n") - 1)
    asked = (counts.withColumn("q", F.explode(F.array(*[F.lit(float(q)) for q in qs])))
             .select("g", "q", F.floor(at).alias("lo"), F.ceil(at).alias("hi"), (at - F.floor(at)).alias("part")))
    ranks = asked.select("g", F.explode(F.array("lo", "hi")).alias("r")).distinct()
    found = keys_at(keyed, ranks).select(F.struct("g").alias("k"), "r", from_key(F.col("key")).alias("v"))
    ends = asked.withColumn("k", F.struct("g"))
    return (ends.join(found.select("k", F.col("r").alias("lo"), F.col("v").alias("a")), ["k", "lo"])
            .join(found.select("k", F.col("r").alias("hi"), F.col("v").alias("b")), ["k", "hi"])
            .select("g", "q", "a", "b", "part"))


def exact_quantiles(df: DataFrame, col: str, qs: list[float], by: list[str] | None = None,
                    sorted_rows: int = 1_000_000) -> DataFrame:
    """``by..., q, value``: linearly interpolated quantiles (as ``percentile``
    and ``quantile_cont``) of each group.  Nulls and NaN are missing, infinities
    are values, a group without values has no rows.  Groups of at most
    ``sorted_rows`` values are sorted, larger ones go through the radix passes."""
    by = list(by or [])
    x = F.col(col).cast("double")
    g = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))
    rows = df.where(x.isNotNull() & ~F.isnan(x)).select(g.alias("g"), x.alias("x"))
    counts = cut_lineage(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")), "radix-counts")
    large = counts.where(F.col("n") > sorted_rows)
    if large.isEmpty():
        both = _sorted_quantiles(rows, qs)
    else:
        wrapped, names = rows.withColumn("k", F.struct("g")), large.select(F.struct("g").alias("k"))
        few, many = (wrapped.join(names, "k", how).drop("k") for how in ("left_anti", "left_semi"))
        both = _radix_quantiles(many, large, qs).unionByName(_sorted_quantiles(few, qs))
    value = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * F.col("part"))
    return both.select(*[F.col(f"g.`{c}`").alias(c) for c in by], "q", value.alias("value"))


def kth_key(df: DataFrame, key: Column, k: int) -> tuple[int, int, int]:
    """The ``k``-th smallest (from 1) of a BIGINT, how many rows lie below it
    and how many share it; each of the four passes reads back 65,536 counts at
    most."""
    rows, prefix, below = df.select(key.alias("key")), None, 0
    count = 0
    for shift in (48, 32, 16, 0):
        part = rows if prefix is None else rows.where(F.shiftright("key", shift + 16) == F.lit(prefix))
        for prefix, count in sorted(map(tuple, part.groupBy(F.shiftright("key", shift)).count().collect())):
            if below + count >= k:
                break
            below += count
    return prefix, below, count
