"""Row ids, orders, samples and splits (2.11-b, O1-O6).

Global positions never use an unpartitioned window: they go through the
chunked path of :mod:`series_window` (chunks of the order key, counts per
chunk, running offsets over the small count table).  Exact random splits
use a hash of ``(seed, row_id)`` that both Spark and the SQL oracle can
compute, bucket counts on the hash prefix, and one threshold key, so no
global sort is needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import free_prefix
from .radix import kth_key
from .series_window import Ordering, with_position


def hash32(seed: str | int, key: str | Column) -> Column:
    """First 32 bits of md5(seed ':' key) as BIGINT (same in DuckDB:
    ``CAST('0x' || substr(md5(s), 1, 8) AS BIGINT)``)."""
    k = F.col(key) if isinstance(key, str) else key
    s = F.concat(F.lit(f"{seed}:"), k.cast("string"))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def add_row_id(df: DataFrame, order: list[str], name: str = "row_id",
               chunk_days: int = 366, chunk_width: int = 4096, mode: str = "auto",
               max_rows_per_task: int = 2_000_000) -> DataFrame:
    """O1 / 2.11-b: 0-based position in ``order`` over the whole table
    (always chunked; ``auto`` sizes the chunks from the data)."""
    o = Ordering(partition=(), order=tuple(order), chunk_days=chunk_days, chunk_width=chunk_width,
                 max_rows_per_task=max_rows_per_task, mode=mode)
    return with_position(df, o, name)


def stride_sample(df: DataFrame, row_id: str, step: int) -> DataFrame:
    """O3: every ``step``-th row from the first (``[::step]``)."""
    return df.where(F.col(row_id) % F.lit(step) == 0)


def chronological_split(df: DataFrame, row_id: str, train_fraction: float,
                        n: int | None = None, name: str = "split") -> DataFrame:
    """First ``int(train_fraction * n)`` rows train, the rest test."""
    if n is None:
        n = df.count()
    cut = int(train_fraction * n)
    return df.withColumn(name, F.when(F.col(row_id) < F.lit(cut), F.lit("train")).otherwise(F.lit("test")))


def chronological_split_by_day(df: DataFrame, date_col: str, train_fraction: float, ties: list[str] | None = None,
                               name: str = "split") -> DataFrame:
    """O6 without a position of every row: the first ``int(train_fraction * n)``
    rows by date are train.  Running sums of the rows per day give the day on
    which the cut falls; only that day's rows are ranked (by date, then ``ties``,
    in chunks if they are many).  Rows without a date come first."""
    lead = free_prefix(df)
    day, info = F.to_date(F.col(date_col)), f"{lead}cut"
    days = df.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("n"))  # one row a day of the calendar
    so_far = Window.orderBy(F.col("day").asc_nulls_first())
    run = days.select("day", F.sum("n").over(so_far).alias("upto"), "n").select(
        "day", (F.col("upto") - F.col("n")).alias("below"), "upto",
        F.floor(F.lit(float(train_fraction)) * F.sum("n").over(Window.partitionBy())).alias("cut"))
    on = run.where((F.col("below") <= F.col("cut")) & (F.col("cut") < F.col("upto")))
    x = df.withColumn(info, on.agg(F.struct(F.count(F.lit(1)).alias("found"), F.first("day").alias("day"),
                                            F.first(F.col("cut") - F.col("below")).alias("inside")).alias("s")).scalar())
    same = day.eqNullSafe(F.col(info)["day"]) & (F.col(info)["found"] > 0)
    before = (F.col(info)["found"] == 0) | F.coalesce(day < F.col(info)["day"], day.isNull())
    others = x.where(~same).withColumn(name, F.when(before, F.lit("train")).otherwise(F.lit("test")))
    order = (date_col, *[t for t in ties or [] if t != date_col])
    rank = f"{lead}rank"
    ranked = with_position(x.where(same), Ordering(partition=(), order=order), rank)
    boundary = ranked.withColumn(name, F.when(F.col(rank) < F.col(info)["inside"], F.lit("train"))
                                 .otherwise(F.lit("test"))).drop(rank)
    return others.unionByName(boundary).select(*[F.col(f"`{c}`") for c in df.columns], name)


def _bucket_counts(df: DataFrame, h: str, bits: int) -> list[tuple[int, int]]:
    b = F.shiftright(F.col(h), 32 - bits)
    return sorted((r[0], r[1]) for r in df.groupBy(b.alias("b")).count().collect())


def _threshold(df: DataFrame, h: str, k: int, bits: int, counts: list[tuple[int, int]]) -> tuple[int, int, int] | None:
    """The hash of the k-th smallest row (from 1), the rows below that hash and
    the rows that share it, from hash-prefix bucket counts (at most 2**bits rows
    to the driver) and the counts of the boundary bucket's hash values (at most
    2**(32 - bits))."""
    if k <= 0:
        return None
    b = F.shiftright(F.col(h), 32 - bits)
    below = 0
    for bucket, c in counts:
        if below + c >= k:
            break
        below += c
    else:
        return None
    for value, c in sorted((r[0], r[1]) for r in df.where(b == F.lit(bucket)).groupBy(h).count().collect()):
        if below + c >= k:
            return value, below, c
        below += c
    return None


def holdout_split(df: DataFrame, key: str, test_fraction: float, seed: int | str = 0,
                  name: str = "split", bits: int = 16) -> DataFrame:
    """Exact random hold-out.  ``ceil(f * n)`` rows with the smallest
    ``hash(seed, key)`` are test, as many as scikit-learn's split
    takes; the split is a column, so aligned tables share it.  Two small
    jobs find the threshold (the row count comes from the bucket counts).

    Rows that share the threshold's hash (null or repeated keys) are told apart
    by the key and then a hash of the whole row; of rows equal in everything as many copies are test
    as are wanted.  Nothing but counts is read back."""
    lead = free_prefix(df)
    h, t = f"{lead}h", f"{lead}t"
    x = df.withColumn(h, hash32(seed, F.coalesce(F.col(key).cast("string"), F.lit(""))))
    counts = _bucket_counts(x, h, bits)
    n = sum(c for _, c in counts)
    n_test = int(math.ceil(test_fraction * n))
    at = _threshold(x, h, n_test, bits, counts)
    if at is None:
        return x.withColumn(name, F.lit("train")).drop(h)
    value, below, shared = at
    test, train = F.lit("test"), F.lit("train")
    if below + shared == n_test:
        return x.withColumn(name, F.when(F.col(h) <= F.lit(value), test).otherwise(train)).drop(h)
    # the threshold falls among rows of one hash: one key in 2**32, each counted once
    same = F.col(h) == F.lit(value)
    groups = sorted(((r[0] is not None, r[0], r[1]) for r in x.where(same).groupBy(key).count().collect()),
                    key=lambda g: g[:2] if g[0] else (False,))
    wanted = n_test - below
    for _, tk, copies in groups:
        if wanted <= copies:
            break
        wanted -= copies
    at_key = same & F.col(key).eqNullSafe(F.lit(tk))
    lower = F.lit(False) if tk is None else F.col(key).isNull() | (F.col(key) < F.lit(tk))
    first = (F.col(h) < F.lit(value)) | (same & lower)
    if wanted == copies:
        return x.withColumn(name, F.when(first | at_key, test).otherwise(train)).drop(h)
    # rows of one key: by a hash of the whole row
    x = x.withColumn(t, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    tie, under, copies = kth_key(x.where(at_key), F.col(t), wanted)
    edge = at_key & (F.col(t) == F.lit(tie))
    first = first | (at_key & (F.col(t) < F.lit(tie)))
    wanted -= under
    columns = [F.col(f"`{c}`") for c in df.columns]
    if wanted == copies:
        return x.withColumn(name, F.when(first | edge, test).otherwise(train)).select(*columns, name)
    # rows equal in everything: any of them, as many as are wanted
    again = (x.where(edge).agg(F.first(F.struct(*columns)).alias("r"), F.count(F.lit(1)).alias("n"))
             .select("r", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("i"))
             .select(*[F.col("r")[c].alias(c) for c in df.columns], F.when(F.col("i") <= wanted, test).otherwise(train).alias(name)))
    return x.where(~edge).withColumn(name, F.when(first, test).otherwise(train)).select(*columns, name).unionByName(again)


def shuffled_order(df: DataFrame, key: str, seed: int | str, name: str = "row_id") -> DataFrame:
    """O2: a repeatable full shuffle: new position in the order of
    ``(hash(seed, key), key)``, computed with the chunked global position."""
    h = f"{free_prefix(df)}h"
    x = df.withColumn(h, hash32(seed, F.coalesce(F.col(key).cast("string"), F.lit(""))))
    o = Ordering(partition=(), order=(h, key), mode="auto")
    return with_position(x, o, name).drop(h)
