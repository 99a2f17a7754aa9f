"""Row-ordered operations inside each series: position, row shifts, and
carrying the nearest non-missing value forward/backward.

Two exact physical strategies share one interface and give the same rows and
columns for every input:

* ``series``  -- ``Window.partitionBy(series).orderBy(date)``: one shuffle,
  one task per series.  Right when every series fits one task.
* ``chunked`` -- every series is cut into chunks along its whole order key and
  the window runs per ``(series, chunk)``.  Whatever crosses a chunk boundary
  (the next/previous K rows, the nearest non-missing value) is taken from
  small per-chunk tables (a few rows per chunk) joined back on ``(series,
  chunk)``.  The big side is already hash-partitioned on exactly those keys by
  the window's exchange, so only the small side moves.  A series holding a
  third of all rows is spread over as many tasks as it has chunks.

``auto`` counts the rows of each series with one aggregate over the key
columns and picks ``series`` when the longest is under ``max_rows_per_task``
rows.  Otherwise it cuts the first order key at one width, if a second count
shows that no chunk is above the budget.  If rows are too uneven for that,
chunks are the partitions of a range partitioning by (partition keys, order
keys): its bounds are quantiles of the observed rows,
so chunks are even for any key type, for bursts, and for many rows on one
date: rows that tie in the order keys are cut by a hash of the whole row and
keep that order.  The partitioned rows
are written to the shared folder once, so that chunks do not change when a
task is recomputed.  ``mode="chunked"`` without ``chunk_rows`` cuts at fixed
widths of the first order key instead.

Null partition and order keys are keys like any other (nulls come first, as
in a window's order): bookkeeping joins use struct-wrapped keys, which match
null with null.  Helper columns get names that no input column begins with.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

#: rows of a range partition that is sorted and cut into chunks
PARTITION_ROWS = 2_000_000


@dataclass(frozen=True)
class Ordering:
    """Partition keys (may be empty = one global order) and order keys.

    Further order columns break ties and should make the order total.
    ``chunk_rows`` cuts chunks of about that many rows (``auto`` sets it for
    uneven rows); without it, ``mode="chunked"`` cuts on ``order[0]``, which must then be a
    DATE, TIMESTAMP or integral column (width ``chunk_days`` for dates,
    ``chunk_micros`` for timestamps, ``chunk_width`` for integers).
    """

    partition: tuple[str, ...]
    order: tuple[str, ...]
    chunk_days: int = 366
    chunk_width: int = 4096  # for an integral first order key
    chunk_micros: int = 86_400_000_000  # for a timestamp first order key
    max_rows_per_task: int = 2_000_000
    mode: str = "auto"
    chunk_rows: int | None = None
    rows: int | None = None  # of the whole table, where known
    null_keys: bool = True  # whether partition or first order keys may be null


class _Names:
    """Helper column names that no column of ``df`` begins with."""

    def __init__(self, df: DataFrame):
        lead = "_sk_"
        while any(c.startswith(lead) for c in df.columns):
            lead += "_"
        self.part, self.chunk, self.rn, self.cnt, self.off, self.total, self.j, self.base, self.pos, \
            self.next, self.prev = (lead + x for x in (
                "part", "chunk", "rn", "cnt", "off", "total", "j", "base", "pos", "next", "prev"))
        self.lead = lead
        self.tie, self.same = lead + "tie", lead + "same"
        self.order: tuple[str, ...] = ()  # order keys with those that break ties, where chunks need them
        self.parts = [self.part]

    def total_order(self, o: Ordering) -> Ordering:
        return replace(o, order=self.order) if self.order else o

    @property
    def keys(self) -> list[str]:
        return [*self.parts, self.chunk]


def _key_units(df: DataFrame, c: str) -> Column:
    """The first order key as a number that grows with it, free of time zones."""
    dt = df.schema[c].dataType
    if isinstance(dt, T.DateType):
        return F.unix_date(F.col(c)).cast("long")
    if isinstance(dt, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{c}`)")
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(F.col(c))
    return F.col(c).cast("long")


def _chunk_expr(df: DataFrame, o: Ordering) -> Column:
    """Chunk of a fixed width; where keys may be null, wrapped so that a null
    key has a chunk too."""
    first = o.order[0]
    dt = df.schema[first].dataType
    if isinstance(dt, T.DateType):
        width = o.chunk_days
    elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        width = o.chunk_micros
    else:
        width = o.chunk_width
    chunk = F.floor(_key_units(df, first) / F.lit(width))
    return F.struct(chunk.alias("c")) if o.null_keys else chunk


def resolve(df: DataFrame, o: Ordering) -> Ordering:
    """Fix the strategy from one or two aggregates over the keys.  Pass the
    result on to several operators over the same rows to count once."""
    if o.mode != "auto":
        return o
    ranged = isinstance(df.schema[o.order[0]].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType, T.IntegralType))
    k = _key_units(df, o.order[0]) if ranged else F.lit(None).cast("long")
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in o.partition + o.order[:1]])
    per = df.groupBy(*o.partition).agg(F.count(F.lit(1)).alias("n"), F.min(k).alias("lo"), F.max(k).alias("hi"),
                                       F.max(missing).alias("missing"))
    longest, rows, nulls = per.agg(F.max(F.struct("n", "lo", "hi")), F.sum("n"), F.max("missing")).first()
    if longest is None or longest["n"] <= o.max_rows_per_task:
        return replace(o, mode="series", rows=rows or 0)
    half = max(1, o.max_rows_per_task // 2)
    o = replace(o, null_keys=bool(nulls))
    if longest["lo"] is not None:
        # chunks of one width of the first key, about half a task each if the
        # longest series is even; taken if the observed rows bear that out
        width = max(1, (longest["hi"] - longest["lo"] + 1) // -(-longest["n"] // half))
        fixed = replace(o, mode="chunked", rows=rows, chunk_days=width, chunk_micros=width, chunk_width=width)
        counts = df.groupBy(*o.partition, _chunk_expr(df, fixed).alias("_width_chunk")).count()
        if counts.agg(F.max("count")).first()[0] <= o.max_rows_per_task:
            return fixed
    return replace(o, mode="chunked", chunk_rows=half, rows=rows)


def resolve_mode(df: DataFrame, o: Ordering) -> str:
    return resolve(df, o).mode


def _w(o: Ordering, *keys: str) -> Window:
    return Window.partitionBy(*[F.col(c) for c in (keys or o.partition)]).orderBy(*[F.col(c) for c in o.order])


def _w_rev(o: Ordering, *keys: str) -> Window:
    """The same partition in exactly reversed order (ascending puts nulls
    first, descending puts them last).  "First non-missing at or after the
    row" is computed as a running "last non-missing" over this order: Spark
    evaluates a running frame incrementally, while a frame reaching to
    UNBOUNDED FOLLOWING is re-aggregated for every row (quadratic)."""
    return Window.partitionBy(*[F.col(c) for c in (keys or o.partition)]) \
        .orderBy(*[F.col(c).desc() for c in o.order])


# --------------------------------------------------------------------------
# chunk bookkeeping
# --------------------------------------------------------------------------

def _range_partitions(df: DataFrame, rows: int, pieces: int) -> int:
    """Partitions of a range partitioning: a few for each core, and more only
    where one would hold above ``PARTITION_ROWS`` rows."""
    few = 4 * df.sparkSession.sparkContext.defaultParallelism
    return min(pieces, max(few, -(-rows // PARTITION_ROWS)))


def _chunked_base(df: DataFrame, o: Ordering, sources: list[str] = ()):
    """``df`` with series key, chunk and in-chunk row number, and the table of
    chunks: rows, rows of the series before it, rows of the series.  The series
    key is the partition columns themselves if they hold no null and are none
    of the ``sources`` that are carried over, else a struct of them."""
    nm = _Names(df)
    if o.partition and not o.null_keys and not set(o.partition) & set(sources):
        nm.parts = list(o.partition)
    part = F.struct(*[F.col(c) for c in o.partition]) if o.partition else F.struct(F.lit(0).alias("all"))

    def keyed(x):
        return x if nm.parts != [nm.part] else x.withColumn(nm.part, part)

    if o.chunk_rows:
        rows = o.rows if o.rows is not None else df.count()
        pieces = max(1, -(-rows // o.chunk_rows))
        # rows with the same order keys are told apart by a hash of the whole
        # row, so that they fall into several chunks and keep one order; rows
        # equal in everything, which any order suits, by a number given once
        tied = df.withColumn(nm.tie, F.xxhash64(*map(_quoted, df.columns))).withColumn(
            nm.same, F.monotonically_increasing_id())
        tied = cut_lineage(tied, "chunk-rows")
        nm.order = o.order + (nm.tie, nm.same)
        by = [F.col(c).asc_nulls_first() for c in o.partition + nm.order]
        ranged = tied.repartitionByRange(_range_partitions(df, rows, pieces), *by).sortWithinPartitions(*by)
        # a row's number: its partition and, in the lower 33 bits, its place there
        numbered = ranged.withColumn(nm.pos, F.monotonically_increasing_id())
        place = F.col(nm.pos).bitwiseAND(F.lit((1 << 33) - 1))
        chunk = F.col(nm.pos) - place % F.lit(o.chunk_rows)  # the number of its chunk's first row
        m = keyed(cut_lineage(numbered.withColumn(nm.chunk, chunk).drop(nm.pos), "chunks"))
    else:
        m = keyed(df).withColumn(nm.chunk, _chunk_expr(df, o))
    m = m.withColumn(nm.rn, F.row_number().over(_w(nm.total_order(o), *nm.keys)))
    # counts per chunk from the windowed frame itself: it is already
    # partitioned by the chunk keys, so this aggregate needs no shuffle and
    # the input's exchange is reused instead of computing the input twice
    counts = m.groupBy(*nm.keys).agg(F.max(nm.rn).cast("long").alias(nm.cnt))
    wp = Window.partitionBy(*nm.parts).orderBy(nm.chunk).rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select(*nm.keys, nm.cnt, F.coalesce(F.sum(nm.cnt).over(wp), F.lit(0)).cast("long").alias(nm.off),
                         F.sum(nm.cnt).over(Window.partitionBy(*nm.parts)).alias(nm.total))
    return m, offs, nm


def with_position(df: DataFrame, o: Ordering, name: str = "row_pos", total: str | None = None) -> DataFrame:
    """0-based position of each row inside its partition, in ``order``, and
    the partition's row count as ``total`` where asked for."""
    o = resolve(df, o)
    if o.mode == "series":
        out = df.withColumn(name, F.row_number().over(_w(o)).cast("long") - 1)
        if total:
            out = out.withColumn(total, F.count(F.lit(1)).over(Window.partitionBy(*map(F.col, o.partition))))
        return out
    m, offs, nm = _chunked_base(df, o)
    out = m.join(offs, nm.keys, "inner")
    return out.select(*map(_quoted, df.columns), (F.col(nm.off) + F.col(nm.rn) - 1).cast("long").alias(name),
                      *([F.col(nm.total).alias(total)] if total else []))


def _quoted(c: str) -> Column:
    return F.col(f"`{c}`")


# --------------------------------------------------------------------------
# row shifts
# --------------------------------------------------------------------------

def shift_rows(df: DataFrame, specs: list[tuple[str, str, int]], o: Ordering) -> DataFrame:
    """Add ``out = value of src k rows later`` (k > 0) or earlier (k < 0).

    Rows past the series end get null, like ``shift`` in the reference.
    ``specs`` is a list of ``(out_name, src_col, k)``.
    """
    if not specs:
        return df
    o = resolve(df, o)
    if o.mode == "series":
        w = _w(o)
        return df.select("*", *[
            (F.lead(src, k) if k > 0 else F.lag(src, -k)).over(w).alias(out)
            for out, src, k in specs])
    return _shift_chunked(df, specs, o)


def _halo_table(m: DataFrame, offs: DataFrame, nm: _Names, srcs: list[str],
                kmax: int, forward: bool, alias: str) -> DataFrame:
    """Per chunk: array of the ``kmax`` rows just after (or before) it."""
    if forward:
        cand = m.where(F.col(nm.rn) <= kmax)
    else:
        cand = m.join(offs.select(*nm.keys, nm.cnt), nm.keys).where(F.col(nm.rn) > F.col(nm.cnt) - kmax)
    cand = (cand.join(offs.select(*nm.keys, nm.off), nm.keys)
            .select(*nm.parts, (F.col(nm.off) + F.col(nm.rn) - 1).alias(nm.pos), *srcs))
    base = F.col(nm.off) + F.col(nm.cnt) if forward else F.col(nm.off) - 1
    step = 1 if forward else -1
    req = offs.select(*nm.keys, F.explode(F.sequence(F.lit(0), F.lit(kmax - 1))).alias(nm.j),
                      base.alias(nm.base))
    req = req.select(*nm.keys, nm.j, (F.col(nm.base) + F.col(nm.j) * step).alias(nm.pos))
    got = req.join(cand, [*nm.parts, nm.pos], "inner")
    return got.groupBy(*nm.keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(nm.j), *[F.col(s) for s in srcs]))).alias(alias))


def _shift_chunked(df: DataFrame, specs, o: Ordering) -> DataFrame:
    srcs = sorted({s for _, s, _ in specs})
    m, offs, nm = _chunked_base(df, o, srcs)
    kf = max([k for _, _, k in specs if k > 0], default=0)
    kb = max([-k for _, _, k in specs if k < 0], default=0)
    w = _w(nm.total_order(o), *nm.keys)
    x = m.join(offs.select(*nm.keys, nm.cnt), nm.keys)
    if kf:
        x = x.join(_halo_table(m, offs, nm, srcs, kf, True, nm.next), nm.keys, "left")
    if kb:
        x = x.join(_halo_table(m, offs, nm, srcs, kb, False, nm.prev), nm.keys, "left")
    cols = []
    for out, src, k in specs:
        if k > 0:
            inside = F.col(nm.rn) + k <= F.col(nm.cnt)
            outside = F.try_element_at(F.col(nm.next), (F.col(nm.rn) + k - F.col(nm.cnt)).cast("int"))[src]
            cols.append(F.when(inside, F.lead(src, k).over(w)).otherwise(outside).alias(out))
        else:
            kk = -k
            inside = F.col(nm.rn) - kk >= 1
            outside = F.try_element_at(F.col(nm.prev), (F.lit(kk) - F.col(nm.rn) + 1).cast("int"))[src]
            cols.append(F.when(inside, F.lag(src, kk).over(w)).otherwise(outside).alias(out))
    return x.select(*map(_quoted, df.columns), *cols)


# --------------------------------------------------------------------------
# nearest non-missing neighbours (for interpolation)
# --------------------------------------------------------------------------

def neighbours(df: DataFrame, cols: list[str], o: Ordering, pos_name: str = "row_pos",
               names: dict[tuple[str, str], str] | None = None) -> DataFrame:
    """Add, per column c: ``c__pv, c__pp`` (last non-missing value and its
    position at or before the row) and ``c__nv, c__np`` (first at or after),
    plus the row position ``pos_name``.  ``names`` gives other names for (c, "pv")
    and so on."""
    o = resolve(df, o)
    shown = names or {(c, k): f"{c}__{k}" for c in cols for k in ("pv", "pp", "nv", "np")}
    if o.mode == "series":
        wb = _w(o).rowsBetween(Window.unboundedPreceding, 0)
        wf = _w_rev(o).rowsBetween(Window.unboundedPreceding, 0)
        x = df.withColumn(pos_name, F.row_number().over(_w(o)).cast("long") - 1)
        out = []
        for c in cols:
            p = F.when(F.col(c).isNotNull(), F.col(pos_name))
            out += [F.last(c, True).over(wb).alias(shown[c, "pv"]), F.last(p, True).over(wb).alias(shown[c, "pp"]),
                    F.last(c, True).over(wf).alias(shown[c, "nv"]), F.last(p, True).over(wf).alias(shown[c, "np"])]
        return x.select("*", *out)

    m, offs, nm = _chunked_base(df, o, cols)
    m = m.join(offs.select(*nm.keys, nm.off), nm.keys)
    m = m.withColumn(pos_name, (F.col(nm.off) + F.col(nm.rn) - 1).cast("long"))
    total = nm.total_order(o)
    wb = _w(total, *nm.keys).rowsBetween(Window.unboundedPreceding, 0)
    wf = _w_rev(total, *nm.keys).rowsBetween(Window.unboundedPreceding, 0)
    inner, summ = [], []
    name = {(c, k): f"{nm.lead}{k}{i}" for i, c in enumerate(cols)
            for k in ("pv", "pp", "nv", "np", "last", "first", "before", "after")}
    for c in cols:
        p = F.when(F.col(c).isNotNull(), F.col(pos_name))
        inner += [F.last(c, True).over(wb).alias(name[c, "pv"]), F.last(p, True).over(wb).alias(name[c, "pp"]),
                  F.last(c, True).over(wf).alias(name[c, "nv"]), F.last(p, True).over(wf).alias(name[c, "np"])]
        nn = F.when(F.col(c).isNotNull(), F.struct(F.col(pos_name).alias("p"), F.col(c).alias("v")))
        summ += [F.max(nn).alias(name[c, "last"]), F.min(nn).alias(name[c, "first"])]
    # per-chunk summary: last / first non-missing (position, value)
    s = m.groupBy(*nm.keys).agg(*summ)
    wprev = Window.partitionBy(*nm.parts).orderBy(nm.chunk).rowsBetween(Window.unboundedPreceding, -1)
    wnext = Window.partitionBy(*nm.parts).orderBy(F.col(nm.chunk).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = s.select(*nm.keys, *[x for c in cols for x in (
        F.last(name[c, "last"], True).over(wprev).alias(name[c, "before"]),
        F.last(name[c, "first"], True).over(wnext).alias(name[c, "after"]))])
    x = m.select("*", *inner).join(carry, nm.keys, "left")
    fixed = []
    for c in cols:
        before, after = F.col(name[c, "before"]), F.col(name[c, "after"])
        fixed += [
            F.coalesce(F.col(name[c, "pv"]), before["v"]).alias(shown[c, "pv"]),
            F.coalesce(F.col(name[c, "pp"]), before["p"]).alias(shown[c, "pp"]),
            F.coalesce(F.col(name[c, "nv"]), after["v"]).alias(shown[c, "nv"]),
            F.coalesce(F.col(name[c, "np"]), after["p"]).alias(shown[c, "np"]),
        ]
    return x.select(*map(_quoted, df.columns), pos_name, *fixed)
