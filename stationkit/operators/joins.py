"""Joins of series by date.

A long table is turned into the wide per-date layout by joining one
filtered slice per series.  The filter on ``series_id`` reaches the scan;
each slice is prefixed with its series name; the join strategy (broadcast or
sort-merge, with skew splitting) is left to AQE at run time.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def series_slice(long_df: DataFrame, series_col: str, series: str, date_col: str,
                 cols: list[str] | None = None, date_offset_days: int = 0) -> DataFrame:
    """One series, its columns prefixed ``{series}_``, keyed by ``date_col``.

    ``date_offset_days`` moves the series' dates forward (P8) before the
    join, so day t-k of this series meets day t of the others (J2).
    """
    x = long_df.where(F.col(series_col) == F.lit(series))
    cols = cols if cols is not None else [c for c in x.columns if c not in (series_col, date_col)]
    key = F.col(date_col)
    if date_offset_days:
        key = F.date_add(key, date_offset_days)
    return x.select(key.alias(date_col), *[F.col(c).alias(f"{series}_{c}") for c in cols])


def join_series(long_df: DataFrame, series_col: str, date_col: str, series: list[str],
                how: str = "inner", cols: list[str] | None = None,
                offsets: dict[str, int] | None = None) -> DataFrame:
    """J1 (how='inner') / J2 (how='left', with offsets): chained equi-joins
    on the date, first series first.  Duplicate dates multiply, null dates
    never match (ingest drops them).  The result keeps one ``date_col``."""
    offsets = offsets or {}
    slices = [series_slice(long_df, series_col, s, date_col, cols, offsets.get(s, 0)) for s in series]
    return reduce(lambda a, b: a.join(b, on=date_col, how=how), slices)


def pivot_series(long_df: DataFrame, series_col: str, date_col: str, series: list[str],
                 cols: list[str]) -> DataFrame:
    """Wide layout by one grouped pivot instead of N joins, for many series.

    One shuffle by date (with map-side partial aggregation) for any number of
    series.  Equal to the inner join: null dates and dates missing from any
    series are removed, and a series with two rows on one date, which the join
    would multiply, is an error here.
    """
    g = (long_df.where(F.col(series_col).isin(series) & F.col(date_col).isNotNull())
         .groupBy(date_col).pivot(series_col, series))
    # pivot names each cell "{series}_{alias}"; "_n" counts a series' rows per date
    wide = g.agg(*[F.max(c).alias(c) for c in cols], F.count(F.lit(1)).alias("_n"))
    present = reduce(lambda a, b: a & b, [F.col(f"`{s}__n`").isNotNull() for s in series])
    single = F.array_max(F.array(*[F.col(f"`{s}__n`") for s in series])) == 1
    checked = F.when(single, F.lit(True)).otherwise(
        F.raise_error(F.lit("a series has several rows on one date; a pivot holds one")).cast("boolean"))
    return wide.where(present).where(checked).select(
        date_col, *[F.col(f"`{s}_{c}`").alias(f"{s}_{c}") for s in series for c in cols])


def pivot_with_shared(long_df: DataFrame, series_col: str, date_col: str, series: list[str],
                      cols: list[str], shared: dict[str, str]) -> DataFrame:
    """``pivot_series`` of ``cols``, and next to it the largest value on each
    date of the ``shared`` columns (``{column: output name}``), which only one
    series fills.  One grouped pass: series as a map of structs, so the plan
    does not grow by an aggregate for each series and column."""
    cell = F.struct(*[F.col(c) for c in cols])
    wide = (long_df.where(F.col(series_col).isin(series) & F.col(date_col).isNotNull())
            .groupBy(date_col)
            .agg(F.collect_list(F.struct(F.col(series_col).alias("s"), cell.alias("c"))).alias("_cells"),
                 *[F.max(c).alias(out) for c, out in shared.items()]))
    distinct = F.size(F.array_distinct(F.transform("_cells", lambda x: x["s"])))
    whole = F.when(F.size("_cells") == distinct, distinct == len(series)).otherwise(
        F.raise_error(F.lit("a series has several rows on one date; a pivot holds one")).cast("boolean"))
    # the cell of each series by search: a map of equal keys would fail before the check does
    one = {s: f"_cell{i}" for i, s in enumerate(series)}

    def found(s: str):
        return F.try_element_at(F.filter("_cells", lambda x: x["s"] == F.lit(s)), F.lit(1))["c"]

    by = wide.where(whole).withColumns({name: found(s) for s, name in one.items()})
    return by.select(date_col, *[F.col(one[s])[c].alias(f"{s}_{c}") for s in series for c in cols], *shared.values())


def suffix_join(left: DataFrame, right: DataFrame, on: str, suffixes: tuple[str, str],
                how: str = "inner") -> DataFrame:
    """P5: only the columns present on both sides get suffixes, as in a
    pandas merge; the join key stays bare."""
    common = (set(left.columns) & set(right.columns)) - {on}
    l = left.withColumnsRenamed({c: c + suffixes[0] for c in common})
    r = right.withColumnsRenamed({c: c + suffixes[1] for c in common})
    return l.join(r, on=on, how=how)


def zip_tables(a: DataFrame, b: DataFrame, key: str = "row_id") -> DataFrame:
    """Align two tables that share an explicit row id (never file order)."""
    return a.join(b, on=key, how="inner")
