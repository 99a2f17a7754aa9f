"""Projections, filters and row cleaning.

All of these are narrow (no shuffle) except the profiles and audits, which
are single aggregates with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns by schema type (no split/recombine is needed)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, NUMERIC)]


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop named columns; unknown names are an error, as in the reference."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def prefix_columns(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Prefix every column except ``keep``."""
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keep})


def sort_columns(df: DataFrame) -> DataFrame:
    """Columns in name order."""
    return df.select(*sorted(df.columns))


def parse_date(c: str | Column, fmt: str = "dd.MM.yyyy") -> Column:
    """Text date to DATE; unparsable text gives null instead of an error."""
    return F.try_to_date(F.col(c) if isinstance(c, str) else c, fmt)


def format_date(c: str | Column, fmt: str = "dd.MM.yyyy") -> Column:
    """DATE back to the station-file text form."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, fmt)


def shift_dates(df: DataFrame, date_col: str, days: int) -> DataFrame:
    """Calendar shift (not a row shift)."""
    return df.withColumn(date_col, F.date_add(F.col(date_col), days))


def cutoff_filter(df: DataFrame, date_col: str, since: str) -> DataFrame:
    """keep rows on or after ``since``; a plain comparison on a DATE
    column, so it reaches the Parquet scan as a pushed filter."""
    return df.where(F.col(date_col) >= F.lit(since).cast("date"))


def sentinel_to_null(df: DataFrame, cols: list[str] | None = None,
                     sentinel: float = -999.0) -> DataFrame:
    """sentinel and NaN become SQL NULL, all numeric columns in one select."""
    cols = cols if cols is not None else numeric_columns(df)
    repl = {}
    for c in cols:
        v = F.col(c)
        repl[c] = F.when(F.isnan(v.cast("double")) | (v == F.lit(sentinel)), F.lit(None)).otherwise(v)
    return df.withColumns(repl)


def complete_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """drop rows with any missing value.  Written as explicit IS NOT NULL
    predicates so the optimizer can turn a preceding outer join into an
    inner one and push the predicates into the scans."""
    cols = cols if cols is not None else df.columns
    cond = F.lit(True)
    for c in cols:
        dt = df.schema[c].dataType
        p = F.col(c).isNotNull()
        if isinstance(dt, (T.DoubleType, T.FloatType)):
            p = p & ~F.isnan(F.col(c))
        cond = cond & p
    return df.where(cond)


def missing_share(df: DataFrame, cols: list[str]) -> DataFrame:
    """F6 data: one row per column with its share of missing values, from a
    single aggregate pass, then unpivoted to long form."""
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    long = agg.unpivot(["_n"], cols, "column_name", "n_missing")
    return long.select("column_name", F.col("n_missing").cast("long").alias("n_missing"),
                       F.col("_n").cast("long").alias("n_rows"),
                       (F.col("n_missing") / F.col("_n")).alias("missing_share"))


def sparse_columns(df: DataFrame, cols: list[str], threshold: float) -> list[str]:
    """names of columns whose missing share is above ``threshold``.
    One aggregate row comes back to the driver: its size is the column count."""
    row = missing_share(df, cols).where(F.col("missing_share") > threshold).select("column_name").collect()
    return [r[0] for r in row]


def drop_sparse_columns(df: DataFrame, cols: list[str], threshold: float) -> DataFrame:
    return df.drop(*sparse_columns(df, cols, threshold))


def missing_profile(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """missing count per group and column (long form)."""
    agg = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"),
                              *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return agg.unpivot(by + ["n_rows"], cols, "column_name", "n_missing")


def preview(df: DataFrame, order: list[str], n: int = 5) -> DataFrame:
    """F8: first rows in a defined order."""
    return df.orderBy(*order).limit(n)
