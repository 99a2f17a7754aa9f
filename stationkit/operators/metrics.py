"""Evaluation tables (E1-E6), all single grouped aggregates or narrow maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stats import exact_quantile


def _r2(y: Column, p: Column) -> Column:
    """1 - SSE/SST around the group's own mean; may be negative.
    Constant y: 1 when the fit is exact, else 0 (as scikit-learn)."""
    sse = F.sum(F.pow(y - p, 2))
    sst = F.count(y) * F.var_pop(y)
    return F.when(sst == 0, F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))) \
        .otherwise(F.lit(1.0) - F.try_divide(sse, sst))


def regression_metrics(df: DataFrame, by: list[str], y: str, p: str) -> DataFrame:
    """N, MSE, RMSE and R^2 per group."""
    yc, pc = F.col(y), F.col(p)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.pow(yc - pc, 2)).alias("mse"),
        F.sqrt(F.avg(F.pow(yc - pc, 2))).alias("rmse"),
        _r2(yc, pc).alias("r2"))


def penalised_mse(df: DataFrame, by: list[str], y: str, p: str, factor: float = 10.0) -> DataFrame:
    """Squared error times ``factor`` where the prediction is negative."""
    se = F.pow(F.col(y) - F.col(p), 2)
    return df.groupBy(*by).agg(
        F.avg(F.when(F.col(p) < 0, F.lit(factor) * se).otherwise(se)).alias("penalised_mse"),
        F.avg(se).alias("mse"),
        F.count_if(F.col(p) < 0).alias("n_negative"))


def error_outliers(df: DataFrame, y: str, p: str, q: float = 0.95) -> DataFrame:
    """E5 + A9: rows whose absolute error is above the q-quantile of all
    absolute errors (exact, linear interpolation)."""
    x = df.withColumn("abs_error", F.abs(F.col(p) - F.col(y)))
    thr = exact_quantile(x, "abs_error", q)
    return x.where(F.col("abs_error") > F.lit(thr)).withColumn("threshold", F.lit(thr))


def actual_vs_predicted(df: DataFrame, y: str, p: str, xlim: tuple[float, float],
                        ylim: tuple[float, float]) -> DataFrame:
    """Pairs with a flag telling whether the point lies in the plot box."""
    inside = (F.col(y).between(xlim[0], xlim[1]) & F.col(p).between(ylim[0], ylim[1]))
    return df.withColumn("in_range", inside)
