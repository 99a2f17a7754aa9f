"""Time shifts (W1-W3, E7; the calendar shift P8 is ``clean.shift_dates``).

Row shifts go through :mod:`series_window`, so they are exact per series and
never cross a series boundary; date shifts are plain column arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from .series_window import Ordering, shift_rows, with_position


def ordering(cfg: Config, tiebreak: tuple[str, ...] | None = None, mode: str = "auto") -> Ordering:
    """Per-series order by date.  Rows sharing a date are ordered by their
    measure values (default ``tiebreak``), so the order is total and a
    recomputed task (after a lost executor) sees the same row order; fully
    identical rows are interchangeable."""
    tiebreak = tuple(cfg.measures) if tiebreak is None else tuple(tiebreak)
    return Ordering(partition=(cfg.series_col,), order=(cfg.date_col,) + tiebreak,
                    chunk_days=cfg.chunk_days, max_rows_per_task=cfg.max_rows_per_task, mode=mode)


def future_targets(df: DataFrame, cfg: Config, o: Ordering | None = None) -> DataFrame:
    """``{target}_future_{k}Day`` = value k rows later in the same series."""
    o = o or ordering(cfg)
    specs = [(cfg.future_name(t, k), t, k) for k in range(1, cfg.horizons + 1) for t in cfg.targets]
    return shift_rows(df, specs, o)


def past_features(df: DataFrame, cfg: Config, o: Ordering | None = None) -> DataFrame:
    """``{feature}_past_{k}Day`` = value k rows earlier in the same series."""
    o = o or ordering(cfg)
    specs = [(cfg.past_name(f, k), f, -k) for k in range(1, cfg.past_days + 1) for f in cfg.features]
    return shift_rows(df, specs, o)


def tail_trim(df: DataFrame, k: int, o: Ordering) -> DataFrame:
    """Drop the last ``k`` rows of every partition (``[:-k]``)."""
    pos, total = "_tt_pos", "_tt_n"
    while pos in df.columns or total in df.columns:
        pos, total = pos + "_", total + "_"
    return (with_position(df, o, pos, total).where(F.col(pos) < F.col(total) - k)
            .drop(pos, total))


def forecast_dates(df: DataFrame, date_col: str, horizons: int, o: Ordering) -> DataFrame:
    """The date a k-step forecast refers to = the date k rows later."""
    return shift_rows(df, [(f"date_day{k}", date_col, k) for k in range(1, horizons + 1)], o)
