"""The preparation job: long station table -> complete supervised table.

Order of steps (kept from the reference because results depend on it):
sentinel -> null, past/future row shifts, interpolation of the configured
measures, one pivot to the wide layout (the inner join of all series on the
date, in one grouped pass whatever their number), projection, drop incomplete rows.  Since the goals are shifted before the
interpolation, a goal that was missing stays missing and its row is dropped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..config import Config
from ..operators.clean import complete_rows, sentinel_to_null
from ..operators.impute import interpolate_linear
from ..operators.joins import pivot_with_shared
from ..operators.pair_tiles import nearest_by_tiles
from ..operators.series_window import resolve
from ..operators.shift import future_targets, ordering, past_features
from ..session import cut_lineage


def prepared_long(obs: DataFrame, cfg: Config, mode: str = "auto", every: bool = False,
                  counts: Observation | None = None) -> DataFrame:
    """Steps before the join, on the long table (one window pass per step,
    all sharing the per-series partitioning), for the configured series or for
    ``every`` one.  ``counts`` observes the rows of each configured series."""
    keep = [cfg.series_col, cfg.date_col] + list(cfg.measures)
    wanted = list(dict.fromkeys((cfg.target_series, *cfg.series)))
    x = obs.select(*keep).where(F.col(cfg.date_col).isNotNull())
    if not every:
        x = x.where(F.col(cfg.series_col).isin(wanted))
    if counts is not None:
        x = x.observe(counts, *[F.count_if(F.col(cfg.series_col) == s).alias(f"before_join_{s}") for s in cfg.series])
    x = sentinel_to_null(x, list(cfg.measures), cfg.sentinel)
    # pick the window strategy once (one aggregate over the wanted series)
    o = resolve(x, ordering(cfg, mode=mode))
    if cfg.past_days:
        x = past_features(x, cfg, o)
    x = future_targets(x, cfg, o)
    if cfg.interpolate:
        x = interpolate_linear(x, list(cfg.interpolate), o)
    return x


def supervised_table(obs: DataFrame, cfg: Config, mode: str = "auto",
                     complete: bool = True, counts: Observation | None = None) -> DataFrame:
    """Features (series x feature x past), goals (target x horizon), date."""
    x = prepared_long(obs, cfg, mode, counts=counts)
    feat_cols = list(cfg.features) + [cfg.past_name(f, k) for f in cfg.features
                                      for k in range(1, cfg.past_days + 1)]
    goal_cols = [cfg.future_name(t, k) for t in cfg.targets for k in range(1, cfg.horizons + 1)]
    # the goals count for the target series only: of the others they are null,
    # so the largest of a date is the target's
    is_target = F.col(cfg.series_col) == F.lit(cfg.target_series)
    x = x.withColumns({g: F.when(is_target, F.col(g)) for g in goal_cols})
    wide = pivot_with_shared(x, cfg.series_col, cfg.date_col,
                             list(dict.fromkeys((cfg.target_series, *cfg.series))), feat_cols,
                             {g: f"{cfg.target_series}_{g}" for g in goal_cols})
    proj = cfg.feature_columns() + cfg.goal_columns() + [cfg.date_col]
    out = wide.select(*proj)
    return complete_rows(out) if complete else out


def audited_table(obs: DataFrame, cfg: Config, mode: str = "auto") -> tuple[DataFrame, dict[str, int]]:
    """The supervised table, written once, and the rows at each stage (F9):
    before the join by series, after it, and complete.  The counts are observed
    by the job that writes the table; no stage is computed for its count.  (A
    shuffle stage that is run again after a lost executor counts its rows again.)"""
    before, after = Observation(), Observation()
    wide = supervised_table(obs, cfg, mode, complete=False, counts=before)
    whole = reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in wide.columns])
    wide = wide.observe(after, F.count(F.lit(1)).alias("after_join"), F.count_if(whole).alias("after_dropna"))
    table = cut_lineage(wide.where(whole), "audited")
    return table, {**before.get, **after.get}


def neighbours_of_every_series(obs: DataFrame, cfg: Config, k: int = 2, least_days: int = 30) -> DataFrame:
    """``col, near1..neark``: for each series the ``k`` others whose first target
    is best correlated with its own, over at least ``least_days`` common days."""
    x = sentinel_to_null(obs.select(cfg.series_col, cfg.date_col, cfg.targets[0]), [cfg.targets[0]], cfg.sentinel)
    return nearest_by_tiles(x, cfg.date_col, cfg.series_col, cfg.targets[0], k, least_days)


def supervised_long(obs: DataFrame, cfg: Config, near: DataFrame, mode: str = "auto") -> DataFrame:
    """The preparation job for every series as its own target: one row per
    series and date, its width bounded by the neighbours of ``near`` (``col,
    near1..neark``), whatever the number of series.  Columns: the series and its
    neighbours, the date, the features of each (``self_..``, ``near1_..``), the
    series' goals; rows in which one is missing are left out."""
    others = [c for c in near.columns if c != "col"]
    x = prepared_long(obs, cfg, mode, every=True)
    s, d = cfg.series_col, cfg.date_col
    feats = list(cfg.features) + [cfg.past_name(f, k) for f in cfg.features for k in range(1, cfg.past_days + 1)]
    goals = [cfg.future_name(t, k) for t in cfg.targets for k in range(1, cfg.horizons + 1)]
    out = x.select(s, d, *[F.col(f).alias(f"self_{f}") for f in feats], *goals).join(
        near.withColumnRenamed("col", s), s)
    for n in others:
        out = out.join(x.select(F.col(s).alias(n), d, *[F.col(f).alias(f"{n}_{f}") for f in feats]), [n, d])
    names = [f"{p}_{f}" for p in ("self", *others) for f in feats]
    return complete_rows(out.select(s, *others, d, *names, *goals))
