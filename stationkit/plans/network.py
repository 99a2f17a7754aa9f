"""Preparation of the network study's table (reference flow C).

Sentinels to null, per-station mean fill, neighbours' day t-3 attached to the
target's day t by a left join on shifted dates, incomplete rows dropped
(explicit predicates, so the outer joins become inner joins), targets = target measure 1..3 rows later in date order, last 3 rows cut,
then a chronological 80/20 split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HORIZONS, TRAIN_FRACTION, Config
from ..operators.clean import complete_rows, sentinel_to_null
from ..operators.impute import mean_impute
from ..operators.joins import join_series
from ..operators.rows import add_row_id, chronological_split
from ..operators.series_window import Ordering, shift_rows
from ..session import cut_lineage

TARGETS = [f"target_day{k}" for k in range(1, HORIZONS + 1)]


def network_table(obs: DataFrame, cfg: Config, target: str = "air_temp", lag_days: int = 3) -> DataFrame:
    m = list(cfg.measures)
    # missing values are the sentinel and null alike, before any mean is taken
    x = mean_impute(sentinel_to_null(obs, m, cfg.sentinel), m, by=[cfg.series_col])
    order = [cfg.target_series] + [s for s in cfg.series if s != cfg.target_series]
    offsets = {s: lag_days for s in order[1:]}
    wide = join_series(x, cfg.series_col, cfg.date_col, order, "left", cols=m, offsets=offsets)
    wide = complete_rows(wide)
    # one row per target day from here on: materialise it once so the
    # position and shift steps below read it instead of re-running the joins
    wide = cut_lineage(add_row_id(cut_lineage(wide), [cfg.date_col], "row_id"))
    o = Ordering(partition=(), order=("row_id",), mode="auto")
    tcol = f"{cfg.target_series}_{target}"
    wide = shift_rows(wide, [(f"target_day{k}", tcol, k) for k in range(1, HORIZONS + 1)], o)
    n = wide.count()
    wide = wide.where(F.col("row_id") < F.lit(n - HORIZONS))
    return chronological_split(wide, "row_id", TRAIN_FRACTION, n=n - HORIZONS)


def network_features(df: DataFrame, cfg: Config, target: str = "air_temp") -> list[str]:
    """X = every measure column except the target's own current value."""
    tcol = f"{cfg.target_series}_{target}"
    return [c for c in df.columns
            if c not in (cfg.date_col, "row_id", "split", tcol) and c not in TARGETS]
