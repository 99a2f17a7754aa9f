"""The older linear study end to end (reference flow D).

Rows from the cut-off date on; the three stations joined on the date with
suffixes on colliding names; targets 1..3 rows later in date order; last rows
trimmed; head-weighted fill; named columns dropped, the rest in name order;
correlation of the numeric columns; one shared hold-out split; one
least-squares model for each target three days ahead, with its errors.

The joined table is written once and positioned once: leads, trim and split
all go by that row id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CUTOFF_DATE, HORIZONS, OLDER_DROPPED, Config
from ..functions.rounding import round_doubles
from ..operators import clean as CL
from ..operators import joins as J
from ..operators import linear as LN
from ..operators import stats as ST
from ..operators.impute import head_weighted_fill
from ..operators.metrics import regression_metrics
from ..operators.rows import holdout_split
from ..operators.series_window import Ordering, resolve, shift_rows, with_position
from ..session import cut_lineage


def older_table(obs: DataFrame, cfg: Config, stations: tuple[str, str, str], since: str = CUTOFF_DATE) -> DataFrame:
    """The joined table with ``row_id``, leads, and its last rows trimmed."""
    raw = CL.cutoff_filter(obs, cfg.date_col, since)
    a, b, c = (raw.where(F.col(cfg.series_col) == s).drop(cfg.series_col) for s in stations)
    joined = J.suffix_join(J.suffix_join(a, b, cfg.date_col, ("_sch", "_arb")), c, cfg.date_col, ("_x", "_y"))
    joined = cut_lineage(joined, "older-joined")
    placed = with_position(joined, Ordering(partition=(), order=(cfg.date_col,)), "row_id", "_rows")
    placed = cut_lineage(placed, "older-rows")
    o = resolve(placed, Ordering(partition=(), order=("row_id",)))
    x = shift_rows(placed, [(cfg.future_name(t, k), t, k) for k in range(1, HORIZONS + 1)
                            for t in reversed(cfg.targets)], o)
    return x.where(F.col("row_id") < F.col("_rows") - HORIZONS).drop("_rows")


@dataclass
class OlderStudy:
    filled: DataFrame
    table: DataFrame
    correlation: DataFrame
    models: DataFrame
    metrics: DataFrame


def older_study(obs: DataFrame, cfg: Config, stations: tuple[str, str, str], dropped: tuple[str, ...] = OLDER_DROPPED,
                test_size: float = 0.2, seed: int = 0, places: int = 6) -> OlderStudy:
    t = cut_lineage(older_table(obs, cfg, stations), "older-table")
    cols = [c for c in t.columns if c not in (cfg.date_col, "row_id")]
    filled = cut_lineage(round_doubles(head_weighted_fill(t, cols, "row_id", cfg.sentinel), places), "older-filled")
    table = CL.sort_columns(CL.drop_columns(filled, list(dropped)))
    numeric = [c for c in CL.numeric_columns(table) if c != "row_id"]
    leads = [c for c in numeric if "_future_" in c]
    goals = {f"older_{tg}": cfg.future_name(tg, HORIZONS) for tg in cfg.targets}
    feats = [c for c in numeric if c not in leads]
    split = cut_lineage(holdout_split(table, "row_id", test_size, seed=seed), "older-split")
    models = cut_lineage(LN.ols_models(split, feats, goals, fit_filter=F.col("split") == "train"), "older-models")
    preds = LN.predict_all(split, models, feats, goals, ["split"])
    return OlderStudy(filled, table, ST.corr_long(table, numeric), models,
                      regression_metrics(preds, ["model_key", "split"], "y", "p"))
