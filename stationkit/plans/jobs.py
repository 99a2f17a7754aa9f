"""End-to-end jobs, as a user of the reference runs them.

``preparation_job``: station CSV files -> complete supervised table ->
three aligned model tables, in date order and in a repeatable shuffled order
(the reference's batch script).  ``linear_study``: model tables ->
split-size sweep, its summaries, the best test size, and the final six
models fitted on a hold-out split and saved as a coefficient table
(the linear notebook).  Both read and write the shared folder only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SWEEP_ITERATIONS, SWEEP_TEST_SIZES, Config
from ..operators import linear as LN
from ..operators import rows as RW
from ..operators import stats as ST
from ..operators.joins import zip_tables
from ..session import cut_lineage
from ..sources.stations import read_model_tables, read_station_files, write_model_tables
from .supervised import supervised_table


def preparation_job(spark: SparkSession, stations_path: str, out_path: str, cfg: Config,
                    shuffle_seed: int = 0) -> dict[str, dict[str, str]]:
    """Returns the paths of the sorted and the shuffled model tables."""
    obs = read_station_files(spark, stations_path, cfg.series_col, cfg.date_col, series=list(cfg.series))
    sup = cut_lineage(RW.add_row_id(supervised_table(obs, cfg), [cfg.date_col]))
    feats, goals = cfg.feature_columns(), cfg.goal_columns()
    out = {"sorted": write_model_tables(sup, f"{out_path}/sorted", feats, goals, cfg.date_col)}
    shuffled = RW.shuffled_order(sup.withColumnRenamed("row_id", "_sorted_id"), "_sorted_id",
                                 shuffle_seed, "row_id").drop("_sorted_id")
    out["shuffled"] = write_model_tables(shuffled, f"{out_path}/shuffled", feats, goals, cfg.date_col)
    return out


@dataclass
class LinearStudy:
    sweep: DataFrame
    summary: DataFrame
    best: DataFrame
    models: DataFrame
    metrics: DataFrame


def linear_study(spark: SparkSession, tables: dict[str, str], cfg: Config, out_path: str,
                 final_test_size: float = 0.2, seed: int = 0) -> LinearStudy:
    t = read_model_tables(spark, tables)
    sup = cut_lineage(zip_tables(t["features"], t["goals"]))
    feats, goal_cols = cfg.feature_columns(), cfg.goal_columns()
    goals = [(k, tg, cfg.goal_name(tg, k)) for k in range(1, cfg.horizons + 1) for tg in cfg.targets]
    sweep = cut_lineage(LN.split_sweep(sup, "row_id", feats, goals, SWEEP_ITERATIONS, list(SWEEP_TEST_SIZES)))
    summary = ST.group_mean(sweep, ["test_size", "target"], {"mse_avg": "mse_test"})
    best = ST.arg_min(summary, "mse_avg", "test_size", ["test_size", "target"])
    split = cut_lineage(RW.holdout_split(sup, "row_id", final_test_size, seed=seed))
    keyed = {f"model_lag{k}_{tg}": cfg.goal_name(tg, k) for tg in cfg.targets for k in range(1, cfg.horizons + 1)}
    models = LN.ols_models(split, feats, keyed, fit_filter=F.col("split") == "train")
    models.write.mode("overwrite").parquet(f"{out_path}/models")  # M3: the model registry
    models = spark.read.parquet(f"{out_path}/models")
    preds = LN.predict_all(split, models, feats, keyed, ["split"])
    from ..operators.metrics import regression_metrics
    metrics = regression_metrics(preds, ["model_key", "split"], "y", "p")
    return LinearStudy(sweep, summary, best, models, metrics)


@dataclass
class StatisticsReport:
    goal_series: DataFrame
    corr_to_goals: DataFrame
    histograms: DataFrame


def statistics_report(spark: SparkSession, tables: dict[str, str], cfg: Config,
                      hist_cols: list[str] | None = None, bins: int = 100) -> StatisticsReport:
    """The statistics notebook: goal series by date in long form, the
    correlation of every feature and goal with the goals, histograms."""
    t = read_model_tables(spark, tables)
    data = cut_lineage(zip_tables(zip_tables(t["features"], t["goals"]), t["timings"]))
    feats, goals = cfg.feature_columns(), cfg.goal_columns()
    hist_cols = hist_cols or [f"{cfg.target_series}_{m}" for m in cfg.targets]
    return StatisticsReport(
        goal_series=ST.goal_series_long(data, cfg.date_col, goals, cfg.targets),
        corr_to_goals=ST.corr_long(data, feats + goals, goals),
        histograms=ST.histogram(data, hist_cols, bins))


@dataclass
class NetworkStudy:
    table: DataFrame
    metrics: DataFrame
    scores: DataFrame


def network_study(spark: SparkSession, stations_path: str, cfg: Config, seed: int = 0) -> NetworkStudy:
    """The network study re-aimed: the lagged table with a chronological
    80/20 split, one least-squares model per horizon (shared X, one Gram
    pass) with train/test metrics, and dense-network scores of every row
    with given weights, labelled with the dates they forecast."""
    from ..config import DENSE_LAYERS, HORIZONS
    from ..operators.metrics import regression_metrics
    from ..operators.models import dense_score, dense_weights
    from ..operators.series_window import Ordering
    from ..operators.shift import forecast_dates
    from .network import TARGETS, network_features, network_table

    obs = read_station_files(spark, stations_path, cfg.series_col, cfg.date_col, series=list(cfg.series))
    table = cut_lineage(network_table(obs, cfg))
    feats = network_features(table, cfg)
    goals = {f"horizon_{k}": c for k, c in enumerate(TARGETS, start=1)}
    models = cut_lineage(LN.ols_models(table, feats, goals, fit_filter=F.col("split") == "train"))
    preds = LN.predict_all(table, models, feats, goals, ["split"])
    metrics = regression_metrics(preds, ["model_key", "split"], "y", "p")
    scores = dense_score(table, feats, ["row_id", cfg.date_col, "split"],
                         dense_weights(len(feats), DENSE_LAYERS, seed),
                         [f"pred_day{k}" for k in range(1, HORIZONS + 1)])
    o = Ordering(partition=(), order=("row_id",))
    scores = forecast_dates(scores, cfg.date_col, HORIZONS, o)
    return NetworkStudy(table, metrics, scores)
