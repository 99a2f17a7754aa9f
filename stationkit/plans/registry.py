"""Registered queries: name -> (Spark builder, DuckDB oracle SQL or None).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame computed from
the driver tables (through the station stand-in of ``sources/fixtures``).
Doubles are rounded on both sides (6 places unless stated).
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CUTOFF_DATE, DEFAULT as C, HIST_BINS, OLDER_DROPPED, PLOT_BOXES, STRIDE, TRAIN_FRACTION, Config
from ..functions.rounding import round_doubles
from ..operators import clean as CL
from ..operators import impute as IM
from ..operators import joins as J
from ..operators import rows as RW
from ..operators import shift as SH
from ..operators import stats as ST
from ..session import cut_lineage
from ..sources.fixtures import EVENT_SERIES_CTE, event_series, station_obs, stored
from . import sqltext as Q
from .supervised import audited_table, supervised_table

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}

M = list(C.measures)
GOALS = C.goal_columns()
FEATS = C.feature_columns()


def register(name: str, oracle: str | None = None):
    def deco(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _clean(spark: SparkSession, sf: str, many: bool = False) -> DataFrame:
    return CL.sentinel_to_null(station_obs(spark, sf, many), M, C.sentinel)


def _sup(spark: SparkSession, sf: str) -> DataFrame:
    return supervised_table(station_obs(spark, sf), C)


def _sup_rowid(spark: SparkSession, sf: str) -> DataFrame:
    """The model table handed from the preparation job to the studies:
    supervised rows with their position by date.  It is written once per
    application to the shared folder, as the reference's preparation script
    writes the files its notebooks read, and the studies read it from there."""
    # one row per date: yearly chunks hold at most 366 rows, so the global
    # position needs no sizing pass
    return stored(spark, sf, "model-table", lambda: build_model_table(spark, sf))


def build_model_table(spark: SparkSession, sf: str) -> DataFrame:
    """The model table computed from the station table (not from the stored one)."""
    return RW.add_row_id(_sup(spark, sf), ["obs_date"], mode="chunked")


W_SERIES = "WINDOW w AS (PARTITION BY series_id ORDER BY obs_date)"

# ---------------------------------------------------------------------------
# flagship and projections
# ---------------------------------------------------------------------------


@register("supervised_table", Q.supervised_sql())
def q_supervised_table(spark, sf):
    return round_doubles(_sup(spark, sf))


_MANY_CFG = Config(series=("2", "3", "1"), target_series="1")


@register("supervised_table_three", Q.supervised_sql_for(_MANY_CFG, many=True))
def q_supervised_table_three(spark, sf):
    """The preparation job on the 1,000-series table: supplier 1 as the
    target, suppliers 2 and 3 as neighbours.  The series filters of the
    slices are pushed below the per-series windows."""
    return round_doubles(supervised_table(station_obs(spark, sf, many=True), _MANY_CFG))


@register("supervised_projection", Q.supervised_sql(complete=False))
def q_supervised_projection(spark, sf):
    return round_doubles(supervised_table(station_obs(spark, sf), C, complete=False))


# ---------------------------------------------------------------------------
# sources, cleaning, filters
# ---------------------------------------------------------------------------


@register("sentinel_to_null", Q.with_ctes(Q.clean_cte()) + f"SELECT {Q.sel(['series_id', 'obs_date'] + M)} FROM clean")
def q_sentinel_to_null(spark, sf):
    return round_doubles(_clean(spark, sf))


@register("cutoff_filter", Q.with_ctes(Q.clean_cte()) +
          f"SELECT {Q.sel(['series_id', 'obs_date'] + M)} FROM clean WHERE obs_date >= DATE '{CUTOFF_DATE}'")
def q_cutoff_filter(spark, sf):
    return round_doubles(CL.cutoff_filter(_clean(spark, sf), "obs_date", CUTOFF_DATE))


@register("complete_rows", Q.with_ctes(Q.clean_cte()) +
          f"SELECT {Q.sel(['series_id', 'obs_date'] + M)} FROM clean WHERE " +
          " AND ".join(f"{m} IS NOT NULL" for m in M))
def q_complete_rows(spark, sf):
    return round_doubles(CL.complete_rows(_clean(spark, sf)))


@register("drop_sentinel_rows", Q.obs_only() +
          f"SELECT {Q.sel(['series_id', 'obs_date'] + M)} FROM obs WHERE " +
          " AND ".join(f"{m} <> -999" for m in M))
def q_drop_sentinel_rows(spark, sf):
    """rows holding a sentinel anywhere are dropped (sentinel -> null, then
    complete rows)."""
    return round_doubles(CL.complete_rows(CL.sentinel_to_null(station_obs(spark, sf), M, C.sentinel)))


@register("date_roundtrip", Q.with_ctes(Q.clean_cte()) +
          "SELECT series_id, obs_date, strftime(obs_date, '%d.%m.%Y') AS date_text, "
          "CAST(strptime(strftime(obs_date, '%d.%m.%Y'), '%d.%m.%Y') AS DATE) AS parsed_date FROM clean")
def q_date_roundtrip(spark, sf):
    x = _clean(spark, sf).select("series_id", "obs_date", CL.format_date("obs_date").alias("date_text"))
    return x.withColumn("parsed_date", CL.parse_date("date_text"))


@register("missing_profile", Q.with_ctes(Q.clean_cte()) + " UNION ALL ".join(
    f"SELECT series_id, CAST(COUNT(*) AS BIGINT) AS n_rows, '{m}' AS column_name, "
    f"CAST(SUM(CASE WHEN {m} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing FROM clean GROUP BY series_id"
    for m in M))
def q_missing_profile(spark, sf):
    return CL.missing_profile(_clean(spark, sf), ["series_id"], M).withColumn(
        "n_missing", F.col("n_missing").cast("long"))


_WIDE_COLS = [f"{s}_{m}" for s in ("R", "N", "A") for m in M]
_WIDE_SQL = ("wide3 AS (SELECT r.obs_date AS obs_date, " +
             ", ".join(f"{a}.{m} AS {s}_{m}" for s, a in (("R", "r"), ("N", "n"), ("A", "a")) for m in M) +
             " FROM (SELECT * FROM clean WHERE series_id = 'R') r"
             " JOIN (SELECT * FROM clean WHERE series_id = 'N') n ON r.obs_date = n.obs_date"
             " JOIN (SELECT * FROM clean WHERE series_id = 'A') a ON r.obs_date = a.obs_date)")


def _wide3(spark, sf):
    return J.join_series(_clean(spark, sf), "series_id", "obs_date", ["R", "N", "A"], "inner", cols=M)


@register("sparse_column_report", Q.with_ctes(Q.clean_cte(), _WIDE_SQL) + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_missing, "
    f"CAST(COUNT(*) AS BIGINT) AS n_rows, "
    f"ROUND(CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*), 6) AS missing_share "
    f"FROM wide3" for c in _WIDE_COLS))
def q_sparse_column_report(spark, sf):
    return round_doubles(CL.missing_share(_wide3(spark, sf), _WIDE_COLS))


@register("row_audit", Q.with_ctes(*Q.supervised_ctes()) +
          "SELECT 'before_join_' || series_id AS stage, CAST(COUNT(*) AS BIGINT) AS n_rows FROM clean GROUP BY series_id"
          " UNION ALL SELECT 'after_join', CAST(COUNT(*) AS BIGINT) FROM wide"
          " UNION ALL SELECT 'after_dropna', CAST(COUNT(*) AS BIGINT) FROM sup")
def q_row_audit(spark, sf):
    """the counts are observed by the job that writes the table."""
    _, counts = audited_table(station_obs(spark, sf), C)
    return spark.createDataFrame(sorted(counts.items()), "stage string, n_rows long")


# ---------------------------------------------------------------------------
# joins and column naming
# ---------------------------------------------------------------------------


@register("station_inner_join", Q.with_ctes(Q.clean_cte(), _WIDE_SQL) +
          f"SELECT {Q.sel(['obs_date'] + _WIDE_COLS)} FROM wide3")
def q_station_inner_join(spark, sf):
    return round_doubles(_wide3(spark, sf))


@register("station_pivot_join", Q.with_ctes(Q.clean_cte(), _WIDE_SQL) +
          f"SELECT {Q.sel(['obs_date'] + _WIDE_COLS)} FROM wide3")
def q_station_pivot_join(spark, sf):
    """J1 as one grouped pivot (one shuffle by date for any number of series)."""
    return round_doubles(J.pivot_series(_clean(spark, sf), "series_id", "obs_date", ["R", "N", "A"], M))


@register("prefixed_wide", Q.with_ctes(Q.clean_cte()) +
          "SELECT obs_date, " + ", ".join(f"ROUND({m}, 6) AS R_{m}" for m in M) +
          " FROM clean WHERE series_id = 'R'")
def q_prefixed_wide(spark, sf):
    x = _clean(spark, sf).where(F.col("series_id") == "R").drop("series_id")
    return round_doubles(CL.prefix_columns(x, "R_", keep=("obs_date",)))


@register("lagged_left_join", Q.with_ctes(Q.clean_cte()) +
          "SELECT r.obs_date AS obs_date, " +
          ", ".join(f"ROUND({a}.{m}, 6) AS {s}_{m}" for s, a in (("R", "r"), ("A", "a"), ("N", "n")) for m in M) +
          " FROM (SELECT * FROM clean WHERE series_id = 'R') r"
          " LEFT JOIN (SELECT CAST(obs_date + INTERVAL 3 DAY AS DATE) AS d3, * FROM clean WHERE series_id = 'A') a"
          " ON r.obs_date = a.d3"
          " LEFT JOIN (SELECT CAST(obs_date + INTERVAL 3 DAY AS DATE) AS d3, * FROM clean WHERE series_id = 'N') n"
          " ON r.obs_date = n.d3")
def q_lagged_left_join(spark, sf):
    x = J.join_series(_clean(spark, sf), "series_id", "obs_date", ["R", "A", "N"], "left",
                      cols=M, offsets={"A": 3, "N": 3})
    return round_doubles(x)


_SUFFIX_COLS = ([f"{m}_sch" for m in M] + [f"{m}_arb" for m in M] + M)


@register("suffix_join", Q.with_ctes(Q.clean_cte()) +
          "SELECT s.obs_date AS obs_date, " +
          ", ".join([f"ROUND(s.{m}, 6) AS {m}_sch" for m in M] + [f"ROUND(a.{m}, 6) AS {m}_arb" for m in M] +
                    [f"ROUND(r.{m}, 6) AS {m}" for m in M]) +
          " FROM (SELECT * FROM clean WHERE series_id = 'N') s"
          " JOIN (SELECT * FROM clean WHERE series_id = 'A') a ON s.obs_date = a.obs_date"
          " JOIN (SELECT * FROM clean WHERE series_id = 'R') r ON s.obs_date = r.obs_date")
def q_suffix_join(spark, sf):
    c = _clean(spark, sf)
    part = {s: c.where(F.col("series_id") == s).drop("series_id") for s in ("N", "A", "R")}
    x = J.suffix_join(part["N"], part["A"], "obs_date", ("_sch", "_arb"))
    x = J.suffix_join(x, part["R"], "obs_date", ("_x", "_y"))
    return round_doubles(x)


# ---------------------------------------------------------------------------
# shifts and fills (per series)
# ---------------------------------------------------------------------------

_FUT = [f"{t}_future_{k}Day" for k in range(1, C.horizons + 1) for t in C.targets]


@register("future_targets", Q.with_ctes(Q.clean_cte(), Q.future_cte("clean", "f")) +
          f"SELECT {Q.sel(['series_id', 'obs_date'] + M + _FUT)} FROM f")
def q_future_targets(spark, sf):
    return round_doubles(SH.future_targets(_clean(spark, sf), C))


_CP2 = Config(past_days=2)
_PAST = [f"{f}_past_{k}Day" for k in range(1, 3) for f in C.features]


@register("past_features", Q.with_ctes(Q.clean_cte()) +
          "SELECT " + Q.sel(["series_id", "obs_date"] + M) + ", " +
          ", ".join(f"ROUND(LAG({f}, {k}) OVER w, 6) AS {f}_past_{k}Day" for k in range(1, 3) for f in C.features) +
          f" FROM clean {W_SERIES}")
def q_past_features(spark, sf):
    return round_doubles(SH.past_features(_clean(spark, sf), _CP2))


@register("tail_trim", Q.with_ctes(Q.clean_cte()) +
          f"SELECT {Q.sel(['series_id', 'obs_date'] + M)} FROM (SELECT *, ROW_NUMBER() OVER "
          "(PARTITION BY series_id ORDER BY obs_date DESC) AS rr FROM clean) t WHERE rr > 3")
def q_tail_trim(spark, sf):
    return round_doubles(SH.tail_trim(_clean(spark, sf), C.horizons, SH.ordering(C)))


_IP = ["air_temp", "precip", "vapor_pressure"]


def _interp_sql(many: bool = False) -> str:
    ctes = [Q.clean_cte()]
    src = "clean"
    for i, c in enumerate(_IP):
        others = ["series_id", "obs_date"] + [m for m in M if m != c]
        ctes.append(Q.interp_cte(src, f"ip{i}", c, others))
        src = f"ip{i}"
    return Q.with_ctes(*ctes, many=many) + f"SELECT {Q.sel(['series_id', 'obs_date'] + M)} FROM {src}"


@register("interpolate_linear", _interp_sql())
def q_interpolate_linear(spark, sf):
    return round_doubles(IM.interpolate_linear(_clean(spark, sf), _IP, SH.ordering(C)))


@register("interpolate_many", _interp_sql(many=True))
def q_interpolate_many(spark, sf):
    return round_doubles(IM.interpolate_linear(_clean(spark, sf, many=True), _IP, SH.ordering(C)))


# the skew-safe strategy, forced with 30-day chunks, checked against the same SQL
_CHUNKED = Config(chunk_days=30)


@register("interpolate_chunked", _interp_sql())
def q_interpolate_chunked(spark, sf):
    o = SH.ordering(_CHUNKED, mode="chunked")
    return round_doubles(IM.interpolate_linear(_clean(spark, sf), _IP, o))


@register("interpolate_many_chunked", _interp_sql(many=True))
def q_interpolate_many_chunked(spark, sf):
    o = SH.ordering(_CHUNKED, mode="chunked")
    return round_doubles(IM.interpolate_linear(_clean(spark, sf, many=True), _IP, o))


@register("future_targets_many", Q.with_ctes(Q.clean_cte(), Q.future_cte("clean", "f"), many=True) +
          f"SELECT {Q.sel(['series_id', 'obs_date'] + M + _FUT)} FROM f")
def q_future_targets_many(spark, sf):
    return round_doubles(SH.future_targets(_clean(spark, sf, many=True), C))


@register("future_targets_chunked", Q.with_ctes(Q.clean_cte(), Q.future_cte("clean", "f"), many=True) +
          f"SELECT {Q.sel(['series_id', 'obs_date'] + M + _FUT)} FROM f")
def q_future_targets_chunked(spark, sf):
    return round_doubles(SH.future_targets(_clean(spark, sf, many=True), C,
                                           SH.ordering(_CHUNKED, mode="chunked")))


@register("past_features_chunked", Q.with_ctes(Q.clean_cte()) +
          "SELECT " + Q.sel(["series_id", "obs_date"] + M) + ", " +
          ", ".join(f"ROUND(LAG({f}, {k}) OVER w, 6) AS {f}_past_{k}Day" for k in range(1, 3) for f in C.features) +
          f" FROM clean {W_SERIES}")
def q_past_features_chunked(spark, sf):
    cfg = Config(past_days=2, chunk_days=30)
    return round_doubles(SH.past_features(_clean(spark, sf), cfg, SH.ordering(cfg, mode="chunked")))


@register("supervised_table_chunked", Q.supervised_sql())
def q_supervised_table_chunked(spark, sf):
    return round_doubles(supervised_table(station_obs(spark, sf), _CHUNKED, mode="chunked"))


def _lw_sql(many: bool = False) -> str:
    cols = ["air_temp", "precip"]
    parts = []
    for c in cols:
        num, den = "0.0", "0.0"
        for k in range(-5, 6):
            if k == 0:
                continue
            v = f"LAG({c}, {-k}) OVER w" if k < 0 else f"LEAD({c}, {k}) OVER w"
            w = repr(math.exp(-0.1 * abs(k)))
            num = f"({num} + COALESCE({v} * {w}, 0.0))"
            den = f"({den} + CASE WHEN {v} IS NOT NULL THEN {w} ELSE 0.0 END)"
        parts.append(f"ROUND(CASE WHEN {c} IS NOT NULL THEN {c} WHEN {den} > 0 THEN {num} / {den} END, 6) AS {c}")
    rest = [m for m in M if m not in cols]
    return (Q.with_ctes(Q.clean_cte(), many=many) + "SELECT series_id, obs_date, " + ", ".join(parts) + ", " +
            Q.sel(rest) + f" FROM clean {W_SERIES}")


@register("local_weighted_fill", _lw_sql())
def q_local_weighted_fill(spark, sf):
    return round_doubles(IM.local_weighted_fill(_clean(spark, sf), ["air_temp", "precip"], SH.ordering(C)))


@register("local_weighted_fill_many", _lw_sql(many=True))
def q_local_weighted_fill_many(spark, sf):
    return round_doubles(IM.local_weighted_fill(_clean(spark, sf, many=True), ["air_temp", "precip"],
                                                SH.ordering(C)))


@register("mean_impute_many", Q.with_ctes(Q.clean_cte(), many=True) + "SELECT series_id, obs_date, " +
          ", ".join(f"ROUND(COALESCE({m}, AVG({m}) OVER (PARTITION BY series_id)), 6) AS {m}" for m in M) +
          " FROM clean")
def q_mean_impute_many(spark, sf):
    return round_doubles(IM.mean_impute(_clean(spark, sf, many=True), M, by=["series_id"]))


@register("mean_impute", Q.with_ctes(Q.clean_cte()) + "SELECT series_id, obs_date, " +
          ", ".join(f"ROUND(COALESCE({m}, AVG({m}) OVER (PARTITION BY series_id)), 6) AS {m}" for m in M) +
          " FROM clean")
def q_mean_impute(spark, sf):
    return round_doubles(IM.mean_impute(_clean(spark, sf), M, by=["series_id"]))


@register("sentinel_mean_impute", Q.with_ctes("mn AS (SELECT " + ", ".join(
    f"AVG(CASE WHEN {m} <> -999 THEN {m} END) AS m_{m}" for m in M) + " FROM obs)") +
    "SELECT series_id, obs_date, " + ", ".join(
    f"ROUND(CASE WHEN {m} = -999 THEN m_{m} ELSE {m} END, 6) AS {m}" for m in M) + " FROM obs, mn")
def q_sentinel_mean_impute(spark, sf):
    return round_doubles(IM.sentinel_mean_impute(station_obs(spark, sf), M, C.sentinel))


@register("minmax_scale", Q.with_ctes(Q.clean_cte(), "mm AS (SELECT " + ", ".join(
    f"MIN({m}) AS lo_{m}, MAX({m}) AS hi_{m}" for m in M) + " FROM clean)") +
    "SELECT series_id, obs_date, " + ", ".join(
    f"ROUND(CASE WHEN hi_{m} = lo_{m} THEN CASE WHEN {m} IS NOT NULL THEN 0.0 END "
    f"ELSE ({m} - lo_{m}) / (hi_{m} - lo_{m}) END, 6) AS {m}" for m in M) + " FROM clean, mm")
def q_minmax_scale(spark, sf):
    return round_doubles(IM.minmax_scale(_clean(spark, sf), M))


# ---------------------------------------------------------------------------
# rows: order, sample, splits
# ---------------------------------------------------------------------------

_SUP_ROWID = Q.with_ctes(*Q.supervised_ctes(), Q.sup_rowid_cte())


@register("sorted_rows", _SUP_ROWID + f"SELECT row_id, {Q.sel(['obs_date'] + GOALS)} FROM supr")
def q_sorted_rows(spark, sf):
    return round_doubles(_sup_rowid(spark, sf).select("row_id", "obs_date", *GOALS))


@register("stride_sample", _SUP_ROWID + f"SELECT row_id, {Q.sel(['obs_date'] + GOALS)} FROM supr "
          f"WHERE row_id % {STRIDE} = 0")
def q_stride_sample(spark, sf):
    x = RW.stride_sample(_sup_rowid(spark, sf), "row_id", STRIDE)
    return round_doubles(x.select("row_id", "obs_date", *GOALS))


@register("holdout_split", _SUP_ROWID +
          f"SELECT row_id, obs_date, CASE WHEN ROW_NUMBER() OVER (ORDER BY {Q.hash_sql(0, 'row_id')}, row_id) "
          "<= CEIL(CAST(0.2 AS DOUBLE) * COUNT(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM supr")
def q_holdout_split(spark, sf):
    x = _sup_rowid(spark, sf).select("row_id", "obs_date")
    return RW.holdout_split(x, "row_id", 0.2, seed=0)


@register("chronological_split", _SUP_ROWID +
          f"SELECT row_id, obs_date, CASE WHEN row_id < FLOOR(CAST({TRAIN_FRACTION} AS DOUBLE) * COUNT(*) OVER ()) "
          "THEN 'train' ELSE 'test' END AS split FROM supr")
def q_chronological_split(spark, sf):
    """O6 from the rows per day, beside each row's position."""
    x = _sup_rowid(spark, sf).select("row_id", "obs_date")
    return RW.chronological_split_by_day(x, "obs_date", TRAIN_FRACTION, ["row_id"])


@register("forecast_dates", _SUP_ROWID + "SELECT row_id, obs_date, " + ", ".join(
    f"LEAD(obs_date, {k}) OVER (ORDER BY row_id) AS date_day{k}" for k in range(1, 4)) + " FROM supr")
def q_forecast_dates(spark, sf):
    x = _sup_rowid(spark, sf).select("row_id", "obs_date")
    from ..operators.series_window import Ordering
    o = Ordering(partition=(), order=("row_id",), mode="auto")
    return SH.forecast_dates(x, "obs_date", C.horizons, o)


@register("preview_rows", Q.with_ctes(*Q.supervised_ctes()) +
          f"SELECT {Q.sel(['obs_date'] + GOALS)} FROM sup ORDER BY obs_date LIMIT 5")
def q_preview_rows(spark, sf):
    return round_doubles(CL.preview(_sup_rowid(spark, sf).select("obs_date", *GOALS), ["obs_date"], 5))


# ---------------------------------------------------------------------------
# statistics
# ---------------------------------------------------------------------------


def _corr_sql(a: str, b: str) -> str:
    a2 = f"CASE WHEN {b} IS NOT NULL THEN {a} END"
    b2 = f"CASE WHEN {a} IS NOT NULL THEN {b} END"
    den = f"SQRT(VAR_POP({a2}) * VAR_POP({b2}))"
    return (f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
            f"ROUND(COVAR_POP({a}, {b}) / CASE WHEN {den} > 0 THEN {den} END, 6) AS corr, "
            f"CAST(SUM(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS n_pairs")


@register("corr_matrix", Q.with_ctes(Q.clean_cte(), _WIDE_SQL) + " UNION ALL ".join(
    _corr_sql(a, b) + " FROM wide3" for i, a in enumerate(_WIDE_COLS) for b in _WIDE_COLS[i:]))
def q_corr_matrix(spark, sf):
    return round_doubles(ST.corr_long(_wide3(spark, sf), _WIDE_COLS))


@register("corr_measures_many", Q.with_ctes(Q.clean_cte(), many=True) + " UNION ALL ".join(
    _corr_sql(a, b) + " FROM clean" for i, a in enumerate(M) for b in M[i:]))
def q_corr_measures_many(spark, sf):
    """A1 on the long many-series table: the measures' pairwise correlation
    over every series-day (pairwise deletion of missing values)."""
    return round_doubles(ST.corr_long(_clean(spark, sf, many=True), M))


@register("corr_to_targets", Q.with_ctes(*Q.supervised_ctes()) + " UNION ALL ".join(
    _corr_sql(a, b) + " FROM sup" for a in FEATS + GOALS for b in GOALS))
def q_corr_to_targets(spark, sf):
    return round_doubles(ST.corr_long(_sup_rowid(spark, sf), FEATS + GOALS, GOALS))


_HIST_COLS = ["R_air_temp", "R_precip"]


def _hist_sql() -> str:
    parts = []
    for c in _HIST_COLS:
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(CASE WHEN hi = lo THEN 0 ELSE LEAST(FLOOR(({c} - lo) / ((hi - lo) / 100.0)), "
            f"{HIST_BINS - 1}) END AS INTEGER) AS bin FROM sup, (SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM sup) b "
            f"WHERE {c} IS NOT NULL")
    bounds = " UNION ALL ".join(f"SELECT '{c}' AS column_name, MIN({c}) AS lo, MAX({c}) AS hi FROM sup"
                                for c in _HIST_COLS)
    return (Q.with_ctes(*Q.supervised_ctes(), "hb AS (" + " UNION ALL ".join(parts) + ")",
                        "bd AS (" + bounds + ")") +
            "SELECT g.column_name, CAST(g.bin AS INTEGER) AS bin, "
            "ROUND(bd.lo + g.bin * ((bd.hi - bd.lo) / 100.0), 6) AS lo, "
            "ROUND(bd.lo + (g.bin + 1) * ((bd.hi - bd.lo) / 100.0), 6) AS hi, "
            "CAST(COALESCE(c.n, 0) AS BIGINT) AS n "
            f"FROM (SELECT column_name, CAST(b AS INTEGER) AS bin FROM bd, range(0, {HIST_BINS}) t(b)) g "
            "JOIN bd ON g.column_name = bd.column_name "
            "LEFT JOIN (SELECT column_name, bin, COUNT(*) AS n FROM hb GROUP BY 1, 2) c "
            "ON g.column_name = c.column_name AND g.bin = c.bin")


@register("histogram_100", _hist_sql())
def q_histogram_100(spark, sf):
    # bounds and bin counts are two passes over the written model table
    return round_doubles(ST.histogram(_sup_rowid(spark, sf), _HIST_COLS, HIST_BINS))


@register("goal_series_long", Q.with_ctes(*Q.supervised_ctes()) + " UNION ALL ".join(
    f"SELECT obs_date, '{g}' AS goal, '{t}' AS target, {k} AS horizon, ROUND({g}, 6) AS value FROM sup"
    for t in C.targets for k in range(1, C.horizons + 1) for g in [C.goal_name(t, k)]))
def q_goal_series_long(spark, sf):
    return round_doubles(ST.goal_series_long(_sup_rowid(spark, sf), "obs_date", GOALS))


# ---------------------------------------------------------------------------
# sources and sinks (files written under the shared checkpoint folder)
# ---------------------------------------------------------------------------

from ..operators import linear as LN  # noqa: E402
from ..operators import metrics as MT  # noqa: E402
from ..operators import models as MD  # noqa: E402
from ..session import cut_lineage, ensure_checkpoint_dir, scratch_path  # noqa: E402
from ..sources import stations as SS  # noqa: E402
from .network import TARGETS as NN_TARGETS, network_features, network_table  # noqa: E402


@register("read_stations", Q.obs_only() +
          f"SELECT {Q.sel(['series_id', 'obs_date'] + M)} FROM obs")
def q_read_stations(spark, sf):
    path = scratch_path(spark, "stations")
    SS.write_station_files(station_obs(spark, sf), path)
    return round_doubles(SS.read_station_files(spark, path))


def _model_tables(spark, sf, shuffled: bool):
    sup = _sup_rowid(spark, sf)
    if shuffled:
        sup = RW.shuffled_order(sup.withColumnRenamed("row_id", "sorted_id"), "sorted_id", 7, "row_id") \
            .drop("sorted_id")
    paths = SS.write_model_tables(sup, scratch_path(spark, "model_tables"), FEATS, GOALS, "obs_date")
    return SS.read_model_tables(spark, paths)


def _zip3(t):
    return J.zip_tables(J.zip_tables(t["features"], t["goals"]), t["timings"])


_SUP_ALL = ["row_id"] + FEATS + GOALS + ["obs_date"]


@register("model_tables_sorted", _SUP_ROWID + f"SELECT {Q.sel(_SUP_ALL, keep=('row_id', 'obs_date'))} FROM supr")
def q_model_tables_sorted(spark, sf):
    return round_doubles(_zip3(_model_tables(spark, sf, False)))


@register("model_tables_shuffled", _SUP_ROWID + "SELECT " +
          Q.sel(FEATS + GOALS + ["obs_date"]) +
          f", ROW_NUMBER() OVER (ORDER BY {Q.hash_sql(7, 'row_id')}, row_id) - 1 AS row_id FROM supr")
def q_model_tables_shuffled(spark, sf):
    return round_doubles(_zip3(_model_tables(spark, sf, True)))


@register("zip_model_tables", _SUP_ROWID + f"SELECT row_id, {Q.sel(['obs_date'] + GOALS)} FROM supr")
def q_zip_model_tables(spark, sf):
    t = _model_tables(spark, sf, True)
    y = J.zip_tables(t["goals"], t["timings"])  # J3: align on the shared row id
    y = y.withColumnRenamed("row_id", "shuffled_id")
    y = RW.add_row_id(y, ["obs_date", "shuffled_id"], "row_id")  # J4: reorder by the dates
    return round_doubles(y.select("row_id", "obs_date", *GOALS))


# ---------------------------------------------------------------------------
# least squares
# ---------------------------------------------------------------------------

_GRAM_TERMS = ["1"] + FEATS + GOALS


def _gram_sql() -> str:
    parts = []
    for i, a in enumerate(_GRAM_TERMS):
        for b in _GRAM_TERMS[i:]:
            ea = "1.0" if a == "1" else a
            eb = "1.0" if b == "1" else b
            parts.append(f"SELECT '{a}' AS term_a, '{b}' AS term_b, ROUND(SUM({ea} * {eb}), 2) AS value FROM sup")
    return Q.with_ctes(*Q.supervised_ctes()) + " UNION ALL ".join(parts)


@register("gram_sums", _gram_sql())
def q_gram_sums(spark, sf):
    g = LN.gram_long(_sup_rowid(spark, sf), FEATS, GOALS)
    return g.withColumn("value", F.round("value", 2))


def _ols1_sql() -> str:
    parts = []
    for t in C.targets:
        for k in range(1, C.horizons + 1):
            g = C.goal_name(t, k)
            mk = f"model_lag{k}_{t}"
            parts.append(f"SELECT '{mk}' AS model_key, 'intercept' AS term, ROUND(REGR_INTERCEPT({g}, R_{t}), 6) AS coef FROM sup")
            parts.append(f"SELECT '{mk}' AS model_key, 'R_{t}' AS term, ROUND(REGR_SLOPE({g}, R_{t}), 6) AS coef FROM sup")
    return Q.with_ctes(*Q.supervised_ctes()) + " UNION ALL ".join(parts)


@register("ols_one_feature", _ols1_sql())
def q_ols_one_feature(spark, sf):
    sup = _sup_rowid(spark, sf)
    out = None
    for t in C.targets:
        goals = {f"model_lag{k}_{t}": C.goal_name(t, k) for k in range(1, C.horizons + 1)}
        m = LN.ols_models(sup, [f"R_{t}"], goals)
        out = m if out is None else out.unionByName(m)
    return round_doubles(out)


def _split_sup(spark, sf):
    sup = RW.holdout_split(_sup_rowid(spark, sf), "row_id", 0.2, seed=0)
    return cut_lineage(sup)


_MODEL_GOALS = {f"model_lag{k}_{t}": C.goal_name(t, k) for t in C.targets for k in range(1, C.horizons + 1)}


def _split_sql_ctes() -> list[str]:
    """Model table with the exact 80/20 hash hold-out (seed 0), as in _split_sup."""
    return list(Q.supervised_ctes()) + [Q.sup_rowid_cte(),
        f"spl AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (ORDER BY {Q.hash_sql(0, 'row_id')}, row_id) "
        "<= CEIL(CAST(0.2 AS DOUBLE) * COUNT(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM supr)",
        "trn AS (SELECT * FROM spl WHERE split = 'train')"]


def _ols_oracle_ctes() -> tuple[list[str], str]:
    ctes, coef = Q.ols_sql("trn", FEATS, _MODEL_GOALS)
    return _split_sql_ctes() + ctes, coef


def _ols_models_sql() -> str:
    ctes, coef = _ols_oracle_ctes()
    return ("WITH RECURSIVE " + Q.obs_only()[len("WITH "):].rstrip() + ",\n" + ",\n".join(ctes) + "\n" +
            f"SELECT model_key, term, ROUND(coef, 6) AS coef FROM {coef}")


@register("ols_models", _ols_models_sql())
def q_ols_models(spark, sf):
    sup = _split_sup(spark, sf)
    return round_doubles(LN.ols_models(sup, FEATS, _MODEL_GOALS, fit_filter=F.col("split") == "train"))


def _ols_predictions(spark, sf):
    sup = _split_sup(spark, sf)
    models = cut_lineage(LN.ols_models(sup, FEATS, _MODEL_GOALS, fit_filter=F.col("split") == "train"))
    return LN.predict_all(sup, models, FEATS, _MODEL_GOALS, ["row_id", "split"])


def _pred_sql_ctes() -> list[str]:
    """Oracle predictions of every model on every row (train and test)."""
    ctes, _ = _ols_oracle_ctes()
    p = len(FEATS)
    parts = []
    for k, (mk, goal) in enumerate(_MODEL_GOALS.items()):
        col = p + k + 1
        icpt = f"m_{p + k} - (" + " + ".join(f"a[{j + 1}][{col}] * m_{j}" for j in range(p)) + ")"
        pred = icpt + " + " + " + ".join(f"a[{j + 1}][{col}] * {f}" for j, f in enumerate(FEATS))
        parts.append(f"SELECT row_id, split, '{mk}' AS model_key, {goal} AS y, {pred} AS p FROM spl, osol, omu")
    return ctes + ["prd AS (" + " UNION ALL ".join(parts) + ")"]


def _with_pred(select: str) -> str:
    return ("WITH RECURSIVE " + Q.obs_only()[len("WITH "):].rstrip() + ",\n" + ",\n".join(_pred_sql_ctes()) +
            "\n" + select)


@register("ols_predictions", _with_pred(
    "SELECT row_id, split, model_key, ROUND(y, 6) AS y, ROUND(p, 6) AS p FROM prd"))
def q_ols_predictions(spark, sf):
    return round_doubles(_ols_predictions(spark, sf))


_METRICS_SELECT = (
    "SELECT model_key, split, CAST(COUNT(*) AS BIGINT) AS n, ROUND(AVG(POW(y - p, 2)), 6) AS mse, "
    "ROUND(SQRT(AVG(POW(y - p, 2))), 6) AS rmse, "
    "ROUND(CASE WHEN COUNT(y) * VAR_POP(y) = 0 THEN CASE WHEN SUM(POW(y - p, 2)) = 0 THEN 1.0 ELSE 0.0 END "
    "ELSE 1.0 - SUM(POW(y - p, 2)) / (COUNT(y) * VAR_POP(y)) END, 6) AS r2 FROM prd GROUP BY model_key, split")


@register("ols_metrics", _with_pred(_METRICS_SELECT))
def q_ols_metrics(spark, sf):
    return round_doubles(MT.regression_metrics(_ols_predictions(spark, sf), ["model_key", "split"], "y", "p"))


_SWEEP_GOALS = [(k, t, C.goal_name(t, k)) for k in range(1, C.horizons + 1) for t in C.targets]


def _sweep(spark, sf):
    from ..config import SWEEP_ITERATIONS, SWEEP_TEST_SIZES
    ensure_checkpoint_dir(spark)
    sup = _sup_rowid(spark, sf)
    return LN.split_sweep(sup, "row_id", FEATS, _SWEEP_GOALS, SWEEP_ITERATIONS, list(SWEEP_TEST_SIZES))


@register("split_sweep")  # oracle registered at the end of the module
def q_split_sweep(spark, sf):
    return round_doubles(_sweep(spark, sf))


@register("sweep_summary")
def q_sweep_summary(spark, sf):
    return round_doubles(ST.group_mean(_sweep(spark, sf), ["test_size", "target"], {"mse_avg": "mse_test"}))


@register("sweep_by_iteration")
def q_sweep_by_iteration(spark, sf):
    return round_doubles(ST.group_mean(_sweep(spark, sf), ["target", "iteration", "test_size"],
                                       {"mse_test": "mse_test", "r2_test": "r2_test"}))


@register("sweep_target_filter")
def q_sweep_target_filter(spark, sf):
    """the sweep rows of one target."""
    return round_doubles(_sweep(spark, sf).where(F.col("target") == F.lit("air_temp")))


@register("best_test_size")
def q_best_test_size(spark, sf):
    s = ST.group_mean(_sweep(spark, sf), ["test_size", "target"], {"mse_avg": "mse_test"})
    overall = ST.arg_min(s, "mse_avg", "test_size", ["test_size", "target"]).withColumn("target", F.lit("*"))
    per_target = s.groupBy("target").agg(
        F.min_by("test_size", F.struct("mse_avg", "test_size")).alias("test_size"),
        F.min("mse_avg").alias("mse_avg"))
    return round_doubles(overall.unionByName(per_target))


# ---------------------------------------------------------------------------
# polynomial terms and other model families
# ---------------------------------------------------------------------------



def _poly_sql() -> str:
    from itertools import combinations_with_replacement
    cols = ["CAST(1.0 AS DOUBLE) AS t_bias"]
    for d in (1, 2):
        for combo in combinations_with_replacement(range(len(FEATS)), d):
            expr = " * ".join(f"CAST({FEATS[i]} AS DOUBLE)" if j == 0 else FEATS[i] for j, i in enumerate(combo))
            cols.append(f"{expr} AS t_{'_'.join(str(i) for i in combo)}")
    return _SUP_ROWID + "SELECT row_id, " + ", ".join(cols) + " FROM supr"


@register("poly_expand", _poly_sql())
def q_poly_expand(spark, sf):
    # products of bit-identical inputs are bit-identical in both engines, so
    # they are compared unrounded (rounding exact ties differs between engines)
    return MD.poly_expand(_sup_rowid(spark, sf), FEATS, 2, ["row_id"])


@register("tree_models")
def q_tree_models(spark, sf):
    sup = _split_sup(spark, sf)
    out = None
    for kind in ("tree", "forest", "gbt"):
        m = MD.fit_family(sup, "split", FEATS, _MODEL_GOALS, kind, seed=42)
        out = m if out is None else out.unionByName(m)
    return out


@register("ridge_lasso")
def q_ridge_lasso(spark, sf):
    sup = _split_sup(spark, sf)
    a = MD.fit_family(sup, "split", FEATS, _MODEL_GOALS, "regularised", reg=0.1, elastic=0.0) \
        .withColumn("family", F.lit("ridge"))
    b = MD.fit_family(sup, "split", FEATS, _MODEL_GOALS, "regularised", reg=0.1, elastic=1.0) \
        .withColumn("family", F.lit("lasso"))
    return a.unionByName(b)


def _nn(spark, sf):
    ensure_checkpoint_dir(spark)
    # the stand-in marks missing values by the sentinel; nulls are planted here
    null = F.dayofyear("obs_date") % 37 == 5
    obs = station_obs(spark, sf).withColumn("vapor_pressure", F.when(~null, F.col("vapor_pressure")))
    return cut_lineage(network_table(obs, C))


def _multi_horizon_sql() -> str:
    feats = [c for c in _NN_COLS if c != "R_air_temp"]
    goals = {f"horizon_{k}": f"target_day{k}" for k in (1, 2, 3)}
    ctes, _ = Q.ols_sql("nntr", feats, goals, prefix="h")
    p = len(feats)
    parts = []
    for k, (mk, goal) in enumerate(goals.items()):
        col = p + k + 1
        icpt = f"m_{p + k} - (" + " + ".join(f"a[{j + 1}][{col}] * m_{j}" for j in range(p)) + ")"
        pred = icpt + " + " + " + ".join(f"a[{j + 1}][{col}] * {f}" for j, f in enumerate(feats))
        parts.append(f"SELECT split, '{mk}' AS model_key, {goal} AS y, {pred} AS p FROM nn, hsol, hmu")
    all_ctes = _nn_sql_ctes() + ["nntr AS (SELECT * FROM nn WHERE split = 'train')"] + ctes + \
        ["prd AS (" + " UNION ALL ".join(parts) + ")"]
    return ("WITH RECURSIVE " + Q.obs_only()[len("WITH "):].rstrip() + ",\n" + ",\n".join(all_ctes) + "\n" +
            _METRICS_SELECT)


@register("multi_horizon")  # oracle registered at the end (needs the network-table SQL)
def q_multi_horizon(spark, sf):
    t = _nn(spark, sf)
    feats = network_features(t, C)
    goals = {f"horizon_{k}": c for k, c in enumerate(NN_TARGETS, start=1)}
    models = cut_lineage(LN.ols_models(t, feats, goals, fit_filter=F.col("split") == "train"))
    pred = LN.predict_all(t, models, feats, goals, ["split"])
    return round_doubles(MT.regression_metrics(pred, ["model_key", "split"], "y", "p"))


@register("dense_score")
def q_dense_score(spark, sf):
    from ..config import DENSE_LAYERS
    t = _nn(spark, sf)
    feats = network_features(t, C)
    w = MD.dense_weights(len(feats), DENSE_LAYERS, seed=0)
    return round_doubles(MD.dense_score(t, feats, ["row_id", "obs_date", "split"], w,
                                        [f"pred_day{k}" for k in range(1, 4)]))


# ---------------------------------------------------------------------------
# evaluation on the prediction stand-in (orders: y = price / 1000)
# ---------------------------------------------------------------------------

_PRED_SQL = ("pred AS (SELECT o_orderkey, o_orderstatus, o_totalprice / 1000.0 AS y, "
             "o_totalprice / 1000.0 + (o_orderkey % 21) - 10 + (o_orderkey % 13) / 13.0 AS p FROM orders)")


def _pred(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    y = F.col("o_totalprice") / F.lit(1000.0)
    p = y + (F.col("o_orderkey") % 21) - 10 + (F.col("o_orderkey") % 13) / F.lit(13.0)
    return o.select("o_orderkey", "o_orderstatus", y.alias("y"), p.alias("p"))


def _pred_with(body: str) -> str:
    return "WITH " + _PRED_SQL + "\n" + body


@register("regression_metrics", _pred_with(
    "SELECT o_orderstatus, CAST(COUNT(*) AS BIGINT) AS n, ROUND(AVG(POW(y - p, 2)), 6) AS mse, "
    "ROUND(SQRT(AVG(POW(y - p, 2))), 6) AS rmse, "
    "ROUND(CASE WHEN COUNT(y) * VAR_POP(y) = 0 THEN CASE WHEN SUM(POW(y - p, 2)) = 0 THEN 1.0 ELSE 0.0 END "
    "ELSE 1.0 - SUM(POW(y - p, 2)) / (COUNT(y) * VAR_POP(y)) END, 6) AS r2 FROM pred GROUP BY o_orderstatus"))
def q_regression_metrics(spark, sf):
    return round_doubles(MT.regression_metrics(_pred(spark, sf), ["o_orderstatus"], "y", "p"))


@register("penalised_mse", _pred_with(
    "SELECT o_orderstatus, ROUND(AVG(CASE WHEN p < 0 THEN 10.0 * POW(y - p, 2) ELSE POW(y - p, 2) END), 6) "
    "AS penalised_mse, ROUND(AVG(POW(y - p, 2)), 6) AS mse, "
    "CAST(SUM(CASE WHEN p < 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_negative FROM pred GROUP BY o_orderstatus"))
def q_penalised_mse(spark, sf):
    from ..config import NEGATIVE_PENALTY
    return round_doubles(MT.penalised_mse(_pred(spark, sf), ["o_orderstatus"], "y", "p", NEGATIVE_PENALTY))


@register("error_outliers", _pred_with(
    "SELECT o_orderkey, o_orderstatus, ROUND(y, 6) AS y, ROUND(p, 6) AS p, ROUND(ABS(p - y), 6) AS abs_error, "
    "ROUND(t, 6) AS threshold FROM pred, (SELECT QUANTILE_CONT(ABS(p - y), 0.95) AS t FROM pred) q "
    "WHERE ABS(p - y) > t"))
def q_error_outliers(spark, sf):
    return round_doubles(MT.error_outliers(_pred(spark, sf), "y", "p", 0.95))


@register("actual_vs_predicted", _pred_with(
    "SELECT o_orderkey, ROUND(y, 6) AS y, ROUND(p, 6) AS p, "
    "(y BETWEEN -10 AND 25) AND (p BETWEEN -10 AND 25) AS in_range FROM pred"))
def q_actual_vs_predicted(spark, sf):
    x = _pred(spark, sf).select("o_orderkey", "y", "p")
    return round_doubles(MT.actual_vs_predicted(x, "y", "p", *PLOT_BOXES["air_temp"]))


@register("axis_bound", _pred_with(
    "SELECT o_orderstatus, ROUND(GREATEST(MAX(y), MAX(p)), 6) AS axis_max FROM pred GROUP BY o_orderstatus"))
def q_axis_bound(spark, sf):
    return round_doubles(_pred(spark, sf).groupBy("o_orderstatus").agg(
        F.greatest(F.max("y"), F.max("p")).alias("axis_max")))


def _head_fill_oracle(src_ctes: list[str], cols: list[str]) -> str:
    ctes, select = Q.head_fill_sql("src", cols, ["obs_date", "row_id"])
    return ("WITH RECURSIVE " + Q.obs_only()[len("WITH "):].rstrip() + ",\n" +
            ",\n".join(src_ctes + ctes) + "\n" + select)


_HW_COLS = [f"{s}_{m}" for s in ("N", "A", "R") for m in M]
_HW_SRC = ["j3 AS (SELECT n.obs_date AS obs_date, " +
           ", ".join(f"{a}.{m} AS {s}_{m}" for s, a in (("N", "n"), ("A", "a"), ("R", "r")) for m in M) +
           " FROM (SELECT * FROM obs WHERE series_id = 'N') n"
           " JOIN (SELECT * FROM obs WHERE series_id = 'A') a ON n.obs_date = a.obs_date"
           " JOIN (SELECT * FROM obs WHERE series_id = 'R') r ON n.obs_date = r.obs_date)",
           "src AS (SELECT *, ROW_NUMBER() OVER (ORDER BY obs_date) - 1 AS row_id FROM j3)"]


@register("head_weighted_fill", _head_fill_oracle(_HW_SRC, _HW_COLS))
def q_head_weighted_fill(spark, sf):
    """W6 on the older notebook's table: the three stations joined on the
    date with sentinels kept, in date order."""
    raw = J.join_series(station_obs(spark, sf), "series_id", "obs_date", ["N", "A", "R"], "inner", cols=M)
    wide = cut_lineage(RW.add_row_id(raw, ["obs_date"]))
    cols = [c for c in wide.columns if c not in ("obs_date", "row_id")]
    return round_doubles(IM.head_weighted_fill(wide, cols, "row_id", C.sentinel))



# ---------------------------------------------------------------------------
# event-level series with one hot key (a third of all rows), timestamp order
# ---------------------------------------------------------------------------

def _event_ordering():
    from ..operators.series_window import Ordering
    # the hot series is far above this per-task bound, so "auto" takes the
    # chunked path, with a chunk width sized to about 500 of its rows
    return Ordering(partition=("series_id",), order=("ts", "event_id"),
                    max_rows_per_task=1000, mode="auto")


_EV_W = "(PARTITION BY series_id ORDER BY ts, event_id"


@register("event_interpolate_skewed", "WITH " + EVENT_SERIES_CTE + ",\n" +
          "n AS (SELECT *, ROW_NUMBER() OVER " + _EV_W + ") - 1 AS _pos FROM ev),\n" +
          "b AS (SELECT *, "
          "LAST_VALUE(value IGNORE NULLS) OVER " + _EV_W + " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _pv, "
          "LAST_VALUE(CASE WHEN value IS NOT NULL THEN _pos END IGNORE NULLS) OVER " + _EV_W +
          " ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _pp, "
          "FIRST_VALUE(value IGNORE NULLS) OVER " + _EV_W + " ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS _nv, "
          "FIRST_VALUE(CASE WHEN value IS NOT NULL THEN _pos END IGNORE NULLS) OVER " + _EV_W +
          " ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS _np FROM n)\n"
          "SELECT series_id, ts, event_id, ROUND(CASE WHEN value IS NOT NULL THEN value WHEN _pv IS NULL THEN NULL "
          "WHEN _nv IS NULL THEN _pv ELSE _pv + (_nv - _pv) * CAST(_pos - _pp AS DOUBLE) / CAST(_np - _pp AS DOUBLE) "
          "END, 6) AS value FROM b")
def q_event_interpolate_skewed(spark, sf):
    return round_doubles(IM.interpolate_linear(event_series(spark, sf), ["value"], _event_ordering()))


@register("event_future_skewed", "WITH " + EVENT_SERIES_CTE + "\n" +
          "SELECT series_id, ts, event_id, ROUND(value, 6) AS value, " + ", ".join(
              f"ROUND(LEAD(value, {k}) OVER {_EV_W}), 6) AS value_next_{k}" for k in (1, 2, 3)) +
          ", " + ", ".join(f"ROUND(LAG(value, {k}) OVER {_EV_W}), 6) AS value_prev_{k}" for k in (1, 2)) +
          " FROM ev")
def q_event_future_skewed(spark, sf):
    from ..operators.series_window import shift_rows
    specs = [(f"value_next_{k}", "value", k) for k in (1, 2, 3)] + \
            [(f"value_prev_{k}", "value", -k) for k in (1, 2)]
    return round_doubles(shift_rows(event_series(spark, sf), specs, _event_ordering()))


def _event_awkward(name: str, series: str, ts: str) -> None:
    """Register position and next value over the event series with changed
    keys; ``series`` and ``ts`` are SQL that both engines read."""
    over = "(PARTITION BY series_id ORDER BY ts NULLS FIRST, event_id)"

    @register(name, "WITH " + EVENT_SERIES_CTE + f""",
k AS (SELECT {series} AS series_id, {ts} AS ts, event_id, value FROM ev)
SELECT series_id, ts, event_id, ROW_NUMBER() OVER {over} - 1 AS row_pos,
  ROUND(LEAD(value, 1) OVER {over}, 6) AS value_next_1 FROM k""")
    def query(spark, sf):
        from ..operators.series_window import resolve, shift_rows, with_position
        k = event_series(spark, sf).select(F.expr(series).alias("series_id"), F.expr(ts).alias("ts"), "event_id", "value")
        o = resolve(k, _event_ordering())
        return round_doubles(with_position(shift_rows(k, [("value_next_1", "value", 1)], o), o)
                             .select("series_id", "ts", "event_id", "row_pos", "value_next_1"))
    query.__name__ = f"q_{name}"


# null series and null times, and half of the hot series at one instant
_event_awkward("event_null_keys", "CASE WHEN event_id % 5 = 0 THEN NULL ELSE series_id END",
               "CASE WHEN event_id % 11 = 0 THEN NULL ELSE ts END")
_event_awkward("event_burst", "series_id", "CASE WHEN series_id = 'hot' AND event_id % 2 = 0 "
               "THEN TIMESTAMP '1990-01-01 00:00:00' ELSE ts END")


@register("ols_actual_vs_predicted", _with_pred(
    "SELECT row_id, split, model_key, ROUND(y, 6) AS y, ROUND(p, 6) AS p, "
    "CASE WHEN model_key LIKE '%\\_precip' ESCAPE '\\' THEN (y BETWEEN 0 AND 30) AND (p BETWEEN -1 AND 6) "
    "ELSE (y BETWEEN -10 AND 25) AND (p BETWEEN -10 AND 25) END AS in_range FROM prd"))
def q_ols_actual_vs_predicted(spark, sf):
    """E6 on the six OLS models: the plot box is per target (precipitation
    x 0..30, y -1..6; temperature -10..25 on both axes)."""
    pred = _ols_predictions(spark, sf)
    is_precip = F.col("model_key").endswith("_precip")
    def within(box):
        return F.col("y").between(*box[0]) & F.col("p").between(*box[1])
    inside = F.when(is_precip, within(PLOT_BOXES["precip"])).otherwise(within(PLOT_BOXES["air_temp"]))
    return round_doubles(pred.withColumn("in_range", inside))


# ---------------------------------------------------------------------------
# the network study's table and dense scoring, with SQL oracles
# ---------------------------------------------------------------------------

_NN_ORDER = ["R", "A", "N"]
_NN_COLS = [f"{s}_{m}" for s in _NN_ORDER for m in M]


def _nn_sql_ctes() -> list[str]:
    mi = ("mi AS (SELECT series_id, obs_date, " + ", ".join(
        f"COALESCE(NULLIF({m}, -999), AVG(NULLIF({m}, -999)) OVER (PARTITION BY series_id)) AS {m}" for m in M) +
        " FROM (SELECT * REPLACE (CASE WHEN DAYOFYEAR(obs_date) % 37 = 5 THEN NULL ELSE vapor_pressure END"
        " AS vapor_pressure) FROM obs) o)")
    sl = []
    for s in _NN_ORDER:
        shift = "obs_date" if s == "R" else "CAST(obs_date + INTERVAL 3 DAY AS DATE)"
        sl.append(f"s_{s} AS (SELECT {shift} AS d, " + ", ".join(f"{m} AS {s}_{m}" for m in M) +
                  f" FROM mi WHERE series_id = '{s}')")
    w = ("w AS (SELECT s_R.d AS obs_date, " + ", ".join(_NN_COLS) +
         " FROM s_R LEFT JOIN s_A ON s_R.d = s_A.d LEFT JOIN s_N ON s_R.d = s_N.d)")
    c = "c AS (SELECT * FROM w WHERE " + " AND ".join(f"{x} IS NOT NULL" for x in _NN_COLS) + ")"
    t = ("t AS (SELECT *, " + ", ".join(f"LEAD(R_air_temp, {k}) OVER (ORDER BY row_id) AS target_day{k}"
                                         for k in (1, 2, 3)) +
         ", COUNT(*) OVER () AS n_all FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY obs_date) - 1 AS row_id FROM c) r)")
    nn = ("nn AS (SELECT *, CASE WHEN row_id < FLOOR(CAST(0.8 AS DOUBLE) * (n_all - 3)) THEN 'train' ELSE 'test' END"
          " AS split FROM t WHERE row_id < n_all - 3)")
    return [mi] + sl + [w, c, t, nn]


_NN_OUT = ["obs_date", "row_id"] + _NN_COLS + [f"target_day{k}" for k in (1, 2, 3)] + ["split"]


@register("network_table", Q.obs_only().rstrip() + ",\n" + ",\n".join(_nn_sql_ctes()) + "\n" +
          "SELECT " + Q.sel(_NN_OUT, keep=("obs_date", "row_id", "split")) + " FROM nn")
def q_network_table(spark, sf):
    return round_doubles(_nn(spark, sf).select(*_NN_OUT))


def _dense_sql() -> str:
    from ..config import DENSE_LAYERS
    feats = [c for c in _NN_COLS if c != "R_air_temp"]
    weights = MD.dense_weights(len(feats), DENSE_LAYERS, seed=0)
    ctes = []
    prev, src = feats, "nn"
    for li, (w, b, act) in enumerate(weights):
        zs = []
        for j in range(w.shape[1]):
            terms = " + ".join(f"{p} * {repr(float(w[i, j]))}" for i, p in enumerate(prev))
            zs.append(f"({terms}) + {repr(float(b[j]))} AS z{j}")
        ctes.append(f"z{li} AS (SELECT row_id, obs_date, split, " + ", ".join(zs) + f" FROM {src})")
        if act == "relu":
            hs = [f"GREATEST(z{j}, 0.0) AS h{li}_{j}" for j in range(w.shape[1])]
        elif act == "elu":
            hs = [f"CASE WHEN z{j} > 0 THEN z{j} ELSE EXP(z{j}) - 1 END AS h{li}_{j}" for j in range(w.shape[1])]
        else:
            hs = [f"z{j} AS h{li}_{j}" for j in range(w.shape[1])]
        ctes.append(f"h{li} AS (SELECT row_id, obs_date, split, " + ", ".join(hs) + f" FROM z{li})")
        prev, src = [f"h{li}_{j}" for j in range(w.shape[1])], f"h{li}"
    outs = ", ".join(f"ROUND({p}, 6) AS pred_day{k}" for k, p in enumerate(prev, start=1))
    return (Q.obs_only().rstrip() + ",\n" + ",\n".join(_nn_sql_ctes() + ctes) + "\n" +
            f"SELECT row_id, obs_date, split, {outs} FROM {src}")


ORACLES["dense_score"] = _dense_sql()


# ---------------------------------------------------------------------------
# the older linear notebook's table: cut-off, suffix joins, leads over the
# joined table's date order, last rows trimmed (raw values, sentinels kept)
# ---------------------------------------------------------------------------

_OLD_LEADS = [f"{t}_future_{k}Day" for k in (1, 2, 3) for t in ("precip", "air_temp")]
_OLD_COLS = ["obs_date"] + _SUFFIX_COLS + _OLD_LEADS


_OLD_STATIONS = ("N", "A", "R")


def _older_table(spark, sf):
    from .older import older_table
    return older_table(station_obs(spark, sf), C, _OLD_STATIONS)


_OLD_CTES = [
    f"c AS (SELECT * FROM obs WHERE obs_date >= DATE '{CUTOFF_DATE}')",
    "j AS (SELECT s.obs_date AS obs_date, " +
    ", ".join([f"s.{m} AS {m}_sch" for m in M] + [f"a.{m} AS {m}_arb" for m in M] + [f"r.{m} AS {m}" for m in M]) +
    " FROM (SELECT * FROM c WHERE series_id = 'N') s"
    " JOIN (SELECT * FROM c WHERE series_id = 'A') a ON s.obs_date = a.obs_date"
    " JOIN (SELECT * FROM c WHERE series_id = 'R') r ON s.obs_date = r.obs_date)",
    "l AS (SELECT *, " + ", ".join(f"LEAD({t}, {k}) OVER (ORDER BY obs_date) AS {t}_future_{k}Day"
                                   for k in (1, 2, 3) for t in ("precip", "air_temp")) +
    ", ROW_NUMBER() OVER (ORDER BY obs_date DESC) AS rr FROM j)",
    "old AS (SELECT " + ", ".join(_OLD_COLS) + " FROM l WHERE rr > 3)",
]


@register("older_notebook_table", Q.obs_only().rstrip() + ",\n" + ",\n".join(_OLD_CTES) + "\n" +
          f"SELECT {Q.sel(_OLD_COLS)} FROM old")
def q_older_notebook_table(spark, sf):
    return round_doubles(_older_table(spark, sf).select(*_OLD_COLS))


@register("older_notebook_filled", _head_fill_oracle(
    _OLD_CTES + ["src AS (SELECT *, ROW_NUMBER() OVER (ORDER BY obs_date) - 1 AS row_id FROM old)"],
    _SUFFIX_COLS + _OLD_LEADS))
def q_older_notebook_filled(spark, sf):
    """W6 over every measure and lead column of the older notebook's table,
    in date order, as its cell loop fills them."""
    t = cut_lineage(_older_table(spark, sf))
    cols = [c for c in t.columns if c not in ("obs_date", "row_id")]
    return round_doubles(IM.head_weighted_fill(t, cols, "row_id", C.sentinel))


_OLD_KEPT = sorted(c for c in _SUFFIX_COLS + _OLD_LEADS + ["obs_date", "row_id"] if c not in OLDER_DROPPED)
_OLD_NUMERIC = [c for c in _OLD_KEPT if c not in ("obs_date", "row_id")]
_OLD_FEATS = [c for c in _OLD_NUMERIC if "_future_" not in c]
_OLD_GOALS = {f"older_{t}": f"{t}_future_3Day" for t in C.targets}


def _older_filled_ctes() -> list[str]:
    """The filled table as a CTE, rounded like the written one."""
    ctes, select = Q.head_fill_sql("src", _SUFFIX_COLS + _OLD_LEADS, ["obs_date", "row_id"])
    return (_OLD_CTES + ["src AS (SELECT *, ROW_NUMBER() OVER (ORDER BY obs_date) - 1 AS row_id FROM old)"] + ctes +
            [f"filled AS ({select})"])


def _older_sql(select: str, ctes: list[str] = ()) -> str:
    return ("WITH RECURSIVE " + Q.obs_only()[len("WITH "):].rstrip() + ",\n" +
            ",\n".join([*_older_filled_ctes(), *ctes]) + "\n" + select)


def _older_study(spark, sf):
    from .older import older_study
    return older_study(station_obs(spark, sf), C, _OLD_STATIONS)


@register("older_study_table", _older_sql("SELECT " + ", ".join(_OLD_KEPT) + " FROM filled"))
def q_older_study_table(spark, sf):
    """The filled table without the columns dropped by name, in name order."""
    return _older_study(spark, sf).table


@register("older_study_corr", _older_sql(" UNION ALL ".join(
    _corr_sql(a, b) + " FROM filled" for i, a in enumerate(_OLD_NUMERIC) for b in _OLD_NUMERIC[i:])))
def q_older_study_corr(spark, sf):
    """Correlation of the filled table's numeric columns."""
    return round_doubles(_older_study(spark, sf).correlation)


def _older_split_ctes() -> list[str]:
    return [f"ospl AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (ORDER BY {Q.hash_sql(0, 'row_id')}, row_id) "
            "<= CEIL(CAST(0.2 AS DOUBLE) * COUNT(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM filled)",
            "otrn AS (SELECT * FROM ospl WHERE split = 'train')"]


def _older_metrics_sql() -> str:
    ctes, _ = Q.ols_sql("otrn", _OLD_FEATS, _OLD_GOALS, prefix="d")
    p = len(_OLD_FEATS)
    parts = []
    for k, (mk, goal) in enumerate(_OLD_GOALS.items()):
        col = p + k + 1
        icpt = f"m_{p + k} - (" + " + ".join(f"a[{j + 1}][{col}] * m_{j}" for j in range(p)) + ")"
        pred = icpt + " + " + " + ".join(f"a[{j + 1}][{col}] * {f}" for j, f in enumerate(_OLD_FEATS))
        parts.append(f"SELECT split, '{mk}' AS model_key, {goal} AS y, {pred} AS p FROM ospl, dsol, dmu")
    return _older_sql(_METRICS_SELECT, _older_split_ctes() + ctes + ["prd AS (" + " UNION ALL ".join(parts) + ")"])


@register("older_study_metrics", _older_metrics_sql())
def q_older_study_metrics(spark, sf):
    """Both targets three days ahead on one shared split."""
    return round_doubles(_older_study(spark, sf).metrics)


# ---------------------------------------------------------------------------
# polynomial least squares of degrees 1 to 4, checked in SQL: two features
# scaled to 0..1, one Gram pass and one scoring scan for each degree
# ---------------------------------------------------------------------------

_POLY_FEATS = ["R_air_temp", "R_precip"]
_POLY_DEGREES = (1, 2, 3, 4)


def _poly_names(degree: int) -> list[str]:
    from itertools import combinations_with_replacement
    return ["t_" + "_".join(map(str, c)) for d in range(1, degree + 1)
            for c in combinations_with_replacement(range(len(_POLY_FEATS)), d)]


def _poly_sweep_sql() -> str:
    goals = list(_MODEL_GOALS.values())
    lo_hi = ", ".join(f"MIN({f}) AS lo{i}, MAX({f}) AS hi{i}" for i, f in enumerate(_POLY_FEATS))
    scaled = ", ".join(f"({f} - lo{i}) / (hi{i} - lo{i}) AS x{i}" for i, f in enumerate(_POLY_FEATS))
    top = max(_POLY_DEGREES)
    terms = ", ".join(" * ".join(f"x{i}" for i in n[2:].split("_")) + f" AS {n}" for n in _poly_names(top))
    ctes = _split_sql_ctes() + [
        f"plim AS (SELECT {lo_hi} FROM spl)",
        f"psc AS (SELECT split, {', '.join(goals)}, {scaled} FROM spl, plim)",
        f"pex AS (SELECT split, {', '.join(goals)}, {terms} FROM psc)",
        "ptr AS (SELECT * FROM pex WHERE split = 'train')"]
    parts = []
    for d in _POLY_DEGREES:
        names = _poly_names(d)
        own, _ = Q.ols_sql("ptr", names, _MODEL_GOALS, prefix=f"p{d}")
        ctes += own
        p = len(names)
        for k, (mk, goal) in enumerate(_MODEL_GOALS.items()):
            col = p + k + 1
            icpt = f"m_{p + k} - (" + " + ".join(f"a[{j + 1}][{col}] * m_{j}" for j in range(p)) + ")"
            pred = icpt + " + " + " + ".join(f"a[{j + 1}][{col}] * {f}" for j, f in enumerate(names))
            parts.append(f"SELECT split, '{mk}_degree{d}' AS model_key, {goal} AS y, {pred} AS p "
                         f"FROM pex, p{d}sol, p{d}mu")
    ctes.append("prd AS (" + " UNION ALL ".join(parts) + ")")
    return ("WITH RECURSIVE " + Q.obs_only()[len("WITH "):].rstrip() + ",\n" + ",\n".join(ctes) + "\n" +
            _METRICS_SELECT)


@register("poly_degree_metrics", _poly_sweep_sql())
def q_poly_degree_metrics(spark, sf):
    """M5-M7: degrees 1 to 4 of two scaled features, all six goals."""
    sup = IM.minmax_scale(_split_sup(spark, sf), _POLY_FEATS)
    goals = list(_MODEL_GOALS.values())
    x = cut_lineage(sup.select("split", *goals, *[e.alias(n) for n, e in MD.poly_terms(
        _POLY_FEATS, max(_POLY_DEGREES), bias=False)]))
    preds = []
    for d in _POLY_DEGREES:
        keyed = {f"{mk}_degree{d}": g for mk, g in _MODEL_GOALS.items()}
        models = cut_lineage(LN.ols_models(x, _poly_names(d), keyed, fit_filter=F.col("split") == "train"))
        preds.append(LN.predict_all(x, models, _poly_names(d), keyed, ["split"]))
    return round_doubles(MT.regression_metrics(reduce(DataFrame.unionByName, preds), ["model_key", "split"], "y", "p"))


# ---------------------------------------------------------------------------
# ridge from the same Gram sums
# ---------------------------------------------------------------------------

_RIDGE_ALPHA = 1.0


def _ridge_sql() -> str:
    ctes, coef = Q.ols_sql("trn", FEATS, _MODEL_GOALS, prefix="r", alpha=_RIDGE_ALPHA)
    return ("WITH RECURSIVE " + Q.obs_only()[len("WITH "):].rstrip() + ",\n" +
            ",\n".join(_split_sql_ctes() + ctes) + f"\nSELECT model_key, term, ROUND(coef, 6) AS coef FROM {coef}")


@register("ridge_models", _ridge_sql())
def q_ridge_models(spark, sf):
    """Ridge coefficients of the six models."""
    return round_doubles(LN.ols_models(_split_sup(spark, sf), FEATS, _MODEL_GOALS,
                                       fit_filter=F.col("split") == "train", alpha=_RIDGE_ALPHA))


ORACLES["multi_horizon"] = _multi_horizon_sql()


# ---------------------------------------------------------------------------
# SQL oracle of the split-size sweep: 10 seeded hash splits x 5 sizes, one
# centred normal-equation system per (iteration, size), solved by a
# recursive Gauss-Jordan elimination over all 50 systems at once, then
# row-wise metrics per split
# ---------------------------------------------------------------------------

def _sweep_sql_ctes() -> list[str]:
    from ..config import SWEEP_ITERATIONS, SWEEP_TEST_SIZES
    feats, goals = FEATS, [g for _, _, g in _SWEEP_GOALS]
    cols = feats + goals
    p, q = len(feats), len(goals)
    sizes = ", ".join(f"({i}, CAST({f} AS DOUBLE))" for i, f in enumerate(SWEEP_TEST_SIZES))
    h = "CAST('0x' || substr(md5(CAST(it AS VARCHAR) || ':' || CAST(row_id AS VARCHAR)), 1, 8) AS BIGINT)"
    ctes = list(Q.supervised_ctes()) + [Q.sup_rowid_cte(),
        f"its AS (SELECT CAST(range AS INTEGER) AS it FROM range({SWEEP_ITERATIONS}))",
        f"szs AS (SELECT * FROM (VALUES {sizes}) s(fi, f))",
        f"rk AS (SELECT supr.*, it, ROW_NUMBER() OVER (PARTITION BY it ORDER BY {h}, row_id) AS rnk, "
        "COUNT(*) OVER (PARTITION BY it) AS n_all FROM supr, its)",
        "sp AS (SELECT rk.*, fi, f, CASE WHEN rnk <= CEIL(f * n_all) THEN 'test' ELSE 'train' END AS split "
        "FROM rk, szs)",
        "smu AS (SELECT it, fi, " + ", ".join(f"AVG(CAST({c} AS DOUBLE)) AS m_{i}" for i, c in enumerate(cols)) +
        " FROM sp WHERE split = 'train' GROUP BY it, fi)",
        "scx AS (SELECT sp.it, sp.fi, " + ", ".join(f"CAST({c} AS DOUBLE) - m_{i} AS v{i}" for i, c in enumerate(cols)) +
        " FROM sp JOIN smu ON sp.it = smu.it AND sp.fi = smu.fi WHERE split = 'train')",
        "sgm AS (SELECT it, fi, [" + ", ".join(
            "[" + ", ".join([f"SUM(v{i} * v{j})" for j in range(p)] + [f"SUM(v{i} * v{p + k})" for k in range(q)]) + "]"
            for i in range(p)) + "] AS a FROM scx GROUP BY it, fi)",
        "sge(it, fi, t, a) AS (SELECT it, fi, 0, a FROM sgm UNION ALL SELECT it, fi, t + 1, "
        "CASE WHEN a[t + 1][t + 1] = 0 THEN a ELSE list_transform(range(len(a)), lambda i: CASE WHEN i = t "
        "THEN list_transform(a[t + 1], lambda x: x / a[t + 1][t + 1]) "
        "ELSE list_transform(range(len(a[i + 1])), lambda j: a[i + 1][j + 1] - a[i + 1][t + 1] * a[t + 1][j + 1] "
        f"/ a[t + 1][t + 1]) END) END FROM sge WHERE t < {p})",
        f"ssol AS (SELECT sge.it, sge.fi, a, smu.* EXCLUDE (it, fi) FROM sge JOIN smu ON sge.it = smu.it "
        f"AND sge.fi = smu.fi WHERE t = {p})",
    ]
    parts = []
    for k, (lag, target, goal) in enumerate(_SWEEP_GOALS):
        col = p + k + 1
        icpt = f"m_{p + k} - (" + " + ".join(f"a[{j + 1}][{col}] * m_{j}" for j in range(p)) + ")"
        pred = icpt + " + " + " + ".join(f"a[{j + 1}][{col}] * sp.{f}" for j, f in enumerate(feats))
        parts.append(f"SELECT sp.it, sp.f, sp.split, {lag} AS lag, '{target}' AS target, sp.{goal} AS y, "
                     f"{pred} AS p FROM sp JOIN ssol ON sp.it = ssol.it AND sp.fi = ssol.fi")
    ctes.append("spr AS (" + " UNION ALL ".join(parts) + ")")
    ctes.append(
        "smet AS (SELECT it, f, lag, target, split, AVG(POW(y - p, 2)) AS mse, "
        "CASE WHEN COUNT(y) * VAR_POP(y) = 0 THEN CASE WHEN SUM(POW(y - p, 2)) = 0 THEN 1.0 ELSE 0.0 END "
        "ELSE 1.0 - SUM(POW(y - p, 2)) / (COUNT(y) * VAR_POP(y)) END AS r2 FROM spr GROUP BY ALL)")
    ctes.append(
        "sweep AS (SELECT a.it AS iteration, a.lag AS lag, a.target AS target, a.f AS test_size, "
        "a.mse AS mse_train, b.mse AS mse_test, a.r2 AS r2_train, b.r2 AS r2_test "
        "FROM smet a JOIN smet b ON a.it = b.it AND a.f = b.f AND a.lag = b.lag AND a.target = b.target "
        "AND a.split = 'train' AND b.split = 'test')")
    return ctes


def _with_sweep(select: str) -> str:
    return ("WITH RECURSIVE " + Q.obs_only()[len("WITH "):].rstrip() + ",\n" + ",\n".join(_sweep_sql_ctes()) +
            "\n" + select)


_SWEEP_OUT = ("SELECT iteration, lag, target, test_size, ROUND(mse_train, 6) AS mse_train, "
              "ROUND(mse_test, 6) AS mse_test, ROUND(r2_train, 6) AS r2_train, ROUND(r2_test, 6) AS r2_test FROM sweep")
ORACLES["split_sweep"] = _with_sweep(_SWEEP_OUT)
ORACLES["sweep_summary"] = _with_sweep(
    "SELECT test_size, target, ROUND(AVG(mse_test), 6) AS mse_avg FROM sweep GROUP BY test_size, target")
ORACLES["sweep_by_iteration"] = _with_sweep(
    "SELECT target, iteration, test_size, ROUND(AVG(mse_test), 6) AS mse_test, ROUND(AVG(r2_test), 6) AS r2_test "
    "FROM sweep GROUP BY target, iteration, test_size")
ORACLES["sweep_target_filter"] = _with_sweep(_SWEEP_OUT + " WHERE target = 'air_temp'")
ORACLES["best_test_size"] = _with_sweep(
    "SELECT test_size, ROUND(mse_avg, 6) AS mse_avg, target FROM ("
    "SELECT test_size, mse_avg, '*' AS target FROM (SELECT test_size, target, AVG(mse_test) AS mse_avg "
    "FROM sweep GROUP BY 1, 2) g ORDER BY mse_avg, test_size, target LIMIT 1) o "
    "UNION ALL SELECT test_size, ROUND(mse_avg, 6), target FROM ("
    "SELECT test_size, target, mse_avg, ROW_NUMBER() OVER (PARTITION BY target ORDER BY mse_avg, test_size) AS r "
    "FROM (SELECT test_size, target, AVG(mse_test) AS mse_avg FROM sweep GROUP BY 1, 2) g) t WHERE r = 1")

from . import many, studies  # noqa: E402, F401  (register their queries)
