"""Queries over every series of a long table, with their SQL: each supplier's
own supervised table, all pairs of series, fills and quantiles by series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import DEFAULT as C, FILL_DECAY, FILL_RADIUS
from ..functions.rounding import round_doubles
from ..operators import impute as IM
from ..operators.pair_tiles import corr_tiles
from ..operators.radix import exact_quantiles
from ..operators.series_window import Ordering, with_position
from ..sources.fixtures import station_obs
from . import sqltext as Q
from .registry import _clean, register
from .supervised import neighbours_of_every_series, supervised_long

M = list(C.measures)
_LEAST_DAYS = 30
_NEAR = ["near1", "near2"]
_GOALS = [f"{t}_future_{k}Day" for t in C.targets for k in range(1, C.horizons + 1)]

_PAIRS = ("pairs AS MATERIALIZED (SELECT a.series_id AS col_a, b.series_id AS col_b, COUNT(*) AS n_pairs, "
          "COVAR_POP(a.air_temp, b.air_temp) / CASE WHEN SQRT(VAR_POP(a.air_temp) * VAR_POP(b.air_temp)) > 0 "
          "THEN SQRT(VAR_POP(a.air_temp) * VAR_POP(b.air_temp)) END AS corr "
          "FROM clean a JOIN clean b ON a.obs_date = b.obs_date AND a.series_id <= b.series_id "
          "WHERE a.air_temp IS NOT NULL AND b.air_temp IS NOT NULL GROUP BY 1, 2)")


@register("corr_suppliers", Q.with_ctes(Q.clean_cte(), _PAIRS, many=True) +
          "SELECT col_a, col_b, ROUND(corr, 6) AS corr, n_pairs FROM pairs")
def q_corr_suppliers(spark, sf):
    """A1 for as many columns as there are series: every pair of suppliers."""
    return round_doubles(corr_tiles(_clean(spark, sf, many=True), "obs_date", "series_id", "air_temp"))


def _supervised_many_sql() -> str:
    feats = list(C.features)
    rest = [m for m in M if m != "air_temp"]
    both = "SELECT col_a AS s, col_b AS o, corr FROM u UNION ALL SELECT col_b, col_a, corr FROM u"
    ctes = [
        Q.clean_cte(), _PAIRS,
        f"u AS (SELECT * FROM pairs WHERE col_a <> col_b AND corr IS NOT NULL AND n_pairs >= {_LEAST_DAYS})",
        f"rk AS (SELECT s, o, ROW_NUMBER() OVER (PARTITION BY s ORDER BY ROUND(corr, 9) DESC, o) AS r FROM ({both}) q)",
        "nb AS (SELECT s, MAX(CASE WHEN r = 1 THEN o END) AS near1, MAX(CASE WHEN r = 2 THEN o END) AS near2 "
        "FROM rk WHERE r <= 2 GROUP BY s)",
        Q.future_cte("clean", "ft"),
        Q.interp_cte("ft", "ip", "air_temp", ["series_id", "obs_date"] + rest + _GOALS)]
    cols = [f"{a}.{f} AS {n}_{f}" for n, a in (("self", "x"), ("near1", "y"), ("near2", "z")) for f in feats]
    names = [f"{n}_{f}" for n in ("self", *_NEAR) for f in feats]
    ctes.append("w AS (SELECT x.series_id, nb.near1, nb.near2, x.obs_date, " + ", ".join(cols) + ", " +
                ", ".join(f"x.{g}" for g in _GOALS) + " FROM ip x JOIN nb ON nb.s = x.series_id "
                "JOIN ip y ON y.series_id = nb.near1 AND y.obs_date = x.obs_date "
                "JOIN ip z ON z.series_id = nb.near2 AND z.obs_date = x.obs_date)")
    return (Q.with_ctes(*ctes, many=True) + "SELECT series_id, near1, near2, obs_date, " +
            ", ".join(Q.r6(c, c) for c in names + _GOALS) + " FROM w WHERE " +
            " AND ".join(f"{c} IS NOT NULL" for c in names + _GOALS))


@register("supervised_table_many", _supervised_many_sql())
def q_supervised_table_many(spark, sf):
    """The preparation job with every supplier as its own target, beside its two
    best-correlated others."""
    obs = station_obs(spark, sf, many=True)
    return round_doubles(supervised_long(obs, C, neighbours_of_every_series(obs, C, len(_NEAR), _LEAST_DAYS)))


# ---------------------------------------------------------------------------
# head-weighted fill of every series
# ---------------------------------------------------------------------------

_FILLED = ["air_temp", "precip"]


def _head_fill_many_sql() -> str:
    span, s = 2 * FILL_RADIUS + 1, "CAST(-999 AS DOUBLE)"
    shape = "[" + ", ".join(str(abs(i - FILL_RADIUS)) for i in range(span)) + "]"
    ctes = ["src AS MATERIALIZED (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY obs_date) - 1 AS row_id FROM obs)"]
    for i, c in enumerate(_FILLED):
        ctes += [
            f"st{i} AS MATERIALIZED (SELECT series_id, COUNT(*) AS n, COUNT(*) FILTER ({c} <> {s}) AS nnm, "
            f"list({c} ORDER BY row_id) FILTER (row_id < {span}) AS h FROM src GROUP BY series_id)",
            f"fs{i} AS (SELECT series_id, list(row_id ORDER BY row_id) AS fp, list({c} ORDER BY row_id) AS fv FROM "
            f"(SELECT series_id, row_id, {c} FROM src WHERE {c} <> {s} "
            f"QUALIFY ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY row_id) <= {2 * span}) q GROUP BY series_id)",
            f"bs{i} AS MATERIALIZED (SELECT st{i}.*, coalesce(fp, []::BIGINT[]) AS fp, coalesce(fv, []::DOUBLE[]) AS fv "
            f"FROM st{i} LEFT JOIN fs{i} USING (series_id))",
            f"rc{i}(series_id, r, f) AS (SELECT series_id, 0, []::DOUBLE[] FROM st{i} UNION ALL "
            f"SELECT series_id, r + 1, list_append(f, CASE WHEN hv <> {s} THEN hv WHEN cnt <= 0 THEN {s} ELSE "
            f"list_sum(list_transform(range(m), lambda k: cur[k + 1] * exp(-{FILL_DECAY} * d[m - k]))) / "
            f"list_sum(list_transform(range(m), lambda k: exp(-{FILL_DECAY} * d[k + 1]))) END) FROM ("
            f"SELECT *, CAST(LEAST(len(d), cnt) AS BIGINT) AS m FROM ("
            f"SELECT series_id, r, f, h[r + 1] AS hv, list_concat(list_filter(f, lambda x: x <> {s}), "
            f"list_transform(list_filter(range(len(fp)), lambda j: fp[j + 1] > r), lambda j: fv[j + 1])) AS cur, "
            f"list_transform(range(GREATEST(0, r - {FILL_RADIUS}), LEAST(n, r + {FILL_RADIUS + 1})), lambda x: abs(x - r)) AS d, "
            f"(CASE WHEN len(f) > 0 AND f[1] <> {s} THEN r ELSE 0 END) + nnm - len(list_filter(fp, lambda p: p <= r)) AS cnt "
            f"FROM rc{i} JOIN bs{i} USING (series_id) WHERE r < LEAST(n, {span})) a) b)",
            f"fn{i} AS MATERIALIZED (SELECT series_id, n, f, list_transform(range({FILL_RADIUS + 1}, {span + 1}), lambda L: "
            f"list_sum(list_transform(range(L), lambda k: f[k + 1] * exp(-{FILL_DECAY} * {shape}[L - k]))) / "
            f"list_sum(list_transform(range(L), lambda k: exp(-{FILL_DECAY} * {shape}[k + 1])))) AS t "
            f"FROM rc{i} JOIN st{i} USING (series_id) WHERE r = LEAST(n, {span}))"]
    outs = [f"ROUND(CASE WHEN src.{c} <> {s} THEN src.{c} WHEN row_id < {span} THEN fn{i}.f[row_id + 1] "
            f"WHEN fn{i}.f[1] = {s} OR fn{i}.n <= {span} THEN {s} "
            f"ELSE fn{i}.t[LEAST({span}, fn{i}.n - row_id + {FILL_RADIUS}) - {FILL_RADIUS}] END, 6) AS {c}"
            for i, c in enumerate(_FILLED)]
    return ("WITH RECURSIVE " + Q.obs_only(many=True)[len("WITH "):].rstrip() + ",\n" + ",\n".join(ctes) +
            "\nSELECT series_id, row_id, " + ", ".join(outs) + " FROM src " +
            " ".join(f"JOIN fn{i} USING (series_id)" for i in range(len(_FILLED))))


@register("head_weighted_fill_many", _head_fill_many_sql())
def q_head_weighted_fill_many(spark, sf):
    """W6 in every supplier's series, without a read-back."""
    obs = with_position(station_obs(spark, sf, many=True).select("series_id", "obs_date", *_FILLED),
                        Ordering(("series_id",), ("obs_date",)), "row_id")
    return round_doubles(IM.head_weighted_fill(obs, _FILLED, "row_id", by=["series_id"]).drop("obs_date"))


# ---------------------------------------------------------------------------
# quantiles of every series
# ---------------------------------------------------------------------------

_QS = (0.05, 0.5, 0.95)


@register("quantiles_many", Q.with_ctes(Q.clean_cte(), many=True) + " UNION ALL ".join(
    f"SELECT series_id, CAST({q} AS DOUBLE) AS q, ROUND(quantile_cont(air_temp, {q}), 6) AS value FROM clean "
    "WHERE air_temp IS NOT NULL GROUP BY series_id" for q in _QS))
def q_quantiles_many(spark, sf):
    """A9 for many groups and ranks at once."""
    return round_doubles(exact_quantiles(_clean(spark, sf, many=True), "air_temp", list(_QS), ["series_id"]))
