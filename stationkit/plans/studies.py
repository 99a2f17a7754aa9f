"""Queries of the model studies with their SQL: polynomial least squares by QR
and by tiles, lasso, trees and forests (M6-M8, M11)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import round_doubles
from ..operators import gram_tiles as GT
from ..operators import lasso as LS
from ..operators import metrics as MT
from ..operators import tall_qr as QR
from ..operators import trees as TR
from . import sqltext as Q
from .registry import (FEATS, GOALS, _METRICS_SELECT, _MODEL_GOALS, _ols_models_sql, _split_sql_ctes, _split_sup,
                       register)

_P = len(FEATS)
_TRAIN = "split = 'train'"


def _with_recursive(ctes: list[str], select: str) -> str:
    return ("WITH RECURSIVE " + Q.obs_only()[len("WITH "):].rstrip() + ",\n" +
            ",\n".join(_split_sql_ctes() + ctes) + "\n" + select)


# ---------------------------------------------------------------------------
# least squares by QR
# ---------------------------------------------------------------------------

@register("ols_models_qr", _ols_models_sql())
def q_ols_models_qr(spark, sf):
    """M1 by QR: the coefficients of ``ols_models`` without Gram sums."""
    return round_doubles(QR.qr_models(_split_sup(spark, sf), FEATS, _MODEL_GOALS, fit_filter=_TRAIN))


def _scaled_ctes(source: str = "spl") -> list[str]:
    """``scl``: rows of ``source`` with x, the features scaled to -1..1."""
    bounds = ", ".join(f"MIN(CAST({f} AS DOUBLE)) AS lo{i}, MAX(CAST({f} AS DOUBLE)) AS hi{i}" for i, f in enumerate(FEATS))
    xs = ", ".join(f"CASE WHEN hi{i} = lo{i} THEN 0.0 ELSE 2 * (CAST({f} AS DOUBLE) - lo{i}) / (hi{i} - lo{i}) - 1 END"
                   for i, f in enumerate(FEATS))
    return [f"plim AS (SELECT {bounds} FROM spl)",
            f"scl AS (SELECT row_id, split, {', '.join(GOALS)}, [{xs}] AS x FROM {source}, plim)"]


def _poly_ols_sql() -> str:
    goals = list(_MODEL_GOALS.values())
    combos = QR.poly_combos(_P, 2)
    p = len(combos)
    terms = [f"x[{c[0] + 1}]" if len(c) == 1 else f"(3 * x[{c[0] + 1}] * x[{c[0] + 1}] - 1) / 2" if c[0] == c[1]
             else f"x[{c[0] + 1}] * x[{c[1] + 1}]" for c in combos]
    keys = " UNION ALL ".join(f"SELECT {k} AS k, '{mk}' AS model_key" for k, mk in enumerate(_MODEL_GOALS))
    ctes = _scaled_ctes() + [
        f"pv AS (SELECT row_id, split, [{', '.join(terms + [f'CAST({g} AS DOUBLE)' for g in goals])}] AS v FROM scl)",
        "pl AS MATERIALIZED (SELECT row_id, split, generate_subscripts(v, 1) AS t, unnest(v) AS val FROM pv)",
        "pm AS MATERIALIZED (SELECT t, AVG(val) AS m FROM pl WHERE split = 'train' GROUP BY t)",
        "pc AS MATERIALIZED (SELECT row_id, split, t, val, val - m AS c FROM pl JOIN pm USING (t))",
        f"pg AS (SELECT a.t AS i, b.t AS j, SUM(a.c * b.c) AS g FROM pc a JOIN pc b ON a.row_id = b.row_id "
        f"WHERE a.split = 'train' AND a.t <= {p} GROUP BY ALL)",
        "pa AS MATERIALIZED (SELECT list(r ORDER BY i) AS a FROM (SELECT i, list(g ORDER BY j) AS r FROM pg GROUP BY i))",
        "pe(t, a) AS (SELECT 0, a FROM pa UNION ALL SELECT t + 1, "
        "CASE WHEN a[t + 1][t + 1] = 0 THEN a ELSE list_transform(range(len(a)), lambda i: CASE WHEN i = t "
        "THEN list_transform(a[t + 1], lambda x: x / a[t + 1][t + 1]) "
        "ELSE list_transform(range(len(a[i + 1])), lambda j: a[i + 1][j + 1] - a[i + 1][t + 1] * a[t + 1][j + 1] "
        f"/ a[t + 1][t + 1]) END) END FROM pe WHERE t < {p})",
        f"ps AS MATERIALIZED (SELECT r AS t, k, a[r][{p} + k + 1] AS coef FROM pe, range(1, {p + 1}) q(r), "
        f"range({len(goals)}) s(k) WHERE pe.t = {p})",
        f"pk AS ({keys})",
        "pp AS (SELECT row_id, split, k, SUM(c * coef) AS off FROM pc JOIN ps USING (t) GROUP BY ALL)",
        f"prd AS (SELECT pk.model_key, pp.split, y.val AS y, pm.m + pp.off AS p FROM pp JOIN pk USING (k) "
        f"JOIN pc y ON y.row_id = pp.row_id AND y.t = {p} + pp.k + 1 JOIN pm ON pm.t = {p} + pp.k + 1)"]
    return _with_recursive(ctes, "SELECT *, 'ols' AS family, 2 AS degree FROM (" + _METRICS_SELECT + ") m")


@register("poly_ols", _poly_ols_sql())
def q_poly_ols(spark, sf):
    """M6: degree 2 on all fifteen features."""
    return round_doubles(QR.poly_family(_split_sup(spark, sf), "split", FEATS, _MODEL_GOALS, 2))


@register("degree_sweep")
def q_degree_sweep(spark, sf):
    """M7: degrees 1 to 4 on all fifteen features, 15 to 3,875 terms; the last
    by tiles."""
    sup = _split_sup(spark, sf)
    parts = [QR.poly_family(sup, "split", FEATS, _MODEL_GOALS, d) for d in (1, 2, 3)]
    parts.append(GT.poly_family_tiled(sup, "split", FEATS, _MODEL_GOALS, 4))
    return reduce(DataFrame.unionByName, parts)


def _degree4_sql() -> str:
    def place(f: int, e: int) -> int:
        return f * 5 + e + 1

    rows = []
    for t in [(), *QR.poly_combos(_P, 4)]:
        at = [place(f, t.count(f)) for f in sorted(set(t))]
        rows.append(f"('{QR.term_name(t)}', " + ", ".join(map(str, at + [1] * (4 - len(at)))) + ")")
    legendre = ", ".join(
        f"1.0, x[{i + 1}], (3 * x[{i + 1}] ** 2 - 1) / 2, (5 * x[{i + 1}] ** 3 - 3 * x[{i + 1}]) / 2, "
        f"(35 * x[{i + 1}] ** 4 - 30 * x[{i + 1}] ** 2 + 3) / 8" for i in range(_P))
    goals = list(_MODEL_GOALS.values())
    return _with_recursive(_scaled_ctes("trn") + [
        f"q AS MATERIALIZED (SELECT row_id, {', '.join(goals)}, [{legendre}] AS p FROM scl)",
        f"tt(term, a, b, c, d) AS (VALUES {', '.join(rows)})",
        "tv AS MATERIALIZED (SELECT row_id, term, p[a] * p[b] * p[c] * p[d] AS v FROM q, tt)",
        "rs AS (SELECT row_id, SUM(v) AS s FROM tv GROUP BY row_id)"],
        "SELECT term, ROUND(SUM(v * v), 2) AS sum_sq, ROUND(SUM(v * s), 2) AS row_sum, " +
        ", ".join(f"ROUND(SUM(v * {g}), 2) AS xy{k}" for k, g in enumerate(goals)) +
        " FROM tv JOIN rs USING (row_id) JOIN q USING (row_id) GROUP BY term")


@register("degree4_gram", _degree4_sql())
def q_degree4_gram(spark, sf):
    """The tiles of the degree-4 fit, term by term: 3,876 terms of the training
    rows with their squares, the sums of their matrix rows and their products
    with the goals."""
    goals = list(_MODEL_GOALS.values())
    x = QR.scaled_to_unit(_split_sup(spark, sf), FEATS, [
        F.col("split"), *[F.col(g).cast("double").alias(f"_y{k}") for k, g in enumerate(goals)]])
    blocks = GT.poly_blocks(_P, 4, len(goals))
    sums = GT.tile_sums(GT.gram_tiles(x.where(_TRAIN), blocks, _P), blocks)
    return sums.withColumns({c: F.round(c, 2) for c in sums.columns if c != "term"})


# ---------------------------------------------------------------------------
# lasso
# ---------------------------------------------------------------------------

_PENALTIES = [1.0, 0.3, 0.1, 0.03]
_SWEEPS = 80


def _lasso_sql() -> str:
    goals = list(_MODEL_GOALS.values())
    cols = FEATS + goals
    keys = " UNION ALL ".join(f"SELECT {k} AS k, '{mk}' AS model_key, CAST({a} AS DOUBLE) AS penalty"
                              for k, mk in enumerate(_MODEL_GOALS) for a in _PENALTIES)
    ctes = [
        "lmu AS (SELECT COUNT(*) AS n, " + ", ".join(f"AVG(CAST({c} AS DOUBLE)) AS m_{i}" for i, c in enumerate(cols)) +
        " FROM trn)",
        "lcx AS (SELECT " + ", ".join(f"CAST({c} AS DOUBLE) - m_{i} AS v{i}" for i, c in enumerate(cols)) + " FROM trn, lmu)",
        "lgm AS (SELECT [" + ", ".join("[" + ", ".join(f"AVG(v{i} * v{j})" for j in range(len(cols))) + "]"
                                       for i in range(_P)) + "] AS g FROM lcx)",
        f"lsd AS (SELECT g, list_transform(range({_P}), lambda i: CASE WHEN g[i + 1][i + 1] > 0 "
        "THEN SQRT(g[i + 1][i + 1]) ELSE 1.0 END) AS u FROM lgm)",
        f"lst AS MATERIALIZED (SELECT u, list_transform(range({_P}), lambda i: list_transform(range({_P}), lambda j: "
        "g[i + 1][j + 1] / (u[i + 1] * u[j + 1]))) AS a, "
        f"list_transform(range({_P}), lambda i: list_transform(range({len(goals)}), lambda k: "
        f"g[i + 1][{_P} + k + 1] / u[i + 1])) AS c FROM lsd)",
        f"lky AS ({keys})",
        f"lss(k, model_key, penalty, t, b) AS (SELECT k, model_key, penalty, 0, list_transform(range({_P}), "
        "lambda i: CAST(0 AS DOUBLE)) FROM lky UNION ALL "
        "SELECT k, model_key, penalty, t + 1, list_transform(range(len(b)), lambda i: CASE WHEN i <> j OR a[j + 1][j + 1] <= 0 "
        "THEN b[i + 1] WHEN z > penalty THEN (z - penalty) / a[j + 1][j + 1] WHEN z < -penalty THEN (z + penalty) "
        "/ a[j + 1][j + 1] ELSE 0.0 END) FROM ("
        f"SELECT lss.*, a, t % {_P} AS j, c[t % {_P} + 1][k + 1] - list_sum(list_transform(range({_P}), lambda i: "
        f"a[t % {_P} + 1][i + 1] * b[i + 1])) + a[t % {_P} + 1][t % {_P} + 1] * b[t % {_P} + 1] AS z "
        f"FROM lss, lst WHERE t < {_SWEEPS * _P}) q)",
        f"lbb AS MATERIALIZED (SELECT k, model_key, penalty, list_transform(range({_P}), lambda i: b[i + 1] / u[i + 1]) AS s, "
        f"lmu.* FROM lss, lst, lmu WHERE t = {_SWEEPS * _P})"]
    mean_y = "CASE k " + " ".join(f"WHEN {k} THEN m_{_P + k}" for k in range(len(goals))) + " END"
    parts = [f"SELECT model_key, penalty, 'intercept' AS term, ROUND({mean_y} - (" +
             " + ".join(f"s[{j + 1}] * m_{j}" for j in range(_P)) + "), 6) AS coef FROM lbb"]
    parts += [f"SELECT model_key, penalty, '{f}' AS term, ROUND(s[{j + 1}], 6) AS coef FROM lbb" for j, f in enumerate(FEATS)]
    return _with_recursive(ctes, " UNION ALL ".join(parts))


@register("lasso_models", _lasso_sql())
def q_lasso_models(spark, sf):
    """Lasso coefficients of the six models for a path of penalties."""
    out = round_doubles(LS.lasso_models(_split_sup(spark, sf), FEATS, _MODEL_GOALS, _PENALTIES, fit_filter=_TRAIN))
    return out.withColumn("coef", F.col("coef") + F.lit(0.0))


# ---------------------------------------------------------------------------
# trees and forests
# ---------------------------------------------------------------------------

_DEPTH, _BINS, _LEAST, _TREES, _SEED = 4, 32, 5, 5, 7


def _tree_ctes(trees: int, seed: int | None) -> list[str]:
    """Levels of the growth, unrolled: ``tm{L}`` rows, ``ts{L}`` splits, ``tn{L}`` nodes."""
    goals = list(_MODEL_GOALS.items())
    bounds = ", ".join(f"MIN(CAST({f} AS DOUBLE)) AS lo{i}, MAX(CAST({f} AS DOUBLE)) AS hi{i}" for i, f in enumerate(FEATS))
    bins = ", ".join(
        f"CASE WHEN hi{i} = lo{i} THEN 0 ELSE GREATEST(0, LEAST(CAST(FLOOR((CAST({f} AS DOUBLE) - lo{i}) / (hi{i} - lo{i}) "
        f"* {float(_BINS)}) AS INTEGER), {_BINS - 1})) END" for i, f in enumerate(FEATS))
    draws = []
    for t in range(trees):
        u = f"{Q.hash_sql(f'{seed}:{t}', 'row_id')} / 4294967296.0"
        w = "1.0" if seed is None else "CASE " + " ".join(
            f"WHEN {u} < CAST({c!r} AS DOUBLE) THEN {float(k)}" for k, c in enumerate(TR.POISSON)) + " ELSE 4.0 END"
        draws += [f"SELECT row_id, split, bins, '{mk}' AS model_key, {t} AS tree, CAST({g} AS DOUBLE) AS y, "
                  f"CAST({w} AS DOUBLE) AS w, CAST(1 AS BIGINT) AS node FROM tb" for mk, g in goals]
    out = [f"tlim AS (SELECT {bounds} FROM trn)",
           f"tb AS MATERIALIZED (SELECT row_id, split, {', '.join(GOALS)}, [{bins}] AS bins FROM spl, tlim)",
           "tm0 AS MATERIALIZED (" + " UNION ALL ".join(draws) + ")"]
    for d in range(_DEPTH):
        out += [
            f"tc{d} AS MATERIALIZED (SELECT model_key, tree, node, f, bins[f + 1] AS bin, SUM(w) AS n, SUM(w * y) AS s "
            f"FROM tm{d}, range({_P}) r(f) WHERE split = 'train' AND w > 0 GROUP BY ALL)",
            f"tg{d} AS (SELECT *, SUM(n) OVER o AS nl, SUM(s) OVER o AS sl, SUM(n) OVER a AS nt, SUM(s) OVER a AS st FROM tc{d} "
            "WINDOW o AS (PARTITION BY model_key, tree, node, f ORDER BY bin), a AS (PARTITION BY model_key, tree, node, f))",
            f"ts{d} AS MATERIALIZED (SELECT model_key, tree, node, f, bin FROM (SELECT *, ROUND(sl * sl / nl + (st - sl) * "
            f"(st - sl) / (nt - nl) - st * st / nt, 6) AS gain FROM tg{d} WHERE nl >= {_LEAST} AND nt - nl >= {_LEAST}) g "
            "WHERE gain > 0 QUALIFY ROW_NUMBER() OVER (PARTITION BY model_key, tree, node ORDER BY gain DESC, f, bin) = 1)"]
        out.append(f"tm{d + 1} AS MATERIALIZED (SELECT m.row_id, m.split, m.bins, m.model_key, m.tree, m.y, m.w, m.node * 2 + "
                   f"CASE WHEN m.bins[s.f + 1] > s.bin THEN 1 ELSE 0 END AS node FROM tm{d} m JOIN ts{d} s USING "
                   "(model_key, tree, node))")
    for d in range(_DEPTH + 1):
        split = (f"LEFT JOIN ts{d} s USING (model_key, tree, node)" if d < _DEPTH else
                 "LEFT JOIN (SELECT CAST(NULL AS BIGINT) AS f, CAST(NULL AS INTEGER) AS bin) s ON true")
        out.append(f"tn{d} AS MATERIALIZED (SELECT model_key, tree, node, {d} AS depth, n, mean, s.f AS f, s.bin AS bin FROM "
                   f"(SELECT model_key, tree, node, SUM(w) AS n, SUM(w * y) / SUM(w) AS mean FROM tm{d} "
                   f"WHERE split = 'train' AND w > 0 GROUP BY ALL) m {split})")
    out.append("tnode AS (" + " UNION ALL ".join(f"SELECT * FROM tn{d}" for d in range(_DEPTH + 1)) + ")")
    out.append("tend AS MATERIALIZED (" + " UNION ALL ".join(
        f"SELECT m.row_id, m.split, m.model_key, m.tree, m.y, n.mean, n.node FROM tm{d} m JOIN tn{d} n USING (model_key, tree, node) "
        "WHERE n.f IS NULL" for d in range(_DEPTH + 1)) + ")")
    return out


def _tree_nodes_sql() -> str:
    name = "[" + ", ".join(f"'{f}'" for f in FEATS) + "][f + 1]"
    lo = "[" + ", ".join(f"lo{i}" for i in range(_P)) + "][f + 1]"
    hi = "[" + ", ".join(f"hi{i}" for i in range(_P)) + "][f + 1]"
    return _with_recursive(_tree_ctes(1, None), (
        f"SELECT model_key, node, CAST(depth AS INTEGER) AS depth, CAST(n AS BIGINT) AS n, ROUND(mean, 6) AS mean, "
        f"{name} AS feature, ROUND({lo} + (bin + 1) * (({hi} - {lo}) / {float(_BINS)}), 6) AS threshold FROM tnode, tlim"))


def _grown(sup, trees: int = 1, seed: int | None = None):
    return TR.grow(sup, FEATS, _MODEL_GOALS, _TRAIN, depth=_DEPTH, bins=_BINS, least_rows=float(_LEAST), trees=trees,
                   seed=seed)


@register("tree_nodes", _tree_nodes_sql())
def q_tree_nodes(spark, sf):
    """M8: one regression tree a goal as a table of nodes."""
    nodes = _grown(_split_sup(spark, sf))
    return round_doubles(nodes.select("model_key", "node", "depth", F.col("n").cast("long"), "mean", "feature", "threshold"))


@register("tree_predictions", _with_recursive(
    _tree_ctes(1, None), "SELECT row_id, split, model_key, ROUND(y, 6) AS y, ROUND(mean, 6) AS p FROM tend"))
def q_tree_predictions(spark, sf):
    """M8: the trees' predictions of every row."""
    sup = _split_sup(spark, sf)
    return round_doubles(TR.predict(sup, _grown(sup), FEATS, _MODEL_GOALS, _TRAIN, ["row_id", "split"], _BINS))


@register("forest_metrics", _with_recursive(
    _tree_ctes(_TREES, _SEED) + ["prd AS (SELECT model_key, split, row_id, ANY_VALUE(y) AS y, AVG(mean) AS p FROM tend "
                                 "GROUP BY model_key, split, row_id)"], _METRICS_SELECT))
def q_forest_metrics(spark, sf):
    """M8: a forest of five trees a goal on Poisson draws of the rows."""
    sup = _split_sup(spark, sf)
    pred = TR.predict(sup, _grown(sup, _TREES, _SEED), FEATS, _MODEL_GOALS, _TRAIN, ["row_id", "split"], _BINS)
    return round_doubles(MT.regression_metrics(pred, ["model_key", "split"], "y", "p"))
