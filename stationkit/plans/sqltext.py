"""SQL text pieces for the DuckDB oracle of each registered query.

The oracle restates each operator in plain SQL over the same stand-in
tables, so Spark results can be compared row for row.  Pieces are shared so
each query's oracle stays short.
"""

from __future__ import annotations

from ..config import DEFAULT as C
from ..sources.fixtures import obs_ctes

MEASURES = list(C.measures)


def r6(expr: str, alias: str) -> str:
    return f"ROUND({expr}, 6) AS {alias}"


def clean_cte(src: str = "obs", name: str = "clean") -> str:
    cols = ", ".join(f"NULLIF({m}, -999) AS {m}" for m in MEASURES)
    return f"{name} AS (SELECT series_id, obs_date, {cols} FROM {src} WHERE obs_date IS NOT NULL)"


def future_cte(src: str, name: str, targets=None, horizons: int = 3) -> str:
    targets = targets or list(C.targets)
    leads = ", ".join(f"LEAD({t}, {k}) OVER w AS {t}_future_{k}Day"
                      for k in range(1, horizons + 1) for t in targets)
    return (f"{name} AS (SELECT *, {leads} FROM {src} "
            f"WINDOW w AS (PARTITION BY series_id ORDER BY obs_date))")


def interp_cte(src: str, name: str, col: str, other_cols: list[str]) -> str:
    """Linear interpolation of ``col`` by row within each series."""
    wb = "(PARTITION BY series_id ORDER BY obs_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    wf = "(PARTITION BY series_id ORDER BY obs_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    inner = (f"{name}_n AS (SELECT *, "
             f"LAST_VALUE({col} IGNORE NULLS) OVER {wb} AS _pv, "
             f"LAST_VALUE(CASE WHEN {col} IS NOT NULL THEN _pos END IGNORE NULLS) OVER {wb} AS _pp, "
             f"FIRST_VALUE({col} IGNORE NULLS) OVER {wf} AS _nv, "
             f"FIRST_VALUE(CASE WHEN {col} IS NOT NULL THEN _pos END IGNORE NULLS) OVER {wf} AS _np "
             f"FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY series_id ORDER BY obs_date) - 1 AS _pos "
             f"FROM {src}) _t)")
    rest = ", ".join(other_cols)
    outer = (f"{name} AS (SELECT {rest}{', ' if rest else ''}"
             f"CASE WHEN {col} IS NOT NULL THEN {col} WHEN _pv IS NULL THEN NULL "
             f"WHEN _nv IS NULL THEN _pv "
             f"ELSE _pv + (_nv - _pv) * CAST(_pos - _pp AS DOUBLE) / CAST(_np - _pp AS DOUBLE) END AS {col} "
             f"FROM {name}_n)")
    return inner + ",\n" + outer


def obs_only(many: bool = False) -> str:
    """WITH clause defining only the station stand-in ``obs``."""
    return "WITH " + obs_ctes(many) + "\n"


def with_ctes(*ctes: str, many: bool = False) -> str:
    return "WITH " + obs_ctes(many) + ",\n" + ",\n".join(ctes) + "\n"


def sel(cols, src: str = "", places: int = 6, keep=("series_id", "obs_date")) -> str:
    """Select list rounding every measure-like column."""
    out = []
    for c in cols:
        ref = f"{src}.{c}" if src else c
        out.append(ref if c in keep else r6(ref, c).replace(", 6)", f", {places})"))
    return ", ".join(out)


def supervised_ctes(cfg=C) -> list[str]:
    """The preparation job in SQL for the stations of ``cfg`` (target first).
    Output names are quoted: station ids may start with a digit."""
    T = cfg.target_series
    goals = [f"{t}_future_{k}Day" for t in cfg.targets for k in range(1, cfg.horizons + 1)]
    others = [m for m in MEASURES if m != "air_temp"]
    tgt_cols = ["series_id", "obs_date"] + others + goals
    oth_cols = ["series_id", "obs_date"] + others
    alias = {s: f"s{i}" for i, s in enumerate(cfg.series)}
    body = []
    for s in cfg.series:
        for f in cfg.features:
            body.append(f'{alias[s]}.{f} AS "{s}_{f}"')
    for g in goals:
        body.append(f'{alias[T]}.{g} AS "{T}_{g}"')
    body.append(f"{alias[T]}.obs_date AS obs_date")
    joins = "".join(f" JOIN (SELECT * FROM oth WHERE series_id = '{s}') {alias[s]} ON {alias[T]}.obs_date = "
                    f"{alias[s]}.obs_date" for s in cfg.series if s != T)
    return [
        clean_cte(),
        future_cte(f"(SELECT * FROM clean WHERE series_id = '{T}')", "tgt_f"),
        interp_cte("tgt_f", "tgt", "air_temp", tgt_cols),
        interp_cte(f"(SELECT * FROM clean WHERE series_id <> '{T}')", "oth", "air_temp", oth_cols),
        "wide AS (SELECT " + ", ".join(body) + f" FROM tgt {alias[T]}" + joins + ")",
        "sup AS (SELECT * FROM wide WHERE " +
        " AND ".join(f'"{c}" IS NOT NULL' for c in cfg.feature_columns() + cfg.goal_columns()) + ")",
    ]


def supervised_sql_for(cfg, many: bool = False) -> str:
    cols = cfg.feature_columns() + cfg.goal_columns()
    sel = ", ".join([f'ROUND("{c}", 6) AS "{c}"' for c in cols] + ["obs_date"])
    return with_ctes(*supervised_ctes(cfg), many=many) + f"SELECT {sel} FROM sup"


SUP_COLS = C.feature_columns() + C.goal_columns()


def supervised_sql(complete: bool = True) -> str:
    src = "sup" if complete else "wide"
    return with_ctes(*supervised_ctes()) + f"SELECT {sel(SUP_COLS + ['obs_date'])} FROM {src}"


def sup_rowid_cte() -> str:
    """Supervised table with its 0-based position by date."""
    return "supr AS (SELECT *, ROW_NUMBER() OVER (ORDER BY obs_date) - 1 AS row_id FROM sup)"


def hash_sql(seed, key: str) -> str:
    return f"CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


def head_fill_sql(src: str, cols: list[str], keep: list[str], radius: int = 5, decay: float = 0.1,
                  sentinel: float = -999.0) -> tuple[list[str], str]:
    """CTEs and the final SELECT of the head-weighted fill over ``src``
    (which has a 0-based ``row_id``).  Per column: a recursive CTE fills the
    first 2*radius+1 rows in order from the first 2*(2*radius+1) non-missing
    values; every later missing row takes the value for its window length."""
    span = 2 * radius + 1
    s = repr(float(sentinel))
    dfull = "[" + ", ".join(str(abs(i - radius)) for i in range(span)) + "]"
    ctes = []
    for i, c in enumerate(cols):
        ctes += [
            f"st{i} AS (SELECT COUNT(*) AS n, CAST(SUM(CASE WHEN {c} <> {s} THEN 1 ELSE 0 END) AS BIGINT) AS nnm "
            f"FROM {src})",
            f"hd{i} AS (SELECT list({c} ORDER BY row_id) AS h FROM {src} WHERE row_id < {span})",
            f"fs{i} AS (SELECT COALESCE(list(row_id ORDER BY row_id), []::BIGINT[]) AS fp, "
            f"COALESCE(list({c} ORDER BY row_id), []::DOUBLE[]) AS fv FROM "
            f"(SELECT row_id, {c} FROM {src} WHERE {c} <> {s} ORDER BY row_id LIMIT {2 * span}) q)",
            f"rc{i}(r, filled) AS (SELECT 0, []::DOUBLE[] UNION ALL "
            f"SELECT r + 1, list_append(filled, CASE WHEN hv <> {s} THEN hv WHEN cnt <= 0 THEN {s} ELSE "
            f"list_sum(list_transform(range(m), lambda k: cur[k + 1] * exp(-{decay} * d[m - k]))) / "
            f"list_sum(list_transform(range(m), lambda k: exp(-{decay} * d[k + 1]))) END) FROM ("
            f"SELECT r, filled, hv, cur, d, CAST(LEAST(len(d), cnt) AS BIGINT) AS m, cnt FROM ("
            f"SELECT r, filled, h[r + 1] AS hv, "
            f"list_concat(list_filter(filled, lambda x: x <> {s}), "
            f"list_transform(list_filter(range(len(fp)), lambda j: fp[j + 1] > r), lambda j: fv[j + 1])) AS cur, "
            f"list_transform(range(GREATEST(0, r - {radius}), LEAST(n, r + {radius + 1})), lambda x: abs(x - r)) AS d, "
            f"(CASE WHEN len(filled) > 0 AND filled[1] <> {s} THEN r ELSE 0 END) + "
            f"(nnm - len(list_filter(fp, lambda p: p <= r))) AS cnt "
            f"FROM rc{i}, hd{i}, fs{i}, st{i} WHERE r < LEAST(n, {span})) a) b)",
            f"fin{i} AS (SELECT filled AS f FROM rc{i} ORDER BY r DESC LIMIT 1)",
            f"tl{i} AS (SELECT list_transform(range({radius + 1}, {span + 1}), lambda L: "
            f"list_sum(list_transform(range(L), lambda k: f[k + 1] * exp(-{decay} * {dfull}[L - k]))) / "
            f"list_sum(list_transform(range(L), lambda k: exp(-{decay} * {dfull}[k + 1])))) AS t FROM fin{i})",
        ]
    outs = []
    for i, c in enumerate(cols):
        L = f"LEAST({span}, st{i}.n - {src}.row_id + {radius})"
        outs.append(f"ROUND(CASE WHEN {src}.{c} <> {s} THEN {src}.{c} "
                    f"WHEN {src}.row_id < {span} THEN fin{i}.f[{src}.row_id + 1] "
                    f"WHEN fin{i}.f[1] = {s} OR st{i}.n <= {span} THEN {s} "
                    f"ELSE tl{i}.t[{L} - {radius}] END, 6) AS {c}")
    froms = ", ".join([src] + [f"st{i}, fin{i}, tl{i}" for i in range(len(cols))])
    select = "SELECT " + ", ".join([f"{src}.{k} AS {k}" for k in keep] + outs) + " FROM " + froms
    return ctes, select


def ols_sql(train: str, feats: list[str], goals: dict[str, str], prefix: str = "o",
            alpha: float = 0.0) -> tuple[list[str], str]:
    """CTEs solving ordinary least squares with intercept for every goal on
    the rows of ``train``: the normal equations of the mean-centred columns,
    solved by Gauss-Jordan elimination in a recursive CTE (one augmented
    matrix for all goals).  A zero pivot (a column constant on the fitting
    rows, whose centred row and column are exactly zero) is skipped, which
    gives it coefficient 0, as the least-norm solution does.  ``alpha`` adds a
    ridge penalty to the diagonal.  Returns the CTEs and the name of a CTE with
    ``(model_key, term, coef)``."""
    gcols = list(goals.values())
    cols = list(feats) + gcols
    p, q = len(feats), len(gcols)
    ctes = [
        f"{prefix}mu AS (SELECT " + ", ".join(f"AVG(CAST({c} AS DOUBLE)) AS m_{i}" for i, c in enumerate(cols)) +
        f" FROM {train})",
        f"{prefix}cx AS (SELECT " + ", ".join(f"CAST({c} AS DOUBLE) - m_{i} AS v{i}" for i, c in enumerate(cols)) +
        f" FROM {train}, {prefix}mu)",
        f"{prefix}gm AS (SELECT [" + ", ".join(
            "[" + ", ".join([f"SUM(v{i} * v{j})" + (f" + {alpha!r}" if i == j and alpha else "") for j in range(p)] +
            [f"SUM(v{i} * v{p + k})" for k in range(q)]) + "]" for i in range(p)) + f"] AS a FROM {prefix}cx)",
        f"{prefix}ge(t, a) AS (SELECT 0, a FROM {prefix}gm UNION ALL SELECT t + 1, "
        "CASE WHEN a[t + 1][t + 1] = 0 THEN a ELSE list_transform(range(len(a)), lambda i: CASE WHEN i = t "
        "THEN list_transform(a[t + 1], lambda x: x / a[t + 1][t + 1]) "
        "ELSE list_transform(range(len(a[i + 1])), lambda j: a[i + 1][j + 1] - a[i + 1][t + 1] * a[t + 1][j + 1] "
        f"/ a[t + 1][t + 1]) END) END FROM {prefix}ge WHERE t < {p})",
        f"{prefix}sol AS (SELECT a FROM {prefix}ge WHERE t = {p})",
    ]
    parts = []
    for k, mk in enumerate(goals):
        col = p + k + 1
        icpt = f"m_{p + k} - (" + " + ".join(f"a[{j + 1}][{col}] * m_{j}" for j in range(p)) + ")"
        parts.append(f"SELECT '{mk}' AS model_key, 'intercept' AS term, {icpt} AS coef FROM {prefix}sol, {prefix}mu")
        for j, f in enumerate(feats):
            parts.append(f"SELECT '{mk}' AS model_key, '{f}' AS term, a[{j + 1}][{col}] AS coef FROM {prefix}sol")
    ctes.append(f"{prefix}coef AS (" + " UNION ALL ".join(parts) + ")")
    return ctes, f"{prefix}coef"
