"""Findings of round 4, on rows built here."""
import time

import numpy as np
import pytest

from stationkit.operators import pair_tiles as PT
from stationkit.session import cut_lineage, shuffles_dropped


# ------------------------------------------------------------------ packed blocks (F1)

def cells_of(spark, key="cast(id % 40 as string)"):
    return spark.range(280).selectExpr(f"{key} as d", "cast(id % 7 as string) s", "cast(id * id % 11 as double) v")


def test_values_are_packed_by_one_shuffle(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(PT, "cut_lineage", lambda df, name: plans.append(
        df._jdf.queryExecution().executedPlan().toString()) or cut_lineage(df, name))
    assert PT.corr_tiles(cells_of(spark), "d", "s", "v").count() == 28
    plan, = plans
    assert plan.split("Initial Plan")[-1].count("Exchange") == 1 and "Join" not in plan


def test_tables_written_for_tiles_leave_no_shuffle_files(spark):
    def files():
        blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {n for n in (blocks.apply(i).getName() for i in range(blocks.size())) if n.startswith("shuffle_")}

    before, key = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    x = cells_of(spark)
    with shuffles_dropped(spark):
        assert spark.conf.get(key) == "true"
        cut_lineage(x.repartition(3, "d"))
    assert spark.conf.get(key) == "false"
    for _ in range(50):  # files go in the background
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before


@pytest.mark.parametrize("key", ["cast(id % 40 as int)", "date_add(date'1969-12-20', cast(id % 40 as int))", "cast(id % 40 as double)"])
@pytest.mark.parametrize("cells", [1000, 20])
def test_keys_of_any_type_pair_the_same_rows(spark, key, cells):
    want = sorted(PT.corr_tiles(cells_of(spark), "d", "s", "v").collect())
    got = sorted(PT.corr_tiles(cells_of(spark, key), "d", "s", "v", 3, cells).collect())
    assert [(r.col_a, r.col_b, r.n_pairs) for r in got] == [(r.col_a, r.col_b, r.n_pairs) for r in want]
    assert np.allclose([r.corr for r in got], [r.corr for r in want], atol=1e-12)


# ------------------------------------------------------------------ best pairs of tiles (F2)

def block(number, columns):
    """A packed block of columns {name: {key: value}}, less their means."""
    names = sorted(columns)
    with np.errstate(invalid="ignore"):
        columns = {n: dict(zip(c, np.array(list(c.values())) - np.mean(list(c.values())))) for n, c in columns.items()}
    keys = sorted({k for c in columns.values() for k in c})
    cells = [(keys.index(k), i, v) for i, name in enumerate(names) for k, v in sorted(columns[name].items())]
    k, c, v = zip(*cells)
    return {"rows": 0, "block": number, "keys": [f"k{k:05}" for k in keys], "cols": names, "k": np.array(k, "i4").tobytes(),
            "c": np.array(c, "i4").tobytes(), "v": np.array(v, "f8").tobytes()}


def odd_columns(seed, prefix, n, days=90):
    """Noise, near ties, offsets, outliers, columns hardly varied, constant, short, huge and tiny."""
    rnd = np.random.default_rng(seed)
    base = np.random.default_rng(1).normal(size=days)

    def some(values, share=0.6):
        return {int(d): float(values[d]) for d in np.flatnonzero(rnd.random(days) < share)}

    made = {f"{prefix}noise{i}": some(rnd.normal(size=days)) for i in range(n)}
    made |= {f"{prefix}near{i}": some(base + 10.0 ** -i * rnd.normal(size=days)) for i in range(9)}
    made |= {f"{prefix}tie{i}": some(base * 3 + i) for i in range(4)}
    made |= {f"{prefix}high{i}": some(1e7 + rnd.normal(size=days)) for i in range(3)}
    made |= {f"{prefix}out{i}": some(rnd.normal(size=days) + 1e9 * (np.arange(days) == 7 * i)) for i in range(3)}
    made |= {f"{prefix}size{i}": some(base * s + rnd.normal(size=days) * s) for i, s in enumerate((1e-200, 1e-40, 1e40, 1e120, 1e-25))}
    return made | {f"{prefix}flat": some(np.full(days, 4.0)), f"{prefix}one": {3: 1.0}, f"{prefix}odd": {500: 1.0, 3: 2.0},
                   f"{prefix}wild": some(np.where(base > 1, np.inf, base))}


def found(a, b, best):
    rows = {}
    sides = PT._sides(a, b)
    with np.errstate(all="ignore"):
        for p, q, sums in PT._wanted(*sides, a["block"] == b["block"], best):
            rows |= {(a["cols"][i], b["cols"][j]): s for i, j, s in zip(p, q, sums.T)}
    return rows


def ranked(rows, best):
    """The k best of each column, by the sums of all pairs."""
    k, least, places = best
    scores = dict(zip(rows, PT._scores(np.array(list(rows.values())).T, least, places)))
    per = {}
    for (a, b), score in scores.items():
        if a != b and score > -np.inf:
            per.setdefault(("left", a), []).append((-score, b))
            per.setdefault(("right", b), []).append((-score, a))
    return {(side, col, other) for (side, col), pairs in per.items() for _, other in sorted(pairs)[:k]}


@pytest.mark.parametrize("columns,keys", [(512, 4096), (7, 4096), (16, 25)])
@pytest.mark.parametrize("best", [(2, 30, 9), (1, 2, 9), (3, 5, 4)])
def test_best_pairs_by_single_precision_are_those_of_double(monkeypatch, columns, keys, best):
    monkeypatch.setattr(PT, "COLUMNS", columns)
    monkeypatch.setattr(PT, "KEYS", keys)
    a, b = block(0, odd_columns(2, "a", 40)), block(1, odd_columns(3, "b", 30))
    for pair in ((a, b), (a, a)):
        with np.errstate(all="ignore"):
            every = found(*pair, None)
            got = found(*pair, best)
        want = ranked(every, best)
        assert want and {(a, b) for side, *ab in want for a, b in [ab if side == "left" else ab[::-1]]} == got.keys()
        for key, sums in got.items():
            assert np.allclose(sums, every[key], rtol=1e-11, atol=1e-9 * np.abs(every[key]).max())


def test_bounds_hold_the_correlation_of_every_pair():
    a, b = block(0, odd_columns(4, "a", 60)), block(1, odd_columns(5, "b", 60))
    left, right, shared = PT._sides(a, b)
    whole = (0, len(left.cols)), (0, len(right.cols))
    with np.errstate(all="ignore"):
        low, high = PT._bounds(PT._single_sums(left, right, *whole, [(0, shared)], None), 1, 2)
        score = PT._scores(np.concatenate([s for _, _, s in PT._tile(left, right, shared, False)], 2), 2, 12) / 1e12
    fit = score > -np.inf
    assert (low[fit] <= score[fit] + 1e-9).all() and (score[fit] <= high[fit] + 1e-9).all()
    assert np.median(high[fit] - low[fit]) < 1e-3 and not np.isfinite(high[~fit]).any()


def test_a_tile_of_equal_columns_is_added_up_whole(monkeypatch):
    values = np.random.default_rng(6).normal(size=60)
    a = block(0, {f"a{i:02}": dict(enumerate(values)) for i in range(50)})
    b = block(1, {f"b{i:02}": dict(enumerate(values)) for i in range(50)})
    left, right, shared = PT._sides(a, b)
    want = {(f"a{i:02}", f"b{j:02}") for i in range(50) for j in range(50) if i < 2 or j < 2}
    assert len(PT._candidates(left, right, shared, False, 2, 30, 9)[0]) == 2500  # few enough to be looked at one by one
    assert found(a, b, (2, 30, 9)).keys() == want
    monkeypatch.setattr(PT, "FEW_PAIRS", 1000)
    assert PT._candidates(left, right, shared, False, 2, 30, 9) is None
    assert found(a, b, (2, 30, 9)).keys() == want


def test_the_ranking_computes_the_pairs_once(spark):
    plan = PT.nearest_by_tiles(cells_of(spark), "d", "s", "v", 2, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("MapInArrow") == 1
