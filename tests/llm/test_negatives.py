import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationkit.llm import negatives


def brute(rows, step=100, k=5):
    known = set()
    for i, v, y in rows:
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            known.add((i, tuple(math.floor(256 * x) for x in v), y))
    out = []
    for a in known:
        if a[0] % step:
            continue
        scored = sorted((-sum(p * q for p, q in zip(a[1], r[1])), r[0], r) for r in known if r != a)
        for ps, pi, _ in [s for s in scored if s[2][2] == a[2]][:k]:
            fits = [(s, i) for s, i, r in scored if r[2] != a[2] and 80 * -ps <= 100 * -s <= 100 * -ps][:k]
            out += [(a[0], pi, n, i, -ps, -s) for n, (s, i) in enumerate(fits, 1)]
    return sorted(out)


def run(spark, rows, step=100, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select(
        "*", *[F.lit(0).alias(c) for c in ("u", "a", "score", "ids", "ints", "rank", "first", "anchor", "tops")])
    return sorted(tuple(r) for r in negatives.mine(df, F.col("vec_id") % step == 0, **kw).collect())


def clustered(seed, n, dims, labels=4, near=0.15):
    rnd = random.Random(seed)
    middles = [[rnd.gauss(0, 0.3) for _ in range(dims)] for _ in range(labels)]
    return [(i, [m + rnd.gauss(0, near) for m in middles[i % labels]], rnd.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("dims,block", [(16, 512), (33, 7), (1, 40), (64, 64)])
def test_equals_brute_force(spark, monkeypatch, dims, block):
    monkeypatch.setattr(negatives, "BLOCK", block)
    rows = clustered(dims, 300, dims)
    got = run(spark, rows, step=20)
    assert got == brute(rows, 20) and got


def test_one_vector_and_one_label_for_a_third(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 32)
    rnd = random.Random(3)
    hot = [0.5, 0.25, 0.125, 0.75]
    rows = [(i, hot if i % 3 == 0 else [rnd.choice([0.0, 0.5, 0.4]) for _ in range(4)], rnd.choice([0, 0, 1, 2]))
            for i in range(300)]
    got = run(spark, rows, step=10)
    assert got == brute(rows, 10) and got


def test_nulls_odd_lengths_repeats_and_negative_scores(spark):
    rows = [(0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (100, [1.0, None], 1), (200, None, 1), (300, [1.0, 1.0], None),
            (None, [1.0, 1.0], 1), (400, [float("nan"), 1.0], 1), (500, [float("inf"), 0.0], 2), (600, [1.0], 1),
            (1, [1.0, 1.9], 2), (2, [1.0, 2.0], 1), (3, [], 2), (700, [-1.0, -1.0], 1), (800, [0.0, 0.0], 2), (4, [0.9, 2.0], 2)]
    assert run(spark, rows) == brute(rows)


def test_no_rows_and_no_anchors(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [0.5, 0.5], 1), (2, [0.5, 0.1], 2)]) == []
    assert run(spark, [(100, [0.5, 0.5], 1), (2, [0.5, 0.1], 2)]) == []


def test_bounds_hold_and_narrow_level_by_level():
    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.normal(0.1, 0.4, (40, 70))).astype("<i8")
    a, b = negatives._Block(x[:15].tobytes(), 15), negatives._Block(x[15:].tobytes(), 25)
    exact, width = x[:15] @ x[15:].T, np.inf
    for level in range(len(a.levels)):
        low, high = negatives.bounds(a, b, level)
        assert (low <= exact).all() and (exact <= high).all()
        assert (high - low).mean() < width
        width = (high - low).mean()
    assert len(a.levels) == 3


def test_the_bounds_decide_most_pairs(spark):
    """Well separated groups: few pairs are scored exactly."""
    rng = np.random.default_rng(7)
    centre = np.repeat(rng.normal(0, 1, (8, 16)), 4, axis=1)
    y = np.arange(400) % 8
    x = np.floor(256 * (centre[y] + rng.normal(0, 0.05, (400, 64)))).astype("<i8")
    a, b = negatives._Block(x[:40].tobytes(), 40), negatives._Block(x[40:].tobytes(), 360)
    counts = [0] * (len(a.levels) + 1)
    low_of = np.sort((x[:40] @ x[40:].T), axis=1)[:, -6]
    negatives._open_pairs(a, b, np.ones((40, 360), bool), lambda r, c, lo, hi: hi >= low_of[r], counts)
    assert counts[0] == 40 * 360 and counts[-1] < 0.2 * counts[0]


def test_large_components_stay_exact(spark):
    rows = [(0, [1e6, 1.0], 1), (1, [1e6, 2.0], 1), (2, [1e6, 1.5], 2), (3, [9e5, 4.0], 2), (100, [-1e6, 4.0], 2)]
    assert run(spark, rows) == brute(rows)
