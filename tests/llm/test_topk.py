import math
import random

import pytest
from pyspark.sql import functions as F

from stationkit.llm import topk


def brute(rows, k=5, step=50):
    ints = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        ints[(i, tuple(math.floor(256 * x) for x in v))] = True
    out = []
    for q, qv in ints:
        if q % step:
            continue
        scored = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ints if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").select(
        "*", *[F.lit(0).alias(c) for c in ("u", "q", "score", "ids", "ints", "rank", "list")])
    return sorted(tuple(r) for r in topk.search(df, F.col("vec_id") % 50 == 0, **kw)
                  .select("query_id", "rank", "vec_id", "score").collect())


@pytest.mark.parametrize("lists,depth", [(2, 48), (1, 6), (4, 6)])
def test_equals_brute_force(spark, lists, depth):
    rnd = random.Random(lists)
    rows = [(i, [rnd.gauss(0, 0.3) for _ in range(16)]) for i in range(400)]
    assert run(spark, rows, lists=lists, depth=depth) == brute(rows)


def test_one_vector_shared_by_a_third_and_ties(spark):
    rnd = random.Random(3)
    hot = [0.5, -0.25, 0.125, 0.75]
    rows = [(i, hot if i % 3 == 0 else [rnd.choice([-0.5, 0.0, 0.5]) for _ in range(4)]) for i in range(301)]
    assert run(spark, rows) == brute(rows)


def test_nulls_odd_lengths_and_repeats(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, None), (100, [1.0, None]), (150, [float("nan"), 1.0]),
            (200, [float("inf"), 1.0]), (None, [1.0, 1.0]), (250, [1.0]), (3, [2.0, -1.0]), (4, [])]
    assert run(spark, rows) == brute(rows)
    assert {r[0] for r in run(spark, rows)} == {0, 250}


def test_no_rows_and_no_queries(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.1])]) == []


def test_large_components_stay_exact(spark):
    rows = [(0, [1e7, 1.0]), (1, [1e7, 2.0]), (2, [1e7, 3.0]), (3, [-1e7, 4.0])]
    assert run(spark, rows) == brute(rows)
