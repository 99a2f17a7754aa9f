import math
import random

import pytest

from stationkit.operators.impute import head_weighted_fill

S = -999.0


def simulate(col, radius=5, decay=0.1):
    """Cell-by-cell in-place fill, top to bottom (the loop the operator replaces)."""
    col = list(col)
    n = len(col)
    for r in range(n):
        if col[r] != S:
            continue
        nm = [v for v in col if v != S]
        if not nm:
            continue
        start, end = max(0, r - radius), min(n, r + radius + 1)
        d = [abs(i - r) for i in range(start, end)][:len(nm)]
        w = [math.exp(-decay * x) for x in d]
        m = len(w)
        col[r] = sum(nm[k] * w[m - 1 - k] for k in range(m)) / sum(w)
    return col


@pytest.mark.parametrize("seed,n,p_missing", [(0, 40, 0.3), (1, 25, 0.7), (2, 8, 0.5), (3, 60, 0.1),
                                              (4, 30, 0.95), (5, 13, 0.0)])
def test_head_weighted_fill_equals_loop(spark, seed, n, p_missing):
    rnd = random.Random(seed)
    a = [S if rnd.random() < p_missing else round(rnd.uniform(-5, 30), 3) for _ in range(n)]
    b = [S] * 12 + [round(rnd.uniform(0, 5), 3) for _ in range(n - 12)] if n > 12 else [S] * n
    c = [S] * n
    rows = [(i, a[i], b[i], c[i]) for i in range(n)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double")
    out = head_weighted_fill(df, ["a", "b", "c"], "row_id").orderBy("row_id").collect()
    for name, col in (("a", a), ("b", b), ("c", c)):
        ref = simulate(col)
        got = [r[name] for r in out]
        assert got == pytest.approx(ref, rel=1e-12, abs=1e-12), name
