import random
import re

import pytest
from pyspark.sql import functions as F

from cases import ROWS, edge_docs, no_docs, prose  # noqa: F401
from stationkit.llm import bottomk as B


def shingles(t):
    w = [x for x in re.split("[\x20\x09-\x0d]+", t or "") if x]
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_sketches_of_edge_rows(edge_docs):
    rows = edge_docs.select("doc_id", "text", B.sketch(F.coalesce("text", F.lit(""))).alias("s")).collect()
    assert len(rows) == len(ROWS)
    by = {}
    for r in rows:
        n = len(shingles(r["text"]))
        assert len(r["s"]) == min(64, n) and list(r["s"]) == sorted(set(r["s"]))
        by.setdefault(r["text"] or "", set()).add(tuple(r["s"]))
    assert all(len(v) == 1 for v in by.values())


def test_estimates(spark):
    rnd = random.Random(1)
    rows = []
    for i, n in enumerate((3, 8, 40, 400, 4000)):
        a = [f"w{rnd.randrange(10 ** 6)}" for _ in range(n)]
        b = a[:n * 3 // 4] + [f"v{rnd.randrange(10 ** 6)}" for _ in range(n - n * 3 // 4)]
        rows.append((i, " ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "i int, a string, b string")
    sa, sb = B.sketch(F.col("a")), B.sketch(F.col("b"))
    for r, (_, a, b) in zip(df.select("i", B.resemblance(sa, sb).alias("r"), B.containment(sa, sb).alias("c"),
                                      B.distinct_shingles(sa).alias("n"),
                                      B.resemblance(sa, sa).alias("same")).orderBy("i").collect(), rows):
        x, y = shingles(a), shingles(b)
        exact = len(x | y) <= 64
        assert abs(r["r"] - jaccard(x, y)) <= (1e-12 if exact else 0.25)
        assert abs(r["c"] - len(x & y) / len(x)) <= (1e-12 if exact else 0.35)
        assert abs(r["n"] - len(x)) <= (0 if len(x) < 64 else 0.5 * len(x))
        assert r["same"] == 1.0


def test_parts_merge_to_the_whole(spark):
    texts = [prose(i, 300) for i in range(6)]
    df = spark.createDataFrame([(i % 2, t) for i, t in enumerate(texts)], "g int, text string")
    parts = df.select("g", B.sketch(F.col("text"), 32).alias("sketch"))
    got = {r["g"]: list(r["sketch"]) for r in B.merge_parts(parts, ["g"], k=32).collect()}
    whole = df.select("g", B.shingle_hashes(F.col("text")).alias("h")).select("g", F.explode("h").alias("h"))
    want = {g: sorted({r["h"] for r in whole.where(F.col("g") == g).collect()})[:32] for g in (0, 1)}
    assert got == want


def successors(rows):
    """Texts in the order of ids (nulls last), and the edited ones."""
    rows = [(d, t or "") for d, t in rows]
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    out = []
    for k, (d, t) in enumerate(order):
        nxt = order[(k + 1) % len(order)][1]
        q = len(t) // 4
        out.append((str(d), t, t[:len(t) - q] + nxt[:q]))
    return sorted(out)


@pytest.mark.parametrize("range_rows", [500, 7, 1])
def test_every_row_meets_its_successor(spark, monkeypatch, range_rows):
    monkeypatch.setattr(B, "RANGE_ROWS", range_rows)
    rnd = random.Random(range_rows)
    ids = rnd.sample(range(10 ** 6), 40) + [10 ** 15, -5]
    rows = [(d, prose(i, rnd.randint(0, 30)) + rnd.choice(["", " é\U0001F600"])) for i, d in enumerate(ids)]
    rows += [(None, "last of all"), (7 * 10 ** 6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = B.edited_and_next(df)
    assert sorted((str(r["doc_id"]), r["text"], r["edited"]) for r in out.collect()) == successors(rows)
    got = out.select("text", B.resemblance(F.col("sketch"), F.col("next_sketch")).alias("r")).collect()
    assert all(0 <= r["r"] <= 1 for r in got)


def test_repeated_rows_one_row_and_none(spark, edge_docs, no_docs):
    assert B.edited_and_next(edge_docs).count() == len(ROWS)
    assert B.edited_and_next(no_docs).count() == 0
    one = B.edited_and_next(spark.createDataFrame([(1, "abcdefgh")], "doc_id long, text string")).collect()
    assert [(r["text"], r["edited"]) for r in one] == [("abcdefgh", "abcdefab")]
    null = B.edited_and_next(spark.createDataFrame([(None, "abcd")], "doc_id long, text string")).collect()
    assert [r["edited"] for r in null] == ["abca"]


def test_plan_stays_in_the_jvm(edge_docs):
    import contextlib
    import io
    with contextlib.redirect_stdout(io.StringIO()) as text:
        B.edited_and_next(edge_docs).explain("formatted")
    assert not re.search("EvalPython|MapInPandas|MapInArrow|Groups|PythonUDF", text.getvalue())
