import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import ROWS, edge_docs, no_docs, prose  # noqa: F401
from stationkit.llm import mixing as M


def brute_rates(n, p, targets, rounds=200):
    """The same descent in numpy, on all rows at once."""
    r, pace, before = np.ones(len(n)), 1.0, np.inf
    own = (n[:, None] * p).sum(0)
    live = own > 0
    for _ in range(rounds):
        miss = np.where(live, (n * r) @ p - targets, 0.0)
        if (np.abs(miss) <= 1e-4 * np.maximum(targets, 1.0)).all():
            break
        loss = (miss ** 2 / np.where(live, own, 1.0)).sum()
        pace = pace / 2 if loss > before else min(1.0, pace * 1.5)
        before = loss
        gram = (p * (n * (r > 0))[:, None]).T @ p
        r = np.maximum(0, r - p @ (pace * M.descent_step(gram, miss, live)))
    return r


@pytest.mark.parametrize("share", [(0.6, 0.3, 0.1), (0.9, 0.05, 0.05), (0.1, 0.1, 0.8)])
def test_rates_meet_the_targets(spark, share):
    rng = np.random.default_rng(7)
    n = rng.integers(0, 500, 300)
    p = rng.dirichlet([0.2, 0.2, 0.2], 300)
    targets = np.array(share) * n.sum()
    table = spark.createDataFrame([(i, int(a), [float(x) for x in q]) for i, (a, q) in enumerate(zip(n, p))],
                                  "doc_id long, tokens long, p array<double>").repartition(3)
    out = {r["doc_id"]: r["rate"] for r in M.fit_rates(table, targets, write_every=2).collect()}
    r = np.array([out[i] for i in range(300)])
    assert (r >= 0).all()
    assert np.allclose((n * r) @ p, targets, rtol=1e-3)
    assert np.allclose(r, brute_rates(n.astype(float), p, targets), atol=1e-6)


def test_targets_out_of_reach_come_as_near_as_can_be(spark):
    """Every document is half of each domain: the domains cannot differ."""
    table = spark.createDataFrame([(i, 10, [0.5, 0.5]) for i in range(20)], "doc_id long, tokens long, p array<double>")
    out = M.fit_rates(table, np.array([150.0, 50.0]), rounds=10).collect()
    assert all(abs(r["rate"] - 1.0) < 1e-3 for r in out)  # 100 tokens each is the least-squares answer


@pytest.fixture(scope="module")
def corpus(spark):
    docs, labels = [], []
    for i in range(300):
        kind = ("clean", "clean", "low", "toxic")[i % 4]
        t = prose(i, 60)
        if kind == "low":
            t = " ".join(w + "###" for w in t.split())
        if kind == "toxic":
            t = t.replace("river", "vile").replace("stone", "vile") + " vile"
        docs.append((i, t, kind))
        if i < 200:
            labels.append((i, kind))
    return (spark.createDataFrame(docs, "doc_id long, text string, kind string"),
            spark.createDataFrame(labels + [(None, "low"), (5, None), (12345, "low")], "doc_id long, domain string"))


def test_posteriors_and_mix(corpus):
    docs, labels = corpus
    table, domains = M.mix(docs, labels, {"clean": 0.9, "low": 0.05, "toxic": 0.05}, "clean")
    assert domains == ["clean", "low", "toxic"]
    rows = table.join(docs.select("doc_id", "kind"), "doc_id").collect()
    assert len(rows) == 300
    assert sum(domains[int(np.argmax(r["p"]))] == r["kind"] for r in rows) >= 290
    assert all(abs(sum(r["p"]) - 1) < 1e-9 and r["rate"] >= 0 for r in rows)
    got = np.sum([np.array(r["p"]) * r["tokens"] * r["rate"] for r in rows], axis=0)
    assert np.allclose(got / got.sum(), [0.9, 0.05, 0.05], atol=1e-3)
    mean = {k: np.mean([r["rate"] for r in rows if r["kind"] == k]) for k in domains}
    assert mean["clean"] > 0.9 > 0.4 > max(mean["low"], mean["toxic"])


def test_edge_rows(spark, corpus, edge_docs, no_docs):
    _, labels = corpus
    for docs in (edge_docs, no_docs):
        table, _ = M.mix(docs, spark.createDataFrame([], "doc_id long, domain string"), {"clean": 1.0}, "clean")
        assert table.count() == docs.count()
    table, domains = M.mix(edge_docs, spark.createDataFrame([(1, "a"), (6, "b")], "doc_id long, domain string"),
                           {"a": 0.5, "b": 0.5}, "c")
    rows = table.collect()
    assert len(rows) == len(ROWS) and domains == ["a", "b"]
    assert {r["tokens"] for r in rows if r["doc_id"] in (3, 4, 5)} == {0}


def test_copies_have_the_rate_as_expectation(spark):
    x = spark.range(4000).select(M.chosen_copies(F.lit(1.25), F.col("id")).alias("c")).agg(F.avg("c"), F.min("c"), F.max("c")).first()
    assert abs(x[0] - 1.25) < 0.05 and (x[1], x[2]) == (1, 2)


@pytest.mark.parametrize("own,share", [((0.75, 0.14, 0.11), (0.97, 0.02, 0.01)), ((0.3, 0.1, 0.6), (0.2, 0.4, 0.4)),
                                       ((0.9, 0.05, 0.05), (0.4, 0.3, 0.3))])
def test_rates_of_one_copy_at_most_hold_the_shares(spark, own, share):
    """A domain above or below its share: the others are cut, no rate is above one."""
    rng = np.random.default_rng(3)
    n = rng.integers(1, 500, 600)
    p = np.array([rng.dirichlet(np.where(np.arange(3) == k, 60, 0.05)) for k in rng.choice(3, 600, p=own)])
    table = spark.createDataFrame([(i, int(a), [float(x) for x in q]) for i, (a, q) in enumerate(zip(n, p))],
                                  "doc_id long, tokens long, p array<double>").repartition(3)
    out = {r["doc_id"]: r["rate"] for r in M.fit_once(table, np.array(share)).collect()}
    r = np.array([out[i] for i in range(600)])
    assert r.min() >= 0 and 0.99 < r.max() <= 1
    got = (n * r) @ p
    assert np.allclose(got / got.sum(), share, atol=1e-3)
    reach = ((n @ p) / share).min()  # tokens that hard membership would leave
    assert got.sum() > 0.9 * min(reach, n.sum())


def test_shares_no_posterior_can_meet_are_named(spark):
    table = spark.createDataFrame([(i, 10, [0.5, 0.5]) for i in range(20)], "doc_id long, tokens long, p array<double>")
    with pytest.warns(UserWarning, match="out of the posteriors' reach"):
        rows = M.fit_once(table, np.array([0.9, 0.1])).collect()
    assert all(r["rate"] > 0.5 for r in rows)


def test_what_the_stage_keeps_has_the_target_shares(spark, tmp_path):
    import corpus_pipeline as C
    from stationkit.llm.queries import MIX_WEIGHTS
    docs, labels = [], []
    for i in range(6000):
        kind = ("clean", "low", "clean", "toxic")[i % 4]
        t = prose(i, 20)
        if kind == "low":
            t = " ".join(w + "###" for w in t.split())
        if kind == "toxic":
            t = t + (" Vile!", " vile,", " VILE", " (vile)")[i // 4 % 4]
        docs.append((i, t, "en", kind))
        labels.append((i, int(kind != "low"), int(kind == "toxic")))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    given = spark.createDataFrame(docs, "doc_id long, text string, lang string, kind string")
    size = F.sum(F.size(F.split("text", " ")))
    kept = {r["kind"]: r["t"] for r in C.mixing_weights(spark, given, str(tmp_path)).groupBy("kind").agg(size.alias("t")).collect()}
    clean = given.where("kind = 'clean'").agg(size).first()[0]
    total = sum(kept.values())
    assert kept["clean"] >= 0.97 * clean
    assert MIX_WEIGHTS == {"clean": 0.97, "low": 0.02, "toxic": 0.01}
    for kind, weight in MIX_WEIGHTS.items():
        assert abs(kept.get(kind, 0) / total - weight) < 0.008


def test_ten_domains_stored_one_after_another_are_all_learned(spark):
    docs = [(1000 * k + i, prose(1000 * k + i, 15) + f" mark{k}", f"d{k}") for k in range(10) for i in range(60)]
    given = spark.createDataFrame(docs, "doc_id long, text string, domain string").coalesce(1)
    _, domains = M.posteriors(given, given.select("doc_id", "domain"), max_rows=200)
    assert domains == [f"d{k}" for k in range(10)]
