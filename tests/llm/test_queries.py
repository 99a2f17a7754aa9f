"""The registered queries and the pipeline at the smallest scale."""

import re
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cases import CLASHES, ROWS, SCHEMA, edge_docs, no_docs, prose  # noqa: F401

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the given tables")


def test_one_query_for_each_operator():
    import __spark_entry__ as entry
    names = entry.queries()
    for n in range(1, 11):
        assert sum(bool(re.match(rf"op{n}_", x)) for x in names) == 1
    assert "pipeline" in names
    import corpus_pipeline
    assert len(corpus_pipeline.STAGES) == 5


def test_topk_equals_its_sql(spark):
    import duckdb

    from stationkit.llm.queries import ORACLES, QUERIES
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = sorted(con.execute(ORACLES["op10_exact_topk"]).fetchall())
    got = QUERIES["op10_exact_topk"](spark, SF).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(tuple(r) for r in got) == want


@pytest.mark.parametrize("name,held,modulus,rest", [("op4_quality_classifier", "quality", 5, 0),
                                                    ("op9_language_id", "lang", 4, 2)])
def test_classifiers_on_rows_they_did_not_learn(spark, name, held, modulus, rest):
    from stationkit.llm.queries import QUERIES
    out = QUERIES[name](spark, SF).collect()
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == rest) for r in out)
    if held == "lang":
        truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
        right = [r["lang_pred"] == truth[r["doc_id"]] for r in out if r["held_out"]]
    else:
        truth = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
        right = [r["predicted"] == truth[r["doc_id"]] for r in out if r["held_out"] and r["doc_id"] in truth]
    assert sum(right) >= 0.85 * len(right)


def test_pipeline_stages(spark):
    """Each stage's kept rows against the operators' own decisions."""
    import corpus_pipeline as C
    from stationkit.llm import langid, secrets, simhash
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(C.STAGES)
    one = stages["language_id"](spark, docs, SF).cache()
    assert one.columns == docs.columns and one.count() >= 0.98 * docs.count()
    two = stages["simhash_near_dedup"](spark, one, SF).cache()
    fps = [(r["doc_id"], simhash.fingerprint(r["text"] or "")) for r in one.collect()]
    left = sorted(fps)
    keep = []
    groups = {}
    for i, f in left:  # smallest id of each component, by flooding
        seen, todo = {f}, [f]
        while todo:
            x = todo.pop()
            for _, y in left:
                if y not in seen and ((x ^ y) & (1 << 64) - 1).bit_count() <= 2:
                    seen.add(y)
                    todo.append(y)
        groups.setdefault(min(seen), i)
    keep = sorted(groups.values())
    assert sorted(r["doc_id"] for r in two.collect()) == keep
    three = stages["secret_scan"](spark, two, SF).cache()
    want = {r["doc_id"]: secrets.redact(r["text"]) for r in two.collect()}
    assert {r["doc_id"]: r["text"] for r in three.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in three.collect() if "[SECRET]" in r["text"])
    four = stages["mixing_weights"](spark, three, SF).cache()
    assert four.columns == docs.columns
    assert {r["doc_id"] for r in four.collect()} <= set(want)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = three.join(labels.where("quality = 1 and toxic = 0"), "doc_id").count()
    kept = four.join(labels.where("quality = 1 and toxic = 0"), "doc_id").count()
    assert kept >= 0.9 * good
    five = stages["best_fit_packing"](spark, four, SF)
    assert {r["doc_id"] for r in five.select("doc_id").distinct().collect()} == {r["doc_id"] for r in four.collect()}


def test_pipeline_on_edge_rows_and_none(spark, edge_docs, no_docs):
    import corpus_pipeline as C
    docs = edge_docs
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = out.cache()
    assert C.STAGES[-1][1](spark, docs, SF).count() >= 0
    for name, stage in C.STAGES:
        assert stage(spark, no_docs, SF).count() == 0
