import random

import pytest

from cases import ROWS, edge_docs, no_docs, prose  # noqa: F401
from stationkit.llm import langid

SYLLABLES = {"aa": ["tion", "ment", "eau", "que", "le"], "bb": ["ung", "keit", "sch", "der", "ge"],
             "cc": ["ing", "th", "ed", "er", "ly"]}


def text(lang, seed):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(60))


@pytest.fixture(scope="module")
def model(spark):
    rows = [(i, text(lang, i), lang) for i, lang in enumerate(["aa", "bb", "cc", "cc"] * 60)] + [(900, "x", None), (901, None, "aa")]
    return langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_lang=80)


def test_held_out_accuracy(spark, model):
    rows = [(i, text(lang, 5000 + i), lang) for i, lang in enumerate(["aa", "bb", "cc"] * 30)]
    out = {r["doc_id"]: r for r in langid.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()}
    assert sum(out[i]["lang_pred"] == lang for i, _, lang in rows) >= 88
    assert all(0 <= r["score"] <= 1 for r in out.values())
    assert sum(r["accepted"] for r in out.values()) >= 88


def test_counts_equal_one_pass_over_the_bytes(monkeypatch):
    t = prose(3, 500) + " Größe"
    whole = langid.subword_counts(t)
    monkeypatch.setattr(langid, "SPAN", 64)
    assert (langid.subword_counts(t) == whole).all()
    n = len(" " + " ".join(t.lower().replace("-", " ").split()) + " ".encode().decode())
    data = (" " + " ".join(t.lower().split()) + " ").encode()
    assert whole.sum() == sum(len(data) - k + 1 for k in langid.ORDERS) and n > 0


def test_edge_rows(edge_docs, no_docs, model):
    out = langid.predict(edge_docs, model).collect()
    assert len(out) == len(ROWS)
    for r in out:
        if r["doc_id"] in (3, 4, 5, 10):
            assert (r["lang_pred"], r["score"], r["accepted"]) == ("und", 0.0, False)
        else:
            assert r["lang_pred"] in SYLLABLES
    assert langid.predict(no_docs, model).count() == 0
    kept = langid.accepted(edge_docs, model)
    assert kept.schema == edge_docs.schema
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in out if r["accepted"])


def test_without_labelled_rows(no_docs, edge_docs):
    model = langid.train(no_docs)
    assert {r["lang_pred"] for r in langid.predict(edge_docs, model).collect()} == {"und"}


def test_twenty_languages_stored_one_after_another_are_all_learned(spark):
    """The bound is shared by the languages, whatever the order of the table."""
    letters = "abcdefghijklmnopqrst"
    rows = []
    for k, c in enumerate(letters):
        rnd = random.Random(k)
        marks = [c + x for x in "aeiouxz"]
        rows += [(i, " ".join("".join(rnd.choices(marks, k=3)) for _ in range(20)), f"l{k:02}")
                 for i in range(1000 * k, 1000 * k + 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).sortWithinPartitions("doc_id")
    sample = langid._sample(docs, 1000, 400)
    assert {c: sum(r["lang"] == c for r in sample) for c in {r[2] for r in rows}} == {f"l{k:02}": 20 for k in range(20)}
    model = langid.train(docs, max_rows=400, epochs=30)
    assert len(model.languages) == 20 and model.out is not None
    right = [model.predict(t)[0] == lang for _, t, lang in rows]
    assert sum(right) >= 0.95 * len(right)


def test_a_repeated_row_does_not_pass_the_bound(spark):
    rows = [(None, text("aa", 1), "aa")] * 500 + [(i, text("bb", i), "bb") for i in range(500)]
    sample = langid._sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"), 40, 60)
    assert sum(r["lang"] == "bb" for r in sample) == 30 and sum(r["lang"] == "aa" for r in sample) <= 30
