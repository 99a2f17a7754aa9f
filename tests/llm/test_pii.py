import hashlib
import re

import pytest

from cases import LONG, ROWS, edge_docs, no_docs  # noqa: F401
from stationkit.llm import pii

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}



def luhn_sum(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def passes(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn_sum(digits)
    return kind == "email" or 8 <= len(digits) <= 15


TEXTS = [
    "a.b@c.de, x@y.com_z@w.org %%@a-b.c-d. @no.pe q@w q@w. é.f@g.hi a@b.c@d.e..f@g.h",
    "1.2.3.4 256.1.1.1 001.02.3.255 1.2.3.4.5.6.7.8 11.22.33 0000000300.1.2.3 ١.2.3.4",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111111111111112 4111  1111 1111 1111 7536784127813050 4845168114407329",
    "+1 (555) 010-9999. +49 30 1234 +1234567 ++12345678 +1 234 567 890 123 456 7 \U0001F600 +44 20 7946 0958)",
    "mail john.doe (at) example dot com and call 555-867-5309 or phone: 030 9018 2000; order 1234567",
    "7" * 5000 + " " + "1.1.1.1" * 500 + " " + "x" * 50_000 + "@" + "1-" * 3000 + "1", LONG, None, ""]


def brute(text):
    out = []
    for k, p in PATTERNS.items():
        out.append([f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if passes(k, m.group())])
    return out


@pytest.fixture(scope="module")
def found(spark, edge_docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return rows, pii.find_personal_data(df).collect()


def test_base_spans_equal_plain_matching(found):
    rows, out = found
    assert len(out) == len(rows)
    texts = dict(rows)
    for r in out:
        want = brute(texts[r["doc_id"]])
        assert [r[f"n_{k}"] for k in PATTERNS] == [len(w) for w in want]
        joined = [s for w in want for s in w]
        assert r["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest()
        spans = [s for s in r["spans"].split(",") if s]
        assert [s for s in spans if s.split(":")[0] in PATTERNS] == joined
        for s in spans:  # added ones are clear of the base
            k, a, b = s.split(":")
            if k in pii.ADDED:
                assert all(int(b) <= int(x.split(":")[1]) or int(a) >= int(x.split(":")[2]) for x in joined)


def test_trees_add_spelled_out_addresses_and_numbers_in_context(found):
    _, out = found
    text = TEXTS[4]
    spans = [s.split(":") for r in out if r["doc_id"] == 4 for s in r["spans"].split(",")]
    added = {(k, text[int(a):int(b)]) for k, a, b in spans}
    assert ("contact", "john.doe (at) example dot com") in added
    assert any(k == "number" and "9018 2000" in t for k, t in added)
    assert not any("1234567" == t for _, t in added)


def test_edge_rows_and_no_rows(edge_docs, no_docs):
    out = pii.find_personal_data(edge_docs).collect()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r[0]) for r in ROWS)
    assert all(r["spans"] == "" for r in out)
    assert pii.find_personal_data(no_docs).count() == 0


def test_plan_stays_in_the_jvm(edge_docs):
    import contextlib
    import io
    with contextlib.redirect_stdout(io.StringIO()) as text:
        pii.candidates(edge_docs).explain("formatted")
    assert not re.search("EvalPython|MapInPandas|MapInArrow|Groups|PythonUDF", text.getvalue())


def added_spans(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {}
    for r in pii.find_personal_data(df).collect():
        spans = [s.split(":") for s in r["spans"].split(",") if s]
        out[r["doc_id"]] = [texts[r["doc_id"]][int(a):int(b)] for k, a, b in spans if k in pii.ADDED]
    return [out[i] for i in range(len(texts))]


def test_numbers_of_other_languages_and_accounts(spark):
    texts = ["Tel: 030/1234567, Fax 030 7654321", "Ruf mich an: 0151-23456789 bitte", "mi número es 612 345 678", "account 12345678 at bank",
             "Bestellung 030/1234567 vom 2019-04-05", "population 612 345 678", "tel 2019-04-05 12"]
    got = added_spans(spark, texts)
    assert got[0] == ["030/1234567", "030 7654321"] and got[1] == ["0151-23456789"]
    assert got[2] == ["612 345 678"] and got[3] == ["12345678"]
    assert got[4] == [] and got[5] == []


def test_recall_on_contexts_and_formats_not_in_the_fit(spark):
    rows = {r["kind"]: r for r in pii.held_out_quality(spark).collect()}
    assert set(rows) == set(pii.ADDED)
    for k, r in rows.items():
        print(k, r)
        assert r["n"] > 30 and r["precision"] >= 0.9 and r["recall"] >= 0.5


def test_clear_of_base_spans_equals_comparing_all(spark):
    import random
    rnd = random.Random(3)
    loose = [(r, a, a + rnd.randrange(1, 9)) for r in range(6) for a in rnd.sample(range(60), 12)]
    base = [(r, a, a + rnd.randrange(1, 15)) for r in range(5) for a in rnd.sample(range(60), 4)]
    schema = "row long, start long, end long"
    got = sorted(tuple(r) for r in pii._clear(spark.createDataFrame(loose, schema), spark.createDataFrame(base, schema))
                 .select("row", "start", "end").collect())
    assert got == sorted(x for x in loose if not any(b[0] == x[0] and b[1] < x[2] and x[1] < b[2] for b in base))
