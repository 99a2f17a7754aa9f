import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from cases import edge_docs, no_docs  # noqa: F401
from stationkit.llm import sentencepieces
from stationkit.llm.queries import op12_sentencepiece

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sentencepieces.default_model())


@pytest.fixture(scope="module")
def own():
    return sentencepieces.Vocabulary(sentencepieces.default_model())


def odd_texts(seed, n, longest=40):
    rnd = random.Random(seed)
    bits = [*" ▁\t\n\0aabcdeißİŞ́　日本ｆ<>sx0AÀ 12", "\U0001F600", "the", "ing", "  ", "‍"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randrange(longest))) for _ in range(n)]


def test_ids_and_texts_are_the_librarys(own, library):
    for t in odd_texts(1, 3000):
        ids = own.encode(t).tolist()
        assert ids == library.encode(t)
        assert own.decode(ids) == library.decode(ids)


def test_any_ids_decode_as_in_the_library(own, library):
    rnd = random.Random(2)
    for _ in range(3000):
        ids = [rnd.choice([0, 1, 2, rnd.randrange(3, 259), 259, 260, 264, 28705, rnd.randrange(32000)])
               for _ in range(rnd.randrange(8))]
        assert own.decode(ids) == library.decode(ids), ids


def test_cutting_into_stretches_changes_nothing(own):
    texts = odd_texts(3, 600, 150)
    for t, ids in zip(texts, own.encode_all(texts)):
        normal = "▁" + t.replace(" ", "▁")
        assert (own._ids(own._agenda(normal)) if t else []) == ids.tolist()


def test_agendas_side_by_side_equal_each_on_its_own(own):
    some = [t for t in odd_texts(5, 2000, 12) if t]
    for t, ids in zip(some, own._together(some)):
        assert np.frombuffer(ids, "<i4").tolist() == own._ids(own._agenda(t))


def test_one_long_word_and_a_full_cache(own, library, monkeypatch):
    word = "ab" * 20_000 + "日" * 5000
    assert own.encode(word).tolist() == library.encode(word)
    monkeypatch.setattr(sentencepieces, "CACHE_STRETCHES", 5)
    for t in odd_texts(4, 200):
        assert own.encode(t).tolist() == library.encode(t)


def test_unknown_characters_without_byte_pieces(own):
    class NoBytes(sentencepieces.Vocabulary):
        pass
    v = NoBytes(sentencepieces.default_model())
    v.bytes_of = {}
    assert v.encode("a\U000F0000\U000F0001 b").tolist().count(v.unknown) == 1


def test_edge_rows(spark, edge_docs, library):
    got = sentencepieces.encode_and_decode(edge_docs, ["doc_id", "text"]).collect()
    assert len(got) == edge_docs.count()
    for r in got:
        ids = library.encode(r["text"] or "")
        assert r["ids"] == ids and r["decoded"] == (library.decode(ids) if ids else "")


def test_clashing_and_empty(spark, edge_docs, no_docs):
    with pytest.raises(ValueError):
        sentencepieces.encode_and_decode(edge_docs, ["doc_id", "ids"])
    assert sentencepieces.encode_and_decode(no_docs, ["doc_id"]).collect() == []


def test_a_difference_is_an_error(spark, edge_docs, monkeypatch):
    monkeypatch.setattr(sentencepieces, "SPACE", "_")
    with pytest.raises(Exception, match="differ from the library"):
        sentencepieces.encode_and_decode(edge_docs, ["doc_id"]).collect()


def test_query_digests(spark, library):
    rows = {r["doc_id"]: r for r in op12_sentencepiece(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(r["text"] or "")
        got = rows[r["doc_id"]]
        assert got["n_tokens"] == len(ids)
        assert got["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got["decoded_sha256"] == hashlib.sha256((library.decode(ids) if ids else "").encode()).hexdigest()
