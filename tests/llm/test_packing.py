import random
import zlib

import numpy as np
import pytest

from cases import LONG, ROWS, edge_docs, no_docs  # noqa: F401
from stationkit.llm import packing

tokenizers = pytest.importorskip("tokenizers")
pytest.importorskip("public_tokenizers")


def plain(text):
    tok, _ = packing._tokenizer(packing.default_tokenizer())
    return tok.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("text", [
    "Don't STOP ~ it's 'S <|endoftext|> <|ENDOFTEXT|> a<|endoftext|>.", "ΣΑΣ İstanbul ñ é x́, foo¿! a b\x85c",
    "a\x1cb", "１２ ²³ ½x, 中文, 日本語!", "", " \n\t", "ﬁ ŉ Ǆ…", "user@mail.com, (x) [y]~~ 3.14,15",
    "rock'n'roll' 'tis l'été, d'", "~ ~~ a~b", "E=mc² µm ß ẞ straße's", "x" * 5000, LONG[:20000]])
def test_word_cache_equals_the_tokenizer(text):
    for _ in range(2):  # unknown words, then remembered ones
        got = packing.encode([text, text], packing.default_tokenizer())
        assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain(text)] * 2


def test_cache_turns_generations(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 10)
    texts = [f"word{i}, and word{i + 1} again" for i in range(60)] * 2
    got = packing.encode(texts, packing.default_tokenizer())
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [plain(t) for t in texts]


def fill(runs, counts, capacity):
    """Bins of a plan: bin -> sorted (offset, length)."""
    bins = {}
    for s, n in counts.items():
        for r in range(n):
            (run,) = [x for x in runs.tolist() if x[0] == s and x[1] <= r < x[2]]
            _, a, _, first, per, offset = run
            bins.setdefault(first + (r - a) // per, []).append((offset + (r - a) % per * s, s))
    for items in bins.values():
        items.sort()
        at = 0
        for offset, s in items:
            assert offset == at
            at += s
        assert at <= capacity
    return bins


def best_fit_bins(counts, capacity):
    """Item by item: greedy matching of the large, then best fit decreasing."""
    large = sorted((s for s, n in counts.items() for _ in range(n) if 3 * s > capacity), reverse=True)
    rooms = []
    while large:
        s = large.pop(0)
        partner = next((t for t in large if s + t <= capacity), None)
        if partner is not None:
            large.remove(partner)
        rooms.append(capacity - s - (partner or 0))
    for s in sorted((s for s, n in counts.items() for _ in range(n) if 3 * s <= capacity), reverse=True):
        fits = [r for r in rooms if r >= s]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - s)
        else:
            rooms.append(capacity - s)
    return len(rooms)


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_the_item_by_item_packing(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([30, 64, 100])
    counts = {rnd.randint(1, capacity): rnd.randint(1, 9) for _ in range(25)}
    runs = packing.plan(counts, capacity)
    bins = fill(runs, counts, capacity)
    assert len(bins) == best_fit_bins(counts, capacity)
    assert sorted(bins) == list(range(len(bins)))
    assert sum(len(b) for b in bins.values()) == sum(counts.values())
    assert all(sum(3 * s > capacity for _, s in b) <= 2 for b in bins.values())


def test_plan_of_nothing():
    assert packing.plan({}, 10).shape == (0, 6)


def test_documents_are_packed_whole(edge_docs):
    out = packing.pack_documents(edge_docs, capacity=256).collect()
    want = sorted((str(d), p, p * 256, len(ids[p * 256:(p + 1) * 256]),
                   zlib.crc32(np.asarray(ids[p * 256:(p + 1) * 256], "<u4").tobytes()))
                  for d, t, *_ in ROWS for ids in [plain(t) + [1]] for p in range(-(-len(ids) // 256)))
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    places = {}
    for r in out:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in places.values():
        at = 0
        for offset, n in sorted(items):
            assert offset == at
            at += n
        assert at <= 256


def test_no_documents(no_docs):
    assert packing.pack_documents(no_docs).count() == 0


def test_ranks_over_many_blocks(spark):
    parts = spark.range(5000).selectExpr("id doc_id", "0 piece", "0L start", "CASE WHEN id % 3 = 0 THEN 7L ELSE id % 50 + 1 END length",
                                         "id ids_crc32")
    out = packing.pack(parts, 64, block_rows=100).collect()
    places = sorted((r["sequence_id"], r["offset"]) for r in out)
    assert len(out) == 5000 and len(set(places)) == 5000
    total = sum(r["length"] for r in out)
    assert len({r["sequence_id"] for r in out}) <= -(-total // 64) + 2


def test_ids_of_word_ends_that_change_in_lower_case():
    tok = tokenizers.Tokenizer.from_file(packing.default_tokenizer())
    rnd = random.Random(11)
    letters = "İIıiŞşÜé\u0301\u0307ǅßſ9Ωςa"
    texts = ["TÜRKİYE CUMHURİYETİ, ANKARA", "ŞİRKETİ.", "HAKKI (İLETİ)", "İ", "İ.", "(İ)", "İ\u0301."]
    texts += ["".join(rnd.choice(letters + ".,;:!?()'\"-~ ") for _ in range(rnd.randrange(1, 25))) for _ in range(4000)]
    for text, ids in zip(texts, packing.encode(texts, packing.default_tokenizer())):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, repr(text)
