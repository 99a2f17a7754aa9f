import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stationkit.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(convs[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).select(
        "*", *[F.lit(0).alias(c) for c in ("pos", "h1", "x1", "kind", "depth", "seg", "base", "h", "_sk_part")])
    got = prefix_trie.trie(*prefix_trie.share_heads(prefix_trie.ordered_turns(df, **kw)))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                           "ends_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def made(seed, n, longest, words, ids=None):
    rnd = random.Random(seed)
    rows = []
    for c in ids or range(n):
        for t in range(rnd.randrange(1, longest)):
            rows.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice([*words, None])))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,segment,block", [(1, 64, 1024), (2, 2, 3), (3, 3, 7), (4, 1, 2), (5, 2, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, segment, block):
    monkeypatch.setattr(prefix_trie, "SEGMENT", segment)
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    monkeypatch.setattr(prefix_trie, "SUPER", 2)
    rows = made(seed, 230, 9, ["a", "bb"])
    assert run(spark, rows) == brute(rebuilt(rows))


def test_equal_conversations_and_one_long_one(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 4)
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    monkeypatch.setattr(prefix_trie, "SUPER", 3)
    long = [(7, t, "user", "x" * (t % 3)) for t in range(150)]
    copy = [(8, t, "user", "x" * (t % 3)) for t in range(120)]
    same = [(c, t, "user", f"turn {t}") for c in range(100, 180) for t in range(9)]
    rows = long + copy + same + made(6, 0, 8, ["a", "b", "c"], ids=range(300, 360))
    want = brute(rebuilt(rows))
    assert run(spark, rows) == want
    assert run(spark, rows, max_rows_per_task=40) == want  # turns placed in chunks


def test_nulls_turnless_and_negative_ids(spark):
    rows = [(1, 0, "user", "a"), (205, None, None, None), (205, 0, "user", "b"), (None, 0, "user", "z"), (-3, 1, "u", "q"),
            (-3, None, "u", "q"), (-100, 0, "u", "q"), (0, 2, "user", "\U0001F600ß"), (0, 1, "user", ""), (0, 1, "user", ""),
            (99, 0, None, "long " * 5000)]
    assert zlib.crc32(b"1") % 6 >= 1  # conversation 1 keeps no turn of its own
    assert run(spark, rows) == brute(rebuilt(rows))


def test_only_turnless_and_none_at_all(spark):
    c = next(c for c in range(101, 199) if zlib.crc32(str(c).encode()) % 6)
    rows = [(c, 0, "user", "a")]
    assert run(spark, rows) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]
    assert run(spark, []) == []


def test_sparse_table_searches_equal_a_walk():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 17, 64):
        lcp = np.concatenate([[-1], rng.integers(-1, 5, n - 1)])
        table = prefix_trie._minima(lcp)
        rows, depth = (a.ravel() for a in np.meshgrid(np.arange(n), np.arange(6)))
        right, left = prefix_trie._right_extent(table, rows, depth), prefix_trie._left_extent(table, rows, depth)
        for i, d, r, lo in zip(rows, depth, right, left):
            a = i
            while a + 1 < n and lcp[a + 1] >= d:
                a += 1
            b = i
            while b > 0 and lcp[b] >= d:
                b -= 1
            assert (b, a) == (lo, r)
        values = rng.integers(0, 100, n)
        low = prefix_trie._minimum(prefix_trie._minima(values), left, right)
        assert all(m == values[a:b + 1].min() for m, a, b in zip(low, left, right))
