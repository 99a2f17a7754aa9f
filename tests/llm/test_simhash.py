import random

import pytest
import xxhash

from cases import ROWS, edge_docs, no_docs, prose  # noqa: F401
from stationkit.llm import simhash


def brute_fingerprint(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in (text or ""))
             .replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ")
             .replace("\r", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    """Component id of every (doc_id, fingerprint)."""
    fps = sorted({f for _, f in rows})
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 2:
                parent[find(a)] = find(b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[find(f)] = min(least.get(find(f), d), d)
    return sorted(((d, f, least.get(find(f))) for d, f in rows), key=str)


def unsigned(x):
    return x & (1 << 64) - 1


def test_fingerprints_and_groups_of_edge_rows(edge_docs):
    out = simhash.near_duplicate_groups(edge_docs).collect()
    got = sorted(((r["doc_id"], unsigned(r["fp"]), r["component_id"]) for r in out), key=str)
    assert got == brute_groups([(d, brute_fingerprint(t)) for d, t, *_ in ROWS])


def test_no_rows(no_docs):
    assert simhash.near_duplicate_groups(no_docs).count() == 0
    assert simhash.one_per_group(no_docs).count() == 0


def planted(seed):
    """Clusters of fingerprints a few bits apart, chains, and lone ones."""
    rnd = random.Random(seed)
    fps = [rnd.getrandbits(64) for _ in range(40)]
    for centre in fps[:4]:
        for _ in range(60):
            x = centre
            for _ in range(rnd.randint(0, 3)):
                x ^= 1 << rnd.randrange(64)
            fps.append(x)
    x = fps[5]
    for b in range(0, 40, 2):  # a chain, two bits a step
        x ^= 3 << b
        fps.append(x)
    return fps


@pytest.mark.parametrize("cell_pairs", [64, 3, 1])
def test_pairs_and_local_references_give_the_same_groups(spark, cell_pairs):
    fps = planted(cell_pairs)
    prints = spark.createDataFrame([(i, simhash._signed(f)) for i, f in enumerate(fps)], "doc_id long, fp long")
    got = sorted(((r["doc_id"], unsigned(r["fp"]), r["component_id"])
                  for r in simhash.groups(prints, cell_pairs=cell_pairs).collect()), key=str)
    assert got == brute_groups(list(enumerate(fps)))


def test_pivot_table_never_discards_a_link(spark):
    rnd = random.Random(5)
    a = [rnd.getrandbits(64) for _ in range(200)]
    b = [x ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64)) for x in a]
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, simhash._signed(x), simhash._signed(y)) for i, (x, y) in enumerate(zip(a, b))],
                               "i long, x long, y long")
    left = simhash.pivot_table(df.select(F.col("x").alias("fp"))).alias("a")
    right = simhash.pivot_table(df.select(F.col("y").alias("fp"))).alias("b")
    near = df.join(left, F.col("x") == F.col("a.fp")).join(right, F.col("y") == F.col("b.fp"))
    assert near.count() == near.where(simhash._within(2)).count() >= 200


def test_one_row_of_each_group_stays(edge_docs):
    kept = simhash.one_per_group(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    groups = {c for _, _, c in brute_groups([(d, brute_fingerprint(t)) for d, t, *_ in ROWS])}
    assert ids == sorted(groups, key=str)  # the one group without an id keeps one row too


def test_long_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 120)] + [(500, 501)], "u long, v long")
    got = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(121)}, 500: 500, 501: 500}


def test_near_copies_link():
    base = prose(7, 400).split()
    other = list(base)
    other[200] = "changed"
    a, b = (simhash.fingerprint(" ".join(x)) for x in (base, other))
    assert (unsigned(a) ^ unsigned(b)).bit_count() <= 8


def test_cells_hold_every_link_and_the_table_decides_pairs(spark):
    fps = planted(9)
    nodes = spark.createDataFrame([(simhash._signed(f),) for f in sorted(set(fps))], "fp long")
    got = {tuple(sorted((unsigned(r["u"]), unsigned(r["v"])))) for r in
           simhash.links(nodes, cell_pairs=10 ** 9).collect()}
    every = sorted(set(fps))
    assert got == {(a, b) for i, a in enumerate(every) for b in every[i + 1:] if (a ^ b).bit_count() <= 2}
    counts = simhash.link_counts(nodes, cell_pairs=10 ** 9)
    assert counts["candidates"] > counts["after_coordinates"] >= counts["links_of_cells"] == len(got)
    assert counts["links_of_references_alone"] == 0


def test_word_coordinates_add_up_to_the_table(spark):
    from pyspark.sql import functions as F
    nodes = spark.createDataFrame([(simhash._signed(random.Random(i).getrandbits(64)),) for i in range(50)], "fp long")
    rows = nodes.select("fp", *[F.array(*simhash.word_coordinates(i)).alias(f"w{i}") for i in range(4)]).collect()
    refs = simhash.reference_fingerprints(simhash.CELL_PIVOTS)
    for r in rows:
        for k, ref in enumerate(refs):
            assert sum(r[f"w{i}"][k] for i in range(4)) == (unsigned(r["fp"]) ^ unsigned(ref)).bit_count()
