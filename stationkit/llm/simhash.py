"""SimHash near-duplicate groups through pivot distance tables.

Fingerprint
    Texts are lower-cased in A-Z, cut into words at ASCII white space, and
    into shingles of ``shingle`` words joined by one space, repeats included
    (fewer words: the whole sequence; none: fingerprint zero).  A bit of the
    64-bit fingerprint is 1 if it is 1 in over half of the shingles' XXH64
    values (UTF-8, seed 42).

Links
    Two fingerprints link at ``max_bits`` (2) or fewer differing bits.  Equal
    fingerprints are collapsed first, so a group of exact copies, however
    large, is one node.

    *Pivot table.*  For every distinct fingerprint its Hamming distances to
    18 reference fingerprints are computed once, and those to ``CELL_PIVOTS`` of
    them also word by word (four words of 16 bits).  Two fingerprints within 2
    bits differ by at most 2 in every coordinate; a pair with a larger
    coordinate difference is discarded, and survivors are verified by the
    distance itself.

    *Cells.*  Pairs come from the table: at most two of the four words hold the
    differing bits, so in the other two words all coordinates agree.  Each
    fingerprint stands in six cells, one for each choice of two words, named by
    its 2 x ``CELL_PIVOTS`` coordinates there; fingerprints of one cell are
    candidates.  (Cells of whole-fingerprint coordinates would need their
    neighbours for the margin of 2, some 1.8 cells for each coordinate, and
    would still grow with the square of the table.)

    *Large cells.*  A cell with more than ``cell_pairs`` members emits no
    pairs.  It is resolved by local references instead: two members whose
    differing bits lie outside the cell's words link if and only if some
    fingerprint within one bit of both (the midpoint) differs from each outside
    those words, so each member goes to its 33 references in the cell (itself, and each
    flip of one of the 32 bits outside the cell's words), and members of a
    reference are within 2 bits of one another by the triangle inequality.
    At most 33 distinct fingerprints share a reference, so this is linear in
    the cell, finds the same groups, and drops nothing.

Groups
    Connected components over linked fingerprints by alternating large-star
    and small-star rounds on edge tables in the shared folder; the driver sees
    only two sums per round.

Defined cases: null text counts as empty; empty texts share fingerprint zero,
linked like any other; repeated rows keep their rows; a null ``doc_id`` gets
the group's smallest id that is not null (null if there is none); texts of any
length are fingerprinted whole, and a bit that half the shingles have is 0; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_batches, text_of, written

SEED = 42
#: coordinates of the pivot table: 7 bits each, nine to a long
PER_LONG, LONGS = 9, 2
#: words of a fingerprint, and references whose distances are taken word by word
WORDS, WORD_BITS = 4, 16
CELL_PIVOTS = 8


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def reference_fingerprints(n: int = PER_LONG * LONGS) -> list[int]:
    """The pivots: XXH64 of their numbers, as signed longs."""
    return [_signed(xxhash.xxh64_intdigest(f"pivot {i}".encode(), SEED)) for i in range(n)]


_POWERS = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: str, shingle: int = 3) -> int:
    """64-bit fingerprint of one text, as a signed long."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if n <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        length = np.fromiter(map(len, words), np.int64, n)
        end = np.cumsum(length + 1) - 1
        start = end - length
        hashes = [digest(joined[a:b], SEED)
                  for a, b in zip(start[:n - shingle + 1].tolist(), end[shingle - 1:].tolist())]
    ones = np.zeros(64, np.int64)
    values = np.array(hashes, dtype="<u8")
    for at in range(0, len(values), 1 << 14):
        part = values[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.uint16)
    return _signed(int(_POWERS[2 * ones > len(hashes)].sum(dtype=np.uint64)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)``, one row per input row."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def each(batches):
        for b in batches:
            fps = [fingerprint(t, shingle) for t in text_of(b)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return rows.mapInArrow(each, f"doc_id {rows.schema[0].dataType.simpleString()}, fp long")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def pivot_table(nodes: DataFrame) -> DataFrame:
    """``fp`` with its distances to the references, packed into t0 and t1."""
    refs = reference_fingerprints()

    def packed(part):
        return reduce(lambda x, y: x.bitwiseOR(y),
                      [F.shiftleft(hamming(F.col("fp"), F.lit(r)).cast("long"), 7 * i)
                       for i, r in enumerate(part)])

    return nodes.select("fp", *[packed(refs[k * PER_LONG:(k + 1) * PER_LONG]).alias(f"t{k}")
                                for k in range(LONGS)])


def _within(max_bits: int) -> Column:
    """No coordinate of the pivot table differs by more than ``max_bits``."""
    def coordinate(side, k, i):
        return F.shiftright(F.col(f"{side}.t{k}"), 7 * i).bitwiseAND(F.lit(127))
    return reduce(lambda x, y: x & y,
                  [F.abs(coordinate("a", k, i) - coordinate("b", k, i)) <= max_bits
                   for k in range(LONGS) for i in range(PER_LONG)])


def _word(x: Column, i: int) -> Column:
    return F.shiftrightunsigned(x, WORD_BITS * i).bitwiseAND(F.lit(0xFFFF))


def word_coordinates(i: int) -> list[Column]:
    """Distances of ``fp`` to the references in its i-th word."""
    return [hamming(_word(F.col("fp"), i), F.lit((r >> WORD_BITS * i) & 0xFFFF).cast("long")) for r in
            reference_fingerprints(CELL_PIVOTS)]


_PAIRS = list(combinations(range(WORDS), 2))


def _cells() -> Column:
    """The six cells of a fingerprint: number of the word pair, and the
    coordinates in the two words, as one number."""
    def named(t, i, j):
        return F.struct(F.lit(t).alias("pair"), F.xxhash64(F.lit(t), *word_coordinates(i), *word_coordinates(j)).alias("cell"))
    return F.array(*[named(t, i, j) for t, (i, j) in enumerate(_PAIRS)])


def _local_references() -> Column:
    """``fp`` and its flips of one bit outside the cell's two words."""
    def flips(kept):
        bits = [b for w in range(WORDS) if w not in kept
                for b in range(WORD_BITS * w, WORD_BITS * (w + 1))]
        return F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(_signed(1 << b))) for b in bits])
    out = F.when(F.col("pair") == 0, flips(_PAIRS[0]))
    for t, kept in list(enumerate(_PAIRS))[1:]:
        out = out.when(F.col("pair") == t, flips(kept))
    return out


def candidates(nodes: DataFrame) -> DataFrame:
    """Fingerprints in cells that hold more than one, with the table's
    coordinates and the cell's members."""
    table = pivot_table(nodes).select("*", F.explode(_cells()).alias("c")).select("fp", *[f"t{k}" for k in range(LONGS)], "c.*")
    sizes = table.groupBy("pair", "cell").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    return table.join(sizes, ["pair", "cell"])


def _cell_pairs(small: DataFrame) -> DataFrame:
    a, b = small.alias("a"), small.alias("b")
    return a.join(b, (F.col("a.pair") == F.col("b.pair")) & (F.col("a.cell") == F.col("b.cell"))
                  & (F.col("a.fp") < F.col("b.fp")))


def links(nodes: DataFrame, max_bits: int = 2, cell_pairs: int = 64) -> DataFrame:
    """Edges ``(u, v)``, u < v, whose connected components are those of all
    links among the distinct fingerprints ``fp`` of ``nodes``."""
    if max_bits != 2:
        raise ValueError("the cells hold links of up to 2 bits")
    shared = written(candidates(nodes), "cells")
    small = shared.where(F.col("members") <= cell_pairs).drop("members")
    pairs = (_cell_pairs(small).where(_within(max_bits)).where(hamming(F.col("a.fp"), F.col("b.fp")) <= max_bits)
             .select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")))
    by_reference = (shared.where(F.col("members") > cell_pairs)
                    .select("fp", "pair", "cell", F.explode(_local_references()).alias("reference"))
                    .groupBy("pair", "cell", "reference").agg(F.collect_set("fp").alias("near"))
                    .where(F.size("near") > 1)
                    .select(F.array_min("near").alias("u"), F.explode("near").alias("v"))
                    .where("u < v"))
    return pairs.unionByName(by_reference).distinct()


def link_counts(nodes: DataFrame, max_bits: int = 2, cell_pairs: int = 64) -> dict[str, int]:
    """How many pairs each step leaves: from cells, after the coordinates, after
    the distance; and the links that local references give."""
    shared = written(candidates(nodes), "cells")
    pairs = _cell_pairs(shared.where(F.col("members") <= cell_pairs)).select(
        F.col("a.fp").alias("u"), F.col("b.fp").alias("v"), _within(max_bits).alias("near"),
        (hamming(F.col("a.fp"), F.col("b.fp")) <= max_bits).alias("link")).distinct()
    row = pairs.agg(F.count(F.lit(1)), F.count_if("near"), F.count_if(F.col("near") & F.col("link"))).first()
    all_links = links(nodes, max_bits, cell_pairs).count()
    return {"candidates": row[0], "after_coordinates": row[1], "links_of_cells": row[2],
            "links_of_references_alone": all_links - row[2]}


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of an edge, root the smallest node
    reachable.  Alternates large-star and small-star; both keep the components
    and end in stars.  A node with very many neighbours is only ever grouped
    by an aggregate with map-side combine or joined on, never collected."""
    edges = written(edges.select("u", "v"), "edges")
    seen = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        # large star: each larger neighbour of u is tied to the least node around u
        large = (both.where("v > u").join(least, "u")
                 .select(F.col("m").alias("u"), "v").where("u <> v").distinct())
        # small star: u and its smaller neighbours are tied to the least of them
        least = large.groupBy("v").agg(F.min("u").alias("m"))
        tied = large.join(least, "v")
        small = (tied.where("u <> m").select(F.col("m").alias("u"), F.col("u").alias("v"))
                 .unionByName(least.select(F.col("m").alias("u"), "v"))
                 .where("u <> v").distinct())
        edges = written(small, "edges")
        now = edges.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                                                      F.lit(0))).first()
        if seen == tuple(now):
            break
        seen = tuple(now)
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return (edges.select(F.col("v").alias("node"), F.col("u").alias("root"))
            .unionByName(edges.select(F.col("u").alias("node"), F.col("u").alias("root"))).distinct())


def groups(prints: DataFrame, max_bits: int = 2, cell_pairs: int = 64) -> DataFrame:
    """``doc_id, fp, component_id, root`` for every row of ``prints``
    (``doc_id, fp``; a written table, it is read several times).  ``root`` is
    the group's smallest fingerprint."""
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    roots = components(links(nodes.select("fp"), max_bits, cell_pairs))
    rooted = (nodes.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    found = rooted.join(least, "root").select("fp", "component_id", "root")
    return prints.select("doc_id", "fp").join(found, "fp").select("doc_id", "fp", "component_id", "root")


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          shingle: int = 3, max_bits: int = 2, cell_pairs: int = 64) -> DataFrame:
    """One row per input row: ``doc_id``, ``fp`` (signed long) and
    ``component_id``, the smallest id of the document's group."""
    prints = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    return groups(prints, max_bits, cell_pairs).select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  shingle: int = 3, max_bits: int = 2, cell_pairs: int = 64) -> DataFrame:
    """The rows of ``docs``, one of each group: the one with the group's
    smallest id (a null id only if the group has no other), of rows that share
    that id and fingerprint the one with the first text."""
    bounded_batches(docs.sparkSession)
    at = docs.columns.index(text_col)
    fp = "_fp"
    while fp in docs.columns:
        fp += "_"

    def each(batches):
        for b in batches:
            yield b.append_column(fp, pa.array([fingerprint(t, shingle) for t in text_of(b, at)], pa.int64()))

    schema = T.StructType(docs.schema.fields + [T.StructField(fp, T.LongType())])
    rows = written(docs.mapInArrow(each, schema), "with-fingerprints")
    keepers = (groups(rows.select(F.col(id_col).alias("doc_id"), F.col(fp).alias("fp")), max_bits, cell_pairs)
               .groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "fp")).alias("k"))
               .select("k.doc_id", "k.fp"))
    first = Window.partitionBy(id_col, fp).orderBy(text_col)
    n = fp + "n"
    return (rows.join(keepers, rows[id_col].eqNullSafe(keepers["doc_id"]) & (rows[fp] == keepers["fp"]), "left_semi")
            .withColumn(n, F.row_number().over(first)).where(F.col(n) == 1).select(*docs.columns))


def fingerprint_text(fp: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
