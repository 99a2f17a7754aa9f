"""Exact top-k inner-product search by the three-phase uniform threshold.

The score of a query and a vector is a sum over ``lists`` groups of
dimensions; each group is a score list that knows only its own part.

1. *Gather.*  Every list gives each query's ``depth`` best local entries.
   Their whole scores are looked up, and the k-th best of them is a lower
   bound ``t`` of the query's k-th best score; the deeper the lists, the
   closer the bound and the fewer entries phase 2 returns.
2. *Cutoff.*  A vector that scores ``t`` or more has a part of at least
   ``t / lists`` in some list, so that is the cutoff sent back to all lists;
   each returns every entry at or above it.
3. *Resolve.*  A vector seen in every list has its whole score as the sum.
   For the others the missing parts lie below the cutoff; those whose upper
   bound reaches ``t`` are scored exactly, and the best k stay.

Vectors enter as integers ``floor(256 * x)``; equal vectors are one entry that
carries its ``k + 1`` smallest ids (no more of them can be among a query's k
best, its own id being left out), so a vector that a third of the rows share
costs one entry and equal query vectors are searched once.  Vectors and
queries are held in blocks of ``BLOCK`` rows; a block of queries meets a block
of vectors as one row, joined on (list, query block, salt).

Defined cases: rows with a null id, a null vector, or a null or non-finite
component take no part; vectors of different lengths are compared as if the
shorter ended in zeros; identical rows are one row; rows with a query's id
are its own; an empty table gives an empty result; other columns are ignored;
a component or score beyond a long is an error, as it has no value to return.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, written

BLOCK = 256
SALTS = 16


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float = 256.0) -> DataFrame:
    """``id, ints``: floor(scale * x) of the rows that take part."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("id"),
                    F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long")).alias("ints")))


def _inner(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x * y, F.lit(0).cast("long"))),
                       F.lit(0).cast("long"), lambda s, v: s + v)


def _spans(dims: int, lists: int) -> list[tuple[int, int]]:
    edges = [dims * i // lists for i in range(lists + 1)]
    return list(zip(edges, edges[1:]))


def _matrix(rows: list, dims: int) -> np.ndarray:
    out = np.zeros((len(rows), dims), np.int64)
    for k, r in enumerate(rows):
        out[k, :len(r)] = r
    return out


def _blocks(entries: DataFrame, dims: int, lists: int, with_cut: bool = False) -> DataFrame:
    """``list, block ids and matrix`` of ``entries`` (u, ints[, cut])."""
    def each(batches):
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                m = _matrix(part.column(1).to_pylist(), dims)
                us = part.column(0).to_numpy().astype("<i8").tobytes()
                cut = part.column(2).to_numpy(zero_copy_only=False).astype("<f8").tobytes() if with_cut else None
                yield pa.RecordBatch.from_pylist(
                    [{"list": i, "us": us, "matrix": np.ascontiguousarray(m[:, lo:hi]).astype("<i8").tobytes(),
                      "cut": cut} for i, (lo, hi) in enumerate(_spans(dims, lists))],
                    pa.schema([("list", pa.int32()), ("us", pa.binary()), ("matrix", pa.binary()),
                               ("cut", pa.binary())]))
    return entries.mapInArrow(each, "list int, us binary, matrix binary, cut binary")


def _meetings(vectors: DataFrame, queries: DataFrame, query_blocks: int) -> DataFrame:
    """Every block of vectors with every block of queries of the same list."""
    v = (vectors.withColumn("salt", F.pmod(F.xxhash64("us"), F.lit(SALTS)))
         .withColumn("qblock", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
         .select("list", "salt", "qblock", F.col("us").alias("vus"), F.col("matrix").alias("vmatrix")))
    q = (queries.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
         .select("list", F.col("salt").cast("long"), "qblock", F.col("us").alias("qus"),
                 F.col("matrix").alias("qmatrix"), "cut"))
    return v.join(q, ["list", "salt", "qblock"]).select("list", "vus", "vmatrix", "qus", "qmatrix", "cut")


def _parts(row):
    """Ids and the partial score matrix (queries x vectors) of one meeting."""
    vus, qus = np.frombuffer(row["vus"], "<i8"), np.frombuffer(row["qus"], "<i8")
    vm = np.frombuffer(row["vmatrix"], "<i8").reshape(len(vus), -1)
    qm = np.frombuffer(row["qmatrix"], "<i8").reshape(len(qus), -1)
    bound = float(np.abs(vm).max(initial=0)) * float(np.abs(qm).max(initial=0)) * max(1, vm.shape[1])
    if bound < 2 ** 53:  # exact in doubles
        return vus, qus, (qm.astype(np.float64) @ vm.T.astype(np.float64)).astype(np.int64)
    return vus, qus, qm @ vm.T


_ENTRY = "q long, list int, u long, part long"


def _entries(q, i, u, s):
    return pa.RecordBatch.from_arrays(
        [pa.array(q, pa.int64()), pa.array(np.full(len(q), i, np.int32)), pa.array(u, pa.int64()),
         pa.array(s, pa.int64())], ["q", "list", "u", "part"])


def _best_of_lists(meetings: DataFrame, k: int) -> DataFrame:
    """Phase 1: each list's k best entries of each query, per task."""
    def each(batches):
        best: dict = defaultdict(lambda: (None, None))
        for b in batches:
            for row in b.to_pylist():
                vus, qus, s = _parts(row)
                key = (row["list"], row["qus"])
                old_u, old_s = best[key]
                u = np.broadcast_to(vus, s.shape)
                if old_u is not None:
                    u, s = np.concatenate([old_u, u], 1), np.concatenate([old_s, s], 1)
                if s.shape[1] > k:
                    at = np.argpartition(-s, k - 1, axis=1)[:, :k]
                    u, s = np.take_along_axis(u, at, 1), np.take_along_axis(s, at, 1)
                best[key] = (u, s)
        for (i, qus), (u, s) in best.items():
            q = np.repeat(np.frombuffer(qus, "<i8"), s.shape[1])
            yield _entries(q, i, u.ravel(), s.ravel())
    return meetings.mapInArrow(each, _ENTRY)


def _above_cutoff(meetings: DataFrame) -> DataFrame:
    """Phase 2: every entry at or above its query's cutoff."""
    def each(batches):
        for b in batches:
            for row in b.to_pylist():
                vus, qus, s = _parts(row)
                at, col = np.nonzero(s >= np.frombuffer(row["cut"], "<f8")[:, None])
                if len(at):
                    yield _entries(qus[at], row["list"], vus[col], s[at, col])
    return meetings.mapInArrow(each, _ENTRY)


def _resolved(pairs: DataFrame, entries: DataFrame) -> DataFrame:
    """``pairs`` (q, u, ...) with the whole score."""
    u, q = entries.select("u", F.col("ints").alias("ui")), entries.select(F.col("u").alias("q"), F.col("ints").alias("qi"))
    return pairs.join(u, "u").join(q, "q").withColumn("score", _inner(F.col("qi"), F.col("ui"))).drop("ui", "qi")


def search(vectors: DataFrame, is_query: Column, k: int = 5, lists: int = 2, depth: int = 48,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score`` of every row of ``vectors`` for which
    ``is_query`` (a condition on ``id_col``) holds, against all other rows;
    ties go to the smaller id."""
    spark = vectors.sparkSession
    bounded_batches(spark, BLOCK)
    rows = quantised(vectors, id_col, vector_col).distinct()
    asks = (quantised(vectors.where(is_query), id_col, vector_col).distinct()
            .select(F.col("id").alias("query_id"), "ints"))
    first = Window.partitionBy("ints").orderBy("id")
    entries = written(
        rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
        .groupBy("ints").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("u", F.monotonically_increasing_id()), "vectors")
    asks = written(asks.join(entries.select("ints", "u"), "ints").select("query_id", "u"), "queries")
    wanted = asks.select("u").distinct()
    counted = wanted.count()
    dims = entries.agg(F.max(F.size("ints"))).first()[0] or 0
    if not counted or not dims:
        lists, dims = 1, max(dims, 1)
    lists = min(lists, dims)
    query_blocks = max(1, -(-counted // BLOCK))
    need = k + 1

    vector_blocks = written(_blocks(entries.select("u", "ints"), dims, lists), "vector-blocks")

    def numbered(found: DataFrame) -> DataFrame:
        return found.withColumn("qblock", F.pmod(F.xxhash64("us"), F.lit(query_blocks)).cast("int"))

    asked = entries.join(wanted, "u")
    q1 = numbered(_blocks(asked.select("u", "ints"), dims, lists))
    by_list = Window.partitionBy("q", "list").orderBy(F.desc("part"), "u")
    depth = max(depth, need)
    local = (_best_of_lists(_meetings(vector_blocks, q1, query_blocks), depth)
             .withColumn("n", F.row_number().over(by_list)).where(F.col("n") <= depth))
    known = _resolved(local.select("q", "u").distinct(), entries)
    by_query = Window.partitionBy("q").orderBy(F.desc("score"), "u")
    bound = written(known.withColumn("n", F.row_number().over(by_query)).where(F.col("n") == need)
                    .select("q", F.col("score").alias("t")), "bounds")

    cut = F.coalesce(F.col("t") / F.lit(float(lists)), F.lit(float("-inf")))
    q2 = numbered(_blocks(asked.join(bound.withColumnRenamed("q", "u"), "u", "left")
                          .select("u", "ints", cut.alias("cut")), dims, lists, with_cut=True))
    seen = (_above_cutoff(_meetings(vector_blocks, q2, query_blocks))
            .groupBy("q", "u").agg(F.sum("part").alias("sum"), F.count(F.lit(1)).alias("n")))
    seen = written(seen.join(bound, "q", "left"), "entries")
    whole = seen.where(F.col("n") == lists).select("q", "u", F.col("sum").alias("score"), "t")
    open_ = (seen.where((F.col("n") < lists)
                        & (F.col("t").isNull()
                           | (F.col("sum") + (lists - F.col("n")) * (F.col("t") / float(lists)) >= F.col("t"))))
             .select("q", "u", "t"))
    scored = (whole.unionByName(_resolved(open_, entries).select("q", "u", "score", "t"))
              .where(F.col("t").isNull() | (F.col("score") >= F.col("t"))))
    firsts = scored.join(entries.select("u", "ids"), "u")
    near = Window.partitionBy("q").orderBy(F.desc("score"), F.col("ids")[0])
    kept = (firsts.withColumn("n", F.row_number().over(near)).where(F.col("n") <= need)
            .select(F.col("q").alias("u"), "ids", "score"))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asks.join(kept, "u").select("query_id", "score", F.explode("ids").alias("vec_id"))
            .where("query_id <> vec_id")
            .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
