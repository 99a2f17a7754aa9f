"""Hard-negative mining by segment summary filtering.

A vector is cut into segments of dimensions; of each segment its mean and its
deviation (the length of what is left without the mean) are stored.  For two
vectors the inner product over a segment of m dimensions lies within

    m * mean * mean'  -  dev * dev'   and   m * mean * mean'  +  dev * dev'

so the products of means, plus or minus the products of deviations, bound a
score from both sides.  One segment over the whole vector comes first; pairs
whose bounds leave them open go on to the next level, where each segment falls
in ``FAN`` parts, and so on; what is still open is scored exactly.

1. *Positives.*  An anchor's floor is the score of the last row it needs:
   within a task, the best lower bounds of rows of its label give a first one,
   exact scores then raise it.  Rows whose upper bound is below it are dropped.
2. *Negatives.*  Each positive score p of an anchor opens a window from
   ``share * p`` to p.  A row of another label is kept at a level if, for some
   window, its lower bound is not above p and its upper bound reaches both the
   window's foot and the window's floor: the lowest of the best ``k`` scores
   that a task has found inside that window so far.

Vectors enter as integers ``floor(256 * x)``.  Equal vectors of one label are
one entry that carries its ``positives + 1`` smallest ids, so a vector that a
third of the rows share costs one entry and equal anchors are searched once.
Entries and anchors are held in blocks; a block of anchors meets a block of
entries as one row, joined on (anchor block, salt), and nothing is broadcast.
A label that holds a third of the rows only fills more blocks.

Defined cases: rows with a null id, label or vector, or with a null or
non-finite component take no part; identical rows are one row, and an anchor's
other rows are all but that one; vectors of different lengths are
compared as if the shorter ended in zeros; an anchor without other rows of its
label, and a positive whose window is empty (as below a score of zero), have
no rows; ties go to the smaller id; an empty table gives an empty result;
other columns are ignored; a component or score beyond a long is an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, written

BLOCK = 512
SALTS = 16
#: parts into which a segment falls at the next level
FAN = 4
#: share of a block's pairs from which on the whole block is scored at once
DENSE = 0.05


def _levels(dims: int) -> list[int]:
    """Numbers of segments, coarse to fine; segments keep two dimensions at least."""
    out = [1]
    while out[-1] * FAN * 2 <= dims:
        out.append(out[-1] * FAN)
    return out


def _summaries(m: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Means (times the root of the segment's length) and deviations."""
    edges = [m.shape[1] * i // parts for i in range(parts + 1)]
    means, devs = np.zeros((len(m), parts)), np.zeros((len(m), parts))
    for k, (lo, hi) in enumerate(zip(edges, edges[1:])):
        if hi > lo:
            seg = m[:, lo:hi]
            mean = seg.mean(1)
            means[:, k] = mean * np.sqrt(hi - lo)
            devs[:, k] = np.sqrt(((seg - mean[:, None]) ** 2).sum(1))
    return means, devs


class _Block:
    """Vectors of a block: as doubles and as longs, and their summaries."""

    def __init__(self, matrix: bytes, n: int):
        self.ints = np.frombuffer(matrix, "<i8").reshape(n, -1)
        self.x = self.ints.astype(np.float64)
        self.top = np.abs(self.x).max(initial=0.0)
        self.levels = [_summaries(self.x, parts) for parts in _levels(max(1, self.x.shape[1]))]


def bounds(a: _Block, b: _Block, level: int, pairs=None):
    """Lower and upper bounds of the scores of all pairs, or of ``pairs`` (rows
    of a, rows of b), widened by what doubles may have lost."""
    (am, ad), (bm, bd) = a.levels[level], b.levels[level]
    if pairs is None:
        mid, off = am @ bm.T, ad @ bd.T
    else:
        mid = np.einsum("ij,ij->i", am[pairs[0]], bm[pairs[1]])
        off = np.einsum("ij,ij->i", ad[pairs[0]], bd[pairs[1]])
    slack = 1e-9 * (1.0 + a.top * b.top * a.x.shape[1])
    return mid - off - slack, mid + off + slack


def _exact(a: _Block, b: _Block, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    small = a.top * b.top * max(1, a.x.shape[1]) < 2 ** 53  # exact in doubles
    x, y = (a.x, b.x) if small else (a.ints, b.ints)
    if len(rows) > DENSE * len(x) * len(y):
        return (x @ y.T)[rows, cols].astype(np.int64)
    return np.einsum("ij,ij->i", x[rows], y[cols]).astype(np.int64)


def _open_pairs(a: _Block, b: _Block, possible: np.ndarray, stays, counts=None):
    """Pairs that ``stays(rows, cols, low, high)`` keeps at every level."""
    low, high = bounds(a, b, 0)
    rows, cols = np.nonzero(possible)
    if counts is not None:
        counts[0] += len(rows)
    keep = stays(rows, cols, low[rows, cols], high[rows, cols])
    rows, cols = rows[keep], cols[keep]
    for level in range(1, len(a.levels)):
        if not len(rows):
            break
        if len(rows) > DENSE * possible.size:
            low, high = bounds(a, b, level)
            low, high = low[rows, cols], high[rows, cols]
        else:
            low, high = bounds(a, b, level, (rows, cols))
        if counts is not None:
            counts[level] += len(rows)
        keep = stays(rows, cols, low, high)
        rows, cols = rows[keep], cols[keep]
    if counts is not None:
        counts[len(a.levels)] += len(rows)
    return rows, cols


def _best(rows: np.ndarray, score: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Places of each row's ``k`` best scores, ties by ``first``."""
    order = np.lexsort((first, -score, rows))
    r = rows[order]
    starts = np.flatnonzero(np.append(True, r[1:] != r[:-1])) if len(r) else np.zeros(0, int)
    place = np.arange(len(r)) - np.repeat(starts, np.diff(np.append(starts, len(r))))
    return order[place < k]


_SHAPE = [("us", pa.binary()), ("firsts", pa.binary()), ("labels", pa.binary()), ("matrix", pa.binary())]


def _blocks(entries: DataFrame, dims: int, windows: bool) -> DataFrame:
    """Blocks of ``entries`` (u, first, label, ints[, tops])."""
    def each(batches):
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                m = np.zeros((part.num_rows, dims), "<i8")
                for k, row in enumerate(part.column(3).to_pylist()):
                    m[k, :len(row)] = row
                out = {"us": part.column(0).to_numpy().astype("<i8").tobytes(),
                       "firsts": part.column(1).to_numpy().astype("<i8").tobytes(),
                       "labels": part.column(2).to_numpy().astype("<i8").tobytes(), "matrix": m.tobytes()}
                if windows:
                    out["tops"] = part.column(4).to_pylist()
                yield pa.RecordBatch.from_pylist([out], pa.schema(
                    _SHAPE + ([("tops", pa.list_(pa.list_(pa.int64())))] if windows else [])))
    return entries.mapInArrow(each, "us binary, firsts binary, labels binary, matrix binary"
                              + (", tops array<array<bigint>>" if windows else ""))


def _meetings(entries: DataFrame, anchors: DataFrame, anchor_blocks: int, windows: bool) -> DataFrame:
    """Every block of entries with every block of anchors."""
    v = (entries.withColumn("salt", F.pmod(F.xxhash64("us"), F.lit(SALTS)))
         .withColumn("ablock", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1)))))
    a = (anchors.withColumn("ablock", F.pmod(F.xxhash64("us"), F.lit(anchor_blocks)).cast("int"))
         .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumn("salt", F.col("salt").cast("long"))
         .select("salt", "ablock", F.col("us").alias("aus"), F.col("labels").alias("alabels"),
                 F.col("matrix").alias("amatrix"), *(["tops"] if windows else [])))
    return v.join(a, ["salt", "ablock"]).drop("salt", "ablock")


class _Meeting:
    """One row of ``_meetings``, blocks kept from the row before where equal."""

    def __init__(self, row, known: dict):
        self.a = known.get(row["aus"])
        if self.a is None:
            known.clear()
            self.a = known[row["aus"]] = _Block(row["amatrix"], len(row["aus"]) // 8)
        self.aus, self.us = np.frombuffer(row["aus"], "<i8"), np.frombuffer(row["us"], "<i8")
        self.b = _Block(row["matrix"], len(self.us))
        self.firsts = np.frombuffer(row["firsts"], "<i8")
        self.same = np.frombuffer(row["alabels"], "<i8")[:, None] == np.frombuffer(row["labels"], "<i8")[None, :]


def _raise(best: dict, key, rows, us, firsts, score, k: int, size: int) -> None:
    """Keep each row's ``k`` best entries under ``key``, with the rows' floors."""
    old = best.get(key)
    if old is not None:
        rows, us, firsts, score = (np.concatenate([o, n]) for o, n in zip(old[:4], (rows, us, firsts, score)))
    at = _best(rows, score, firsts, k)
    rows, us, firsts, score = rows[at], us[at], firsts[at], score[at]
    floor = np.full(size, -np.inf)
    full = np.bincount(rows, minlength=size) == k
    if len(rows):
        low = np.full(size, np.inf)
        np.minimum.at(low, rows, score.astype(np.float64))
        floor[full] = low[full] - 1e-9 * np.abs(low[full])
    best[key] = (rows, us, firsts, score, floor)


_FOUND = "a long, slot int, u long, first long, score long"


def _found(aus, slots, got) -> pa.RecordBatch:
    rows, us, firsts, score, _ = got
    return pa.RecordBatch.from_arrays(
        [pa.array(aus[rows]), pa.array(slots, pa.int32()), pa.array(us), pa.array(firsts), pa.array(score)],
        ["a", "slot", "u", "first", "score"])


def _runs(meetings: DataFrame, work, finish) -> DataFrame:
    """``work(meeting, row, best)`` on every meeting; ``best`` is emptied by
    ``finish(anchor ids, best)`` when a task goes on to another anchor block."""
    def each(batches):
        best: dict = {}
        known: dict = {}
        key = None
        for batch in batches:
            for row in batch.to_pylist():
                if key is not None and row["aus"] != key:
                    yield from finish(np.frombuffer(key, "<i8"), best)
                    best.clear()
                key = row["aus"]
                work(_Meeting(row, known), row, best)
        if key is not None:
            yield from finish(np.frombuffer(key, "<i8"), best)
    return meetings.mapInArrow(each, _FOUND)


def _finish(aus, best):
    for slot, got in best.items():
        if len(got[0]):
            yield _found(aus, np.full(len(got[0]), slot), got)


def _positives(meetings: DataFrame, k: int) -> DataFrame:
    """Each anchor entry's ``k`` best entries of its label, per task."""
    def work(m, row, best):
        n = len(m.aus)
        floor = best[0][4] if best else np.full(n, -np.inf)

        def stays(rows, cols, low, high):
            nonlocal floor
            at = _best(rows, low, cols, k)  # k lower bounds that a row has are a floor
            full = np.bincount(rows[at], minlength=n) == k
            least = np.full(n, np.inf)
            np.minimum.at(least, rows[at], low[at])
            floor = np.where(full, np.maximum(floor, least), floor)
            return high >= floor[rows]

        rows, cols = _open_pairs(m.a, m.b, m.same, stays)
        _raise(best, 0, rows, m.us[cols], m.firsts[cols], _exact(m.a, m.b, rows, cols), k, n)
    return _runs(meetings, work, _finish)


def _negatives(meetings: DataFrame, k: int, share: tuple[int, int]) -> DataFrame:
    """Each anchor entry's ``k`` best entries of other labels inside each of its
    windows (slot: the window's place in the anchor's list), per task."""
    num, den = share

    def work(m, row, best):
        n = len(m.aus)
        slots = max((len(t) for t in row["tops"]), default=0)
        tops = np.full((n, slots), -1, np.int64)  # a window of a negative score is empty
        for i, t in enumerate(row["tops"]):
            tops[i, :len(t)] = t
        whole, rest = np.divmod(tops, den)
        feet = whole * num - (-num * rest // den)  # num / den of the top, rounded up
        floors = [best[s][4] if s in best else np.full(n, -np.inf) for s in range(slots)]

        def stays(rows, cols, low, high):
            keep = np.zeros(len(rows), bool)
            for s in range(slots):
                top = tops[rows, s]
                keep |= (top >= 0) & (low <= top) & (high >= feet[rows, s]) & (high >= floors[s][rows])
            return keep

        rows, cols = _open_pairs(m.a, m.b, ~m.same, stays)
        score = _exact(m.a, m.b, rows, cols)
        for s in range(slots):
            at = (tops[rows, s] >= 0) & (score <= tops[rows, s]) & (score >= feet[rows, s])
            _raise(best, s, rows[at], m.us[cols[at]], m.firsts[cols[at]], score[at], k, n)
    return _runs(meetings, work, _finish)


def _rows(vectors: DataFrame, id_col: str, label_col: str, vector_col: str, is_anchor: Column) -> DataFrame:
    """``id, label, ints, anchor`` of the rows that take part, identical ones once."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & finite)
            .select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"),
                    F.transform(x, lambda v: F.floor(v.cast("double") * 256.0).cast("long")).alias("ints"),
                    F.coalesce(is_anchor, F.lit(False)).alias("anchor"))
            .groupBy("id", "label", "ints").agg(F.max("anchor").alias("anchor")))


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, share: tuple[int, int] = (80, 100),
         id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score``: for every row for which ``is_anchor`` (a condition on the
    input's columns) holds and each of its best ``positives`` other rows of the
    same label, the best ``negatives`` rows of other labels that score from
    ``share`` of the positive's score up to that score."""
    spark = vectors.sparkSession
    bounded_batches(spark, BLOCK)
    rows = _rows(vectors, id_col, label_col, vector_col, is_anchor)
    need = positives + 1
    first = Window.partitionBy("label", "ints").orderBy("id")
    entries = written(
        rows.withColumn("n", F.row_number().over(first)).where(F.col("n") <= max(need, negatives))
        .groupBy("label", "ints").agg(F.sort_array(F.collect_list("id")).alias("ids"))
        .withColumn("u", F.monotonically_increasing_id()).withColumn("first", F.col("ids")[0]), "negative-entries")
    anchors = written(rows.where("anchor").join(entries.select("label", "ints", "u"), ["label", "ints"])
                      .select(F.col("id").alias("anchor_id"), F.col("u").alias("a")), "negative-anchors")
    wanted = anchors.select(F.col("a").alias("u")).distinct()
    anchor_blocks = max(1, -(-wanted.count() // BLOCK))
    dims = max(1, entries.agg(F.max(F.size("ints"))).first()[0] or 1)

    blocks = written(_blocks(entries.select("u", "first", "label", "ints"), dims, False), "negative-blocks")
    asked = entries.join(wanted, "u").select("u", "first", "label", "ints")
    near = Window.partitionBy("a").orderBy(F.desc("score"), "first", "u")
    found = (_positives(_meetings(blocks, _blocks(asked, dims, False), anchor_blocks, False), need)
             .withColumn("n", F.row_number().over(near)).where(F.col("n") <= need))
    # the best rows of each anchor entry, an anchor's own row among them
    by_row = Window.partitionBy("a").orderBy(F.desc("score"), "id", "u")
    listed = written(found.select("a", "u", "score").join(entries.select("u", "ids"), "u")
                     .select("a", "u", "score", F.explode("ids").alias("id"))
                     .withColumn("n", F.row_number().over(by_row)).where(F.col("n") <= need).drop("n"),
                     "negative-positives")
    tops = listed.groupBy("a").agg(F.sort_array(F.collect_set("score"), asc=False).alias("tops"))

    with_tops = asked.join(tops.withColumnRenamed("a", "u"), "u").select("u", "first", "label", "ints", "tops")
    each_window = Window.partitionBy("a", "slot").orderBy(F.desc("score"), "first", "u")
    inside = (_negatives(_meetings(blocks, _blocks(with_tops, dims, True), anchor_blocks, True), negatives, share)
              .withColumn("n", F.row_number().over(each_window)).where(F.col("n") <= negatives)
              .join(entries.select("u", "ids"), "u").join(tops, "a")
              .select("a", F.col("tops")[F.col("slot")].alias("positive_score"), F.col("score").alias("negative_score"),
                      "u", F.explode("ids").alias("negative_id")))
    ranked = Window.partitionBy("a", "positive_score").orderBy(F.desc("negative_score"), "negative_id", "u")
    chosen = inside.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives).drop("u")
    own = Window.partitionBy("anchor_id", "a").orderBy(F.desc("score"), "id", "u")
    pairs = (anchors.join(listed, "a").where("NOT (id = anchor_id AND u = a)")
             .withColumn("n", F.row_number().over(own)).where(F.col("n") <= positives)
             .select("a", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    return (pairs.join(chosen, ["a", "positive_score"])
            .select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score",
                    "negative_score"))
