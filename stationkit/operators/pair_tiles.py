"""Correlations of thousands of columns by column-block tiles (A1).

The table is long: (row key, column, value).  Columns are dealt to blocks by a
hash, at most about ``block_columns`` columns and ``cells`` values each, and
each block is written once, packed into one row of arrays.  A tile is a pair of
blocks: the packed table is paired with itself without a shuffle, so a block is
read by many tasks but never copied to disk for each of them, and a task adds
up its pairs' sums as matrix products, ``COLUMNS`` columns of each side and
``KEYS`` rows at a time.  No task sees all columns.  Only where single columns
hold more than ``cells`` values are rows dealt to blocks too; then the row
blocks' sums of a pair are added on each executor before a shuffle.

Values enter less their column's mean, so a column's offset costs no digits.

Where only the best pairs of each column are wanted, a tile's sums are taken in
single precision first.  Their rounding errors are bounded pair by pair, and
the pairs that may be among the best within those bounds are added up again in
double precision; what is handed on is what double precision alone would give.
"""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, shuffles_dropped

#: rows of a tile that are held as matrices at a time
KEYS = 4096
#: columns of either side of a tile that are multiplied at a time
COLUMNS = 512
#: columns of a block, where more would leave cores without a tile
FEW = 64

_SUMS = ["n", "sa", "sb", "saa", "sbb", "sab"]
_BLOCK = "rows int, block int, keys array<string>, cols array<string>, k binary, c binary, v binary"
_TINY = 1e-12


#: rounding of one operation in single precision
_UNIT = 2.0 ** -24
#: least variation (of a column scaled to about one) that single precision is trusted with
_LEAST = 1e-12
#: candidate pairs of a tile that are always looked at one by one
FEW_PAIRS = 4096
#: cells of candidate pairs that are added up at a time in double precision
_CELLS = 1 << 19


def _pack(group: pa.Table, centred: bool = True) -> pa.Table:
    """One row of a block's cells, by column and then key; both are numbers of
    sorted names.  Values that are not ``centred`` lose their column's mean, for
    which the block must hold whole columns."""
    def numbered(name):
        coded = group.column(name).combine_chunks().dictionary_encode()
        names = np.array([str(x) for x in coded.dictionary.to_pylist()], object)
        order = np.argsort(names)
        number = np.empty(len(names), np.int32)
        number[order] = np.arange(len(names), dtype=np.int32)
        return names[order], number[coded.indices.to_numpy()]

    (keys, k), (cols, c) = numbered("key"), numbered("col")
    order = np.lexsort((k, c))
    k, c, v = k[order], c[order], group.column("v").to_numpy()[order]
    if ((k[1:] == k[:-1]) & (c[1:] == c[:-1])).any():
        raise ValueError("a row has several values in one column")
    if not centred:
        v = v - (np.bincount(c, v) / np.bincount(c))[c]
    arrays = [pa.array([group.column(n)[0].as_py()], pa.int32()) for n in ("rows", "block")]
    arrays += [pa.array([x.tolist()], pa.list_(pa.string())) for x in (keys, cols)]
    arrays += [pa.array([x.tobytes()], pa.binary()) for x in (k, c, v)]
    return pa.table(arrays, ["rows", "block", "keys", "cols", "k", "c", "v"])


class _Side:
    """A packed block, its keys numbered among those that both blocks have."""

    def __init__(self, cols, k, c, v, shared_at):
        at = shared_at[k]
        here = at >= 0
        self.cols, self.at, self.c, self.v = cols, at[here], c[here], v[here]
        self.starts = np.searchsorted(self.c, np.arange(len(cols) + 1))
        self.scaled = None

    def matrices(self, first: int, last: int, key: int, keys: int) -> tuple[np.ndarray, np.ndarray]:
        """Values and presence of columns first..last in keys key..key+keys."""
        lo, hi = np.searchsorted(self.c, [first, last])
        some = lo + np.flatnonzero((self.at[lo:hi] >= key) & (self.at[lo:hi] < key + keys))
        at, c, v = self.at[some], self.c[some], self.v[some]
        x, w = np.zeros((keys, last - first)), np.zeros((keys, last - first))
        x[at - key, c - first], w[at - key, c - first] = v, 1.0
        return x, w

    def singles(self, first: int, last: int, key: int, keys: int) -> tuple[np.ndarray, np.ndarray]:
        """The same in single precision, a row for each column, scaled to about one."""
        if self.scaled is None:
            with np.errstate(all="ignore"):
                square = np.bincount(self.c, self.v * self.v, len(self.cols)) / np.bincount(self.c, minlength=len(self.cols))
                power = np.frexp(np.sqrt(square))[1]
                self.scaled = np.ldexp(self.v, -power[self.c]).astype(np.float32)
        lo, hi = np.searchsorted(self.c, [first, last])
        at, c, v = self.at[lo:hi] - key, self.c[lo:hi] - first, self.scaled[lo:hi]
        if key or at.max(initial=0) >= keys:
            some = (at >= 0) & (at < keys)
            at, c, v = at[some], c[some], v[some]
        x, w = np.zeros((last - first, keys), np.float32), np.zeros((last - first, keys), np.float32)
        x[c, at], w[c, at] = v, 1.0
        return x, w

    def cells(self, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the cells of any ``columns`` stand, and of which of them each is."""
        first = self.starts[columns]
        many = self.starts[columns + 1] - first
        row = np.repeat(np.arange(len(columns)), many)
        return (first - (np.cumsum(many) - many))[row] + np.arange(len(row)), row


def _sides(a: dict, b: dict) -> tuple[_Side, _Side, int]:
    """The two blocks of a tile and how many keys they share."""
    ka, kb = (np.array(s["keys"], object) for s in (a, b))
    shared, in_a, in_b = np.intersect1d(ka, kb, assume_unique=True, return_indices=True)
    sides = []
    for s, keys, found in ((a, ka, in_a), (b, kb, in_b)):
        at = np.full(len(keys), -1, np.int64)
        at[found] = np.arange(len(found))
        sides.append(_Side(s["cols"], *(np.frombuffer(s[n], t) for n, t in (("k", "i4"), ("c", "i4"), ("v", "f8"))), at))
    return *sides, len(shared)


def _tile(left: _Side, right: _Side, shared: int, same: bool):
    """First column of either side and sums of their pairs, part by part."""
    for i in range(0, len(left.cols), COLUMNS):
        for j in range(i if same else 0, len(right.cols), COLUMNS):
            wide = min(i + COLUMNS, len(left.cols)), min(j + COLUMNS, len(right.cols))
            sums = np.zeros((6, wide[0] - i, wide[1] - j))
            for key in range(0, shared, KEYS):
                keys = min(KEYS, shared - key)
                xa, wa = left.matrices(i, wide[0], key, keys)
                xb, wb = right.matrices(j, wide[1], key, keys)
                for total, (p, q) in zip(sums, ((wa, wb), (xa, wb), (wa, xb), (xa * xa, wb), (wa, xb * xb), (xa, xb))):
                    total += p.T @ q
            yield i, j, sums


def _rounded(r: np.ndarray, places: int) -> np.ndarray:
    """``r`` in units of the last place, halves away from zero in its decimal digits."""
    scaled = np.abs(r) * 10.0 ** places
    out = np.floor(scaled + 0.5)
    for at in zip(*np.nonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-6)):
        out[at] = float(Decimal(repr(abs(float(r[at])))).scaleb(places).quantize(Decimal(1), ROUND_HALF_UP))
    return np.copysign(out, r)


def _scores(sums: np.ndarray, least_pairs: int, places: int) -> np.ndarray:
    """Correlations in units of the last place; of pairs without one, minus infinity."""
    n, sa, sb, saa, sbb, sab = sums
    with np.errstate(divide="ignore", invalid="ignore"):
        va, vb = saa - sa * sa / n, sbb - sb * sb / n
        r = np.clip((sab - sa * sb / n) / (np.sqrt(va) * np.sqrt(vb)), -1.0, 1.0)
        fit = (n >= max(1, least_pairs)) & (va > saa * _TINY) & (vb > sbb * _TINY) & ~np.isnan(r)
    score = np.full(r.shape, -np.inf)
    score[fit] = _rounded(r[fit], places)
    return score


def _may_be_best(sums: np.ndarray, apart: np.ndarray, k: int, least_pairs: int, places: int) -> np.ndarray:
    """Which pairs are among the ``k`` best of their left or their right column
    in this part of a tile; ties go to the first name, as the columns are sorted."""
    score = np.where(apart, _scores(sums, least_pairs, places), -np.inf)
    found = np.zeros(score.shape, bool)
    for axis in (0, 1):
        left = score.copy()
        for _ in range(min(k, score.shape[axis])):
            best = np.expand_dims(left.argmax(axis), axis)
            np.put_along_axis(found, best, True, axis)
            np.put_along_axis(left, best, -np.inf, axis)
    return found & (score > -np.inf)


def _single_sums(left: _Side, right: _Side, first: tuple[int, int], second: tuple[int, int], chunks, kept) -> np.ndarray:
    """``n, sa, saa, sb, sab, sbb`` of a part's pairs, in single precision."""
    sums = np.zeros((6, first[1] - first[0], second[1] - second[0]), np.float32)
    shape = (-1, *sums.shape[1:])
    for chunk in chunks:
        xa, wa = left.singles(*first, *chunk)
        xb, wb = kept or right.singles(*second, *chunk)
        with np.errstate(all="ignore"):
            stacked = np.concatenate([wa, xa, xa * xa])
            sums[:3] += (stacked @ wb.T).reshape(shape)
            sums[3:5] += (stacked[:2 * len(wa)] @ xb.T).reshape(shape)
            sums[5] += wa @ (xb * xb).T
    return sums


def _bounds(sums: np.ndarray, chunks: int, least_pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest correlation that single-precision sums leave possible.

    A sum of n products is off by at most about n units of the products' sizes,
    whatever their order, since zeros add no error; so ``va`` is off by (3n + 5)
    units of ``saa`` at most, the numerator by as many of sqrt(saa sbb), and the
    quotient by (3n + 5) (saa / va + sbb / vb) units, of which twice as many are
    allowed for.  Where that is much or cannot be told, anything is possible."""
    n, sa, saa, sb, sab, sbb = sums
    with np.errstate(all="ignore"):
        va, vb = saa - sa * sa / n, sbb - sb * sb / n
        r = (sab - sa * sb / n) / np.sqrt(va * vb)
        off = (n + np.float32(chunks + 3)) * np.float32(6 * _UNIT) * (saa / va + sbb / vb)
        sure = (va > _LEAST) & (vb > _LEAST) & (off < 0.1) & np.isfinite(r)
        low, high = np.where(sure, r - off, -np.inf), np.where(sure, r + off, np.inf)
    none = n < max(1, least_pairs)
    low[none] = high[none] = -np.inf
    return low, high


def _largest(seen: np.ndarray, more: np.ndarray) -> np.ndarray:
    """The largest of each row of both, as many as ``seen`` has."""
    k = seen.shape[1]
    if more.shape[1] > k:
        more = np.partition(more, -k, axis=1)[:, -k:]
    return np.partition(np.concatenate([seen, more], axis=1), -k, axis=1)[:, -k:]


def _candidates(left: _Side, right: _Side, shared: int, same: bool, k: int, least_pairs: int, places: int):
    """Left and right columns of the pairs that may be among the ``k`` best of
    their left or right column in the tile; nothing if they are too many to be
    looked at one by one."""
    na, nb = len(left.cols), len(right.cols)
    cuts = -(-shared // KEYS)
    edges = [shared * c // cuts for c in range(cuts + 1)] if cuts else []
    chunks = [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]
    best = [np.full((n, k), -np.inf, np.float32) for n in (na, nb)]
    slack = np.float32(10.0 ** -places + 1e-6)  # pairs apart by less may rank alike
    found, many = [], 0
    width = COLUMNS if same else 4 * COLUMNS
    for j in range(0, nb, width):
        second = j, min(j + width, nb)
        kept = right.singles(*second, *chunks[0]) if len(chunks) == 1 else None
        for i in range(0, min(na, second[1]) if same else na, COLUMNS):
            first = i, min(i + COLUMNS, na)
            sums = _single_sums(left, right, first, second, chunks, kept)
            low, high = sums[0], sums[1]
            step = max(1, (1 << 16) // (second[1] - j))
            for at in range(0, len(low), step):  # few rows at a time stay in the cache
                low[at:at + step], high[at:at + step] = _bounds(sums[:, at:at + step], len(chunks), least_pairs)
            if same:
                below = np.arange(*first)[:, None] >= np.arange(*second)[None, :]
                low[below] = high[below] = -np.inf
            best[0][slice(*first)] = _largest(best[0][slice(*first)], low)
            best[1][slice(*second)] = _largest(best[1][slice(*second)], np.ascontiguousarray(low.T))
            least = [b[slice(*part)].min(1) - slack for b, part in zip(best, (first, second))]
            p, q = np.nonzero((high > -np.inf) & ((high >= least[0][:, None]) | (high >= least[1][None, :])))
            found.append((p + i, q + j, high[p, q]))
            many += len(p)
            if many > max(FEW_PAIRS, na * nb // 16):
                return None
    p, q, high = (np.concatenate(x) for x in zip(*found))
    some = (high >= best[0].min(1)[p] - slack) | (high >= best[1].min(1)[q] - slack)
    return p[some], q[some]


def _sums_at(left: _Side, right: _Side, shared: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Sums of the pairs of columns ``p`` and ``q``, each of which has cells."""
    sums = np.empty((6, len(p)))
    order = np.argsort(q, kind="stable")
    step = max(1, _CELLS // max(1, shared))
    for at in range(0, len(p), step):
        some = order[at:at + step]
        columns, of = np.unique(q[some], return_inverse=True)
        cells, row = right.cells(columns)
        y, wb = np.zeros((len(columns), shared)), np.zeros((len(columns), shared))
        y[row, right.at[cells]], wb[row, right.at[cells]] = right.v[cells], 1.0
        cells, row = left.cells(p[some])
        here = of[row] * shared + left.at[cells]
        x, y, w = left.v[cells], y.ravel()[here], wb.ravel()[here]
        xa = x * w
        starts = np.searchsorted(row, np.arange(len(some)))
        for total, product in zip(sums, (w, xa, y, x * xa, y * y, x * y)):
            total[some] = np.add.reduceat(product, starts)
    return sums


def _best_at(sums: np.ndarray, p: np.ndarray, q: np.ndarray, k: int, least_pairs: int, places: int) -> np.ndarray:
    """:func:`_may_be_best` of pairs by their columns."""
    score = _scores(sums, least_pairs, places)
    found = np.zeros(len(p), bool)
    for own, other in ((p, q), (q, p)):
        order = np.lexsort((other, -score, own))
        place = np.arange(len(order)) - np.searchsorted(own[order], own[order])
        found[order[place < k]] = True
    return found & (score > -np.inf)


def _wanted(left: _Side, right: _Side, shared: int, same: bool, best: tuple[int, int, int] | None):
    """Left and right columns of a tile's pairs, and their sums, part by part."""
    if best:
        some = _candidates(left, right, shared, same, *best)
        if some is not None:
            sums = _sums_at(left, right, shared, *some)
            found = _best_at(sums, *some, *best)
            yield some[0][found], some[1][found], sums[:, found]
            return
    for i, j, sums in _tile(left, right, shared, same):
        apart = wanted = np.ones(sums.shape[1:], bool)
        if same:  # each pair once
            p, q = i + np.arange(len(wanted))[:, None], j + np.arange(wanted.shape[1])[None, :]
            apart, wanted = p != q, p <= q
        if best:
            some = _may_be_best(sums, apart, *best)
            if same and i == j:  # its pairs stand on both sides of the diagonal
                some |= some.T
            wanted = wanted & some
        p, q = np.nonzero(wanted & (sums[0] > 0))
        yield i + p, j + q, sums[:, p, q]


def _sums_of(best: tuple[int, int, int] | None):
    """Arrow function: sums of the pairs of each row's two blocks."""
    def each(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                whole = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                a, b = ({n[2:]: x for n, x in whole.items() if n.startswith(p)} for p in ("a_", "b_"))
                na, nb = np.array(a["cols"], object), np.array(b["cols"], object)
                names = pa.array([*a["cols"], *b["cols"]], pa.string())
                for p, q, s in _wanted(*_sides(a, b), a["block"] == b["block"], best):
                    turned = na[p] > nb[q]
                    s = np.where(turned, s[[0, 2, 1, 4, 3, 5]], s)
                    first, second = p, len(na) + q
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(np.where(turned, second, first))), names.take(pa.array(np.where(turned, first, second))),
                         *map(pa.array, s)], ["col_a", "col_b", *_SUMS])
    return each


def corr_tiles(long: DataFrame, row_key: str, column: str, value: str, block_columns: int = 2048,
               cells: int = 2_000_000, best: tuple[int, int, int] | None = None) -> DataFrame:
    """``col_a, col_b, corr, n_pairs`` of all pairs col_a <= col_b that share a
    row, each over the rows where both are present.  Missing values are nulls
    and NaN; rows without a key or column take no part; a pair with a constant
    side has a null correlation; two values in one cell are an error.

    With ``best`` (k, least pairs, places) the pairs that cannot be among the k
    best-correlated others of either column may be left out, see
    :func:`nearest_by_tiles`."""
    v = F.col(value).cast("double")
    whole = isinstance(long.schema[row_key].dataType, (T.DateType, T.IntegralType))  # keys that are short as numbers
    key = F.unix_date(row_key) if isinstance(long.schema[row_key].dataType, T.DateType) else F.col(row_key)
    x = (long.where(F.col(row_key).isNotNull() & F.col(column).isNotNull() & v.isNotNull() & ~F.isnan(v))
         .select(key.cast("long" if whole else "string").alias("key"), F.col(column).cast("string").alias("col"), v.alias("v")))
    columns, total = x.groupBy("col").agg(F.count(F.lit(1)).alias("m")).agg(F.count(F.lit(1)), F.sum("m")).first()
    columns, total = max(columns or 0, 1), total or 0
    tasks = long.sparkSession.sparkContext.defaultParallelism
    blocks = max(-(-columns // block_columns), -(-total // cells), min(-(-columns // FEW), math.isqrt(4 * tasks)))
    blocks = min(blocks, columns)
    rows = max(1, -(-total // (blocks * cells)))
    if rows > 1:  # a block holds a part of a column; its mean is not known there
        x = (x.join(x.groupBy("col").agg(F.avg("v").alias("mean")), "col")
             .select("key", "col", (F.col("v") - F.col("mean")).alias("v")))
    dealt = x.select(F.pmod(F.xxhash64("key"), F.lit(rows)).cast("int").alias("rows"),
                     F.pmod(F.xxhash64("col"), F.lit(blocks)).cast("int").alias("block"), "key", "col", "v")
    # files of few blocks, as each is read by many tasks; more of them than blocks, or some would hold several and others none
    dealt = dealt.repartition(min(4 * blocks * rows, 16 * tasks), "rows", "block")
    packed = dealt.groupBy("rows", "block").applyInArrow(lambda cells: _pack(cells, rows > 1), _BLOCK)
    with shuffles_dropped(long.sparkSession):
        packed = cut_lineage(packed, "packed-columns")
    names = [f.split()[0] for f in _BLOCK.split(", ")]
    a, b = (packed.select(*[F.col(n).alias(f"{side}_{n}") for n in names]) for side in "ab")
    # of two blocks either may be the left one, by turns, so that tasks get like shares
    turn = (F.col("a_block") + F.col("b_block")) % 2 == 0
    pairs = a.join(b.hint("shuffle_replicate_nl"), (F.col("a_rows") == F.col("b_rows")) & (
        (F.col("a_block") == F.col("b_block")) | (turn & (F.col("a_block") < F.col("b_block")))
        | (~turn & (F.col("a_block") > F.col("b_block")))))
    sums = pairs.mapInArrow(_sums_of(best if rows == 1 else None),
                            "col_a string, col_b string, " + ", ".join(f"{s} double" for s in _SUMS))
    if rows > 1:
        sums = sums.groupBy("col_a", "col_b").agg(*[F.sum(s).alias(s) for s in _SUMS])
    va = F.col("saa") - F.col("sa") * F.col("sa") / F.col("n")
    vb = F.col("sbb") - F.col("sb") * F.col("sb") / F.col("n")
    r = (F.col("sab") - F.col("sa") * F.col("sb") / F.col("n")) / (F.sqrt(va) * F.sqrt(vb))
    varied = (va > F.col("saa") * _TINY) & (vb > F.col("sbb") * _TINY)
    return sums.select("col_a", "col_b", F.when(varied, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), r))).alias("corr"),
                       F.col("n").cast("long").alias("n_pairs"))


def nearest_by_tiles(long: DataFrame, row_key: str, column: str, value: str, k: int, least_pairs: int = 2,
                     places: int = 9, **blocks) -> DataFrame:
    """:func:`nearest_columns` of all pairs, of which each tile hands on those
    that are among a column's ``k`` best in it."""
    return nearest_columns(corr_tiles(long, row_key, column, value, best=(k, least_pairs, places), **blocks),
                           k, least_pairs, places)


def nearest_columns(corr: DataFrame, k: int, least_pairs: int = 2, places: int = 9) -> DataFrame:
    """``col, near1..neark``: each column's ``k`` best-correlated others (by the
    correlation rounded to ``places``, ties by name); columns with fewer are left out."""
    some = corr.where((F.col("col_a") != F.col("col_b")) & F.col("corr").isNotNull() & (F.col("n_pairs") >= least_pairs))
    # both directions of a row at once, as two branches would compute all pairs twice
    ways = F.array(*[F.struct(F.col(f"col_{a}").alias("col"), F.col(f"col_{b}").alias("other")) for a, b in ("ab", "ba")])
    both = some.select(F.explode(ways).alias("way"), "corr").select("way.*", "corr")
    w = Window.partitionBy("col").orderBy(F.desc(F.round("corr", places)), "other")
    ranked = both.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)
    wide = ranked.groupBy("col").agg(*[F.max(F.when(F.col("place") == i, F.col("other"))).alias(f"near{i}")
                                       for i in range(1, k + 1)])
    return wide.where(F.col(f"near{k}").isNotNull())
