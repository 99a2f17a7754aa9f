"""Prefix trie of conversations by range minima over sorted common prefixes.

A conversation is a sequence of turns; each distinct sequence of a
conversation's first d turns is a node of depth d, the root has depth 0.

Sorted, the conversations of a node stand side by side, and a node of depth d
reaches from any of its members as far as the common prefix of neighbours (the
LCP) does not fall below d.  Each candidate prefix (row, depth) therefore finds
its extents on its own: a sparse table holds the minima of the LCPs over all
runs of a power of two, and a binary search over it goes right, another one
left.  No stack is kept and no candidate waits for another.  A second sparse
table gives the smallest member; children, leaves and tokens of a subtree are
differences of running sums, as a subtree is a run of candidates.

On a cluster
    A turn is a pair of 64-bit hashes under different seeds, salted with its
    place; the exclusive-or over the first d turns names a prefix (two unequal
    ones agree with a chance of 2^-128).  Turns stay rows until they are cut
    into segments of ``SEGMENT`` turns, so no row or group grows with a
    conversation.  A segment stands under the prefix before it; segments are
    ranged by (number, prefix before, hashes, conversation), which also divides
    equal conversations, and worked off in blocks of at most ``BLOCK`` rows.

    Nodes inside a block are complete there.  Those that touch a block's first
    or last row may go on in the next block: the two paths of a block are kept
    as rows, equal prefixes of all blocks are added up, and sums over a subtree
    follow from each path's suffix sums.  Where conversations go on in a
    further segment, each conversation's later sums (of nodes whose smallest
    member it is) are added to the prefixes of its earlier segments.

    Conversations that end in a node are hashed in ascending order of their
    ids, as a stream of pieces of a block each, never as one list.

Defined cases: rows without a conversation id take no part; null roles and
texts are empty; turns come in order of ``turn`` (null first), ties in order of
a hash of role and text, so that repeated rows are turns of their own; texts of
any length are whole turns; a conversation of any length is whole; without
conversations there is no root and the result is empty; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.series_window import Ordering, with_position
from .common import bounded_batches, written

#: turns of a segment, and rows of a block
SEGMENT = 64
BLOCK = 1024
#: segments (or their like) of one conversation that meet in one window
SUPER = 4096

_NO_IDS = hashlib.sha256(b"").hexdigest()
_KEY = ["x1", "x2", "depth"]


# --------------------------------------------------------------------------
# turns and segments
# --------------------------------------------------------------------------

def ordered_turns(conversations: DataFrame, max_rows_per_task: int = 2_000_000) -> DataFrame:
    """``conv_id, pos, h1, h2, cp``: turns in order from 1 on, as hashes of role
    and text and the text's code points."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn"), F.xxhash64(F.lit(1), role, text).alias("h1"),
        F.xxhash64(F.lit(2), text, role).alias("h2"), F.length(text).cast("long").alias("cp"))
    order = Ordering(("conv_id",), ("turn", "h1", "h2"), max_rows_per_task=max_rows_per_task)
    placed = with_position(rows, order, "pos")
    return written(placed.select("conv_id", (F.col("pos") + 1).alias("pos"), "h1", "h2", "cp"), "trie-turns")


def share_heads(turns: DataFrame, group: int = 100, most: int = 5) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt with a shared head: the first h turns of
    conversation ``c - c % group`` (h = crc32 of c's digits modulo ``most + 1``),
    then c's own turns after its first h.  Returns the turns and
    ``conv_id, length`` of all conversations, turnless ones too."""
    c = F.col("conv_id")
    base = (c - c % group).alias("base")
    h = (F.crc32(c.cast("string").cast("binary")) % (most + 1)).alias("h")
    heads = turns.where(F.col("pos") <= most).withColumnRenamed("conv_id", "base")
    counts = heads.groupBy("base").agg(F.count(F.lit(1)).alias("there"))
    convs = (turns.groupBy("conv_id").agg(F.max("pos").alias("own")).select("conv_id", "own", base, h)
             .join(counts, "base", "left")
             .withColumn("take", F.least(F.col("h"), F.coalesce("there", F.lit(0)))))
    convs = written(convs.select("conv_id", "base", "h", "take",
                                 (F.col("take") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")),
                    "trie-convs")
    shared = (heads.join(convs, "base").where(F.col("pos") <= F.col("h"))
              .select("conv_id", "pos", "h1", "h2", "cp"))
    rest = (turns.join(convs.select("conv_id", "h", "take"), "conv_id").where(F.col("pos") > F.col("h"))
            .select("conv_id", (F.col("pos") - F.col("h") + F.col("take")).alias("pos"), "h1", "h2", "cp"))
    return shared.unionByName(rest), convs.select("conv_id", "length")


def _before(df: DataFrame, order: str, columns: list[str], total, add, later: bool = False) -> DataFrame:
    """``df`` with each of ``columns`` replaced by its total over the rows of the
    same ``conv_id`` before the row (after it, if ``later``), in two levels, so
    that a window holds ``SUPER`` rows at most (``order`` counts without gaps
    or has some, but is never repeated)."""
    def exclusive(name, *keys):
        return (Window.partitionBy(*keys).orderBy(F.desc(name) if later else F.asc(name))
                .rowsBetween(Window.unboundedPreceding, -1))

    big = df.withColumn("super", F.floor(F.col(order) / SUPER))
    sums = big.groupBy("conv_id", "super").agg(*[total(c).alias(c) for c in columns])
    over = exclusive("super", "conv_id")
    offs = sums.select("conv_id", "super",
                       *[F.coalesce(total(c).over(over), F.lit(0)).alias(f"{c}_off") for c in columns])
    inside = exclusive(order, "conv_id", "super")
    out = big.withColumns({c: F.coalesce(total(c).over(inside), F.lit(0)) for c in columns})
    out = out.join(offs, ["conv_id", "super"])
    return out.withColumns({c: add(F.col(c), F.col(f"{c}_off")) for c in columns}).drop(
        "super", *[f"{c}_off" for c in columns])


def segments(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """``conv_id, seg, s1, s2, ks, cps, more``: segments of the conversations
    with the prefix before them, their salted hashes (two a turn) and code
    points, and whether the conversation goes on behind them."""
    per_super = SEGMENT * SUPER
    rows = (turns.select("conv_id", (F.col("pos") - 1).alias("at"), "cp", F.xxhash64("pos", "h1").alias("k1"),
                         F.xxhash64("pos", "h2").alias("k2"))
            .withColumn("seg", F.floor(F.col("at") / SEGMENT)).withColumn("part", F.floor(F.col("at") / per_super))
            .repartition("conv_id", "part"))
    segs = written(rows.groupBy("conv_id", "part", "seg").agg(
        F.sort_array(F.collect_list(F.struct("at", "k1", "k2", "cp"))).alias("t"),
        F.bit_xor("k1").alias("s1"), F.bit_xor("k2").alias("s2"), F.max("at").alias("last")).drop("part"), "trie-segments")
    starts = _before(segs.select("conv_id", "seg", "s1", "s2"), "seg", ["s1", "s2"], F.bit_xor, Column.bitwiseXOR)
    filled = (segs.drop("s1", "s2").join(starts, ["conv_id", "seg"]).join(lengths, "conv_id")
              .select("conv_id", "seg", "s1", "s2",
                      F.flatten(F.transform("t", lambda x: F.array(x["k1"], x["k2"]))).alias("ks"),
                      F.transform("t", lambda x: x["cp"]).alias("cps"), (F.col("last") + 1 < F.col("length")).alias("more")))
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")
    turnless = lengths.where("length = 0").select(
        "conv_id", zero.alias("seg"), zero.alias("s1"), zero.alias("s2"), none.alias("ks"), none.alias("cps"),
        F.lit(False).alias("more"))
    return filled.unionByName(turnless)


# --------------------------------------------------------------------------
# one block of sorted segments
# --------------------------------------------------------------------------

def _minima(values: np.ndarray) -> list[np.ndarray]:
    """Sparse table: at level k the minimum of 2^k values from each place on."""
    table = [values]
    while 2 ** len(table) <= len(values):
        half, before = 2 ** (len(table) - 1), table[-1]
        level = before.copy()
        level[:-half] = np.minimum(before[:-half], before[half:])
        table.append(level)
    return table


def _right_extent(table, rows, depth):
    """Last row up to which all LCPs behind ``rows`` are at least ``depth``."""
    n, at = len(table[0]), rows.copy()
    for k in range(len(table) - 1, -1, -1):
        fits = at + 2 ** k < n
        fits[fits] = table[k][at[fits] + 1] >= depth[fits]
        at[fits] += 2 ** k
    return at


def _left_extent(table, rows, depth):
    """First row from which all LCPs up to ``rows`` are at least ``depth``."""
    at = rows.copy()
    for k in range(len(table) - 1, -1, -1):
        fits = at - 2 ** k >= 0
        fits[fits] = table[k][at[fits] - 2 ** k + 1] >= depth[fits]
        at[fits] -= 2 ** k
    return at


def _minimum(table, left, right):
    """Minimum over left..right by two runs of a power of two."""
    k = np.floor(np.log2(right - left + 1)).astype(np.int64)
    stacked = np.stack(table)
    return np.minimum(stacked[k, left], stacked[k, right - 2 ** k + 1])


class _Sorted:
    """A block: its LCPs, prefixes and candidates."""

    def __init__(self, batch: pa.RecordBatch):
        col = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
        self.conv, self.seg = (col[c].to_numpy().astype(np.int64) for c in ("conv_id", "seg"))
        s1, s2 = (col[c].to_numpy().astype(np.int64) for c in ("s1", "s2"))
        self.more = col["more"].to_numpy(zero_copy_only=False)
        cps = col["cps"]
        self.len = np.diff(cps.offsets.to_numpy())
        n, wide = len(self.conv), int(self.len.max(initial=0))
        used = np.arange(wide)[None, :] < self.len[:, None]
        ks = col["ks"].flatten().to_numpy().reshape(-1, 2)
        k1, k2, cp = (np.zeros((n, wide), np.int64) for _ in range(3))
        k1[used], k2[used], cp[used] = ks[:, 0], ks[:, 1], cps.flatten().to_numpy()
        same = (self.seg[1:] == self.seg[:-1]) & (s1[1:] == s1[:-1]) & (s2[1:] == s2[:-1])
        equal = used[1:] & used[:-1] & (k1[1:] == k1[:-1]) & (k2[1:] == k2[:-1])
        self.lcp = np.full(n, -1, np.int64)  # -1: under another prefix
        self.lcp[1:] = np.where(same, np.logical_and.accumulate(equal, axis=1).sum(1), -1)
        zero = np.zeros((n, 1), np.int64)
        self.x1 = s1[:, None] ^ np.bitwise_xor.accumulate(np.hstack([zero, k1]), axis=1)
        self.x2 = s2[:, None] ^ np.bitwise_xor.accumulate(np.hstack([zero, k2]), axis=1)
        known = np.maximum(self.lcp, 0)
        count = self.len - known
        self.known, self.off = known, np.concatenate([[0], np.cumsum(count)])
        self.row = np.repeat(np.arange(n), count)
        self.d = np.arange(len(self.row)) - self.off[self.row] + known[self.row] + 1
        self.cp = cp[self.row, self.d - 1]
        self.table = _minima(self.lcp)

    def candidate(self, left: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """Place of the candidate of ``depth`` whose first row is ``left``."""
        return self.off[left] + depth - self.known[left] - 1


_REC = [("kind", "int"), ("block", "long"), ("which", "int"), ("x1", "long"), ("x2", "long"), ("depth", "long"),
        ("p1", "long"), ("p2", "long"), ("conv_id", "long"), ("parent_conv_id", "long"), ("n_convs", "long"),
        ("n_children", "long"), ("n_leaves", "long"), ("saved_tokens", "long"), ("own_leaf", "long"), ("cp", "long"),
        ("carry", "boolean"), ("more", "boolean"), ("ends", "string")]
_ARROW = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}[t])
                    for n, t in _REC])
COMPLETE, PATH, STEP, PIECE = 0, 1, 2, 3


def _records(kind: int, block: int, n: int, **columns) -> pa.RecordBatch:
    out = []
    for f in _ARROW:
        v = {"kind": kind, "block": block}.get(f.name, columns.get(f.name))
        out.append(v if isinstance(v, pa.Array) else pa.nulls(n, f.type) if v is None else
                   pa.array(np.full(n, v) if np.isscalar(v) else v, f.type))
    return pa.RecordBatch.from_arrays(out, schema=_ARROW)


def _ending(b: _Sorted):
    """For each run of equal rows: its first row and the ids that end there."""
    firsts = np.flatnonzero(b.lcp < b.len)
    for i, j in zip(firsts, np.append(firsts[1:], len(b.len))):
        same = np.flatnonzero(b.len[i:j] == b.len[i]) + i  # rows behind are longer
        ids = b.conv[same][~b.more[same]]
        if len(ids):
            yield i, ",".join(map(str, ids.tolist()))


def _block_records(b: _Sorted, block: int):
    n = len(b.conv)
    smallest = _minima(b.conv)
    row, d = b.row, b.d
    left, right = _left_extent(b.table, row, d), _right_extent(b.table, row, d)
    up_left, up_right = _left_extent(b.table, row, d - 1), _right_extent(b.table, row, d - 1)
    going_on = np.concatenate([[0], np.cumsum(b.more)])
    carry = going_on[right + 1] > going_on[left]
    more = carry & (d == SEGMENT)
    members, conv = right - left + 1, _minimum(smallest, left, right) if len(row) else row
    open_ = (left == 0) | (right == n - 1)
    up_open = (up_left == 0) | (up_right == n - 1)
    inner = d > 1
    parent = b.candidate(up_left[inner], d[inner] - 1)
    children = np.bincount(parent, minlength=len(row))
    closed_children = np.bincount(parent[~open_[inner]], minlength=len(row))
    leaf = ((children == 0) & ~more & ~open_).astype(np.int64)
    saved = np.where(open_, 0, (members - 1) * b.cp)
    below = b.off[right + 1]
    leaves_to, saved_to = (np.concatenate([[0], np.cumsum(v)]) for v in (leaf, saved))
    place = np.arange(len(row))
    n_leaves, n_saved = leaves_to[below] - leaves_to[place], saved_to[below] - saved_to[place]
    depth = d + SEGMENT * b.seg[row]
    key = {"x1": b.x1[row, d], "x2": b.x2[row, d], "p1": b.x1[row, d - 1], "p2": b.x2[row, d - 1]}

    digests = np.full(len(row), _NO_IDS, object)
    pieces = []
    for i, ids in _ending(b):
        at = b.candidate(np.array([i]), b.len[i:i + 1])[0] if b.len[i] else -1
        if at < 0 or open_[at]:
            end = b.len[i]
            pieces.append((b.x1[i, end], b.x2[i, end], end + SEGMENT * b.seg[i], ids))
        else:
            digests[at] = hashlib.sha256(ids.encode()).hexdigest()
    if pieces:
        x1, x2, dep, ids = zip(*pieces)
        yield _records(PIECE, block, len(pieces), x1=list(map(int, x1)), x2=list(map(int, x2)),
                       depth=list(map(int, dep)), ends=list(ids))

    c = np.flatnonzero(~open_)
    if len(c):
        known = inner[c] & ~up_open[c]
        up = pa.array(_minimum(smallest, up_left[c], up_right[c]), pa.int64(), mask=~known)
        yield _records(COMPLETE, block, len(c), **{k: v[c] for k, v in key.items()}, depth=depth[c], conv_id=conv[c],
                       parent_conv_id=up, n_convs=members[c], n_children=children[c], n_leaves=n_leaves[c],
                       saved_tokens=n_saved[c], own_leaf=leaf[c], cp=b.cp[c], carry=carry[c], more=more[c],
                       ends=digests[c])
    for which, i in ((0, 0), (1, n - 1)):
        dd = np.arange(1, b.len[i] + 1)
        if not len(dd):
            continue
        first = _left_extent(b.table, np.full(len(dd), i), dd)
        at = b.candidate(first, dd)
        counts = (first > 0) | (which == 0)  # the last row's shared prefixes are on the first row's path
        part = {k: np.where(counts, v, 0) for k, v in (
            ("n_convs", members[at]), ("n_children", closed_children[at]), ("n_leaves", n_leaves[at]),
            ("saved_tokens", n_saved[at]))}
        yield _records(PATH, block, len(dd), which=which, **{k: v[at] for k, v in key.items()}, depth=depth[at],
                       conv_id=conv[at], cp=b.cp[at], carry=carry[at], more=more[at], **part)
    for i in np.flatnonzero(b.more):
        dd = np.arange(1, b.len[i] + 1)
        yield _records(STEP, block, len(dd), x1=b.x1[i, 1:b.len[i] + 1], x2=b.x2[i, 1:b.len[i] + 1],
                       depth=dd + SEGMENT * b.seg[i], conv_id=int(b.conv[i]), which=int(b.seg[i]))


def _blocks(segs: DataFrame) -> DataFrame:
    """Records of the sorted segments, block by block."""
    def each(batches):
        lead, k = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                yield from _block_records(_Sorted(batch.slice(at, BLOCK)), lead + k)
                k += 1

    order = ["seg", "s1", "s2", "ks", "conv_id"]
    return (segs.repartitionByRange(*order).sortWithinPartitions(*order)
            .mapInArrow(each, ", ".join(f"{n} {t}" for n, t in _REC)))


def _hashed(pieces: DataFrame) -> DataFrame:
    """``x1, x2, depth, ends``: SHA-256 of the joined ids, piece after piece."""
    def each(batches):
        key = hasher = None
        for b in batches:
            out = []
            for row in b.to_pylist():
                now = (row["x1"], row["x2"], row["depth"])
                if now == key:
                    hasher.update(b",")
                else:
                    if key is not None:
                        out.append((*key, hasher.hexdigest()))
                    key, hasher = now, hashlib.sha256()
                hasher.update(row["ends"].encode())
            yield shaped(out)
        if key is not None:
            yield shaped([(*key, hasher.hexdigest())])

    shape = pa.schema([("x1", pa.int64()), ("x2", pa.int64()), ("depth", pa.int64()), ("ends", pa.string())])

    def shaped(rows):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(shape)],
                                          schema=shape)

    return (pieces.select(*_KEY, "block", "ends").repartition(*_KEY).sortWithinPartitions(*_KEY, "block")
            .mapInArrow(each, "x1 long, x2 long, depth long, ends string"))


# --------------------------------------------------------------------------
# the trie
# --------------------------------------------------------------------------

_NODE = [*_KEY, "p1", "p2", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
         "own_leaf", "own_saved", "carry", "ends"]


def _child_counts(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.groupBy(F.col("p1").alias("x1"), F.col("p2").alias("x2"), (F.col("depth") - 1).alias("depth")).agg(
        F.count(F.lit(1)).alias(name))


def _with_parent(children: DataFrame, nodes: DataFrame) -> DataFrame:
    """``children`` with the smallest member of their parents, which are in ``nodes``."""
    up = nodes.select(F.col("x1").alias("p1"), F.col("x2").alias("p2"), (F.col("depth") + 1).alias("depth"),
                      F.col("conv_id").alias("_up"))
    return children.drop("parent_conv_id").join(up, ["p1", "p2", "depth"]).withColumnRenamed("_up", "parent_conv_id")


def _nodes(rec: DataFrame, lowest: int) -> tuple[DataFrame, DataFrame]:
    """All nodes but the root as they are known from one segment each (columns
    ``_NODE``), and the digests of those that cross blocks."""
    rel = (F.col("depth") - 1) % SEGMENT  # 0: the parent is the root or in the segment before
    paths = rec.where(F.col("kind") == PATH)
    merged = paths.groupBy(*_KEY).agg(
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.min("conv_id").alias("conv_id"), F.max("cp").alias("cp"), F.max("carry").alias("carry"),
        F.max("more").alias("more"), F.max("p1").alias("p1"), F.max("p2").alias("p2"),
        F.min(F.struct("block", "which")).alias("home"))
    merged = merged.join(_child_counts(merged.where(rel > 0), "open_children"), _KEY, "left")
    kids = F.col("n_children") + F.coalesce("open_children", F.lit(0))
    merged = written(merged.withColumns({
        "n_children": kids, "own_leaf": ((kids == 0) & ~F.col("more")).cast("long"),
        "own_saved": (F.col("n_convs") - 1) * F.col("cp")}).drop("open_children"), "trie-open")
    at_home = F.col("home") == F.struct("block", "which")
    down = Window.partitionBy("block", "which").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    along = written(
        paths.select("block", "which", *_KEY)
        .join(merged.select(*_KEY, "conv_id", "home", "own_leaf", "own_saved"), _KEY)
        .select("block", "which", *_KEY, "conv_id",
                F.sum(F.when(at_home, F.col("own_leaf")).otherwise(0)).over(down).alias("more_leaves"),
                F.sum(F.when(at_home, F.col("own_saved")).otherwise(0)).over(down).alias("more_saved")), "trie-paths")
    sums = along.groupBy(*_KEY).agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))
    digests = written(_hashed(rec.where(F.col("kind") == PIECE)), "trie-digests")
    opened = (merged.join(sums, _KEY).join(digests, _KEY, "left").withColumns({
        "n_leaves": F.col("n_leaves") + F.col("more_leaves"), "saved_tokens": F.col("saved_tokens") + F.col("more_saved"),
        "ends": F.coalesce("ends", F.lit(_NO_IDS))}))
    top = F.when(F.col("depth") == 1, F.lit(lowest)).cast("long")
    opened = (opened.where(rel == 0).withColumn("parent_conv_id", top)
              .unionByName(_with_parent(opened.where(rel > 0), merged), allowMissingColumns=True))

    done = rec.where(F.col("kind") == COMPLETE).withColumn("own_saved", (F.col("n_convs") - 1) * F.col("cp"))
    inner = done.where((rel > 0) & F.col("parent_conv_id").isNull())
    # a parent that touches its block's edge is on one of the block's paths
    up = along.groupBy("block", *_KEY).agg(F.max("conv_id").alias("_up"))
    inner = (inner.drop("parent_conv_id")
             .join(up.select("block", F.col("x1").alias("p1"), F.col("x2").alias("p2"),
                             (F.col("depth") + 1).alias("depth"), "_up"), ["block", "p1", "p2", "depth"])
             .withColumnRenamed("_up", "parent_conv_id"))
    plain = done.where((rel == 0) | F.col("parent_conv_id").isNotNull()).withColumn(
        "parent_conv_id", F.coalesce("parent_conv_id", top))
    nodes = plain.select(*_NODE).unionByName(inner.select(*_NODE)).unionByName(opened.select(*_NODE))
    return written(nodes, "trie-nodes"), digests


def _later_segments(nodes: DataFrame, steps: DataFrame) -> DataFrame:
    """Nodes on which a conversation goes on in a further segment, with the sums
    of what follows there and the children at the segment's end."""
    deep = nodes.where(F.col("depth") > SEGMENT)
    sums = deep.groupBy("conv_id", F.floor((F.col("depth") - 1) / SEGMENT).alias("seg")).agg(
        F.sum("own_leaf").alias("leaves"), F.sum("own_saved").alias("saved"))
    asked = steps.select("conv_id", F.col("which").cast("long").alias("seg")).distinct()
    zero = F.lit(0).cast("long")
    both = (sums.unionByName(asked.select("conv_id", "seg", zero.alias("leaves"), zero.alias("saved")))
            .groupBy("conv_id", "seg").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    after = _before(both, "seg", ["leaves", "saved"], F.sum, Column.__add__, later=True)
    extra = (steps.select("conv_id", F.col("which").cast("long").alias("seg"), *_KEY).join(after, ["conv_id", "seg"])
             .groupBy(*_KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))
    children = _child_counts(deep.where((F.col("depth") - 1) % SEGMENT == 0), "later_children")
    return (nodes.where("carry").join(extra, _KEY, "left").join(children, _KEY, "left").withColumns({
        "n_leaves": F.col("n_leaves") + F.coalesce("leaves", zero),
        "saved_tokens": F.col("saved_tokens") + F.coalesce("saved", zero),
        "n_children": F.col("n_children") + F.coalesce("later_children", zero)}).select(*_NODE))


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens`` and ``ends_sha256``, for conversations given as ``turns``
    (conv_id, pos from 1, h1, h2, cp) and ``lengths`` (conv_id, length)."""
    spark = turns.sparkSession
    bounded_batches(spark, BLOCK)
    total, lowest = lengths.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    rec = written(_blocks(segments(turns, lengths)), "trie-records")
    nodes, digests = _nodes(rec, lowest if total else 0)
    later = written(_later_segments(nodes, rec.where(F.col("kind") == STEP)), "trie-later")
    known = nodes.where("NOT carry").unionByName(later)
    lone = known.where(F.col("parent_conv_id").isNull())
    below = (known.where(F.col("parent_conv_id").isNotNull()).unionByName(_with_parent(lone, later).select(*_NODE)))
    shown = below.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                         F.col("ends").alias("ends_sha256"))
    zero, n = F.lit(0).cast("long"), F.lit(total).cast("long")
    tops = known.where(F.col("depth") == 1).select(F.lit(1).cast("long").alias("kids"), "n_leaves", "saved_tokens",
                                                   F.lit(None).cast("string").alias("ends"))
    ended = digests.where(F.col("depth") == 0).select(zero.alias("kids"), zero.alias("n_leaves"),
                                                      zero.alias("saved_tokens"), "ends")
    root = (tops.unionByName(ended).agg(F.sum("kids").alias("kids"), F.sum("n_leaves").alias("leaves"),
                                        F.sum("saved_tokens").alias("saved"), F.max("ends").alias("ends"))
            .where(n > 0).select(
                F.lit(lowest).cast("long").alias("conv_id"), zero.alias("depth"),
                F.lit(None).cast("long").alias("parent_conv_id"), n.alias("n_convs"),
                F.col("kids").alias("n_children"), F.greatest(F.col("leaves"), F.lit(1)).cast("long").alias("n_leaves"),
                F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(_NO_IDS)).alias("ends_sha256")))
    return root.unionByName(shown)
