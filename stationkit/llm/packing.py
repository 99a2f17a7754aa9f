"""Best-fit packing of documents into sequences by large-item matching.

Tokens
    A document's ids come from a public tokenizer file, without special
    tokens, followed by ``end_id``.  Only documents longer than ``capacity``
    are cut, into pieces of ``capacity`` ids; the last piece may be shorter.
    The tokenizer (NFC, lower case, split that drops white space) never joins
    anything across white space, nor a letter or digit with a sign after it (a
    combining mark is neither), so
    ids are looked up word by word in a bounded cache; a text with an information separator (U+001C to U+001F),
    which Python counts as white space and the tokenizer does not, is encoded
    whole.

Packing
    Pieces of over a third of the capacity go at most twice into a bin: taken
    from the longest down, each is matched with the longest remaining one that
    fits beside it.  Shorter pieces follow in falling length, each into the
    tightest gap that holds it; a new bin is opened only if none does.

    All of that depends on lengths alone, and there are at most ``capacity``
    of them.  The driver therefore sees one count for each length, and plans
    in runs: "the pieces of length s with ranks a to b go to the bins from n
    on, k to a bin, at offset o".  The number of runs is bounded by the
    capacity, not by the corpus.  Each piece then finds its run by its rank
    among the pieces of its length.  Ranks come from counts per (length, hash
    block) and row numbers inside a block, so a length or source that holds a
    third of all rows is still ranked by many tasks.

Defined cases: null or empty text is the single end id; repeated rows are
packed each on their own; null ids are kept; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import os
import sys
import types
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, text_of, written

#: words whose ids one Python worker remembers, in each of two generations
CACHE_WORDS = 1_000_000


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _tokenizer(path: str):
    """The tokenizer of ``path`` and its word cache, once per worker process.
    Task functions are shipped by value, so a global of this module would begin
    anew in every task; a module entry of the process lasts as long as it."""
    loaded = sys.modules.setdefault("stationkit_worker_state", types.ModuleType("stationkit_worker_state")).__dict__
    if path not in loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_file(path)
        loaded[path] = (tok, _Words(tok))
    return loaded[path]


_SEPARATORS = "\x1c\x1d\x1e\x1f"
#: ASCII signs after a word's last letter or digit are tokens of their own
#: (the apostrophe is left out: the tokenizer knows endings such as 's)
_SIGNS = ".,;:!?*$#%&\"|()[]{}<>/\\-_+=~^`@"
#: stands between words that are encoded together, as one token of its own
_BETWEEN = "~"


class _Words(dict):
    """Ids of words, remembered in two generations of ``CACHE_WORDS``.  Asking
    for an unknown word gives a buffer that ``learn`` fills."""

    def __init__(self, tok):
        super().__init__()
        self.tok = tok
        self.older: dict[str, bytes] = {}
        self.open: dict[str, bytearray] = {}
        self.between = tok.encode(_BETWEEN, add_special_tokens=False).ids
        assert len(self.between) == 1

    def __missing__(self, word: str):
        known = self.older.get(word)
        if known is None:
            known = self.open[word] = bytearray()
        self[word] = known
        return known

    def learn(self) -> None:
        """Fill the buffers of the words that were asked for."""
        split, parts = [], set()
        for w in self.open:
            core = w.rstrip(_SIGNS)
            if core and len(core) < len(w) and "<|" not in w and _ends_in_letter(core):
                split.append((w, core, w[len(core):]))
                parts.update(split[-1][1:])
            else:
                parts.add(w)
        fresh = []
        for w in parts:
            known = self.get(w) or self.older.get(w)
            if known and w not in self.open:
                self[w] = known
            elif _BETWEEN in w or "<|" in w:
                self[w] = _packed_ids(self.tok.encode(w, add_special_tokens=False))
            else:
                fresh.append(w)
        for at in range(0, len(fresh), 1000):
            some = fresh[at:at + 1000]
            found = np.array(self.tok.encode_batch_fast([f" {_BETWEEN} ".join(some)],
                                                        add_special_tokens=False)[0].ids, "<u4")
            data = found.tobytes()
            ends = np.append(np.flatnonzero(found == self.between[0]), len(found)) * 4
            begin = 0
            for w, end in zip(some, ends.tolist()):
                self[w] = data[begin:end]
                begin = end + 4
        for w, core, tail in split:
            self[w] = self[core] + self[tail]
        for w, buffer in self.open.items():
            buffer[:] = self[w]
        self.open = {}

    def turn(self) -> None:
        """Begin a generation when the present one is full."""
        if len(self) > CACHE_WORDS:
            self.older = dict(self)
            self.clear()


def _ends_in_letter(core: str) -> bool:
    """Whether the word's last letter or digit still ends it in the tokenizer's
    form: the dot of a lower-cased U+0130 would join a sign behind it."""
    return core[-1].isalnum() and unicodedata.normalize("NFC", core).lower()[-1].isalnum()


def _words_of(text: str) -> list[str]:
    """The text at white space; in lower case where that is plain to do before
    the tokenizer does it (Latin-1 letters, no special tokens)."""
    if "<|" not in text:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text.split()
        return text.lower().split()
    return text.split()


def _packed_ids(encoding) -> bytes:
    return np.asarray(encoding.ids, "<u4").tobytes()


def encode(texts: list[str], path: str) -> list[bytes]:
    """Little-endian unsigned 32-bit ids of each text."""
    tok, known = _tokenizer(path)
    out: list = [None] * len(texts)
    open_texts: dict[int, list] = {}
    held = 0

    def flush():
        nonlocal held
        known.learn()
        for i, parts in open_texts.items():
            out[i] = b"".join(parts)
        open_texts.clear()
        known.turn()
        held = 0

    for i, text in enumerate(texts):
        if any(c in text for c in _SEPARATORS):
            out[i] = _packed_ids(tok.encode(text, add_special_tokens=False))
            continue
        parts = open_texts[i] = list(map(known.__getitem__, _words_of(text)))
        held += len(parts)
        if held > 100_000:
            flush()
    flush()
    return out


def pieces(docs: DataFrame, capacity: int, tokenizer: str | None = None, end_id: int = 1,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``, one row per piece."""
    path = tokenizer or default_tokenizer()
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    last = np.asarray([end_id], "<u4").tobytes()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def each(batches):
        for b in batches:
            owner, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(encode(text_of(b), path)):
                ids += last
                n = len(ids) // 4
                for p, at in enumerate(range(0, n, capacity)):
                    owner.append(i)
                    piece.append(p)
                    start.append(at)
                    length.append(min(capacity, n - at))
                    crc.append(zlib.crc32(ids[4 * at:4 * (at + capacity)]))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names)

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(each, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class _Gaps:
    """Bins by the room left in them, as ranges of bin numbers."""

    def __init__(self):
        self.sizes: list[int] = []
        self.ranges: dict[int, list] = defaultdict(list)

    def add(self, room: int, first: int, n: int) -> None:
        if room > 0 and n > 0:
            if not self.ranges[room]:
                insort(self.sizes, room)
            self.ranges[room].append((first, n))

    def tightest(self, need: int):
        at = bisect_left(self.sizes, need)
        if at == len(self.sizes):
            return None
        room = self.sizes[at]
        first, n = self.ranges[room].pop()
        if not self.ranges[room]:
            self.sizes.pop(at)
        return room, first, n


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Runs ``(length, rank_from, rank_to, bin_from, per_bin, offset)``, sorted
    by length and rank: rank r goes to bin ``bin_from + (r - rank_from) //
    per_bin``, at ``offset + ((r - rank_from) % per_bin) * length``."""
    left = {s: n for s, n in counts.items() if n > 0}
    rank: dict[int, int] = defaultdict(int)
    runs, gaps, bins = [], _Gaps(), 0

    def place(s, n, first, per_bin, offset):
        runs.append((s, rank[s], rank[s] + n, first, per_bin, offset))
        rank[s] += n
        left[s] -= n

    large = sorted((s for s in left if 3 * s > capacity), reverse=True)
    ascending = large[::-1]
    for s in large:
        while left[s]:
            # the longest remaining partner that fits, itself included if two are left
            at = bisect_left(ascending, min(capacity - s, s) + 1) - 1
            while at >= 0 and (not left[ascending[at]] or (ascending[at] == s and left[s] < 2)):
                if not left[ascending[at]]:
                    ascending.pop(at)
                at -= 1
            if at < 0:
                n = left[s]
                place(s, n, bins, 1, 0)
                gaps.add(capacity - s, bins, n)
            elif (t := ascending[at]) == s:
                n = left[s] // 2
                place(s, 2 * n, bins, 2, 0)
                gaps.add(capacity - 2 * s, bins, n)
            else:
                n = min(left[s], left[t])
                place(s, n, bins, 1, 0)
                place(t, n, bins, 1, s)
                gaps.add(capacity - s - t, bins, n)
            bins += n
    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        while left[s]:
            found = gaps.tightest(s)
            if found is None:
                per = capacity // s
                n = max(1, left[s] // per)
                found, bins = (capacity, bins, n), bins + n
            room, first, n = found
            per, offset = room // s, capacity - room
            full = min(n, left[s] // per)
            if full:
                place(s, full * per, first, per, offset)
                gaps.add(room - per * s, first, full)
            if full < n and left[s]:
                k = left[s]
                place(s, k, first + full, k, offset)
                gaps.add(room - k * s, first + full, 1)
                full += 1
            gaps.add(room, first + full, n - full)
    return np.array(sorted(runs), dtype=np.int64).reshape(-1, 6)


def pack(parts: DataFrame, capacity: int, block_rows: int = 20_000) -> DataFrame:
    """``parts`` (columns of ``pieces``) with ``sequence_id`` and ``offset``.
    ``parts`` should be a written table; it is read twice."""
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}
    runs = plan(counts, capacity)
    # hash blocks of each length on their own, so that their table stays far below the pieces'
    blocks = F.array(*[F.lit(max(1, -(-counts.get(s, 0) // block_rows))) for s in range(capacity + 1)])
    keyed = parts.withColumn("_block", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"),
                                              F.element_at(blocks, (F.col("length") + 1).cast("int"))))
    sizes = keyed.groupBy("length", "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_block").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = (keyed.withColumn("_row", F.row_number().over(inside))
              .join(sizes, ["length", "_block"])
              .select("doc_id", "piece", "start", "length", "ids_crc32",
                      (F.col("_before") + F.col("_row") - 1).alias("_rank")))
    firsts = np.searchsorted(runs[:, 0], np.arange(capacity + 2))

    def each(batches):
        for b in batches:
            length = b.column(3).to_numpy()
            at = b.column(5).to_numpy()
            run = np.empty(len(length), np.int64)
            for s in np.unique(length):
                rows = np.flatnonzero(length == s)
                lo, hi = firsts[s], firsts[s + 1]
                run[rows] = lo + np.searchsorted(runs[lo:hi, 1], at[rows], side="right") - 1
            _, a, _, first, per, offset = runs[run].T
            step = at - a
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:5], pa.array(first + step // per), pa.array(offset + step % per * length)],
                [f.name for f in b.schema][:5] + ["sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema.fields[:5])
    return ranked.mapInArrow(each, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, end_id: int = 1,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32,
    sequence_id, offset``."""
    return pack(written(pieces(docs, capacity, tokenizer, end_id, id_col, text_col), "pieces"), capacity)
