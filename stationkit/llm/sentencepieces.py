"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding
    A text is normalised (the model's own rules; spaces become U+2581, one
    stands before the text), cut into characters, and adjacent symbols are
    joined in the order of an agenda: the pair whose joined piece has the
    highest score goes first, ties by place, and each join puts the pairs it
    makes on the agenda.  What is left and not in the vocabulary becomes its
    UTF-8 bytes, where the vocabulary has them.

    Joins never reach across a place where no piece has the two characters side
    by side, so a text falls into stretches that are encoded each on its own
    and remembered in a bounded cache: runs of characters that occur in longer
    pieces, cut before each U+2581, and single other characters.  Both rules
    are taken from the vocabulary; one whose pieces hold U+2581 behind another
    character is encoded without the first cut.  Texts are cut by array
    operations, and each different stretch of a slice is looked up once.  The
    unknown ones are worked off together: in each round every one of them takes
    the first entry of its agenda, by array operations over all.  Stretches of more
    than ``TOGETHER`` characters have an agenda (a heap) of their own.

Decoding
    The pieces' bytes in order, U+2581 as a space, without the first space; a
    byte that is not UTF-8 becomes U+FFFD.

Each Arrow batch is checked against the sentencepiece library, ids and decoded
texts alike; a difference is an error that names the row's place.

Defined cases: null text is empty and has no ids; texts of any length are
encoded whole, and a batch is worked off in slices of bounded length; ties
between pairs go to the left one; repeated rows are encoded each on their own;
null keys are kept; an empty table gives an empty result; columns not asked
for are ignored.
"""

from __future__ import annotations

import codecs
import sys
import types
from array import array
from heapq import heapify, heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from .common import bounded_batches

#: stretches whose ids one Python worker remembers, in each of two generations
CACHE_STRETCHES = 400_000
#: characters of the texts that are worked off at a time
SLICE_CHARS = 2_000_000

#: characters of stretches that are encoded side by side, below 256
TOGETHER = 64
#: bits of an agenda entry that hold a place
_PLACE_BITS = 40
_PLACE = (1 << _PLACE_BITS) - 1
#: bits of an entry's place that hold the joined piece instead, where stretches are short
_ID_BITS = 32
_ID = (1 << _ID_BITS) - 1
#: above every entry of an agenda, as is twice as much
_LAST = 1 << 61
_NEVER = 2 * _LAST
#: slots of the table of joins for each join; its keys are spread by this odd number
_SLOTS = 8
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
# kinds of characters where texts are cut
_OTHER, _INNER, _SPACE = 0, 1, 2

SPACE = "▁"
# kinds of pieces and the merge-type model, as numbered in the model file (fixed values)
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE, UNUSED = 1, 2, 3, 4, 6, 5
MERGE_MODEL = 2


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(data: bytes):
    """Field numbers and values of one protobuf message."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, data[at:at + size]
            at += size


def _one_byte(error):
    return "�", error.start + 1


codecs.register_error("stationkit-one-byte", _one_byte)


class Vocabulary:
    """A model file: pieces, ranks of joins, and the ids of stretches met so
    far as packed 32-bit numbers."""

    def __init__(self, path: str):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        top = list(_fields(self.library.serialized_model_proto()))
        pieces = [dict(_fields(v)) for k, v in top if k == 1]
        trainer = dict(_fields(next((v for k, v in top if k == 2), b"")))
        rules = dict(_fields(next((v for k, v in top if k == 3), b"")))
        kinds = [p.get(3, NORMAL) for p in pieces]
        names = [p[1].decode("utf-8") for p in pieces]
        if trainer.get(3, 1) != MERGE_MODEL or USER_DEFINED in kinds or UNUSED in kinds:
            raise ValueError("only merge-type vocabularies without user-defined or unused pieces are encoded")
        self.plain = not rules.get(2) and rules.get(3, 1) == 1 and rules.get(4, 1) == 0 and rules.get(5, 1) == 1
        self.first_space, self.trims = rules.get(3, 1) == 1, rules.get(4, 1) == 1
        self.numbers = {n: i for i, (n, k) in enumerate(zip(names, kinds)) if k == NORMAL}
        scores = {n: float(np.frombuffer(pieces[i].get(2, b"\0\0\0\0"), "<f4")[0]) for n, i in self.numbers.items()}
        place = {score: k << _PLACE_BITS for k, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.ranks = {n: place[score] for n, score in scores.items()}  # equal scores have equal ranks
        self.unknown = kinds.index(UNKNOWN)
        self.bytes_of = {int(n[3:5], 16): i for i, (n, k) in enumerate(zip(names, kinds)) if k == BYTE}
        self.surface = [b"" if k == CONTROL else " ⁇ ".encode() if k == UNKNOWN
                        else bytes([int(n[3:5], 16)]) if k == BYTE else n.replace(SPACE, " ").encode()
                        for n, k in zip(names, kinds)]
        self.controls = {i for i, k in enumerate(kinds) if k == CONTROL}
        self.is_control = np.array([k == CONTROL for k in kinds])
        # surfaces by id, and by id + size those of a text's first piece
        plain = {UNKNOWN, BYTE}
        cut = [s if k in plain else self._without_space(s) for s, k in zip(self.surface, kinds)]
        self.shown = pa.array(self.surface + cut, pa.binary())
        joined = {c for n in self.numbers if len(n) > 1 for c in n}
        self.kind_of = np.full(sys.maxunicode + 1, _OTHER, np.uint8)
        self.kind_of[[ord(c) for c in joined]] = _INNER
        inside = any(SPACE in n.lstrip(SPACE) for n in self.numbers)
        self.kind_of[ord(SPACE)] = _INNER if inside else _SPACE
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # every way to join two pieces into a third, by the two pieces' numbers
        self.size = len(names)
        self.base = self.size + sys.maxunicode + 1
        joins = [(self.numbers[n[:k]] * self.base + self.numbers[n[k:]], self.ranks[n] + i)
                 for n, i in self.numbers.items() for k in range(1, len(n))
                 if n[:k] in self.numbers and n[k:] in self.numbers]
        self._spread(*np.array(joins, np.int64).reshape(-1, 2).T.copy())
        # a character's number by code point; from size on: it is no piece
        self.symbol_of = self.size + np.arange(sys.maxunicode + 1)
        for n, i in self.numbers.items():
            if len(n) == 1:
                self.symbol_of[ord(n)] = i

    def _without_space(self, surface: bytes) -> bytes:
        """A surface at the start of a text."""
        if self.trims:
            return surface.lstrip(b" ")
        return surface.removeprefix(b" ") if self.first_space else surface

    def _agenda(self, stretch: str) -> list[str]:
        """Symbols of ``stretch`` after all joins.  An entry of the agenda is
        the rank of a joined piece and the place of its left symbol in one
        number; it holds as long as the pair at that place has that rank."""
        symbols, n, rank_of = list(stretch), len(stretch), self.ranks.get
        after, before = list(range(1, n + 1)), list(range(-1, n))
        agenda = [r + i for i, r in enumerate(map(rank_of, map(add, stretch, stretch[1:]))) if r is not None]
        heapify(agenda)
        while agenda:
            entry = heappop(agenda)
            i = entry & _PLACE
            left, j = symbols[i], after[i]
            if not left or j == n:
                continue
            joined = left + symbols[j]
            if rank_of(joined) != entry - i:
                continue
            symbols[i], symbols[j] = joined, ""
            after[i] = k = after[j]
            before[k] = i
            if k < n:
                r = rank_of(joined + symbols[k])
                if r is not None:
                    heappush(agenda, r + i)
            k = before[i]
            if k >= 0:
                r = rank_of(symbols[k] + joined)
                if r is not None:
                    heappush(agenda, r + k)
        return [s for s in symbols if s]

    def _ids(self, symbols: list[str]) -> list[int]:
        known = list(map(self.numbers.get, symbols))
        if None not in known:
            return known
        out = []
        for s, i in zip(symbols, known):
            if i is not None:
                out.append(i)
            elif self.bytes_of:
                out += [self.bytes_of[b] for b in s.encode("utf-8")]
            else:
                out.append(self.unknown)
        return out

    def _spread(self, keys: np.ndarray, entries: np.ndarray) -> None:
        """Table of joins; a key lies in the first free slot from its own on."""
        bits = max(1, (_SLOTS * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.join_keys, self.join_entries = np.full(1 << bits, -1), np.full(1 << bits, _NEVER)
        slot, left = self._slot(keys), np.arange(len(keys))
        while len(left):
            free = left[self.join_keys[slot[left]] == -1]
            self.join_keys[slot[free]] = keys[free]  # of several for one slot one stays
            left = left[self.join_keys[slot[left]] != keys[left]]
            slot[left] = (slot[left] + 1) & (len(self.join_keys) - 1)
        self.join_entries[slot] = entries

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _SPREAD) >> self.shift).view(np.int64)

    def _joins(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks and ids of joined pairs in one number; ``_NEVER`` where there is none."""
        key = left * self.base + right
        at = self._slot(key)
        there = self.join_keys[at]
        far = np.flatnonzero((there != key) & (there != -1))
        while len(far):
            at[far] = (at[far] + 1) & (len(self.join_keys) - 1)
            there = self.join_keys[at[far]]
            far = far[(there != key[far]) & (there != -1)]
        return self.join_entries[at]

    def _together(self, stretches: list[str]) -> list[bytes]:
        """Ids of many short stretches, whose agendas go on side by side.  A
        symbol stands at the place of its first character; ``wide`` and
        ``back`` lead to the next one and the one before.  An end that joins
        with nothing stands between two stretches.  ``agenda`` holds the open
        stretches only; places in it are ``moved`` from those in the rest."""
        size = np.fromiter(map(len, stretches), np.int64, len(stretches))
        first = np.cumsum(size + 1) - size
        symbol = self.symbol_of[np.frombuffer("\0".join(["", *stretches, ""]).encode("utf-32-le"), "<u4")]
        symbol[0] = symbol[first + size] = self.base - 1
        stays = np.ones(len(symbol), bool)
        stays[0] = stays[first + size] = False
        wide, back = np.ones((2, len(symbol)), np.int64)
        agenda = np.append(self._joins(symbol[1:-1], symbol[2:]), _NEVER)
        agenda += np.arange(len(agenda)) - np.repeat(first - 1, size + 1) << _ID_BITS
        start, length, moved = first, size + 1, -1
        while True:
            best = np.minimum.reduceat(agenda, start + moved)
            goes = best < _LAST
            if not goes.all():
                agenda = agenda[np.repeat(goes, length)]
                start, length, best = start[goes], length[goes], best[goes]
                if not len(start):
                    break
                moved = np.cumsum(length) - length - start
            piece, place = best & _ID, best & _PLACE & ~_ID
            at = start + (place >> _ID_BITS)
            gone = at + wide[at]
            width, step = wide[at] + wide[gone], back[at]
            symbol[at], wide[at], back[at + width], stays[gone] = piece, width, width, False
            agenda[gone + moved] = _NEVER
            agenda[at + moved] = self._joins(piece, symbol[at + width]) + place
            agenda[at - step + moved] = self._joins(symbol[at - step], piece) + place - (step << _ID_BITS)
        owner = np.repeat(np.arange(len(size)), np.add.reduceat(stays[1:], first - 1, dtype=np.int64))
        symbol = symbol[stays]
        odd = symbol >= self.size
        if odd.any():
            lists = [self._ids([chr(s - self.size)]) for s in symbol[odd].tolist()]
            times = np.ones(len(symbol), np.int64)
            times[odd] = list(map(len, lists))
            owner, symbol, odd = (np.repeat(x, times) for x in (owner, symbol, odd))
            symbol[odd] = [i for x in lists for i in x]
        data, ends = symbol.astype("<i4").tobytes(), np.searchsorted(owner, np.arange(len(stretches) + 1)) * 4
        return [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]

    def _learn(self, stretches: list[str]) -> dict[str, bytes]:
        """Ids of stretches that are not known; short ones are from now on."""
        found = dict(zip(stretches, map(self.older.get, stretches)))
        new = [s for s, ids in found.items() if ids is None]
        short = [s for s in new if len(s) <= TOGETHER]
        if short:
            found.update(zip(short, self._together(short)))
        if len(short) == len(new):
            self.known.update(found)
        else:
            self.known.update((s, ids) for s, ids in found.items() if len(s) <= TOGETHER)
            found.update((s, array("i", self._ids(self._agenda(s))).tobytes()) for s in new if len(s) > TOGETHER)
        return found

    def _cut(self, normal: list[str]) -> tuple[pa.Array, np.ndarray]:
        """The stretches of normalised texts one behind the other, and where
        each text's begin and end among them."""
        ends = np.cumsum([0, *map(len, normal)])
        whole = "".join(normal)
        points = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        kind = self.kind_of[points]
        begins = np.ones(len(points) + 1, bool)
        begins[1:-1] = (kind[1:] == _OTHER) | (kind[:-1] == _OTHER) | (kind[1:] == _SPACE) & (kind[:-1] == _INNER)
        begins[ends] = True
        begins = np.flatnonzero(begins)  # and the end of the last
        sizes = np.ones(len(points), np.uint8)
        for least in (0x80, 0x800, 0x10000):  # bytes in UTF-8
            sizes += points >= least
        sizes = np.add.reduceat(sizes, begins[:-1], dtype=np.int64) if len(points) else []
        bounds = np.append(0, np.cumsum(sizes, dtype=np.int64))
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(whole.encode("utf-8"))]
        return pa.Array.from_buffers(pa.large_string(), len(sizes), buffers), np.searchsorted(begins, ends)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts.  Each different stretch is looked up once."""
        if len(self.known) >= CACHE_STRETCHES:
            self.older, self.known = self.known, {}
        if self.plain:
            normal = [SPACE + t.replace(" ", SPACE) if t else "" for t in texts]
        else:
            normal = [self.library.normalize(t) for t in texts]
        stretches, ends = self._cut(normal)
        stretches = stretches.dictionary_encode()
        different = stretches.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.get, different))
        new = [k for k, known in enumerate(ids) if known is None]
        for k, learnt in zip(new, self._learn([different[k] for k in new]).values()):
            ids[k] = learnt
        _, bounds, data = pa.array(ids, pa.large_binary()).take(stretches.indices).buffers()
        ends = np.frombuffer(bounds, "<i8")[ends] // 4 if len(stretches) else ends
        data = np.frombuffer(data or b"", "<i4")
        found = [data[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]
        if not self.bytes_of:  # a run of unknown characters is one id
            found = [f[~np.append(False, (f[1:] == self.unknown) & (f[:-1] == self.unknown))] if len(f) else f
                     for f in found]
        return found

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: list[int]) -> str:
        """Text of a list of ids."""
        shown = list(map(self.surface.__getitem__, ids))
        mixed = not self.controls.isdisjoint(ids)
        k = next((k for k, i in enumerate(ids) if i not in self.controls), None) if mixed else 0
        if ids and k is not None:
            shown[k] = self.shown[ids[k] + self.size].as_py()
        if not mixed:
            return b"".join(shown).decode("utf-8", "stationkit-one-byte")
        parts = [[]]
        for i, part in zip(ids, shown):  # bytes on both sides of a control piece make no character
            parts.append([]) if i in self.controls else parts[-1].append(part)
        return "".join(b"".join(p).decode("utf-8", "stationkit-one-byte") for p in parts)

    def decode_all(self, found: list[np.ndarray]) -> list[str]:
        """Texts of many arrays of ids: the surfaces of all are looked up at
        once, and lie one behind the other in the bytes of the result."""
        ends = np.cumsum([0, *map(len, found)])
        ids = np.concatenate(found).astype(np.int64) if found else np.zeros(0, np.int64)
        if self.is_control[ids].any():
            return [self.decode(f.tolist()) for f in found]
        ids[ends[:-1][np.diff(ends) > 0]] += self.size
        _, starts, data = self.shown.take(pa.array(ids)).buffers()
        if not len(ids):
            return [""] * len(found)
        at, data = np.frombuffer(starts, "<i4")[ends].tolist(), memoryview(data)
        return [str(data[a:b], "utf-8", "stationkit-one-byte") for a, b in zip(at, at[1:])]


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of ``path`` with its cache, once per worker process."""
    loaded = sys.modules.setdefault("stationkit_worker_state", types.ModuleType("stationkit_worker_state")).__dict__
    key = ("pieces", path)
    if key not in loaded:
        loaded[key] = Vocabulary(path)
    return loaded[key]


def _slices(texts: list[str]):
    """Ranges of rows with about ``SLICE_CHARS`` characters."""
    start = size = 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= SLICE_CHARS:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def encode_and_decode(df: DataFrame, keep: list[str], text: str = "text", model: str | None = None,
                      check: bool = True) -> DataFrame:
    """Columns ``keep`` of ``df``, ``ids`` (array of int) of the whole text, and
    ``decoded``, the text of those ids.  With ``check`` both are compared with
    the library's, batch by batch."""
    bounded_batches(df.sparkSession, 256)
    path = model or default_model()
    some = df.select(*[f"`{c}`" for c in keep], f"`{text}`")
    wide = StructType(some.schema.fields[:-1]).add("ids", ArrayType(IntegerType())).add("decoded", StringType())
    if len(set(wide.names)) < len(wide.names):
        raise ValueError(f"columns {keep} cannot be kept beside ids and decoded")
    arrow = to_arrow_schema(wide)

    def each(batches):
        own = vocabulary(path)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            for lo, hi in _slices(texts):
                part = texts[lo:hi]
                found = own.encode_all(part)
                decoded = own.decode_all(found)
                if check:
                    theirs = own.library.encode(part, return_type="numpy", num_threads=1)
                    again = own.library.decode(theirs, num_threads=1) if theirs else []
                    for k, (a, b, c, d) in enumerate(zip(found, theirs, decoded, again, strict=True)):
                        if not np.array_equal(a, b) or c != d:
                            raise AssertionError(f"ids or text differ from the library's in row {lo + k} of a batch")
                ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                kept = batch.slice(lo, hi - lo).columns[:-1]
                yield pa.RecordBatch.from_arrays(
                    [*(c.cast(f.type) for c, f in zip(kept, arrow)), ids.cast(arrow.field("ids").type),
                     pa.array(decoded, arrow.field("decoded").type)], schema=arrow)

    return some.mapInArrow(each, wide)
