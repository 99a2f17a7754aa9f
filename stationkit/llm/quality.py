"""Quality classifier: a byte-level convolutional network in numpy.

Network
    Bytes are embedded in ``EMBED`` numbers; ``FILTERS`` learned filters of
    ``WIDTH`` bytes run over the whole UTF-8 text at a stride of 2.  Their
    values are max-pooled in chunks of ``CHUNK`` bytes that overlap by half and
    together cover the document; the mean and the maximum of the chunks go
    through one hidden layer to a logit.  For scoring, embedding and filters
    are multiplied out to one table of 256 rows for each tap.  Memory is that
    of one span of chunks, whatever the length of the text.

Training rows
    Labelled rows only, with their whole texts: up to ``per_class`` of each
    label (those of least hash, ``max_rows`` in all); if their texts are more
    than ``MAX_BYTES``, in proportion fewer rows of each label, never parts of a
    text.  That bounds what the driver holds.  Mean and maximum are learned over
    all chunks, as they are applied; in each epoch every text comes whole and,
    so that short texts are judged alike, as one random stretch of up to
    ``STRETCH`` half chunks as well.  A fifth of the rows is kept out of the descent; on it
    the logits are scaled (least log loss) and shifted, so that the cut with
    the best balanced accuracy falls on the score ``cut``.

Defined cases: null text counts as empty; an empty text is scored as a run of
zero bytes; texts of any length are learned and scored whole; equal maxima
count for the first place; with fewer than two labels every score is one half; repeated rows
are scored alike; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, rows_each, stratified

EMBED, WIDTH, FILTERS, HIDDEN = 8, 8, 32, 16
CHUNK, STRIDE = 512, 2
#: bytes of all training texts
MAX_BYTES = 192_000_000
#: half chunks of the texts of one training step; a longer text is a step of its own
STEP_HALVES = 768
STRETCH = 3
#: half chunks scored at a time
SPAN = 256

_HALF = CHUNK // 2 // STRIDE  # positions in half a chunk


def _filtered(data: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Filter values (positions x FILTERS) of a padded byte array."""
    n = (len(data) - WIDTH) // STRIDE + 1
    out = tables[0][data[0:STRIDE * n:STRIDE]]
    for k in range(1, WIDTH):
        out += tables[k][data[k:k + STRIDE * n:STRIDE]]
    return out


def pooled(text: bytes, tables: np.ndarray) -> np.ndarray:
    """Mean and maximum over the chunks of the filters' maxima (2 x FILTERS)."""
    step = _HALF * STRIDE
    halves = max(1, -(-len(text) // step))
    maxima = []
    for at in range(0, halves, SPAN):
        take = min(SPAN, halves - at)
        part = np.zeros(take * step + WIDTH - STRIDE, np.uint8)
        piece = np.frombuffer(text, np.uint8, offset=min(at * step, len(text)))[:len(part)]
        part[:len(piece)] = piece
        values = _filtered(part, tables)
        maxima.append(values.reshape(take, _HALF, FILTERS).max(axis=1))
    half = np.concatenate(maxima)
    chunk = np.maximum(half[:-1], half[1:]) if len(half) > 1 else half
    return np.concatenate([chunk.mean(axis=0), chunk.max(axis=0)])


@dataclass
class Model:
    tables: np.ndarray  # WIDTH x 256 x FILTERS
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    scale: float
    shift: float

    def score(self, text: str | None) -> float:
        x = pooled((text or "").encode("utf-8", "surrogatepass"), self.tables)
        z = float(np.maximum(np.tanh(x) @ self.hidden + self.hidden_bias, 0) @ self.out)
        return float(1 / (1 + np.exp(-np.clip(self.scale * z + self.shift, -30, 30))))


def _sample(docs: DataFrame, labels: DataFrame, per_class: int, max_rows: int) -> list:
    """Labels and texts of the training rows."""
    known = labels.where("doc_id is not null and label in (0, 1)").select(
        "doc_id", F.col("label").cast("string").alias("label")).distinct()
    counts = [(r["label"], r["count"]) for r in known.groupBy("label").count().collect()]
    if len(counts) < 2:
        return []
    each = rows_each(per_class, max_rows, len(counts))

    def of(rows: int) -> DataFrame:  # ids and labels, so small enough for every task
        chosen = stratified(known, "label", counts, rows, "quality")
        return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
                .select("label", F.encode("text", "utf-8").alias("text")))

    size = of(each).agg(F.sum(F.length("text"))).first()[0] or 0
    if size > MAX_BYTES:
        each = max(1, int(each * MAX_BYTES / size))
    return [(int(r["label"]), bytes(r["text"])) for r in of(each).collect()]


def _halves(text: bytes) -> np.ndarray:
    """Half chunks of a text with the bytes that the last filters reach, zero-padded."""
    step = _HALF * STRIDE
    n = max(1, -(-len(text) // step))
    data = np.zeros(n * step + WIDTH - STRIDE, np.uint8)
    data[:len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(data, step + WIDTH - STRIDE)[::step]


class _Net:
    """The network with its gradients, on whole texts."""

    def __init__(self, rng):
        f = np.float32
        self.emb = rng.normal(0, 0.5, (256, EMBED)).astype(f)
        self.conv = rng.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH, EMBED, FILTERS)).astype(f)
        self.hidden = rng.normal(0, (2 * FILTERS) ** -0.5, (2 * FILTERS, HIDDEN)).astype(f)
        self.hidden_bias = np.zeros(HIDDEN, f)
        self.out = rng.normal(0, HIDDEN ** -0.5, HIDDEN).astype(f)
        self.out_bias = np.zeros(1, f)

    def parts(self):
        return [self.emb, self.conv, self.hidden, self.hidden_bias, self.out, self.out_bias]

    def tables(self):
        return np.einsum("be,kef->kbf", self.emb, self.conv)

    def forward(self, texts: list[np.ndarray]):
        """Logits of texts, each given as its half chunks."""
        flat, count = np.concatenate(texts), np.array([len(t) for t in texts])
        tables = self.tables()
        values = tables[0][flat[:, 0:STRIDE * _HALF:STRIDE]]
        for k in range(1, WIDTH):
            values += tables[k][flat[:, k:k + STRIDE * _HALF:STRIDE]]
        where = values.argmax(axis=1)  # half chunks x FILTERS
        half = np.take_along_axis(values, where[:, None], 1)[:, 0]
        pools, source = [], []  # each chunk's maximum is one of its halves'
        for at, n in zip(np.cumsum(count) - count, count):
            own = half[at:at + n]
            later = own[1:] > own[:-1] if n > 1 else np.zeros((1, FILTERS), bool)
            chunk = np.maximum(own[:-1], own[1:]) if n > 1 else own
            top = chunk.argmax(axis=0)
            pools.append(np.concatenate([chunk.mean(axis=0), chunk[top, np.arange(FILTERS)]]))
            source.append((at, later, top))
        t = np.tanh(np.stack(pools))
        h = np.maximum(t @ self.hidden + self.hidden_bias, 0)
        return h @ self.out + self.out_bias[0], (flat, where, source, t, h)

    def gradients(self, kept, g):
        """g: derivative of the loss by each text's logit."""
        flat, where, source, t, h = kept
        d_out, d_ob = h.T @ g, np.array([g.sum()], np.float32)
        dh = np.outer(g, self.out) * (h > 0)
        d_hidden, d_hb = t.T @ dh, dh.sum(axis=0)
        dx = (dh @ self.hidden.T) * (1 - t * t)
        dhalf = np.zeros(where.shape, np.float32)
        f = np.arange(FILTERS)
        for (at, later, top), d in zip(source, dx):
            n = len(later)
            dchunk = np.repeat(d[None, :FILTERS] / n, n, axis=0)
            dchunk[top, f] += d[FILTERS:]
            dhalf[at:at + n] += np.where(later, 0, dchunk)
            if later.any():
                dhalf[at + 1:at + 1 + n] += np.where(later, dchunk, 0)
        # only the bytes under each maximum take part
        owner, fi = np.nonzero(dhalf)
        at, dv = where[owner, fi] * STRIDE, dhalf[owner, fi]
        d_emb, d_conv = np.zeros_like(self.emb), np.zeros_like(self.conv)
        for k in range(WIDTH):
            d_table = np.bincount(flat[owner, at + k].astype(np.int64) * FILTERS + fi, weights=dv,
                                  minlength=256 * FILTERS).reshape(256, FILTERS).astype(np.float32)
            d_conv[k] = self.emb.T @ d_table
            d_emb += d_table @ self.conv[k].T
        return [d_emb, d_conv, d_hidden, d_hb, d_out, d_ob]


def _with_stretches(rows: np.ndarray, texts: list[np.ndarray], rng) -> tuple[np.ndarray, list[np.ndarray]]:
    """``rows`` whole, and a random stretch of each longer one: numbers of the
    rows and the half chunks, in random order."""
    own, parts = list(rows), [texts[i] for i in rows]
    for i in rows:
        size = int(rng.integers(1, STRETCH + 1))
        if len(texts[i]) > size:
            at = int(rng.integers(0, len(texts[i]) - size + 1))
            some = texts[i][at:at + size]
            if size == 1:  # as short as the shortest texts, the rest zeros
                some = some.copy()
                some[:, int(rng.integers(32, some.shape[1] + 1)):] = 0
            own.append(i)
            parts.append(some)
    order = rng.permutation(len(own))
    return np.array(own)[order], [parts[k] for k in order]


def _steps(which: np.ndarray, texts: list[np.ndarray], rows: int = 32):
    """Rows of a training step: up to ``rows``, and up to ``STEP_HALVES`` half chunks."""
    some, size = [], 0
    for i in which:
        if some and (len(some) == rows or size + len(texts[i]) > STEP_HALVES):
            yield np.array(some)
            some, size = [], 0
        some.append(i)
        size += len(texts[i])
    if some:
        yield np.array(some)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 1200, max_rows: int = 4000, epochs: int = 6,
          rate: float = 3e-3, cut: float = 0.3, seed: int = 4) -> Model:
    """Fit on ``labels`` (``doc_id, label`` 0 or 1) and the texts of ``docs``
    (``doc_id, text``)."""
    rows = _sample(docs, labels, per_class, max_rows)
    rows.sort()
    y = np.array([r[0] for r in rows], np.float32)
    rng = np.random.default_rng(seed)
    net = _Net(rng)
    if len(rows) < 10 or y.min() == y.max():
        return Model(net.tables(), net.hidden * 0, net.hidden_bias, net.out, 1.0, 0.0)
    x = [_halves(r[1]) for r in rows]
    order = rng.permutation(len(rows))
    held, fit = order[:len(rows) // 5], order[len(rows) // 5:]
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-6), 0.5 / max(1 - y.mean(), 1e-6)).astype(np.float32)
    means = [np.zeros_like(p) for p in net.parts()]
    squares = [np.zeros_like(p) for p in net.parts()]
    step = 0
    for epoch in range(epochs):
        own, parts = _with_stretches(fit, x, rng)
        for some in _steps(np.arange(len(own)), parts):
            which = own[some]
            z, kept = net.forward([parts[i] for i in some])
            g = ((_sigmoid(z) - y[which]) * weight[which] / len(which)).astype(np.float32)
            step += 1
            pace = rate * (1 - epoch / epochs)
            for p, d, m, v in zip(net.parts(), net.gradients(kept, g), means, squares):  # Adam
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                p -= pace * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    rows, parts = _with_stretches(held, x, rng)
    z = np.concatenate([net.forward([parts[i] for i in some])[0]
                        for some in _steps(np.arange(len(rows)), parts, 64)]).astype(float)
    own, w = y[rows], weight[rows]
    grid = np.geomspace(0.1, 10, 41)
    loss = [-(w * (own * np.log(_sigmoid(s * z) + 1e-12) + (1 - own) * np.log(1 - _sigmoid(s * z) + 1e-12))).mean()
            for s in grid]
    scale = float(grid[int(np.argmin(loss))])
    # the middle of the cuts with the best balanced accuracy
    cuts = np.unique(z)
    cuts = (cuts[1:] + cuts[:-1]) / 2 if len(cuts) > 1 else cuts
    rates = np.array([(z[own == 1] >= c).mean() + (z[own == 0] < c).mean() for c in cuts])
    best = cuts[rates >= rates.max() - 1e-9]
    shift = float(np.log(cut / (1 - cut)) - scale * (best.min() + best.max()) / 2)
    # the network's own output bias is the same for all rows, so it is part of the shift
    return Model(net.tables(), net.hidden, net.hidden_bias, net.out, scale, shift + scale * float(net.out_bias[0]))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for every row."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def each(batches):  # the model, about 260 KB, goes along with the function
        for b in batches:
            found = [model.score(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.float64())], ["doc_id", "score"])

    return rows.mapInArrow(each, f"doc_id {rows.schema[0].dataType.simpleString()}, score double")
