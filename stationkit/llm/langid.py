"""Language identification with averaged hashed subword embeddings.

Model
    A text is lower-cased, everything in ASCII that is no letter becomes
    white space, and the runs of letters are joined by one space.  Its byte
    n-grams (2, 3 and 4 bytes, word borders included) are hashed into
    ``BUCKETS`` rows of an embedding table; the document vector is their
    average, and a linear softmax over it gives the language.  Embeddings and
    weights are trained together by stochastic gradient descent in numpy.

Training rows
    Labelled rows only, up to ``per_lang`` of each language, fewer of each when
    all would be more than ``max_rows``, but never under ``LEAST_ROWS``: those of
    least hash of id and text, wherever they lie in the table.  A documented
    bound on what the one training task holds, as bucket counts of at most
    ``BUCKETS`` entries a document; the driver gets the model only.  Every
    language is learned.  Scoring reads every whole text.

Calibrated rejection
    A fifth of each language's sampled rows is kept out of the descent.  On it a
    temperature is fitted (least log loss), and the rejection threshold is set
    so that all but ``reject`` of the rightly labelled rows stay accepted,
    never above one half.

Defined cases: a null text, or one without a letter, gets ``und`` with score
0; without labelled rows every text does; repeated rows are scored alike; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, rows_each, stratified

BUCKETS = 1 << 14
DIM = 12
ORDERS = (2, 3, 4)
UNKNOWN = "und"
#: bytes of text hashed at a time
SPAN = 1 << 20

_NOT_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def subword_counts(text: str) -> np.ndarray:
    """Counts of the text's hashed n-grams over ``BUCKETS`` rows."""
    words = text.lower().encode("utf-8", "surrogatepass").translate(_NOT_LETTERS).split()
    data = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    counts = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(data), SPAN):
        part = data[at:at + SPAN + max(ORDERS) - 1]
        rolling = part * _MULTIPLIERS[0]
        for n in range(2, max(ORDERS) + 1):
            if len(part) < n:
                break
            rolling = (rolling[:len(part) - n + 1] ^ (rolling[:len(part) - n + 1] >> np.uint32(15))) \
                + part[n - 1:] * _MULTIPLIERS[n - 1]
            if n in ORDERS:
                here = rolling[:SPAN]
                mixed = (here ^ (here >> np.uint32(16))) * _MULTIPLIERS[1]
                counts += np.bincount(mixed >> np.uint32(32 - 14), minlength=BUCKETS)
    return counts


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Model:
    """``table`` is embeddings times weights, so a document's logits are the
    average of its n-grams' rows plus ``bias``, over the temperature.  With more
    languages than ``DIM`` it is the embeddings alone, and ``out`` the weights."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    out: np.ndarray | None = None

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        total = max(1, counts.sum())
        z = (counts.astype(np.float32) @ self.table) / np.float32(total)
        z = (z if self.out is None else z @ self.out) + self.bias
        return softmax(z[None, :].astype(np.float64) / self.temperature)[0]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not text or not has_letter(text):
            return UNKNOWN, 0.0
        p = self.probabilities(subword_counts(text))
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def _counted(docs: DataFrame, per_lang: int, max_rows: int) -> DataFrame | None:
    """``lang, idx, cnt`` (buckets and counts) of a hash-chosen, bounded set of rows."""
    spark = docs.sparkSession
    counts = [(r["lang"], r["count"]) for r in docs.groupBy("lang").count().collect()]
    if not counts:
        return None
    rows = stratified(docs, "lang", counts, rows_each(per_lang, max_rows, len(counts)), "langid").select("lang", "text")
    bounded_batches(spark, 256)

    def each(batches):
        for b in batches:
            idx, cnt = [], []
            for t in b.column(1).to_pylist():
                c = subword_counts(t)
                at = np.flatnonzero(c)
                idx.append(at.astype("<u2").tobytes())
                cnt.append(np.minimum(c[at], 65535).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(idx, pa.binary()), pa.array(cnt, pa.binary())],
                                             ["lang", "idx", "cnt"])

    return rows.mapInArrow(each, "lang string, idx binary, cnt binary")


def _sample(docs: DataFrame, per_lang: int, max_rows: int) -> list:
    """The rows that ``train`` learns from, to look at; it does not collect them."""
    rows = _counted(docs, per_lang, max_rows)
    return [] if rows is None else rows.collect()


def train(docs: DataFrame, per_lang: int = 1000, max_rows: int = 8000, epochs: int = 8,
          rate: float = 1.0, reject: float = 0.001, seed: int = 9) -> Model:
    """Fit on rows of ``docs`` (``doc_id, text, lang``); rows with a null text
    or language are left out."""
    sample = _counted(docs.where("text is not null and lang is not null").select("doc_id", "text", "lang"),
                      per_lang, max_rows)

    def fitted(batches):
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        if rows:
            fields = vars(_fit(rows, epochs, rate, reject, seed))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fields)], pa.binary())], ["model"])

    found = None if sample is None else sample.repartition(1).mapInArrow(fitted, "model binary").first()
    if found is None:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0, 0.5)
    return Model(**pickle.loads(found["model"]))


def _fit(rows: list[tuple[str, bytes, bytes]], epochs: int, rate: float, reject: float, seed: int) -> Model:
    """The model of ``rows`` of language, buckets and counts, in any order."""
    rows.sort()
    rng = np.random.default_rng(seed)
    languages = sorted({lang for lang, _, _ in rows})
    kinds = len(languages)
    number = {x: k for k, x in enumerate(languages)}
    label = np.array([number[lang] for lang, _, _ in rows])

    def dense(which):
        x = np.zeros((len(which), BUCKETS), np.float32)
        for k, i in enumerate(which):
            c = np.frombuffer(rows[i][2], "<u2").astype(np.float32)
            x[k, np.frombuffer(rows[i][1], "<u2")] = c / max(1.0, c.sum())
        return x

    order = rng.permutation(len(rows))
    by_lang = order[np.argsort(label[order], kind="stable")]
    place = np.empty(len(rows), int)  # a row's place among its language's rows
    sizes = np.bincount(label, minlength=kinds)
    place[by_lang] = np.arange(len(rows)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out_of = place[order] < sizes[label[order]] // 5
    held, fit = order[out_of], order[~out_of]
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = rng.normal(0, 0.5, (DIM, kinds)).astype(np.float32)
    bias = np.zeros(kinds, np.float32)
    # an n-gram's gradient carries its share of the document, about one over
    # the number of distinct n-grams; the embedding rate makes up for it
    scale = np.float32(200.0)
    for epoch in range(epochs):
        step = np.float32(rate * (1 - epoch / epochs))
        for at in range(0, len(fit), 64):
            which = fit[at:at + 64]
            x = dense(which)
            hidden = x @ emb
            g = softmax(hidden @ out + bias).astype(np.float32)
            g[np.arange(len(which)), label[which]] -= 1
            g /= len(which)
            back = g @ out.T
            out -= step * (hidden.T @ g)
            bias -= step * g.sum(axis=0)
            emb -= step * scale * (x.T @ back)
    table, last = (emb @ out, None) if kinds <= DIM else (emb, out)
    temperature, threshold = 1.0, 0.5
    if len(held):
        z = np.concatenate([dense(held[a:a + 256]) @ table for a in range(0, len(held), 256)])
        z = ((z if last is None else z @ last) + bias).astype(np.float64)
        own = label[held]
        grid = np.geomspace(0.05, 5, 41)
        loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(own)), own], 1e-12)).mean() for t in grid]
        temperature = float(grid[int(np.argmin(loss))])
        p = softmax(z / temperature)
        right = p.max(axis=1)[p.argmax(axis=1) == own]
        if len(right):
            threshold = float(min(0.5, np.quantile(right, reject)))
    return Model(languages, table, bias, temperature, threshold, last)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, accepted`` for every row."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = spark.sparkContext.broadcast(model)  # BUCKETS x languages floats

    def each(batches):
        m = shared.value
        for b in batches:
            found = [m.predict(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([x for x, _ in found], pa.string()),
                 pa.array([s for _, s in found], pa.float64()),
                 pa.array([x != UNKNOWN and s >= m.threshold for x, s in found], pa.bool_())],
                ["doc_id", "lang_pred", "score", "accepted"])

    kind = rows.schema[0].dataType.simpleString()
    return rows.mapInArrow(each, f"doc_id {kind}, lang_pred string, score double, accepted boolean")


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is accepted, with their columns."""
    spark = docs.sparkSession
    bounded_batches(spark)
    at = docs.columns.index(text_col)
    shared = spark.sparkContext.broadcast(model)

    def each(batches):
        m = shared.value
        for b in batches:
            found = [m.predict(t) for t in b.column(at).to_pylist()]
            yield b.filter(pa.array([x != UNKNOWN and s >= m.threshold for x, s in found], pa.bool_()))

    return docs.mapInArrow(each, docs.schema)
