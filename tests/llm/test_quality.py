import numpy as np
import pytest

from cases import ROWS, edge_docs, no_docs, prose  # noqa: F401
from stationkit.llm import quality as Q


def junk(seed, n):
    return " ".join(w + "###" for w in prose(seed, n).split())


@pytest.fixture(scope="module")
def model(spark):
    docs = [(i, prose(i, 150) if i % 4 else junk(i, 150)) for i in range(240)]
    labels = [(i, int(i % 4 > 0)) for i in range(240)] + [(None, 1), (7777, 0), (3, None)]
    return Q.train(spark.createDataFrame(docs, "doc_id long, text string"),
                   spark.createDataFrame(labels, "doc_id long, label int"), epochs=4)


def test_held_out_accuracy(spark, model):
    rows = [(i, prose(1000 + i, 100) if i % 2 else junk(1000 + i, 100)) for i in range(100)]
    out = {r["doc_id"]: r["score"] for r in Q.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert sum((out[i] >= 0.3) == bool(i % 2) for i in range(100)) >= 95


def brute_pooled(text, tables):
    """Chunk by chunk: every filter at every second byte, padded with zeros."""
    step = Q.CHUNK // 2
    halves = max(1, -(-len(text) // step))
    data = np.frombuffer(text + bytes(halves * step + Q.WIDTH - len(text)), np.uint8)
    chunks = []
    for c in range(max(1, halves - 1)):
        end = min(halves, c + 2) * step
        values = [sum(tables[k][data[at + k]] for k in range(Q.WIDTH)) for at in range(c * step, end, Q.STRIDE)]
        chunks.append(np.max(values, axis=0))
    return np.concatenate([np.mean(chunks, axis=0), np.max(chunks, axis=0)])


@pytest.mark.parametrize("n", [0, 1, 7, 255, 256, 257, 1000, 3000])
def test_pooling_covers_the_whole_text(n, monkeypatch):
    rng = np.random.default_rng(n)
    tables = rng.normal(size=(Q.WIDTH, 256, Q.FILTERS)).astype(np.float32)
    text = bytes(rng.integers(1, 256, n, dtype=np.uint8))
    want = brute_pooled(text, tables)
    assert np.allclose(Q.pooled(text, tables), want, atol=1e-4)
    monkeypatch.setattr(Q, "SPAN", 2)
    assert np.allclose(Q.pooled(text, tables), want, atol=1e-4)


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    net = Q._Net(rng)
    for k, p in enumerate(net.parts()):
        p[...] = p.astype(np.float64)
    x = [Q._halves(bytes(rng.integers(0, 256, n, dtype=np.uint8))) for n in (1700, 90, 700)]
    y = np.array([0, 1, 1], np.float32)

    def loss():
        z = net.forward(x)[0].astype(np.float64)
        return float(np.log1p(np.exp(-z * (2 * y - 1))).sum())
    z, kept = net.forward(x)
    grads = net.gradients(kept, (Q._sigmoid(z) - y).astype(np.float32))
    for p, g in zip(net.parts(), grads):
        at = np.unravel_index(np.argmax(np.abs(g)), p.shape)
        old = p[at]
        p[at] = old + 2e-3
        up = loss()
        p[at] = old - 2e-3
        down = loss()
        p[at] = old
        assert abs((up - down) / 4e-3 - g[at]) <= 0.15 * abs(g[at]) + 2e-3


def test_edge_rows_and_training_without_labels(spark, edge_docs, no_docs, model):
    out = Q.score(edge_docs, model).collect()
    assert len(out) == len(ROWS) and all(0 <= r["score"] <= 1 for r in out)
    same = {r["doc_id"]: r["score"] for r in out}
    assert same[1] == same[2] and same[3] == same[4]
    assert Q.score(no_docs, model).count() == 0
    none = Q.train(edge_docs, spark.createDataFrame([], "doc_id long, label int"))
    assert {r["score"] for r in Q.score(edge_docs, none).collect()} == {0.5}


def test_learning_and_scoring_pool_alike(model):
    """The network's own logits are those of the scored model, over all chunks."""
    rng = np.random.default_rng(2)
    net = Q._Net(rng)
    m = Q.Model(net.tables(), net.hidden, net.hidden_bias, net.out, 1.0, 0.0)
    for n in (0, 3, 256, 600, 5000, 300_000):
        text = bytes(rng.integers(32, 127, n, dtype=np.uint8))
        z = net.forward([Q._halves(text)])[0][0]
        assert abs(Q._sigmoid(z) - m.score(text.decode("ascii"))) < 1e-4


def test_whole_training_texts_under_a_byte_bound(spark, monkeypatch):
    docs = spark.createDataFrame([(i, ("x" * 1000 + str(i))) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, label int")
    rows = Q._sample(docs, labels, 50, 400)
    assert len(rows) == 100 and all(len(t) > 1000 for _, t in rows)
    monkeypatch.setattr(Q, "MAX_BYTES", 20_000)
    few = Q._sample(docs, labels, 50, 400)
    assert 10 <= len(few) <= 24 and all(len(t) > 1000 for _, t in few) and {y for y, _ in few} == {0, 1}


def test_a_poor_passage_in_the_middle_of_a_long_text_is_learned(spark):
    """Junk only deep inside long texts, where four pieces would not look."""
    docs, labels = [], []
    for i in range(160):
        words = prose(i, 900).split()
        if i % 2:
            words[400:540] = junk(i, 140).split()
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 2 == 0)))
    m = Q.train(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, label int"),
                epochs=10, cut=0.3)
    right = sum((m.score(t) >= 0.3) == bool(y) for (_, t), (_, y) in zip(docs, labels))
    assert right >= 150
