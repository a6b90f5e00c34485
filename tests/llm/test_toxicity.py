from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from clickweave.llm import toxicity
from clickweave.llm.common import utf8

STEMS = ("grizmo", "flaké")


def texts(seed, number):
    """Random words; texts of label 1 have a word with a stem of ill repute in every 40 or so."""
    draw = random.Random(seed)
    parts = ["ba", "ke", "lo", "mi", "nu", "ra", "so", "té", "wi", "griz", "fla"]

    def word():
        return "".join(draw.choices(parts, k=draw.randrange(1, 5)))

    rows = []
    for i in range(number):
        words = [word() for _ in range(draw.choice([10, 60, 300]))]
        label = int(draw.random() < 0.3)
        if label:
            for _ in range(2 + len(words) // 60):
                words[draw.randrange(len(words))] = draw.choice(STEMS) + word()
        rows.append((i, " ".join(words), label))
    return rows


@pytest.fixture(scope="module")
def model():
    rows = texts(1, 700)
    return toxicity.train([r[1] for r in rows], [r[2] for r in rows], 0.3)


def test_unseen_words_of_known_stems(model):
    rows = texts(2, 300)
    found = model.predict(pa.array([r[1] for r in rows])) >= toxicity.THRESHOLD
    label = np.array([r[2] for r in rows], bool)
    assert (found & label).sum() >= 0.95 * label.sum()
    assert (found & ~label).sum() <= 0.02 * (~label).sum()


def test_every_window_counts(model):
    clean, toxic = " ".join(["ba", "kelo", "minu"] * 2000), " grizmoba flakéso grizmowi "
    long = [clean + toxic, toxic + clean, clean + toxic + clean, clean]
    assert (model.predict(pa.array(long)) >= toxicity.THRESHOLD).tolist() == [True] * 3 + [False]


def test_batches_change_nothing(model):
    rows = [r[1] for r in texts(3, 40)] + ["", None, "a" * 3000, "!?"]
    whole = model.predict(pa.array(rows))
    alone = [model.predict(pa.array([r], pa.string()))[0] for r in rows]
    assert np.allclose(whole, alone, atol=1e-5)
    assert (whole >= 0).all() and (whole <= 1).all()
    assert whole[-1] == whole[-3] == whole[-4] == pytest.approx(0.3)


def test_windows_cover_every_word():
    for n in (0, 1, 63, 64, 65, 112, 113, 1000):
        text, start, size = toxicity._windows(np.array([3, n]))
        own = [(a - 3, a - 3 + s) for t, a, s in zip(text, start, size) if t == 1]
        assert {i for a, b in own for i in range(a, b)} == set(range(n))
        assert all(b - a == min(n, toxicity.WINDOW) for a, b in own)
        assert len({a for a, _ in own}) == len(own)


def test_gradient():
    """Against differences, in double precision."""
    rows = [r[1] for r in texts(4, 6)]
    data, starts = utf8(pa.array(rows))
    words = toxicity.read(data, starts)
    net = toxicity.Network(3)
    net.vectors = np.random.default_rng(1).standard_normal(net.vectors.shape)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    count = np.minimum(np.bincount(words.text, minlength=6), 20)
    first = np.searchsorted(words.text, np.arange(6))
    place = np.arange(20)
    kinds = np.where(place < count[:, None], words.kind[np.minimum(first[:, None] + place, len(
        words.kind) - 1)], len(words.word))
    label = np.array([0, 1, 0, 1, 1, 0])

    def loss():
        x, _ = net.inputs(words)
        logit = net.logits(kinds, count, net._project(np.vstack([x, np.zeros((1, x.shape[1]))])))[0]
        weight = np.where(label, toxicity.WEIGHT, 1)
        return (weight * (np.logaddexp(0, logit) - label * logit)).mean()

    g, touched, d_vectors = net.gradient(kinds, words, count, label)
    total = np.zeros_like(net.vectors)
    np.add.at(total, touched, d_vectors)
    draw = np.random.default_rng(2)
    places = np.unique(touched)[draw.permutation(len(np.unique(touched)))[:10]]
    for value, gradient, at in [*((net.p[k], g[k], None) for k in net.p), (net.vectors, total, places)]:
        for _ in range(4):
            i = tuple(draw.integers(0, s) for s in value.shape) if at is None \
                else (int(draw.choice(at)), int(draw.integers(0, toxicity.DIM)))
            old, step = value[i], 1e-5
            value[i] = old + step
            up = loss()
            value[i] = old - step
            down = loss()
            value[i] = old
            assert gradient[i] == pytest.approx((up - down) / (2 * step), rel=2e-2, abs=2e-5)


def test_query(spark):
    rows = texts(5, 500)
    docs = spark.createDataFrame(
        [(i, t, "x", 5.0) for i, t, _ in rows] + [(None, None, None, None), (900, "", "y", 1.0)],
        "doc_id LONG, text STRING, predicted STRING, score DOUBLE")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [
        (900, 1), (901, 0), (3, 1), (3, 0), (None, 1), (4, None), (5, 7)], "doc_id LONG, toxic INT")
    found = toxicity.report(docs.repartition(5), labels).collect()
    assert len(found) == 502
    label = {i: y for i, _, y in rows}
    held = [r for r in found if r.held_out and r.doc_id in label]
    assert 100 < len(held) < 250
    right = sum(r.predicted == label[r.doc_id] for r in held)
    assert right >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    whole = toxicity.score(docs, toxicity.train(["a"], [0]))
    assert sorted(whole.columns) == ["doc_id", "predicted", "score", "text"]


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id LONG, text STRING")
    labels = spark.createDataFrame([], "doc_id LONG, toxic INT")
    assert [(r.score, r.predicted) for r in toxicity.report(docs, labels).collect()] \
        == [(pytest.approx(0, abs=1e-9), 0)] * 2
    assert toxicity.report(docs.limit(0), labels).collect() == []
    ones = spark.createDataFrame([(i, 1) for i in range(9)], labels.schema)
    assert all(r.predicted == 1 for r in toxicity.report(
        spark.createDataFrame([(i, "a b") for i in range(9)], docs.schema), ones).collect())
