"""Language ID: labels against plain Viterbi, accuracy on texts held out."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickweave.llm import language
from clickweave.llm.common import table, utf8

DOCS = "doc_id LONG, text STRING, lang STRING, score INT, LANG_PRED INT"


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@pytest.fixture(scope="module")
def model(docs):
    return language.learn(docs.where(~language.held_out(docs["doc_id"])), 300)


def test_accuracy_of_held_out_texts(docs, model):
    found = language.identify(docs, model).where(language.held_out(F.col("doc_id")))
    right, number = found.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")),
                              F.count("*")).first()
    assert number > 200 and right / number > 0.97


def plain(score):
    """The best labels of one text, all sequences of states compared step by step."""
    value, back = score[0].copy(), []
    for row in score[1:]:
        step = value[:, None] - language.SWITCH * (1 - np.eye(len(value)))
        back.append(step.argmax(0))
        value = step.max(0) + row
    out = [int(value.argmax())]
    for mark in reversed(back):
        out.append(int(mark[out[-1]]))
    return out[::-1], value.max()


def worth(score, label):
    return score[np.arange(len(label)), label].sum() - language.SWITCH * np.count_nonzero(
        np.diff(label))


@pytest.mark.parametrize("few", [0, 2, 8, 50])
def test_viterbi(docs, model, few, monkeypatch):
    monkeypatch.setattr(language, "FEW", few)
    rng = random.Random(5)
    texts = [r.text for r in docs.orderBy("doc_id").limit(40).collect()]
    cut = [t.split()[:40] for t in texts]
    mixed = [" ".join(rng.choice(cut)[:rng.randint(1, 40)] + rng.choice(cut)) for _ in range(30)]
    data, starts = utf8(pa.array([*mixed, "", "a", "1 2"]))
    words = language._read(data, starts)
    label = model.label(words, 33)
    score = model.word_scores(words)
    for i in range(33):
        own = words.text == i
        if own.any():
            mine = label[own].astype(int)
            _, best = plain(score[words.kind[own]])
            assert worth(score[words.kind[own]], mine) == pytest.approx(best)


def test_spans_of_a_mixed_text(model, docs):
    parts = {r.lang: r.text[:600] for r in docs.where("length(text) > 800 AND text NOT LIKE '%&%'")
             .orderBy("doc_id").collect()}
    text = parts["de"] + " " + parts["fr"]
    _, score, spans = model.predict(pa.array([text]))
    assert [s["lang"] for s in spans[0].as_py()] == ["de", "fr"] and 0.4 < score[0].as_py() < 0.7


def test_edges(spark, model):
    texts = [None, "", "123 …—♥ ½", "日本語", "Straße und der die", "x" * 300_000, "é"]
    rows = [(i, t, None, 7, 8) for i, t in enumerate(texts)] + [(None, "the of", "en", 1, 2)] * 2
    df = spark.createDataFrame(rows, DOCS)
    found = language.identify(df, model)
    assert found.columns == ["doc_id", "text", "lang", "lang_pred", "score", "spans"]
    by_id = {r.doc_id: r for r in found.collect()}
    assert [by_id[i].lang_pred for i in range(3)] == ["und"] * 3 and by_id[1].score == 0
    assert by_id[4].lang_pred == "de" and by_id[4].score == 1 and by_id[3].lang_pred != "und"
    got = language.report(df).collect()
    assert len(got) == 9 and {r.lang_pred for r in got} == {"und", "en"}
    assert {r.lang_pred for r in language.report(df.where("lang IS NULL")).collect()} == {"und"}
    assert language.report(df.limit(0)).collect() == []
    assert language.with_a_language(df).columns == df.columns


def test_a_rare_language_is_learned(spark):
    """One document of 100 in a language of its own words, and a hundred languages."""
    rng = random.Random(4)
    common, rare = ([["".join(rng.choice(letters) for _ in range(6)) for _ in range(80)]
                     for letters in ("abcdef", "uvwxyz")])
    rows = [(i, " ".join(rng.choices(rare if i % 100 == 7 else common, k=30)),
             "rare" if i % 100 == 7 else "common") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING, lang STRING")
    found = language.report(df, learn_docs=60).collect()
    assert all(r.lang_pred == rows[r.doc_id][2] for r in found)


def test_quotas_and_tables():
    assert language._quotas({"a": 5, "b": 1000, "c": 10_000}, 305) == {"a": 5, "b": 150, "c": 150}
    assert language._quotas({"a": 5, "b": 6}, 100) == {"a": 5, "b": 6}
    assert language.gram_bits(4) == language.GRAM_BITS
    for n in (300, 5000):
        assert language.LEAST_BITS <= language.gram_bits(n) < language.GRAM_BITS
        assert n * language.columns(language.gram_bits(n)) < 2 * language.TABLE_ENTRIES


def test_parts_change_nothing(docs, model, monkeypatch):
    column = pa.array([r.text for r in docs.limit(60).collect()] + [None, ""])
    whole = model.predict(column)
    monkeypatch.setattr(language, "PATH_BYTES", 3000)
    assert all(a.equals(b) for a, b in zip(whole, model.predict(column)))
    assert [len(a) for a in model.predict(column.slice(0, 0))] == [0, 0, 0]
