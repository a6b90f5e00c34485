from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from clickweave.llm import importance
from clickweave.llm.common import utf8

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i:i + n]) for n in (1, 2, 3)
                        for i in range(len(words) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def brute(docs, target, percent=5):
    s, t = np.zeros(10000, int), np.zeros(10000, int)
    for count, texts in ((s, [text for _, text in docs]), (t, target)):
        for text in texts:
            for f in features(text)[1]:
                count[bucket(f)] += 1
    S, T = s.sum(), t.sum()
    gain = [math.floor(1000 * math.log((b + 1) * (S + 10000) / ((a + 1) * (T + 10000))))
            for a, b in zip(s.tolist(), t.tolist())]
    rows = []
    for doc_id, text in docs:
        n, found = features(text)
        weight = sum(gain[bucket(f)] for f in found)
        name = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"42:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(found), weight, score, None, n])
    fit = sorted((r for r in rows if r[5] >= 20),
                 key=lambda r: (-r[3], r[0] is not None, r[0]))
    for rank, r in enumerate(fit[:percent * len(fit) // 100], 1):
        r[4] = rank
    return [tuple(r[:5]) for r in rows]


def texts(seed, number):
    draw = random.Random(seed)
    words = ["Alpha", "beta", "GAMMA", "δέλτα", "é", "x1", "Été", "y" * 70, "of", "the"]
    return [" ,\n"[draw.randrange(3)].join(draw.choices(words, k=draw.randrange(60)))
            for _ in range(number)]


def key(row):
    return tuple((v is not None, v) for v in row)


def test_buckets_are_those_of_the_checksum():
    rows = [*texts(1, 30), "", None, "a", "z" * 500 + " b c", "a\x00b  c-d", "İstanbul É É É"]
    data, starts = utf8(pa.array(rows))
    text, found, words = importance.buckets(data, starts)
    for i, row in enumerate(rows):
        n, expected = features(row)
        assert words[i] == n
        assert sorted(found[text == i].tolist()) == sorted(map(bucket, expected))


@pytest.mark.parametrize("percent", [5, 37, 100])
def test_against_brute_force(spark, percent):
    docs = [*enumerate(texts(2, 400)), (None, None), (None, "the " * 30), (9001, "")]
    target = [*texts(3, 20), None, ""]
    frame = spark.createDataFrame([(i, t, "x", 5) for i, t in docs],
                                  "doc_id LONG, text STRING, score STRING, n_words INT")
    found = importance.importance(
        frame.repartition(7), spark.createDataFrame([(1, t) for t in target],
                                                    "item_id LONG, text STRING"), percent)
    rows = [tuple(r) for r in found.select("doc_id", "n_features", "weight", "score", "rank").collect()]
    assert sorted(rows, key=key) == sorted(brute(docs, target, percent), key=key)


def scored(spark, rows):
    return spark.createDataFrame(rows, "doc_id LONG, score LONG, eligible BOOLEAN")


def test_ties_and_repeated_rows(spark, monkeypatch):
    # Copies of a row are numbered in parts.
    monkeypatch.setattr(importance, "COPIES", 3)
    rows = [(7, 50, True)] * 10 + [(i, 50, True) for i in (3, 5, 9)] + [
        (None, 50, True), (1, 49, True), (2, 90, True), (4, 99, False), (2, 90, True)]
    for drawn in (0, 1, 2, 3, 5, 8, 14, 16, 17, 40):
        found = importance.resample(scored(spark, rows), drawn).collect()
        assert sorted(tuple(r)[:3] for r in found if r.doc_id) == sorted(r for r in rows if r[0])
        ranked = sorted((r.rank, r.doc_id) for r in found if r["rank"])
        order = [2, 2, None, 3, 5, *[7] * 10, 9, 1][:drawn]
        assert ranked == [(i, d) for i, d in enumerate(order, 1)]


def test_the_cutoff_is_found_in_wide_ranges(spark):
    draw = random.Random(5)
    rows = [(draw.randrange(-2**62, 2**62), draw.randrange(-2**40, 2**40) // 2**36, True)
            for _ in range(300)]
    found = importance.resample(scored(spark, rows), 111).where("rank IS NOT NULL").collect()
    best = sorted(rows, key=lambda r: (-r[1], r[0]))[:111]
    assert [(r.doc_id, r.score) for r in sorted(found, key=lambda r: r["rank"])] \
        == [r[:2] for r in best]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id LONG, text STRING")
    target = spark.createDataFrame([], "item_id LONG, text STRING")
    assert importance.report(docs, target).collect() == []
    some = spark.createDataFrame([(1, "a " * 25)], docs.schema)
    row, = importance.report(some, target).collect()
    assert tuple(row)[:2] == (1, 72) and row["rank"] is None
