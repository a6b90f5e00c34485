from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from clickweave.llm import lexical_search as search
from clickweave.llm.common import table
from tests.compare import connect, differences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return [w.translate(LOWER) for w in WORD.findall(text or "")]


def brute(docs, items, top=10):
    held = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    N = sum(bool(c) for _, c in held)
    L = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item_id, text in items:
        asked = set(terms(text))
        scores = []
        for doc_id, count in held:
            n, total = sum(count.values()), 0
            for t in asked & set(count):
                w = math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1)))
                total += w * (10**9 * count[t] // (1000 * count[t] + 8 * (10 + 90 * n * N // L)))
            if total > 0:
                scores.append((-total, doc_id is not None, doc_id or 0, doc_id))
        out += [(item_id, rank, doc_id, -score)
                for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def corpus(seed, number):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["Été", "été", "ÉTÉ", "x_y", "3rd", "The", "the"]
    odds = [1 / (1 + i) for i in range(len(words))]
    return [" ".join(draw.choices(words, odds, k=draw.choice([1, 5, 30, 200]))) for _ in range(number)]


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("block_chars", [search.BLOCK_CHARS, 300])
def test_against_brute_force(spark, block_chars):
    docs = [*enumerate(corpus(1, 500)), (None, None), (None, "w1 w2 w299"), (7, "w1 w2 w299"),
            (7, "w1 w2 w299"), (8, ""), (9, "---"), (10, "w5 " * 3000)]
    items = [(i, t) for i, t in enumerate(corpus(2, 25))] + [
        (3, "w299 w298"), (90, None), (91, ""), (92, "nowhere at all"), (93, "THE the w0 W0")]
    found = search.search(
        frame(spark, [(i, t, 0, "x") for i, t in docs],
              "doc_id LONG, text STRING, rank INT, query STRING").repartition(5),
        frame(spark, [(i, t, 1) for i, t in items], "item_id LONG, text STRING, score INT"),
        block_chars=block_chars)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(docs, items)


def test_a_third_of_the_documents_is_one_text(spark):
    copies = [(1000 + i, "w7 w8 w9 w250 w250") for i in range(200)]
    docs = [*enumerate(corpus(3, 400)), *copies]
    items = [(1, "w250 w9 w7"), (2, "w100 w101")]
    found = search.search(frame(spark, docs, "doc_id LONG, text STRING").repartition(6),
                          frame(spark, items, "item_id LONG, text STRING"))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(docs, items)


def test_pairs_beyond_a_broadcast_are_joined(spark, monkeypatch):
    monkeypatch.setattr(search, "BROADCAST_PAIRS", 0)
    docs, items = [*enumerate(corpus(4, 120))], [(1, "w2 w3 w77")]
    found = search.search(frame(spark, docs, "doc_id LONG, text STRING"),
                          frame(spark, items, "item_id LONG, text STRING"))
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(docs, items)


def test_bounds_hold_and_exclude(spark):
    docs = [*enumerate(corpus(5, 600))]
    index = search.build_index(frame(spark, docs, "doc_id LONG, text STRING"))
    rows = index.collect()
    N, L = sum(len(r.n) for r in rows), sum(sum(r.n) for r in rows)
    assert (N, L) == (600, sum(len(terms(t)) for _, t in docs))
    item = frame(spark, [("q", "w30 w90 w120 w200")], "item_id STRING, text STRING").collect()
    ids, own, vocabulary = search._read(item)
    df = search._document_counts(frame(spark, docs, "doc_id LONG, text STRING"), vocabulary)
    weight = np.array([math.floor(1000 * math.log((2 * N + 2) / (2 * n + 1))) for n in df])
    queries = search._Queries(ids, own, vocabulary, weight, N, L)
    exact = {d: -s for d, s in ((r[2], -r[3]) for r in brute(docs, [("q", item[0].text)], 10**6))}
    bounds = {}
    for row in rows:
        bounds |= dict(zip(row.doc, search._bounds(queries, row.asDict())[0].tolist()))
    assert all(bounds[d] >= exact.get(d, 0) for d, _ in docs)
    tenth = sorted(exact.values())[-10]
    assert sum(b >= tenth for b in bounds.values()) < 60


def test_empty_tables(spark):
    docs = frame(spark, [], "doc_id LONG, text STRING")
    items = frame(spark, [(1, "a")], "item_id LONG, text STRING")
    assert search.report(docs, items).collect() == []
    assert search.report(frame(spark, [(1, "a")], docs.schema), items.limit(0)).collect() == []
    assert search.report(frame(spark, [(1, None)], docs.schema), items).collect() == []


def test_against_sql(spark, sf_dir):
    found = search.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    assert differences(found, connect(sf_dir), search.ORACLE_SQL) == []
