"""Suffix-array dedup against every window compared with all earlier ones."""

from __future__ import annotations

import hashlib
import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from clickweave.llm import suffix_dedup

SCHEMA = "doc_id LONG, text STRING, kept STRING, doc INT"


def slot(text):
    """The leading bits of Spark's xxhash64 of the text."""
    return xxhash.xxh64_intdigest((text or "").encode(), 42) >> 64 - suffix_dedup.SLOT_BITS


def brute(rows, length=100):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) of rows (doc_id, text), in their order."""
    ordered = sorted(rows, key=lambda r: (-2**63 if r[0] is None else r[0], slot(r[1])))
    seen, out = set(), []
    for doc_id, text in ordered:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i:i + length]
            if window in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def words(rng, n, pool):
    return " ".join(rng.choice(pool) for _ in range(n))


def check(spark, rows):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in suffix_dedup.report(df).collect()), key=str)
    assert got == brute(rows)


def test_random_texts(spark):
    rng = random.Random(7)
    pool = ["the", "of", "an", "erable", "tion", "é", "日本", "x"]
    passages = [words(rng, rng.randint(20, 60), pool) for _ in range(6)]
    texts = []
    for _ in range(60):
        parts = [rng.choice(passages) if rng.random() < .4 else words(rng, rng.randint(1, 50), pool)
                 for _ in range(rng.randint(1, 6))]
        texts.append(rng.choice(["", " ", "\n"]).join(parts))
    texts += texts[:10]
    check(spark, list(enumerate(texts)))


def test_edges(spark):
    rng = random.Random(3)
    pool = ["ab", "cd", "ef", "g"]
    long = words(rng, 60_000, [f"{i:x}" for i in range(5000)])
    check(spark, [(None, "a" * 350), (None, None), (1, None), (2, ""), (3, "a" * 99),
                  (4, "a" * 100), (5, "ab" * 400), (5, "ab" * 400), (6, long),
                  (7, "x" + long[1000:150_000]), (8, "é" * 200), (9, words(rng, 400, pool)),
                  (-4, "b" + "a" * 101)])


def test_hot_passage_with_other_neighbours(spark):
    rng = random.Random(5)
    pool = [f"w{i}" for i in range(500)]
    passage = words(rng, 40, pool)
    check(spark, [(i, words(rng, 12, pool) + passage + words(rng, 12, pool)) for i in range(150)])


def test_passage_repeated_in_one_document_over_slices(spark, monkeypatch):
    rng = random.Random(11)
    pool = [f"w{i}" for i in range(500)]
    passages = [words(rng, 40, pool) for _ in range(6)]

    def spoilt(passage):
        cut = rng.randint(20, len(passage) - 20)
        return rng.choice([passage, passage[:cut] + words(rng, 2, pool) + passage[cut:],
                           passage[cut // 3:], passage[:-cut // 3]])

    rows = [(i, "".join(words(rng, 3, pool) + spoilt(rng.choice(passages)) for _ in range(12)))
            for i in range(8)]
    for size in (3, 8):
        monkeypatch.setattr(suffix_dedup, "ROWS", size)
        check(spark, rows)


@pytest.mark.parametrize("ids", [suffix_dedup.BROADCAST_IDS, 0])
def test_many_texts_of_one_id(spark, monkeypatch, ids):
    monkeypatch.setattr(suffix_dedup, "BROADCAST_IDS", ids)
    rng = random.Random(13)
    pool = [f"w{i}" for i in range(300)]
    passages = [words(rng, 40, pool) for _ in range(4)]
    texts = [words(rng, 20, pool) + rng.choice(passages) + words(rng, 20, pool) for _ in range(120)]
    check(spark, [(None, t) for t in texts] + [(5, t) for t in texts[:40]]
          + [(None, texts[0])] * 60 + [(3, "a" * 99)] * 5 + [(None, None)] * 9)


def test_null_ids_take_no_longer(spark):
    rng = random.Random(17)
    pool = [f"w{i}" for i in range(3000)]
    texts = [words(rng, 150, pool) for _ in range(4000)]

    def seconds(rows):
        df = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(4)
        begin = time.perf_counter()
        suffix_dedup.report(df).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    unique, null = ([(i, t) for i, t in enumerate(texts)], [(None, t) for t in texts])
    seconds(unique)
    assert seconds(null) <= 1.5 * seconds(unique) + 1


def test_empty_table_and_clashing_names(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup.report(df).collect() == []
    df = spark.createDataFrame([(1, "t", "mine", 3)], SCHEMA)
    row = suffix_dedup.remove_repeats(df).first()
    assert (row.doc_id, row.text, row.doc, bytes(row.kept), row.spans) == (1, "t", 3, b"t", [])
    assert suffix_dedup.without_repeats(df).columns == df.columns


def test_surroundings_are_cut_out_a_few_at_a_time():
    """A thousand open rows of 60 windows, as repeated text has them: hashes of all at once take 100 MB."""
    n = 1024
    low = np.arange(n, dtype=np.int64) * 60
    place = suffix_dedup._pack(low + 59, low, low + 59)
    text = "".join(chr(97 + i % 23) for i in range(60 * n + 200))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1]), pa.array([0]), pa.array([{"text": text}]),
         pa.array([[{"place": int(x)} for x in place]])], ["doc", "copy", "row", "open"])
    tracemalloc.start()
    try:
        found = list(suffix_dedup._next_pass(100, 8)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(b.num_rows for b in found) > 0
    assert peak < 50e6, peak
