"""Sharding: exact sizes, gapless slots, and counts that follow the hypergeometric law."""

from __future__ import annotations

import math
import zlib
from collections import Counter

from pyspark.sql import functions as F

from clickweave.llm import sharding

DOCS = "doc_id LONG, text STRING, shard STRING, part INT"


def check(rows, shards=16):
    sizes = Counter(r.shard for r in rows)
    assert max(sizes.values()) - min(sizes[s] for s in range(shards)) <= 1
    for shard, size in sizes.items():
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(size))


def test_sizes_and_slots(spark):
    for n in (1, 15, 16, 17, 1000, 3001):
        docs = spark.range(n).select(F.col("id").alias("doc_id"),
                                     F.concat(F.lit("é"), F.col("id")).alias("text"))
        rows = sharding.report(docs).collect()
        assert sorted(r.doc_id for r in rows) == list(range(n))
        check(rows)
        assert all(r.size == 3 + len(str(r.doc_id)) and r.law == "rows" and r.grown_shard is None
                   and r.text_crc32 == zlib.crc32(f"é{r.doc_id}".encode()) for r in rows)


def test_edges(spark):
    rows = [(None, None, "a", 1), (None, None, "a", 1), (1, "", None, None)] + [
        (5, "same", "b", 2)] * 100 + [(6, "x" * 100_000, "c", 3)]
    docs = spark.createDataFrame(rows, DOCS)
    found = sharding.shuffle_to_shards(docs, ["doc_id", "text"])
    assert found.columns == ["doc_id", "text", "part", "shard", "slot"]
    check(found.collect())
    sizes = {r.doc_id: (r.size, r.text_crc32) for r in sharding.report(docs).collect()}
    assert sizes[None] == (1, 0) and sizes[1] == (1, 0) and sizes[6][0] == 100_001
    assert sharding.report(docs.limit(0)).collect() == []


def test_repeats_itself_and_follows_the_seed(spark):
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    runs = [{(r.doc_id, r.shard, r.slot) for r in sharding.report(d, seed=s).collect()}
            for d, s in ((docs, 1), (docs.repartition(7), 1), (docs, 2))]
    assert runs[0] == runs[1] != runs[2]


def test_hypergeometric_law(spark):
    pool, good, draws, n = 60, 25, 20, 20_000
    u = (F.col("id") + 0.5) / n
    column = sharding._hypergeometric(u, *[F.lit(x).cast("long") for x in (pool, good, draws)])
    got = Counter(r[0] for r in spark.range(n).select(column).collect())
    for k in range(draws + 1):
        p = math.comb(good, k) * math.comb(pool - good, draws - k) / math.comb(pool, draws)
        assert abs(got[k] - n * p) <= 2


def test_matrix_sums_and_spread(spark):
    counts = [7, 0, 100, 33, 1, 59]
    table = spark.createDataFrame([(i, n) for i, n in enumerate(counts) if n], "part LONG, n LONG")
    mean = [0.0] * 6
    for seed in range(12):
        rows = sharding.communication_matrix(table, 6, 4, seed).orderBy("part").collect()
        assert [sum(r.take) for r in rows] == counts
        assert [sum(r.take[j] for r in rows) for j in range(4)] == [50] * 4
        for j in range(4):
            place = 0
            for r in rows:
                assert r.start[j] == place
                place += r.take[j]
        mean = [m + r.take[0] / 12 for m, r in zip(mean, rows, strict=True)]
    assert all(abs(m - n / 4) < 4 for m, n in zip(mean, counts, strict=True))


def test_permutation(spark):
    for size in (1, 2, 3, 10, 1000):
        column = sharding.permuted(F.col("id"), F.lit(size).cast("long"), F.lit(3))
        assert sorted(r[0] for r in spark.range(size).select(column).collect()) == list(range(size))


def test_half_of_the_rows_are_one_row(spark, monkeypatch):
    monkeypatch.setattr(sharding, "HEAVY", 100)
    rows = [(None, None)] * 3000 + [(i, f"t{i}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(8)
    for keys in (sharding.BROADCAST_KEYS, 0):
        monkeypatch.setattr(sharding, "BROADCAST_KEYS", keys)
        found = sharding.report(docs).collect()
        check(found)
        assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    copies = Counter(r.shard for r in found if r.doc_id is None)
    # 187.5 in the mean, with a deviation of 9.4.
    assert len(copies) == 16 and min(copies.values()) > 140 and max(copies.values()) < 235


def test_walks_end_inside(spark, monkeypatch):
    monkeypatch.setattr(sharding, "WALK", 1)
    for size in (1, 2, 3, 5, 50, 701):
        column = sharding.permuted(F.col("id"), F.lit(size).cast("long"), F.lit(3))
        assert sorted(r[0] for r in spark.range(size).select(column).collect()) == list(range(size))
