"""SimHash links against all pairs of fingerprints, fingerprints against their definition."""

from __future__ import annotations

import random
import re

import xxhash
from pyspark.sql import functions as F

from clickweave.llm import simhash

DOCS = "doc_id LONG, text STRING, fingerprint INT, component_id STRING"


def brute_print(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """{fingerprint: the least of its component}."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    ordered = sorted(root)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if (a ^ b).bit_count() <= 2:
                a_root, b_root = find(a), find(b)
                root[max(a_root, b_root)] = min(a_root, b_root)
    return {p: find(p) for p in prints}


def expected(rows):
    prints = [(d, brute_print(t)) for d, t in rows]
    root = brute_components({p for _, p in prints})
    least = {}
    for d, p in prints:
        if d is not None:
            least[root[p]] = min(d, least.get(root[p], d))
    return sorted(((d, f"{p:016x}", least.get(root[p])) for d, p in prints), key=str)


def test_documents(spark):
    rng = random.Random(2)
    pool = ["The", "of", "été", "x", "日本", "A-b", "tion"]
    rows = [(None, "a b c"), (3, None), (4, ""), (5, " \t\n"), (6, "one"), (7, "One\vTWO"),
            (8, "a b c"), (8, "a b c"), (9, "word " * 40_000), (10, "a b c d")]
    for i in range(11, 90):
        text = [rng.choice(pool) for _ in range(rng.randint(1, 300))]
        rows.append((i, " ".join(text)))
        if rng.random() < .5:
            text[rng.randrange(len(text))] = "changed"
            rows.append((1000 - i, "\n".join(text)))
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], DOCS).repartition(3)
    got = sorted((tuple(r) for r in simhash.report(df).collect()), key=str)
    assert got == expected(rows)
    kept = simhash.without_near_copies(df)
    assert kept.columns == df.columns
    firsts = {c for _, _, c in got if c is not None}
    assert {r.doc_id for r in kept.collect()} == firsts


def test_one_row_of_each_component_stays(spark):
    rng = random.Random(8)
    pool = [f"w{i}" for i in range(300)]
    a, b, c, d, e = (" ".join(rng.choice(pool) for _ in range(200)) for _ in range(5))
    rows = [(1, a, 1, "x"), (1, a, 1, "x"), (1, a, 1, "x"),  # equal rows
            (2, b, 1, "x"), (2, b, 2, "x"), (2, b, 1, None),  # equal in id and text only
            (0, c, 1, "x"), (0, d, 1, "x"), (-5, d, 1, "x"),  # an id of two texts, once the least
            (None, e, 1, "x"), (None, e, 1, "x"), (None, e, 2, "y"),  # none but null ids
            (None, a, 1, "x"), (None, b, 3, "z"), (None, None, 1, "x"), (None, "", 1, "x")]
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    kept = [tuple(r) for r in simhash.without_near_copies(df).collect()]
    assert sorted(((i, t or "") for i, t, *_ in kept), key=str) == sorted(
        [(1, a), (2, b), (0, c), (-5, d), (None, e), (None, "")], key=str)
    assert set(kept) <= set(rows)
    # Rows of other components change nothing.
    assert simhash.without_near_copies(df.where("doc_id > 0")).count() == 2
    shuffled = simhash.without_near_copies(spark.createDataFrame(rows[::-1], DOCS).repartition(2))
    assert sorted(map(tuple, shuffled.collect()), key=str) == sorted(kept, key=str)
    assert simhash.without_near_copies(df.where("doc_id > 9")).collect() == []


def test_each_component_of_random_rows_keeps_one(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice(["a", "b", "c", "d e"]) for _ in range(rng.randint(1, 5)))
             for _ in range(60)]
    rows = [(rng.choice([None, *range(12)]), rng.choice(texts)) for _ in range(200)]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], DOCS).repartition(3)
    kept = simhash.without_near_copies(df).select("doc_id", "text").collect()
    root = brute_components({brute_print(t) for _, t in rows})
    least = {}
    for d, t in rows:
        r = root[brute_print(t)]
        least[r] = min((d is None, d or 0), least.get(r, (True, 0)))
    got = sorted((root[brute_print(t)], (d is None, d or 0)) for d, t in kept)
    assert got == sorted(least.items())


def _signed(p):
    return p - (1 << 64) if p >> 63 else p


def test_links_of_crowded_and_of_small_buckets(spark):
    rng = random.Random(4)
    prints = {rng.getrandbits(64) for _ in range(60)} | {0, 2**64 - 1, 2**63}
    for p in list(prints):
        for _ in range(rng.randint(0, 5)):
            p ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            prints.add(p)
    # All within one bucket: equal but for the low bits.
    prints |= {0xABCD << 48 | rng.getrandbits(12) << rng.choice([0, 20]) for _ in range(200)}
    nodes = spark.createDataFrame([(_signed(p),) for p in prints], "fp LONG NOT NULL")
    root = brute_components(prints)
    for bucket in (1, 8, 10_000):
        pairs = simhash.links(nodes, bucket)
        assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in pairs.collect())
        got = {r.u: r.v for r in simhash.components(pairs).collect()}
        mine = {}
        for p in prints:
            mine.setdefault(got.get(_signed(p), _signed(p)), set()).add(p)
        theirs = {}
        for p, r in root.items():
            theirs.setdefault(r, set()).add(p)
        assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_long_chain(spark):
    path = [(i + 1, i) for i in range(300)]
    random.Random(1).shuffle(path)
    found = simhash.components(spark.createDataFrame(path, "u LONG, v LONG"))
    assert found.select("v").distinct().collect() == [(0,)] and found.count() == 300


def test_empty_table(spark):
    df = spark.createDataFrame([], DOCS)
    assert simhash.report(df).collect() == []
    assert simhash.links(df.select(F.col("doc_id").alias("fp"))).collect() == []
