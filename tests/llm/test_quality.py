"""Statistics against plain Python; rules on labels that a known list made."""

from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from clickweave.llm import quality
from clickweave.llm.common import table

DOCS = "doc_id LONG, text STRING, n_words INT, words STRING"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    hit = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1
           for j in range(i, i + 5)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(hit),
            n < 10 or 100 * len(hit) > 20 * n)


def test_statistics(spark):
    rng = random.Random(6)
    pool = ["a", "b#", "été", "|", "日本", "X!", "\x1c", " "]
    texts = [None, "", " \n\t", "one", "a b c d", "a b c d e", "a a a a a a", "a\n\na\n \na",
             "x\r\nx\r\nx", "\x0b\x0cq", "w " * 30_000,
             " ".join(str(i % 7000) for i in range(20_000))]
    for _ in range(150):
        seps = [" ", "  ", "\n", "\t"]
        texts.append("".join(rng.choice(pool) + rng.choice(seps) for _ in range(rng.randint(0, 60))))
    rows = [*enumerate(texts), (None, "a b"), (3, "one")]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], DOCS)
    labels = spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT")
    got = quality.report(df, labels).collect()
    want = [(d, *brute(t), not brute(t)[-1]) for d, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert quality.report(df.limit(0), labels).collect() == []


def test_rules_find_a_known_list(spark):
    rng = random.Random(8)
    stats, labels = [], []
    for i in range(4000):
        words = rng.randint(20, 500)
        chars = words * rng.randint(3, 9)
        symbols, bars = rng.choice([0, 0, 1, words]), rng.choice([0, 0, words // 2])
        stats.append((i, words, chars, symbols, 0, 0, rng.randint(0, 5), 0, bars))
        labels.append((i, 0 if symbols > 0.05 * chars or (bars > 0.3 * words and words > 200) else 1))
    df = spark.createDataFrame(stats, ["doc_id", *quality.COUNTS])
    table_of = spark.createDataFrame([*labels, (None, 0), (7, None)], "doc_id LONG, quality INT")
    rules = quality.learn(df, table_of)
    assert 2 <= len(rules) <= quality.MAX_RULES
    wrong = quality.judge(df, rules).join(table_of, "doc_id").where(
        (F.col("quality") == 1) != F.col("kept") | F.col("base_failed")).count()
    assert wrong < 100


def test_without_bad_labels_no_rules(spark):
    df = spark.createDataFrame([(1, 20, 90, 0, 0, 0, 0, 0, 0)], ["doc_id", *quality.COUNTS])
    good = spark.createDataFrame([(1, 1)], "doc_id LONG, quality INT")
    assert quality.learn(df, good) == [] and quality.learn(df, good.limit(0)) == []


def test_labelled_documents(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    found = quality.report(table(spark, sf_dir, "documents"), labels).join(labels, "doc_id")
    good, kept_good, bad, kept_bad = found.where("NOT base_failed").agg(
        F.sum("quality"), F.sum(F.col("quality") * F.col("kept").cast("int")),
        F.sum(1 - F.col("quality")), F.sum((1 - F.col("quality")) * F.col("kept").cast("int"))
    ).first()
    assert kept_good / good > 0.99 and kept_bad / bad < 0.2
