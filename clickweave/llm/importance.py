"""Importance resampling towards a target: the documents most like the benchmark, drawn at random.

Every run of 1 to GRAMS words is a feature, hashed to one of BUCKETS buckets by crc32. An array holds
what each bucket says for the target (its gain); a document's weight is the sum over its features. To
the weight comes Gumbel noise from a hash of the document's id: the highest sums are a draw without
replacement in proportion to the weights.

The documents to draw are found without ordering the others. Scores are written once, equal rows as
one with their number. Then the numeric threshold is bisected: count jobs over the written scores
halve the range in which the cutoff lies until it is one number, first of the scores and then, among
rows of that score, of doc_id. (One job counts at all points of DEPTH halvings.) Only the rows
selected are range-partitioned, and numbered partition by partition.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import bound_batches, checkpointed, freeing, id_key, map_rows, parts, utf8
from clickweave.llm.words import WORDS, word_bytes

GRAMS = 3
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
PART_BYTES = 1 << 20
# Halvings of a range whose points are counted by one job.
DEPTH = 5
# Copies of one row that are made together.
COPIES = 10_000
# Words of more bytes take the plain checksum: tables of shifts end here.
SHORT = 64

_FOLD = word_bytes()[1]


def _byte_table() -> np.ndarray:
    """The checksum's register after each byte, from its polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(0xEDB88320), table >> 1)
    return table.astype(np.uint32)


_BYTE = _byte_table()


def _shift_tables(most: int) -> np.ndarray:
    """For n zero bytes up to `most`, each byte of a register and its value: the register after them.

    The checksum is linear: the register after a text A and a text B is that after A, moved on by as
    many zero bytes as B has, exclusive-or that after B alone.
    """
    table = np.zeros((most + 1, 4, 256), np.uint32)
    for place in range(4):
        table[0, place] = np.arange(256, dtype=np.uint32) << np.uint32(8 * place)
    for n in range(most):
        table[n + 1] = table[n] >> np.uint32(8) ^ _BYTE[table[n] & np.uint32(255)]
    return table


_SHIFT = _shift_tables(GRAMS * (SHORT + 1))


def _shifted(register: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = _SHIFT[n, 0, register & np.uint32(255)]
    for place in (1, 2, 3):
        out ^= _SHIFT[n, place, register >> np.uint32(8 * place) & np.uint32(255)]
    return out


def _registers(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The register after each word alone, from zero."""
    out = np.zeros(len(begin), np.uint32)
    order = np.argsort(-size, kind="stable")
    begin, size = begin[order], size[order]
    alive = np.searchsorted(-size, -np.arange(int(size[0]) if len(size) else 0), "left")
    for at, n in enumerate(alive):
        own = out[:n]
        out[:n] = own >> np.uint32(8) ^ _BYTE[(own ^ data[begin[:n] + at]) & np.uint32(255)]
    back = np.empty(len(order), np.uint32)
    back[order] = out
    return back


def buckets(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each feature of the texts its text and its bucket; and the texts' words."""
    text, begin, end, _ = WORDS(data, starts)
    lower = _FOLD[data]
    size = end - begin
    short = size <= SHORT
    clipped = np.where(short, size, 0)
    alone = _registers(lower, begin, clipped)
    # With the space before it.
    spaced = _shifted(np.full(len(alone), _BYTE[32], np.uint32), clipped) ^ alone
    texts, found = [text], [(alone, clipped, short)]
    for n in range(2, GRAMS + 1):
        register, length, plain = found[-1]
        after = slice(n - 1, None)
        whole = text[after] == text[:len(text) - n + 1]
        count = len(whole)
        found.append((_shifted(register[:count], clipped[after] + 1) ^ spaced[after],
                      length[:count] + clipped[after] + 1, plain[:count] & short[after]))
        texts.append(np.where(whole, text[:count], -1))
    first = np.uint32(0xFFFFFFFF)
    out_text, out_bucket = [], []
    for n, (of, (register, length, plain)) in enumerate(zip(texts, found, strict=True), 1):
        own = of >= 0
        crc = register ^ _shifted(np.full(len(register), first), length) ^ first
        for i in np.flatnonzero(own & ~plain):
            words = (lower[begin[j]:end[j]].tobytes() for j in range(i, i + n))
            crc[i] = zlib.crc32(b" ".join(words))
        out_text.append(of[own])
        out_bucket.append((crc[own] % np.uint32(BUCKETS)).astype(np.int64))
    return np.concatenate(out_text), np.concatenate(out_bucket), np.bincount(
        text, minlength=len(starts) - 1)


def bucket_counts(texts: DataFrame) -> np.ndarray:
    """The features of all texts in each bucket. The driver gets one number for each bucket."""
    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            data, starts = utf8(batch.column("text"))
            for begin, end in parts(starts, PART_BYTES):
                own = starts[begin:end + 1]
                _, bucket, _ = buckets(data[own[0]:own[-1]], own - own[0])
                count += np.bincount(bucket, minlength=BUCKETS)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(count[at])],
                                         ["bucket", "n"])

    bound_batches(texts.sparkSession)
    out = np.zeros(BUCKETS, np.int64)
    counted = texts.select("text").mapInArrow(run, "bucket INT, n LONG")
    for bucket, n in counted.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What each bucket says for the target, in thousandths."""
    s, t = float(source.sum() + BUCKETS), float(target.sum() + BUCKETS)
    return np.array([math.floor(1000 * math.log((b + 1.0) * s / ((a + 1.0) * t)))
                     for a, b in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, keep: list[str] | None = None) -> DataFrame:
    """Every row of `docs` with `n_words`, `n_features` and `weight`, the sum of its gains."""
    def outcome(batch: pa.RecordBatch) -> list[pa.Array]:
        data, starts = utf8(batch.column("text"))
        words, features, weight = ([np.zeros(0, np.int64)] for _ in range(3))
        for begin, end in parts(starts, PART_BYTES):
            own = starts[begin:end + 1]
            text, bucket, n = buckets(data[own[0]:own[-1]], own - own[0])
            words.append(n)
            features.append(np.bincount(text, minlength=end - begin))
            total = np.zeros(end - begin, np.int64)
            np.add.at(total, text, gain[bucket])
            weight.append(total)
        return [pa.array(np.concatenate(x).astype(np.int64)) for x in (words, features, weight)]

    return map_rows(docs, {"text": docs["text"]}, "n_words LONG, n_features LONG, weight LONG",
                    outcome, keep)


def noise(doc_id: Column) -> Column:
    """Gumbel noise from the id, in thousandths; that of a null id is that of the text `42:`."""
    text = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    uniform = (h + F.lit(0.5)) / F.lit(4294967296.0)
    return F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")


def _last_reached(rows: DataFrame, value: Column, wanted: int, low: int, high: int) -> int:
    """The least v in [low, high] such that `wanted` or more of the rows have a `value` up to v.

    Each job counts the rows up to every point that DEPTH halvings of the range could ask for.
    """
    while low < high:
        step = max(1, (high - low) >> DEPTH)
        points = list(range(low + step - 1, high, step))
        counts = rows.agg(*[F.coalesce(F.sum(F.when(value <= p, F.col("n"))), F.lit(0))
                            for p in points]).first()
        reached = [p for p, n in zip(points, counts, strict=True) if n >= wanted]
        if reached:
            high = reached[0]
        missed = [p for p in points if not reached or p < reached[0]]
        if missed:
            low = missed[-1] + 1
    return low


def resample(scored: DataFrame, drawn: int) -> DataFrame:
    """The rows of `scored` with `rank`: 1, 2, 3... of the `drawn` eligible ones highest by `score`.

    Takes a written table with doc_id, score and eligible. Equal scores go by doc_id, a null one
    first; rows that share both go by a hash of their other columns, and of wholly equal rows as many
    are drawn as there is room for.
    """
    names = scored.columns
    keyed = scored.withColumns({"_id": id_key(F.col("doc_id")),
                                "_tie": F.xxhash64(*[scored[f"`{n}`"] for n in names])})
    rows = checkpointed(keyed.groupBy(*keyed.columns).agg(F.count("*").alias("n")))
    left = rows.where("eligible")
    cuts: list[tuple[Column, int]] = []
    wanted = drawn
    # By score first, the highest in front; then, among rows of the cutoff, by doc_id and the hash.
    for value in (-F.col("score"), F.col("_id"), F.col("_tie")):
        low, high, total = left.agg(F.min(value), F.max(value), F.sum("n")).first()
        if not wanted or total is None or total <= wanted:
            break
        cut = _last_reached(left, value, wanted, low, high)
        wanted -= left.where(value < cut).agg(F.sum("n")).first()[0] or 0
        cuts.append((value, cut))
        left = left.where(value == cut)
    # In front of the first cutoff, or at it and in front of the second, and so on.
    inside = reduce(lambda rest, c: (c[0] < c[1]) | ((c[0] == c[1]) & rest), reversed(cuts), F.lit(True))
    chosen = F.col("eligible") & F.lit(drawn > 0) & inside
    order = [F.desc("score"), F.asc("_id"), F.asc("_tie")]
    selected = checkpointed(
        rows.where(chosen).repartitionByRange(*order)
        .withColumn("part", F.shiftright(F.monotonically_increasing_id(), 33).cast("int")))
    offsets, total = [], 0
    for part, size in sorted(selected.groupBy("part").agg(F.sum("n")).collect()):
        offsets.append((part, total))
        total += size
    table = F.broadcast(scored.sparkSession.createDataFrame(offsets, "part INT, offset LONG"))
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    first = F.col("offset") + F.sum("n").over(within) - F.col("n")
    ranked = _copies(selected.join(table, "part").withColumn("before", first)).withColumn(
        "rank", F.col("before") + F.col("copy"))
    drawn_rows = ranked.select(*names, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    return keyed.where(~chosen).select(*names, F.lit(None).cast("long").alias("rank")).unionByName(
        drawn_rows)


def _copies(rows: DataFrame) -> DataFrame:
    """Each row `n` times, numbered from 1 as `copy`; those of one row are made by many tasks."""
    of_chunk = F.col("chunk") * COPIES
    whole = rows.withColumn("chunk", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES)))).hint("rebalance")
    return whole.withColumn("copy", F.explode(F.sequence(
        of_chunk + 1, F.least(F.col("n"), of_chunk + COPIES))))


def importance(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of `docs`.

    `weight` says how much more the document is like the texts of `target` than like `docs` as a
    whole. Of the N rows with LEAST_WORDS words or more, percent * N / 100 (rounded down) are drawn
    by the highest scores and ranked; the others have a null rank. A null text has no words; repeated
    rows are documents of their own; other columns are passed over. Empty tables give no rows or, as
    a target, no features.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    found = weighted(docs.select("doc_id", "text"), gain, ["doc_id"])
    scored = checkpointed(found.select(
        "doc_id", "n_words", "n_features", "weight",
        (F.col("weight") + noise(F.col("doc_id"))).alias("score"),
        (F.col("n_words") >= LEAST_WORDS).alias("eligible")))
    number = scored.where("eligible").count()
    return resample(scored, percent * number // 100).drop("eligible")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of `importance` per document."""
    return importance(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank")
