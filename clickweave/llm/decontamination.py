"""Benchmark decontamination by winnowing.

A window of WINDOW words holds WINDOW - GRAM + 1 grams of GRAM words; the least of their hashes is its
fingerprint. It depends on the window's words alone, so a window shared by a document and a benchmark
item has the same fingerprint in both, and joining the fingerprints misses no shared window. A joined
fingerprint is then extended: the windows that hold it are compared as a whole, by a second hash of all
their words, and those equal in both are joined to runs of words, which are hit.

An item with fewer words is one window of its own length, and its fingerprint the hash of all of it.

Neither table meets the driver. Tasks over the documents get a bitmap of fixed size in which the
fingerprints of the benchmark are marked, whatever its size; only windows with a marked one go on, and
of equal windows of a text one, and of equal texts one. These meet the windows of the benchmark in a
join by hash. All other documents stay where they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import (
    U64,
    Hashes,
    bound_batches,
    checkpointed,
    freeing,
    map_rows,
    parts,
    utf8,
    window_min,
)
from clickweave.llm.words import HASHES, WORDS

WINDOW, GRAM = 13, 7
PART_BYTES = 1 << 20
# Bits of a fingerprint that tell its place in the bitmap.
MARK_BITS = 24
# Rows up to which the smaller side of a join is sent to the larger one.
BROADCAST_ROWS = 500_000

# The second hash of a window, of the same words.
WHOLE = Hashes(304)


def _fingerprints(words: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first words of all windows of n words, and their fingerprints."""
    start = np.flatnonzero(text[n - 1:] == text[:max(0, len(text) - n + 1)])
    if not len(start):
        return start, np.zeros(0, U64)
    if n < WINDOW:
        return start, _spread(HASHES.windows(words, n)[0][start], n)
    least = window_min(HASHES.windows(words, GRAM)[0], WINDOW - GRAM + 1)
    return start, _spread(least[start], n)


def _wholes(words: np.ndarray, start: np.ndarray, n: int) -> np.ndarray:
    """The second hash of the windows of n words that begin at `start`."""
    spread = (words ^ words >> U64(31)) * U64(0x9E3779B97F4A7C15)
    return _spread(WHOLE.windows(spread, n)[0][start], n)


def _spread(value: np.ndarray, n: int) -> np.ndarray:
    """Hashes whose leading bits are as good as all, and tell lengths apart."""
    value = (value ^ value >> U64(32)) * U64(0xC2B2AE3D27D4EB4F) + U64(n)
    return value ^ value >> U64(29)


def _windows_of_items(benchmark: DataFrame) -> DataFrame:
    """The different windows of each item: print, whole, size (in words), item_id."""
    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(batch.column("text"))
            for begin, end in parts(starts, PART_BYTES):
                own = starts[begin:end + 1]
                text, _, _, words = WORDS(data[own[0]:own[-1]], own - own[0])
                size = np.minimum(np.bincount(text, minlength=end - begin), WINDOW)
                for n in np.unique(size[size > 0]):
                    # Words of other items have the mark of none: their windows are passed over.
                    mine = size[text] == n
                    start, prints = _fingerprints(words[mine], text[mine], int(n))
                    wholes = _wholes(words[mine], start, int(n))
                    item = pa.array(begin + text[mine][start])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(prints.view(np.int64)), pa.array(wholes.view(np.int64)),
                         pa.array(np.full(len(start), n, np.int32)),
                         batch.column("item_id").take(item)], ["print", "whole", "size", "item_id"])

    items = benchmark.select(
        F.coalesce(benchmark["item_id"].cast("string"), F.lit("")).alias("item_id"), benchmark["text"])
    return checkpointed(items.mapInArrow(
        run, "print LONG, whole LONG, size INT, item_id STRING").distinct())


def _marks(windows: DataFrame) -> tuple[np.ndarray, list[int]]:
    """The bitmap of fingerprints, and the lengths of windows. Both are of bounded size."""
    place = F.shiftrightunsigned("print", 64 - MARK_BITS)
    bit = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(print, {64 - MARK_BITS}) % 64 AS INT))")
    marks = np.zeros(1 << MARK_BITS - 6, np.int64)
    for at, value in windows.groupBy(F.shiftright(place, 6).alias("at")).agg(
            F.bit_or(bit)).toLocalIterator():
        marks[at] = value
    sizes = [r["size"] for r in windows.select("size").distinct().toLocalIterator()]
    return marks.view(np.uint8), sorted(sizes)


def _text_key(text: Column) -> list[Column]:
    """128 bits that tell texts apart."""
    return [F.xxhash64(F.lit(name), text).alias(name) for name in ("a", "b")]


def _marked(docs: DataFrame, windows: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` of all rows, `a`, `b`, n_words; and of windows whose fingerprint is marked
    the first word, size and both hashes, null if there are none."""
    marks, sizes = _marks(windows)

    def outcome(batch: pa.RecordBatch) -> list[pa.Array]:
        data, starts = utf8(batch.column("text"))
        n_words, found = [], [None] * batch.num_rows
        for begin, end in parts(starts, PART_BYTES):
            own = starts[begin:end + 1]
            text, _, _, words = WORDS(data[own[0]:own[-1]], own - own[0])
            count = np.bincount(text, minlength=end - begin)
            n_words.append(count)
            first = np.cumsum(count) - count
            hits = []
            for n in sizes:
                start, prints = _fingerprints(words, text, n)
                place = prints >> U64(64 - MARK_BITS)
                marked = marks[(place >> U64(3)).astype(np.int64)] >> (place & U64(7)).astype(
                    np.uint8) & 1
                at = np.flatnonzero(marked)
                if len(at):
                    hits.append((start[at], np.full(len(at), n), prints[at],
                                 _wholes(words, start[at], n)))
            if not hits:
                continue
            start, size, prints, wholes = (np.concatenate(x) for x in zip(*hits, strict=True))
            order = np.argsort(text[start], kind="stable")
            start, size, prints, wholes = (x[order] for x in (start, size, prints, wholes))
            edges = np.searchsorted(text[start], np.arange(end - begin + 1))
            for i in np.flatnonzero(np.diff(edges)):
                mine = slice(edges[i], edges[i + 1])
                found[begin + i] = {"start": (start[mine] - first[i]).astype(np.int32),
                                    "size": size[mine].astype(np.int32),
                                    "print": prints[mine].view(np.int64),
                                    "whole": wholes[mine].view(np.int64)}
        counts = np.concatenate(n_words) if n_words else np.zeros(0, np.int64)
        return [pa.array(counts.astype(np.int64)), pa.array(found, _FOUND)]

    keyed = docs.select(*[docs[f"`{name}`"] for name in keep], docs["text"].alias("_text"),
                        *_text_key(docs["text"]))
    return map_rows(keyed, {"text": keyed["_text"]}, "n_words LONG, marked STRUCT<start: ARRAY<INT>, "
                    "size: ARRAY<INT>, print: ARRAY<LONG>, whole: ARRAY<LONG>>", outcome,
                    [*keep, "a", "b"])


_FOUND = pa.struct([("start", pa.list_(pa.int32())), ("size", pa.list_(pa.int32())),
                    ("print", pa.list_(pa.int64())), ("whole", pa.list_(pa.int64()))])
_HIT = pa.struct([("item_id", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_HITS = "hits ARRAY<STRUCT<item_id: STRING, start: LONG, end: LONG>>"


def _small(rows: DataFrame) -> DataFrame:
    """Sent to the other side of a join if it is small; else both are dealt by hash, and AQE splits
    what is hot."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


@freeing
def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each text the runs of words that windows of an item cover, item by item."""
    for batch in batches:
        out = []
        for marked, found in zip(batch.column("marked"), batch.column("found"), strict=True):
            start, size, whole = (marked[name].values.to_numpy(zero_copy_only=False)
                                  for name in ("start", "size", "whole"))
            order = np.argsort(whole, kind="stable")
            ordered, hits = whole[order], []
            of_item: dict[str, list[np.ndarray]] = {}
            for pair in found.as_py():
                low, high = np.searchsorted(ordered, pair["whole"], "left"), np.searchsorted(
                    ordered, pair["whole"], "right")
                of_item.setdefault(pair["item_id"], []).append(order[low:high])
            for item, places in sorted(of_item.items()):
                at = np.sort(np.concatenate(places))
                at = at[np.argsort(start[at], kind="stable")]
                low, reach = start[at], np.maximum.accumulate(start[at] + size[at])
                new = np.concatenate(([True], low[1:] > reach[:-1]))
                last = np.concatenate((new[1:], [True]))
                hits += [{"item_id": item, "start": int(a), "end": int(b)}
                         for a, b in zip(low[new], reach[last], strict=True)]
            out.append(hits)
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(out, pa.list_(_HIT))], ["a", "b", "hits"])


def _hits(marked: DataFrame, windows: DataFrame) -> DataFrame:
    """a, b and hits of every text with windows of the benchmark."""
    some = marked.where("marked IS NOT NULL").select("a", "b", "marked")
    # Equal texts meet on the map side, so copies cost one row for each task.
    texts = checkpointed(some.groupBy("a", "b").agg(F.first("marked").alias("marked")))
    pairs = texts.select("a", "b", F.explode(F.array_distinct(F.arrays_zip(
        F.col("marked.print").alias("print"), F.col("marked.whole").alias("whole")))).alias("w"))
    joined = pairs.select("a", "b", "w.print", "w.whole").hint("rebalance").join(
        _small(windows), ["print", "whole"])
    found = joined.groupBy("a", "b").agg(F.collect_set(F.struct("whole", "item_id")).alias("found"))
    bound_batches(marked.sparkSession)
    return checkpointed(texts.join(found, ["a", "b"]).mapInArrow(_runs, f"a LONG, b LONG, {_HITS}"))


def _summed(found: DataFrame) -> DataFrame:
    """Adds n_hit, items and contaminated, from n_words and hits."""
    none = F.array().cast(_HITS.removeprefix("hits "))
    found = found.withColumn("hits", F.coalesce("hits", none))
    # Words covered by the spans in order: each adds what lies beyond all earlier ones.
    spans = F.array_sort(F.transform("hits", lambda h: F.struct(h["start"], h["end"])))
    covered = F.aggregate(
        spans, F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("reach")),
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("long"),
                                   s["end"] - F.greatest(s["start"], acc["reach"]))).alias("n"),
            F.greatest(acc["reach"], s["end"]).alias("reach")))
    return found.withColumns({
        "n_hit": covered["n"],
        "items": F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["item_id"])))
    }).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def _judged(docs: DataFrame, benchmark: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` of all rows with a, b, n_words, hits and what follows from them."""
    windows = _windows_of_items(benchmark)
    marked = checkpointed(_marked(docs, windows, keep))
    return _summed(marked.drop("marked").join(_small(_hits(marked, windows)), ["a", "b"], "left"))


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every row of `docs` with its `n_words` and `hits`: item_id, first word and end of each run of
    words that windows of the item cover.

    Also `n_hit` (words in any hit), `items` (sorted ids of the items hit, as strings, each once) and
    `contaminated`: a hit, and a twentieth of the words or more are hit. A null text has no words;
    a null item_id is the empty string; items without words match nothing; items with the same id
    count once. Repeated rows stay. Input columns named like an added one are replaced by it. Empty
    tables give no rows or no hits.
    """
    added = ["n_words", "hits", "n_hit", "items", "contaminated"]
    kept = [name for name in docs.columns if name.lower() not in added]
    found = _judged(docs.select("text"), benchmark, []).select(
        "a", "b", *added).dropDuplicates(["a", "b"])
    keys = _text_key(docs["text"])
    row = docs.select(F.struct(*[docs[f"`{n}`"] for n in kept]).alias("row"), *keys)
    return row.join(_small(found), ["a", "b"]).select("row.*", *added)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The digest of `find_contamination` per document."""
    found = _judged(docs, benchmark, ["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
                        "contaminated")


def without_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `docs` that are not contaminated."""
    found = _judged(docs.select("text"), benchmark, []).where("contaminated").select("a", "b").distinct()
    row = docs.select(F.struct(*[docs[f"`{n}`"] for n in docs.columns]).alias("row"),
                      *_text_key(docs["text"]))
    return row.join(_small(found), ["a", "b"], "left_anti").select("row.*")
