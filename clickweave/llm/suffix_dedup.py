"""Suffix-array dedup: every byte inside a passage that also starts earlier is removed.

The suffixes of all texts are ordered through `length` bytes only, by radix passes from the most
significant digit on; each pass deals rows by a digit, and a row alone in its group is finished.
Groups still equal after the last pass are exactly the repeated windows.

The order of digits is chosen so that the first passes move few rows. Each window of `length` bytes
holds an anchor: of its k-grams the one with the least hash (the leftmost of equals). It depends on
the window's bytes alone, so equal windows have it at the same place, and neighbouring windows
mostly share it. The digits of a window are then

1. the k-gram at its anchor: one row stands for all windows of that anchor, about 30;
2. the bytes common to all windows of a block of 8 offsets from the anchor;
3. the window itself.

At passes 1 and 2 a row also carries a hash of all bytes its windows cover. Rows equal in it are
copies: all but the first are covered, and only the first goes on to the next pass, if another row
with other surroundings shares its digit. So thousands of copies cost one row each, and almost all
text is finished after the first pass.

Hot digits are split before they are dealt: an Arrow batch sends at most one row for each k-gram and
decides itself what it can, namely copies within the batch and rows known to share their digit.
Digits are 64-bit hashes, two independent ones decide that rows are equal. So suffixes are ordered by
the hashes of their digits, not alphabetically, and only as far as to tell equal windows: within a group
nothing is ordered, and suffixes that do not begin at an anchor have no row of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.llm.common import (
    U64,
    Hashes,
    bound_batches,
    freeing,
    id_key,
    parts,
    unpack,
    utf8,
    whole_row,
    window_min,
)

LENGTH = 100
BLOCK = 8
# Positions hashed at a time: their arrays stay in the processor's cache.
CHUNK = 1 << 16

DIGIT, SURROUNDINGS = Hashes(101), Hashes(202)

# What is known of a row before it is dealt.
PLAIN, COVERED, SHARED, SHARED_ELSEWHERE = 0, 1, 2, 3

# Open rows after which a batch is decided upon, and blocks of them whose surroundings are cut out at a
# time: a few dozen hashes are held for each byte of these.
ROWS, BLOCKS = 1 << 10, 1 << 10
# Bytes of text after which a batch is decided upon.
BATCH_BYTES = 1 << 23

# Texts of one id are dealt by a slot, bits of their hash, and within it by the part of the input they
# stand in: so neither an id nor a text that a third of all rows have goes to one task. `copy` tells
# the texts apart that share both, and has so many bits.
SLOT_BITS, PART_BITS, COPY_BITS = 20, 16, 24
# Ids up to which those of several rows are sent to all tasks; other rows then have slot 0, which takes
# no room in what is dealt. With more of them every row has its slot.
BROADCAST_IDS = 1_000_000

# `tag`: slot, part, copy and kind. `place`: windows and anchor of a row, see _pack; of a covered one
# the first window, `c` then being the last.
_DEALT = "k LONG NOT NULL, c LONG NOT NULL, doc LONG NOT NULL, tag LONG NOT NULL, place LONG NOT NULL"


def _pack(at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The first window, how many follow and how far the anchor is: both are less than 2^15."""
    return low << 30 | (high - low) << 15 | (at - low)


def _unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low, mask = place >> 30, (1 << 15) - 1
    return low + (place & mask), low, low + (place >> 15 & mask)


def _windows_of_text(data: np.ndarray, starts: np.ndarray, length: int) -> tuple:
    """One row per anchor: its digit, hash of surroundings, text, anchor, first and last window."""
    k = max(1, 2 * length // 5)
    width = length - k + 1
    found: list[tuple] = []
    for begin in range(0, max(0, len(data) - length + 1), CHUNK):
        part = data[begin:begin + CHUNK + length - 1]
        first = DIGIT.symbols[part]
        gram, whole = DIGIT.windows(first, k, length)
        n = len(whole)
        # The low bits hold the place: the least value is the leftmost of equal hashes.
        key = (gram >> U64(20) << U64(20)) | np.arange(len(gram), dtype=U64)
        anchor = (window_min(key, width) & U64((1 << 20) - 1)).astype(np.int64)
        # Windows that cross the end of a text do not count.
        ends = starts[1:] - begin
        ends = ends[(ends > 0) & (ends < n + length)]
        change = np.zeros(n + 1, np.int64)
        np.add.at(change, np.clip(ends - length + 1, 0, n), 1)
        np.add.at(change, np.clip(ends, 0, n), -1)
        valid = np.cumsum(change[:-1]) == 0
        joint = valid[1:] & valid[:-1] & (anchor[1:] == anchor[:-1])
        low = np.flatnonzero(valid & ~np.concatenate(([False], joint)))
        high = np.flatnonzero(valid & ~np.concatenate((joint, [False])))
        if not len(low):
            continue
        at = anchor[low]
        around = _surroundings(whole[low], whole[high], high - low, at - low)
        text = np.searchsorted(starts, low + begin, "right") - 1
        shift = begin - starts[text]
        found.append((gram[at], around, text, at + shift, low + shift, high + shift))
    if not found:
        return tuple(np.zeros(0, t) for t in (U64, U64, *[np.int64] * 4))
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def _surroundings(first: np.ndarray, last: np.ndarray, *places: np.ndarray) -> np.ndarray:
    value = first * U64(0x9E3779B97F4A7C15) + (last ^ (last >> U64(32))) * U64(0xC2B2AE3D27D4EB4F)
    for place in places:
        value = (value ^ (value >> U64(31))) * U64(0x165667B19E3779F9) + place.astype(U64)
    return value ^ (value >> U64(30))


def _decide(k: np.ndarray, c: np.ndarray, doc: np.ndarray, copy: np.ndarray, at: np.ndarray,
            low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    """What one batch knows by itself, as rows to be dealt by `k`.

    Copies within the batch are covered, neighbours joined to one row. Of the rows that share a
    digit one is sent to it, marked; the others are dealt by their surroundings.
    """
    order = np.lexsort((low, copy, doc, c, k))
    k, c, doc, copy, at, low, high = (x[order] for x in (k, c, doc, copy, at, low, high))
    same_k = np.concatenate(([False], k[1:] == k[:-1]))
    repeated = same_k & np.concatenate(([False], c[1:] == c[:-1]))
    group = np.cumsum(~same_k) - 1
    shared = (np.bincount(group, ~repeated) > 1)[group] if len(k) else same_k
    kind = np.where(repeated, COVERED, np.where(
        shared, np.where(same_k, SHARED_ELSEWHERE, SHARED), PLAIN)).astype(np.int32)
    k = np.where(kind == SHARED_ELSEWHERE, c, k)
    go, done = kind != COVERED, np.flatnonzero(kind == COVERED)
    done = done[np.lexsort((low[done], copy[done], doc[done]))]
    rows = [(k[go], c[go], doc[go], copy[go] << 2 | kind[go], _pack(at[go], low[go], high[go]))]
    if len(done):
        d, p, lo, hi = doc[done], copy[done], low[done], high[done]
        new = np.concatenate(([True], (d[1:] != d[:-1]) | (p[1:] != p[:-1]) | (lo[1:] > hi[:-1] + 1)))
        first, last = np.flatnonzero(new), np.flatnonzero(np.concatenate((new[1:], [True])))
        d, p, lo = d[first], p[first], lo[first]
        spread = _surroundings(d.astype(U64), lo.astype(U64), p)
        rows.append((spread, hi[last].astype(U64), d, p << 2 | COVERED, lo))
    k, c, doc, tag, place = (np.concatenate(x) for x in zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(x) for x in (k.view(np.int64), c.view(np.int64), doc, tag, place)],
        ["k", "c", "doc", "tag", "place"])


def _ids(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return (batch.column("doc").to_numpy(zero_copy_only=False),
            batch.column("copy").to_numpy(zero_copy_only=False))


def _first_pass(length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, copy = _ids(batch)
            data, starts = utf8(batch.column("row").field("text"))
            for begin, end in parts(starts, BATCH_BYTES):
                part = starts[begin:end + 1]
                k, c, text, at, low, high = _windows_of_text(
                    data[part[0]:part[-1]], part - part[0], length)
                if len(k):
                    yield _decide(k, c, doc[begin + text], copy[begin + text], at, low, high)
    return run


def _flat(lists: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The number of structs in each list, and their fields."""
    values = lists.flatten()
    return (lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False),
            {f.name: values.field(i).to_numpy(zero_copy_only=False)
             for i, f in enumerate(values.type)})


def _next_pass(length: int, block: int) -> Callable[[Iterator[pa.RecordBatch]],
                                                    Iterator[pa.RecordBatch]]:
    """The windows still open, as rows for blocks of `block` offsets from their anchors."""
    width = length - max(1, 2 * length // 5) + 1

    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, copy = _ids(batch)
            data, starts = utf8(batch.column("row").field("text"))
            count, rows = _flat(batch.column("open"))
            text = np.repeat(np.arange(len(count)), count)
            for begin in range(0, len(text), ROWS):
                part = slice(begin, begin + ROWS)
                yield _refine(data, starts, doc, copy, text[part], *_unpack(rows["place"][part]))

    def _refine(data, starts, doc, copy, text, at, low, high) -> pa.RecordBatch:
        # One row per block of offsets (anchor less start) that has a window.
        near, far = (at - high) // block, (at - low) // block
        size = far - near + 1
        row = np.repeat(np.arange(len(at)), size)
        number = near[row] + np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        text, at = text[row], at[row]
        nearest = number * block
        last = at - np.maximum(nearest, at - high[row])
        first = at - np.minimum(nearest + block - 1, at - low[row])
        found = [_digits(data, starts, *(x[i:i + BLOCKS] for x in (text, at, nearest, first, last)))
                 for i in range(0, len(text), BLOCKS)]
        k, c = (np.concatenate(x) for x in zip(*found, strict=True))
        return _decide(k, c, doc[text], copy[text], at, first, last)

    def _digits(data, starts, text, at, nearest, first, last) -> tuple[np.ndarray, np.ndarray]:
        # Bytes about the anchor, zeros beyond the text; then hashes of windows within them.
        reach = np.arange(-width, length)
        place = (starts[text] + at)[:, None] + reach
        inside = (place >= starts[text][:, None]) & (place < starts[text + 1][:, None])
        near_bytes = np.where(inside, data[np.where(inside, place, 0)], 0)
        common = length - block + 1
        digits, = DIGIT.windows(DIGIT.symbols[near_bytes], common)
        wholes, = SURROUNDINGS.windows(SURROUNDINGS.symbols[near_bytes], length)
        i, origin = np.arange(len(text)), at - width
        k = _surroundings(digits[i, at - nearest - origin], nearest.astype(U64))
        c = _surroundings(wholes[i, first - origin], wholes[i, last - origin], last - first,
                          at - first)
        return k, c

    return run


def _judged(dealt: DataFrame) -> DataFrame:
    """For each document the rows of a pass that are covered, or open for the next pass.

    Of rows equal in digit and surroundings all but the first are covered; the first is open if its
    digit is shared by a row with other surroundings. A document is an id and a slot with its part.
    """
    # The kind does not order rows: those of one text may be of different kinds.
    order = Window.partitionBy("k").orderBy("c", "doc", F.shiftright("tag", 2), "place")
    group = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    kind = F.col("tag") % 4
    covered = (kind == COVERED) | F.coalesce(F.col("c") == F.col("before"), F.lit(False))
    # One list for both kinds: both readers of it then share one shuffle.
    return (dealt.withColumns({
        "before": F.lag("c").over(order),
        "shared": (F.first("c").over(group) != F.last("c").over(group))
        | (F.max(kind).over(group) >= SHARED)})
        .where(covered | F.col("shared"))
        .groupBy("doc", F.shiftright("tag", COPY_BITS + 2).alias("slot"))
        .agg(F.collect_list(F.struct(
            covered.alias("covered"), _own_copy(F.shiftright("tag", 2)).alias("copy"), "place",
            F.when(kind == COVERED, F.col("c")).otherwise(
                F.shiftright("place", 30) + F.shiftright("place", 15) % (1 << 15)).alias("high"),
            F.when(kind == COVERED, F.col("place")).otherwise(
                F.shiftright("place", 30)).alias("low"))).alias("rows")))


def _own_copy(document: Column) -> Column:
    return document.bitwiseAND(F.lit((1 << COPY_BITS) - 1))


def _open(texts: DataFrame, judged: DataFrame) -> DataFrame:
    """The texts with windows to look at again. Joined by what both are dealt by."""
    rows = F.filter("rows", lambda r: ~r["covered"] & (r["copy"] == _own_copy(F.col("copy"))))
    return texts.join(judged, ["doc", "slot"]).select(
        "doc", "copy", "row", rows.alias("open")).where(F.size("open") > 0)


def _covered(judged: DataFrame) -> DataFrame:
    return judged.select("doc", "slot", F.filter("rows", lambda r: r["covered"]).alias("spans"))


def _merged(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans [low, high) sorted and joined where they touch."""
    order = np.argsort(low, kind="stable")
    low, reach = low[order], np.maximum.accumulate(high[order])
    new = np.concatenate(([True], low[1:] > reach[:-1])) if len(low) else np.zeros(0, bool)
    return low[new], reach[np.flatnonzero(np.concatenate((new[1:], [True])))] if len(low) else reach


def _cut(length: int, as_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = utf8(batch.column("row").field("text"))
            count, rows = _flat(batch.column("spans"))
            ends = np.cumsum(count)
            kept, spans = [], []
            for i, n in enumerate(count):
                text = data[starts[i]:starts[i + 1]]
                if not n:
                    kept.append(text.tobytes())
                    spans.append([])
                    continue
                own = slice(ends[i] - n, ends[i])
                low, high = _merged(rows["low"][own], rows["high"][own] + length)
                keep = np.ones(len(text), bool)
                for a, b in zip(low, high, strict=True):
                    keep[a:b] = False
                kept.append(text[keep].tobytes())
                spans.append([{"start": int(a), "end": int(b)}
                              for a, b in zip(low, high, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(np.diff(starts)), pa.array(spans, _SPANS),
                 pa.array([k.decode(errors="ignore") for k in kept], pa.string())
                 if as_text else pa.array(kept, pa.binary())], ["row", "n_bytes", "spans", "kept"])
    return run


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def remove_repeats(docs: DataFrame, length: int = LENGTH, as_text: bool = False) -> DataFrame:
    """Every row of `docs` with what is left of its `text` once repeated passages are removed.

    Adds `n_bytes` (of the UTF-8 text), `spans` (removed runs, array of start and end byte) and
    `kept` (binary; `as_text`: a string, without characters cut apart). A byte is removed if a string of `length` bytes covers it that also starts
    earlier: in a document with a smaller doc_id, or in the same one at an earlier start. Overlaps
    count, matches never cross documents, and strings are judged on the input.

    A null doc_id comes first, a null text is empty, and a text shorter than `length` stays whole.
    Rows with the same doc_id are documents of their own, ordered by the leading bits of the xxhash64
    of their texts; of two equal rows one stays. Input columns named like an added one are replaced by it. No rows give no rows.
    """
    bound_batches(docs.sparkSession)
    schema = docs.select(whole_row(docs)).schema["row"].dataType
    text_hash = F.shiftrightunsigned(F.xxhash64(F.coalesce(docs["text"], F.lit(""))), 64 - SLOT_BITS)
    part = F.spark_partition_id().cast("long").bitwiseAND(F.lit((1 << PART_BITS) - 1))
    slot = F.shiftleft(text_hash, PART_BITS).bitwiseOR(part)
    rows = docs.select(id_key(docs["doc_id"]).alias("doc"), slot.alias("slot"), whole_row(docs))
    repeated = (docs.select(id_key(docs["doc_id"]).alias("doc")).groupBy("doc")
                .agg(F.count("*").alias("n")).where("n > 1").select("doc", F.lit(True).alias("many")))
    if repeated.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        rows = rows.join(F.broadcast(repeated), "doc", "left").select(
            "doc", F.when(F.col("many"), F.col("slot")).otherwise(0).alias("slot"), "row")
    rows = rows.repartition("doc", "slot")
    # The columns are the same wherever the texts are read, so they are shuffled only once.
    copies = Window.partitionBy("doc", "slot").orderBy(F.col("row.text"))
    number = F.row_number().over(copies).cast("long") - 1
    texts = rows.withColumn("copy", F.shiftleft("slot", COPY_BITS).bitwiseOR(number))
    passes = [_judged(texts.mapInArrow(_first_pass(length), _DEALT))]
    for block in (min(BLOCK, length), 1):
        asked = _open(texts, passes[-1]).mapInArrow(_next_pass(length, block), _DEALT)
        passes.append(_judged(asked))
    covered = [_covered(judged) for judged in passes]
    spans = (covered[0].union(covered[1]).union(covered[2]).groupBy("doc", "slot")
             .agg(F.flatten(F.collect_list("spans")).alias("spans")))
    own = F.filter("spans", lambda r: r["copy"] == _own_copy(F.col("copy")))
    out = T.StructType([T.StructField("row", schema)]
                       + T.StructType.fromDDL("n_bytes LONG, spans ARRAY<STRUCT<start: LONG, "
                                              "end: LONG>>, kept "
                                              + ("STRING" if as_text else "BINARY")).fields)
    cut = texts.join(spans, ["doc", "slot"], "left").select("row", own.alias("spans")).mapInArrow(
        _cut(length, as_text), out)
    return unpack(cut, "n_bytes", "spans", "kept")


def report(docs: DataFrame) -> DataFrame:
    """The digest of `remove_repeats` per document."""
    found = remove_repeats(docs.select("doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """`docs` with repeated passages taken out of `text`, as are characters cut apart by that."""
    found = remove_repeats(docs, as_text=True)
    return found.withColumn("text", F.col("kept")).select(*docs.columns)
