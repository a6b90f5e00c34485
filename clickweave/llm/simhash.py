"""SimHash near-duplicates, candidates found by pigeonring filtering.

A fingerprint of 64 bits is cut in SEGMENTS parts that form a ring. If two fingerprints differ in at
most DISTANCE bits, then from some part on every chain of l consecutive parts differs in at most
l * DISTANCE / SEGMENTS bits. With five parts and two bits these budgets are 0, 0, 1, 1, 2: two
neighbouring parts are equal. So fingerprints meet by two neighbouring parts of any start, and a
candidate must keep the budgets of the longer chains before all bits are compared.

Only different fingerprints are compared, so copies cost nothing. A part pair shared by more than
BUCKET fingerprints is not paired off: there, each fingerprint sends itself and all fingerprints at
one bit's distance in its other parts, and those that meet in one are within two bits of each other.
That finds the same links with work linear in the bucket; a meeting point has 65 members at most.

Linked fingerprints are then joined to components by alternating stars (large star, small star).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import checkpointed, map_rows, unpack, whole_row

SHINGLE = 3
SEED = 42
DISTANCE, SEGMENTS = 2, 5
BUCKET = 64
# Shingles whose bits are spread out at a time.
CHUNK = 1 << 14

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _shingles(words: list[bytes]) -> Iterator[bytes]:
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        yield joined
        return
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-(SHINGLE)] + 1))
    for a, b in zip(starts.tolist(), ends[SHINGLE - 1:].tolist(), strict=True):
        yield joined[a:b]


def fingerprint(text: str | None) -> int:
    """The fingerprint of one text as a signed long; 0 without words."""
    # bytes.split() splits at space, tab, line feed, vertical tab, form feed, carriage return.
    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in _shingles(words)), np.uint64,
                         max(1, len(words) - SHINGLE + 1))
    count = np.zeros(64, np.int64)
    for i in range(0, len(hashes), CHUNK):
        own = hashes[i:i + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        count += np.unpackbits(own, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * count > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def _outcome(batch: pa.RecordBatch) -> list[pa.Array]:
    return [pa.array((fingerprint(t.as_py()) for t in batch.column("text")), pa.int64())]


def fingerprints(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Every row of `docs` with the fingerprint of its text (a long)."""
    return map_rows(docs, {"text": docs["text"]}, "fingerprint LONG NOT NULL", _outcome, keep)


def _segments() -> list[tuple[int, int]]:
    """First bit and width of each part."""
    edges = [64 * i // SEGMENTS for i in range(SEGMENTS + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _exact() -> int:
    """The longest chain whose budget is no difference."""
    return max(n for n in range(1, SEGMENTS + 1) if n * DISTANCE // SEGMENTS == 0)


def _mask(parts: list[tuple[int, int]]) -> int:
    mask = sum(((1 << width) - 1) << at for at, width in parts)
    return mask - (1 << 64) if mask >> 63 else mask


def _chain(start: int, length: int) -> list[tuple[int, int]]:
    parts = _segments()
    return [parts[(start + i) % SEGMENTS] for i in range(length)]


def _keys(nodes: DataFrame) -> DataFrame:
    """A row per start: the bits of the chain that must be equal."""
    found = F.explode(F.array(*[
        F.struct(F.lit(i).alias("start"),
                 F.col("fp").bitwiseAND(F.lit(_mask(_chain(i, _exact())))).alias("key"))
        for i in range(SEGMENTS)])).alias("k")
    return nodes.select("fp", found).select("fp", "k.start", "k.key")


def _within_budgets(start: Column, differing: Column) -> Column:
    """Whether the chains from `start` keep their budgets, and the whole its distance."""
    tests = [F.bit_count(differing) <= DISTANCE]
    for n in range(_exact() + 1, SEGMENTS):
        masks = F.array(*[F.lit(_mask(_chain(i, n))) for i in range(SEGMENTS)])
        tests.append(F.bit_count(differing.bitwiseAND(masks[start])) <= n * DISTANCE // SEGMENTS)
    out = tests[0]
    for test in tests[1:]:
        out = out & test
    return out


def links(nodes: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Pairs (u, v), u > v, that connect the distinct fingerprints `fp` within DISTANCE bits.

    Two of them are connected by these pairs if and only if they are by all pairs in that distance.
    """
    keys = _keys(nodes)
    size = keys.groupBy("start", "key").agg(F.count("*").alias("n")).where("n > 1")
    small = keys.join(size.where(F.col("n") <= bucket).drop("n"), ["start", "key"], "left_semi")
    left, right = small.select("start", "key", F.col("fp").alias("v")), small.select(
        "start", "key", F.col("fp").alias("u"))
    near = left.join(right, ["start", "key"]).where(
        (F.col("u") > F.col("v"))
        & _within_budgets(F.col("start"), F.col("u").bitwiseXOR(F.col("v")))).select("u", "v")
    large = keys.join(size.where(F.col("n") > bucket).drop("n"), ["start", "key"], "left_semi")
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[
        F.lit(_mask([(bit, 1)])) for at, width in _chain(i + _exact(), SEGMENTS - _exact())
        for bit in range(at, at + width)]) for i in range(SEGMENTS)])
    points = large.select("fp", F.explode(flips[F.col("start")]).alias("flip")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
    met = points.groupBy("point").agg(F.collect_set("fp").alias("members")).where(
        F.size("members") > 1)
    stars = met.select(F.explode("members").alias("u"), F.array_min("members").alias("v")).where(
        "u > v")
    return near.union(stars).distinct()


def _two(df: DataFrame, u1: Column, v1: Column, u2: Column, v2: Column) -> DataFrame:
    """Two pairs (u, v) for each row."""
    pairs = F.array(*[F.struct(u.alias("u"), v.alias("v")) for u, v in ((u1, v1), (u2, v2))])
    return df.select(F.explode(pairs).alias("p")).select("p.u", "p.v")


def _step(pairs: DataFrame) -> DataFrame:
    """One large star and one small star over pairs (u, v), u > v."""
    both = _two(pairs, F.col("u"), F.col("v"), F.col("v"), F.col("u"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        "u", F.least("u", "m").alias("m"))
    large = (both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .where("u > v").distinct())
    lowest = large.groupBy("u").agg(F.min("v").alias("m"))
    return _two(large.join(lowest, "u"), F.col("v"), F.col("m"), F.col("u"), F.col("m")).where(
        "u > v").distinct()


def components(pairs: DataFrame) -> DataFrame:
    """For each node of some pair (u, v), u > v, that is not the least of its component: the least.

    Pairs stay in the cluster, written to the shared folder after each round. Rounds end when they
    change nothing, after the order of log^2 of the nodes.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    pairs = checkpointed(pairs)
    now = state(pairs)
    while now[0]:
        pairs = checkpointed(_step(pairs))
        before, now = now, state(pairs)
        if now == before:
            break
    return pairs


def _rooted(nodes: DataFrame, bucket: int) -> DataFrame:
    """The nodes (fp, first) with the least fingerprint of their component as `root`."""
    root = components(links(nodes, bucket))
    return nodes.join(root, nodes["fp"] == root["u"], "left").select(
        "fp", "first", F.coalesce("v", "fp").alias("root"))


def link_documents(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """The rows (doc_id, fingerprint) with component_id: the least doc_id that links reach.

    Null ids are passed over: a component of none but null ids has a null component_id.
    """
    prints = checkpointed(prints)
    nodes = checkpointed(prints.groupBy(F.col("fingerprint").alias("fp")).agg(
        F.min("doc_id").alias("first")))
    rooted = _rooted(nodes, bucket)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select(F.col("fp").alias("fingerprint"), "component_id")
    return prints.join(named, "fingerprint")


def report(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row of `docs`.

    A text that is null or has no words has fingerprint zero and is linked like any other; repeated
    rows stay; ids that are equal are told apart by nothing and share their component if their texts
    do. No rows give no rows.
    """
    linked = link_documents(fingerprints(docs.select("doc_id", "text"), ["doc_id"]), bucket)
    return linked.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
                         .alias("fingerprint"), "component_id")


def _row_key(docs: DataFrame) -> list[Column]:
    """128 bits as `a` and `b` that tell rows apart unless all of their columns are equal."""
    others = [docs[f"`{n}`"] for n in docs.columns if n not in ("doc_id", "text")]
    rest = F.to_json(F.struct(*others)) if others else F.lit("")
    return [F.xxhash64(F.lit(name), docs["doc_id"], docs["text"], rest).alias(name)
            for name in ("a", "b")]


def without_near_copies(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """One row of `docs` for each component: one of the least doc_id.

    Null ids come last, so a component of none but null ids keeps one row too. Of rows with the same
    id the least by a hash of the row stays, and one of rows equal in every column.
    """
    key = _row_key(docs)
    prints = fingerprints(docs.select("doc_id", "text", *key), ["doc_id", "a", "b"])
    rows = prints.groupBy("fingerprint", "doc_id", "a", "b").agg(F.count("*").alias("n"))
    first = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "a", "b", "n")
    nodes = checkpointed(rows.groupBy(F.col("fingerprint").alias("fp")).agg(
        F.min(first).alias("first")))
    keep = _rooted(nodes, bucket).groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    keyed = docs.select(whole_row(docs), *key)
    alone = keyed.join(keep.where("n = 1"), ["a", "b"], "left_semi").select("row")
    # By a struct rather than by the join's keys: equal rows then merge before they are dealt, so
    # AQE may split the join of a row that is most of the table.
    equal = keyed.join(keep.where("n > 1"), ["a", "b"], "left_semi").groupBy(
        F.struct("a", "b").alias("key")).agg(F.first("row").alias("row")).select("row")
    return unpack(alone.union(equal))
