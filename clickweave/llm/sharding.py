"""Uniform shuffle of rows into shards of exact sizes, with built-in functions only.

1. Rows are dealt to partitions by a hash; one count per partition is all that is gathered. Of a row
   that is there very often the copies are dealt by the part of the input they stand in as well.
2. How many rows of each partition go to each shard is drawn from the hypergeometric law: a shard
   draws from what the partitions before left of its size. The partitions are drawn in two levels,
   first groups of them, then each group's own, so that no row of the plan holds more than about
   the square root of their number.
3. Each partition puts its rows in random order and gives the first to shard 0, the next to shard 1
   and so on, by those counts.
4. Rows go to their shards. Each has a place there by its partition and order; a keyed permutation
   of the shard's places (a Feistel network, walked until the place exists) then makes the order
   uniform without sorting a whole shard.

Draws and permutations depend on `seed` and the data alone, so a task that runs again, or a lost
executor, changes nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHARDS, SEED = 16, 7
# Partitions of step 1 for each shuffle partition: small ones even out.
FINER = 8
ROUNDS, WALK = 4, 8
# Copies of a row beyond which they are dealt apart, and keys of such rows sent to all tasks at most.
HEAVY, BROADCAST_KEYS = 10_000, 1_000_000
# A draw is sought this many standard deviations about the mode, and so many counts.
REACH = 12.0


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with `value` evaluated once."""
    return F.transform(F.array(value), use)[0]


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _uniform(*keys: Column) -> Column:
    """A number between 0 and 1, ends excluded, that the keys decide."""
    return (F.shiftrightunsigned(F.xxhash64(*keys), 11) + 0.5) * F.lit(2.0**-53)


def _hypergeometric(u: Column, pool: Column, good: Column, draws: Column) -> Column:
    """How many of `draws` from a pool are good ones: the inverse of the distribution at `u`."""
    def ratio(k: Column) -> Column:
        """The probability of k over that of k - 1."""
        return ((good - k + 1).cast("double") * (draws - k + 1)
                / (k.cast("double") * (pool - good - draws + k)))

    share = good / pool
    spread = F.sqrt(draws * share * (1 - share) * (pool - draws) / F.greatest(
        pool - 1, _long(1)))
    mode = F.floor((draws + 1).cast("double") * (good + 1) / (pool + 2))
    span = F.ceil(spread * REACH + REACH)
    low = F.greatest(_long(0), draws + good - pool, mode - span)
    high = F.least(draws, good, mode + span)

    def search(low: Column, high: Column) -> Column:
        start = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"))
        total = F.aggregate(F.sequence(low + 1, high), start, lambda acc, k: let(
            acc["w"] * ratio(k), lambda w: F.struct(w.alias("w"), (acc["sum"] + w).alias("sum"))),
            lambda acc: acc["sum"])
        begin = F.struct(F.lit(1.0).alias("w"), F.lit(1.0).alias("sum"), low.alias("x"))
        return let(total * u, lambda goal: F.aggregate(
            F.sequence(low + 1, high), begin, lambda acc, k: let(
                acc["w"] * ratio(k), lambda w: F.struct(
                    w.alias("w"), (acc["sum"] + w).alias("sum"),
                    F.when(goal >= acc["sum"], k).otherwise(acc["x"]).alias("x"))),
            lambda acc: acc["x"]))

    return F.when(pool <= 0, _long(0)).otherwise(let(
        F.struct(low.alias("low"), high.alias("high")),
        lambda r: F.when(r["low"] >= r["high"], r["high"]).otherwise(search(r["low"], r["high"]))))


def _draw(sizes: Column, draws: Column, *keys: Column) -> Column:
    """A random part of `draws` of the places that `sizes` counts: as many of each, an array."""
    start = F.struct(draws.alias("left"), F.aggregate(sizes, _long(0), lambda a, s: a + s).alias(
        "pool"), F.array().cast("array<long>").alias("out"))
    return F.aggregate(
        sizes, start, lambda acc, size: let(
            _hypergeometric(_uniform(*keys, F.size(acc["out"])), acc["pool"], size, acc["left"]),
            lambda x: F.struct((acc["left"] - x).alias("left"), (acc["pool"] - size).alias("pool"),
                               F.concat(acc["out"], F.array(x)).alias("out"))),
        lambda acc: acc["out"])


def _deal(sizes: Column, starts: Column, counts: Column, *keys: Column) -> Column:
    """For each of `counts` in turn: where its rows start in each shard, and how many it has there."""
    none = F.array().cast("array<struct<start: array<long>, take: array<long>>>")
    begin = F.struct(sizes.alias("free"), starts.alias("start"), none.alias("out"))
    return F.aggregate(
        counts, begin, lambda acc, n: let(
            _draw(acc["free"], n, *keys, F.size(acc["out"])), lambda take: F.struct(
                F.zip_with(acc["free"], take, lambda a, b: a - b).alias("free"),
                F.zip_with(acc["start"], take, lambda a, b: a + b).alias("start"),
                F.concat(acc["out"], F.array(F.struct(
                    acc["start"].alias("start"), take.alias("take")))).alias("out"))),
        lambda acc: acc["out"])


def communication_matrix(counts: DataFrame, parts: int, shards: int = SHARDS,
                         seed: int = SEED) -> DataFrame:
    """(part, sizes, start, take) of `counts` (part, n), which has a row for each part at most.

    `sizes` holds the rows of each shard, at most one apart; `take` how many of them are this part's;
    `start` the first of their places in the shard.
    """
    group = max(1, math.isqrt(parts))
    session = counts.sparkSession
    all_parts = session.range(parts).select(F.col("id").alias("part"))
    every = (all_parts.join(counts, "part", "left")
             .select("part", F.floor(F.col("part") / group).alias("group"),
                     F.coalesce("n", _long(0)).alias("n")))
    # Both lists are about the square root of the number of parts long.
    groups = every.groupBy("group").agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("part", "n"))).alias("own"))
    root = groups.agg(F.sum("n").alias("total"),
                      F.sort_array(F.collect_list(F.struct("group", "n"))).alias("groups"))
    sizes = F.transform(F.sequence(_long(0), _long(shards - 1)), lambda j: F.floor(
        F.col("total") / shards) + F.when(j < F.col("total") % shards, 1).otherwise(0))
    zeros = F.array_repeat(_long(0), shards)
    top = root.select("groups", sizes.alias("sizes")).select("sizes", F.posexplode(_deal(
        F.col("sizes"), zeros, F.transform("groups", lambda g: g["n"]), F.lit(seed), F.lit("groups")
    )).alias("group", "dealt"))
    own = top.join(groups, "group").select("sizes", "own", F.posexplode(_deal(
        F.col("dealt.take"), F.col("dealt.start"), F.transform("own", lambda p: p["n"]), F.lit(seed),
        F.col("group"))).alias("at", "dealt"))
    return own.select(F.col("own")[F.col("at")]["part"].alias("part"), "sizes",
                      "dealt.start", "dealt.take")


def _round(right: int, rows: Column, columns: Column, *keys: Column) -> Callable[[Column], Column]:
    """One side of the grid's place moves by a hash of the other."""
    def move(p: Column) -> Column:
        side, other, size = ("r", "l", columns) if right else ("l", "r", rows)
        moved = ((p[side] + F.pmod(F.xxhash64(*keys, p[other]), size)) % size).alias(side)
        return F.struct(p["l"], moved) if right else F.struct(moved, p["r"])
    return move


def permuted(place: Column, size: Column, *keys: Column) -> Column:
    """Where a keyed permutation of the numbers below `size` puts `place`."""
    def once(x: Column, rows: Column, columns: Column) -> Column:
        out = F.struct(F.floor(x / columns).alias("l"), (x % columns).alias("r"))
        for number in range(ROUNDS):
            out = let(out, _round(number % 2, rows, columns, *keys, F.lit(number)))
        return let(out, lambda p: p["l"] * columns + p["r"])

    columns = F.ceil(F.sqrt(size.cast("double")))
    grid = F.struct(F.ceil(size / columns).alias("rows"), columns.alias("columns"))
    # The walk leaves the places that the grid has too many at once, as a rule, and always does
    # after so many steps as they are: it comes to each of them once at most.
    def walk(x: Column, steps: Column, g: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1).cast("long"), steps), x, lambda y, step: F.when(
            y >= size, once(y, g["rows"], g["columns"])).otherwise(y))

    return let(grid, lambda g: let(
        walk(once(place, g["rows"], g["columns"]), _long(WALK), g), lambda x: F.when(
            x < size, x).otherwise(walk(x, g["rows"] * g["columns"] - size + 1, g))))


def shuffle_to_shards(docs: DataFrame, by: list[str], shards: int = SHARDS,
                      seed: int = SEED) -> DataFrame:
    """Every row of `docs` with its `shard` and `slot`, dealt to its shard in that order.

    Shards differ by one row at most, slots are gapless from 0, and every order is equally likely.
    `by` names columns that tell rows apart (an id and a text): rows equal in them are
    interchangeable, so they may be null or repeated. Where more than HEAVY rows are equal the result
    depends on how the input is cut as well. Input columns named `shard` or `slot` are replaced. No rows give no rows.
    """
    session = docs.sparkSession
    shuffles = int(session.conf.get("spark.sql.shuffle.partitions"))
    parts = FINER * shuffles
    keys = [docs[f"`{name}`"] for name in by]
    whole = F.struct(*[docs[f"`{name}`"] for name in docs.columns]).alias("row")
    key = F.xxhash64(F.lit(seed), F.lit("part"), *keys)
    heavy = docs.select(key.alias("key")).groupBy("key").agg(F.count("*").alias("n")).where(
        F.col("n") > HEAVY).select("key", F.lit(True).alias("heavy"))
    if heavy.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        heavy = F.broadcast(heavy)
    piece = F.when(F.col("heavy"), F.xxhash64("key", "piece")).otherwise(F.col("key"))
    dealt = docs.select(
        whole, key.alias("key"), F.spark_partition_id().alias("piece")).join(
        heavy, "key", "left").select("row", "key", F.pmod(piece, _long(parts)).alias("part"))
    matrix = communication_matrix(dealt.groupBy("part").agg(F.count("*").alias("n")),
                                  parts, shards, seed)
    # Equal rows are numbered, so that each has a random place of its own. Dealt by the part before:
    # by part and key they would be shuffled once more.
    equal = F.row_number().over(Window.partitionBy("part", "key").orderBy("key"))
    order = Window.partitionBy("part").orderBy("random", "key", "equal")
    ordered = (dealt.repartition("part").withColumn("equal", equal)
               .withColumn("random", F.xxhash64(F.lit(seed), F.lit("order"), "part", "key", "equal"))
               .withColumn("at", F.row_number().over(order).cast("long") - 1))
    # The shard whose share of the partition's order holds this row, and the place in that share.
    found = F.aggregate(
        "take", F.struct(_long(0).alias("shard"), F.col("at").alias("rest"),
                         F.lit(False).alias("done")),
        lambda acc, n: F.when(acc["done"] | (acc["rest"] < n), F.struct(
            acc["shard"], acc["rest"], F.lit(True).alias("done"))).otherwise(F.struct(
                (acc["shard"] + 1).alias("shard"), (acc["rest"] - n).alias("rest"),
                F.lit(False).alias("done"))))
    shard = F.col("found.shard").cast("int")
    size = F.col("sizes")[shard]
    placed = ordered.join(matrix, "part").withColumn("found", found).select(
        "row", shard.alias("shard"), size.alias("size"), permuted(
            F.col("start")[shard] + F.col("found.rest"), size, F.lit(seed), shard).alias("slot"))
    # A shard is cut in blocks of neighbouring slots, so that it is not one task.
    blocks = max(1, -(-4 * shuffles // shards))
    block = F.floor(F.col("slot") * blocks / F.col("size"))
    kept = [n for n in docs.columns if n.lower() not in ("shard", "slot")]
    return (placed.withColumn("block", block).repartition("shard", "block")
            .sortWithinPartitions("shard", "slot")
            .select(*[F.col("row")[n].alias(n) for n in kept], "shard", "slot"))


def report(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of `docs`."""
    dealt = shuffle_to_shards(docs.select("doc_id", "text"), ["doc_id", "text"], shards, seed)
    text = F.coalesce("text", F.lit(""))
    return dealt.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                        F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
                        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
