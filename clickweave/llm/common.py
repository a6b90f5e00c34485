"""What the operators share: rows kept whole, Arrow text as bytes, hashes of all windows of a text."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickweave.session import work_folder

NULL_ID = -(2**63)

BATCH_BYTES = 1 << 21
ARROW_BYTES = 1 << 23

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder, its lineage cut; survives the loss of executors."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(work_folder(df.sparkSession, "checkpoints"))
    return df.checkpoint()


def id_key(column: Column) -> Column:
    """An id as a long that is never null, so that joins need no filter; null comes first."""
    return F.coalesce(column.cast("long"), F.lit(NULL_ID))


def whole_row(df: DataFrame, keep: list[str] | None = None) -> Column:
    """All (or some) columns as one struct `row`: its fields cannot clash with an operator's."""
    return F.struct(*[df[f"`{name}`"] for name in keep or df.columns]).alias("row")


def unpack(df: DataFrame, *added: str) -> DataFrame:
    """The fields of `row`, then the added columns; these replace input columns of the same name."""
    new = {name.lower() for name in added}
    kept = [f.name for f in df.schema["row"].dataType.fields if f.name.lower() not in new]
    return df.select(*[F.col("row")[name].alias(name) for name in kept], *added)


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of the session hold ARROW_BYTES at most, so Python workers do as well."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"\s*(-?\d+)\s*([kmgtp]?)b?\s*", str(spark.conf.get(name)).lower()).groups()
    now = int(number) << 10 * " kmgtp".index(unit or " ")
    if not 0 < now <= ARROW_BYTES:
        spark.conf.set(name, f"{ARROW_BYTES}b")


def freeing(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task's function that hands its memory back at the end.

    A Python worker goes on to other tasks or waits; neither Arrow nor the C library would return
    what the largest batch took.
    """
    def freed(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)
    return freed


def map_rows(df: DataFrame, columns: dict[str, Column], schema: str,
             outcome: Callable[[pa.RecordBatch], list[pa.Array]],
             keep: list[str] | None = None,
             done: Callable[[], None] = lambda: None) -> DataFrame:
    """Every row of `df` with columns that Python finds from the Arrow batches of `columns`.

    `keep` names the columns of `df` to return, all of them by default. `done` is called at the end
    of each task, whose Python worker goes on to others.
    """
    bound_batches(df.sparkSession)
    inner = df.select(whole_row(df, keep), *[c.alias(f"in_{name}") for name, c in columns.items()])
    added = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    out = T.StructType([inner.schema["row"], *added.fields])
    given_names, names = list(columns), ["row", *added.names]

    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for whole in batches:
                # Python holds what it makes of so many bytes at a time, or of one row.
                rows = max(1, whole.num_rows * BATCH_BYTES // max(1, whole.nbytes))
                for batch in (whole.slice(i, rows) for i in range(0, whole.num_rows, rows)):
                    given = pa.RecordBatch.from_arrays(batch.columns[1:], given_names)
                    yield pa.RecordBatch.from_arrays([batch.column(0), *outcome(given)], names)
        finally:
            done()

    return unpack(inner.mapInArrow(run, out), *added.names)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts of an Arrow column in a row, and where each begins (and the last ends).

    A null counts as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(
        column.type) else np.int32
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset:column.offset + len(column) + 1].astype(
        np.int64) if len(column) else np.zeros(1, np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def parts(starts: np.ndarray, size: int) -> Iterator[tuple[int, int]]:
    """The texts of a batch in runs of about `size` bytes, each of one text at least."""
    begin, count = 0, len(starts) - 1
    while begin < count:
        end = max(begin + 1, int(np.searchsorted(starts, starts[begin] + size)) - 1)
        yield begin, min(end, count)
        begin = min(end, count)


class Words:
    """The words of many texts as 64-bit hashes, found bytewise for all texts at once."""

    def __init__(self, is_word: np.ndarray, fold: np.ndarray, hashes: Hashes):
        """`is_word` and `fold`: for each byte, whether words have it and what it stands for."""
        self.is_word, self.symbols = is_word, hashes.symbols[fold]

    def __call__(self, data: np.ndarray, starts: np.ndarray) -> tuple:
        """For each word: its text, first byte, end and hash."""
        inside = self.is_word[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        heads = starts[:-1][starts[:-1] < starts[1:]]
        first[heads] = inside[heads]
        begin = np.flatnonzero(first)
        if not len(begin):
            none = np.zeros(0, np.int64)
            return none, none, none, np.zeros(0, U64)
        text = np.searchsorted(starts, begin, "right") - 1
        # A word's bytes are the word bytes up to the next word.
        kind = np.int32 if len(data) < 2**31 else np.int64
        count = np.append(np.cumsum(inside, dtype=kind)[begin[1:] - 1],
                          kind(np.count_nonzero(inside)))
        length = np.diff(count, prepend=kind(0))
        place = np.arange(count[-1], dtype=kind) - np.repeat(count - length, length)
        powers = np.full(int(length.max()), 0x9E3779B97F4A7C15, U64)
        powers[0] = 1
        value = np.add.reduceat(self.symbols[data[inside]] * np.cumprod(powers)[place],
                                count - length)
        value = (value ^ value >> U64(32)) * U64(0xC2B2AE3D27D4EB4F) + length.astype(U64)
        return text, begin, begin + length, value ^ value >> U64(29)


class Hashes:
    """64-bit hashes of every window of given lengths of a byte (or word hash) sequence.

    A hash of n symbols is made from those of two parts, so a window of 100 takes eight steps over
    the whole sequence. Each sum is folded, so that the high bits reach the low ones.
    """

    def __init__(self, seed: int):
        self.seed = seed
        self.symbols = np.random.default_rng(seed).integers(0, 2**64, 256, U64)
        self._factors: dict[tuple[int, int], tuple[np.uint64, np.uint64]] = {}

    def _join(self, left: np.ndarray, n: int, right: np.ndarray, m: int) -> np.ndarray:
        if (n, m) not in self._factors:
            pair = np.random.default_rng([self.seed, n, m]).integers(0, 2**64, 2, U64) | U64(1)
            self._factors[n, m] = pair[0], pair[1]
        a, b = self._factors[n, m]
        size = max(0, left.shape[-1] - m)
        out = left[..., :size] * a
        out += right[..., n:n + size] * b
        out ^= out >> U64(29)
        return out

    def windows(self, first: np.ndarray, *lengths: int) -> list[np.ndarray]:
        """For each length, the hash at every start. `first`: the hashes of single symbols."""
        powers, size = {1: first}, 1
        while size * 2 <= max(lengths):
            powers[2 * size] = self._join(powers[size], size, powers[size], size)
            size *= 2
        found = []
        for length in lengths:
            done, value = 0, None
            for bit in sorted((p for p in powers if length & p), reverse=True):
                value = powers[bit] if value is None else self._join(value, done, powers[bit], bit)
                done += bit
            found.append(value)
        return found


def window_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least value of every `width` neighbours."""
    size, out = 1, values
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return np.minimum(out[:-rest], out[rest:]) if rest else out
