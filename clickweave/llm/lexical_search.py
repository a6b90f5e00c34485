"""Ranked lexical search over bit-sliced Bloom signatures.

Every document is a column of a bit matrix, every row ("slice") a bit of the signatures of many
documents. A document sets HASHES bits for each of its terms, and again for each step of STEPS that
the term's number of occurrences reaches. Documents with about as many such elements share a matrix,
whose signatures have BITS bits an element at least. The slices of a term's bits, joined by AND, are
a bitmap over the documents: it may have a document too many, but never one too few. So

1. `build_index` writes the matrices and the documents' lengths, once, whatever is asked;
2. the weighted sums of a query's bitmaps, each step counting what one more occurrence up to the next
   step can add, are an upper bound of every document's score;
3. the documents with the highest bounds are scored exactly; the tenth best of these scores is one
   that the result must reach;
4. all documents whose bound reaches it are scored exactly, the others provably have no place.

Terms are told apart by 64-bit hashes. Queries are taken in blocks of at most about BLOCK_CHARS
characters, so that what is sent to the tasks is bounded.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import (
    NULL_ID,
    U64,
    bound_batches,
    checkpointed,
    freeing,
    id_key,
    parts,
    utf8,
)
from clickweave.llm.words import WORDS

TOP = 10
# Documents of the highest bounds that are scored to find the score to reach.
TRIED = 4 * TOP
HASHES, BITS = 8, 12
# Occurrences at which a term sets bits anew. Beyond the last step the length of the text is the bound.
STEPS = [1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 128, 256, 512, 1024, 4096, 16384]
LEAST_BITS = 64 * BITS
# Bits of a matrix, and documents of one, at most (but for one document of its own).
MATRIX_BITS, MATRIX_DOCS = 1 << 25, 1 << 9
# Bytes of text that Python looks at together.
PART_BYTES = 1 << 21
BLOCK_CHARS = 250_000
# Pairs of a document and a query up to which these are broadcast to the documents.
BROADCAST_PAIRS = 250_000

_INDEX = ("bits LONG NOT NULL, doc ARRAY<LONG> NOT NULL, hash ARRAY<LONG> NOT NULL, "
          "n ARRAY<LONG> NOT NULL, steps INT NOT NULL, slices BINARY NOT NULL")


def _elements(value: np.ndarray, step: int) -> np.ndarray:
    """The hash of a term at a step."""
    value = (value + U64((step + 1) * 0x9E3779B97F4A7C15 % 2**64)) * U64(0xBF58476D1CE4E5B9)
    value ^= value >> U64(29)
    return value * U64(0x94D049BB133111EB)


def _bits(elements: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each element, one row for each hash; `bits` is 3 times a power of two or one."""
    first, second = elements >> U64(32), elements & U64(0xFFFFFFFF) | U64(1)
    return np.stack([((first + U64(i) * second + U64(i * i)) % U64(bits)).astype(np.int64)
                     for i in range(HASHES)])


class _Matrices:
    """Signatures that wait to be written, by their number of bits."""

    def __init__(self):
        self.waiting: dict[int, list[tuple]] = {}

    def add(self, doc: int, text_hash: int, n: int, by_step: list[np.ndarray]) -> pa.RecordBatch | None:
        """Take a document; the matrix that is full with it, if any."""
        size = sum(map(len, by_step))
        bits = LEAST_BITS
        while bits < BITS * size:
            bits *= 2
        own = self.waiting.setdefault(bits, [])
        own.append((doc, text_hash, n, by_step))
        if len(own) < max(1, min(MATRIX_DOCS, MATRIX_BITS // bits)):
            return None
        return self.write(bits)

    def write(self, bits: int) -> pa.RecordBatch:
        rows = self.waiting.pop(bits)
        matrix = np.zeros((bits, len(rows)), bool)
        steps = 0
        for column, (*_, by_step) in enumerate(rows):
            steps = max(steps, len(by_step))
            for step, value in enumerate(by_step):
                matrix[_bits(_elements(value, step), bits).ravel(), column] = True
        longs = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array([bits], pa.int64()), *[pa.array([[r[i] for r in rows]], longs) for i in range(3)],
             pa.array([steps], pa.int32()),
             pa.array([np.packbits(matrix, axis=1).tobytes()], pa.binary())],
            ["bits", "doc", "hash", "n", "steps", "slices"])


def _terms_of(data: np.ndarray, starts: np.ndarray) -> tuple:
    """For each text and term of it, in order: the text, the term's hash, its occurrences; and all
    texts' lengths."""
    text, _, _, value = WORDS(data, starts)
    n = np.bincount(text, minlength=len(starts) - 1)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return text[at], value[at], np.diff(np.append(at, len(text))), n


@freeing
def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    matrices = _Matrices()
    for batch in batches:
        doc, text_hash = batch.column("doc").to_pylist(), batch.column("hash").to_pylist()
        data, starts = utf8(batch.column("text"))
        for begin, end in parts(starts, PART_BYTES):
            own = starts[begin:end + 1]
            text, value, often, n = _terms_of(data[own[0]:own[-1]], own - own[0])
            edges = np.searchsorted(text, np.arange(end - begin + 1))
            for i in np.flatnonzero(n):
                terms, times = value[edges[i]:edges[i + 1]], often[edges[i]:edges[i + 1]]
                most = times.max()
                by_step = [terms if step == 1 else terms[times >= step]
                           for step in STEPS if step <= most]
                full = matrices.add(doc[begin + i], text_hash[begin + i], int(n[i]), by_step)
                if full is not None:
                    yield full
    for bits in list(matrices.waiting):
        yield matrices.write(bits)


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents as doc (never null), hash of the text, text."""
    return docs.select(id_key(docs["doc_id"]).alias("doc"), docs["text"]).select(
        "doc", F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"), "text")


def build_index(docs: DataFrame) -> DataFrame:
    """The matrices of all documents that have a term, a row each, written to the shared folder.

    `bits` is the number of slices, `slices` their bytes in order; `doc`, `hash` and `n` are the
    documents' ids, the hashes of their texts and their lengths in terms, in the order of the bits of
    a slice; `steps` is how many of STEPS are found.
    """
    bound_batches(docs.sparkSession)
    return checkpointed(_keyed(docs).mapInArrow(_index, _INDEX))


@dataclass(frozen=True)
class _Queries:
    """A block of queries: their terms, and the weights of these in the documents at hand."""

    ids: list
    terms: list[np.ndarray]  # of each query, places in `vocabulary`
    vocabulary: np.ndarray  # hashes, sorted
    weight: np.ndarray
    documents: int
    length: int

    def penalty(self, n: np.ndarray) -> np.ndarray:
        # Python's whole numbers do not overflow, whatever the corpus.
        return np.array([10 + 90 * int(x) * self.documents // self.length for x in n], np.int64)


def _shares(times: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * times // np.maximum(1000 * times + 8 * penalty, 1)


def _places(vocabulary: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are in the vocabulary, and their places there."""
    if not len(vocabulary):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    place = np.minimum(np.searchsorted(vocabulary, value), len(vocabulary) - 1)
    found = np.flatnonzero(vocabulary[place] == value)
    return found, place[found]


def _read(rows: list) -> tuple[list, list[np.ndarray], np.ndarray]:
    """Ids of queries, their terms as places in a vocabulary, the vocabulary."""
    data, starts = utf8(pa.array([r.text for r in rows], pa.large_string()))
    text, value, _, _ = _terms_of(data, starts)
    vocabulary, place = np.unique(value, return_inverse=True)
    edges = np.searchsorted(text, np.arange(len(rows) + 1))
    return ([r.item_id for r in rows],
            [place[a:b] for a, b in zip(edges, edges[1:], strict=False)], vocabulary)


def _document_counts(docs: DataFrame, vocabulary: np.ndarray) -> np.ndarray:
    """For each term the documents that hold it."""
    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            data, starts = utf8(batch.column("text"))
            for begin, end in parts(starts, PART_BYTES):
                own = starts[begin:end + 1]
                text, _, _, value = WORDS(data[own[0]:own[-1]], own - own[0])
                found, place = _places(vocabulary, value)
                pairs = np.unique(text[found] * len(vocabulary) + place)
                count += np.bincount(pairs % len(vocabulary), minlength=len(vocabulary))
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(count[at])], ["term", "n"])

    out = np.zeros(len(vocabulary), np.int64)
    if len(vocabulary):
        counted = docs.select("text").mapInArrow(run, "term INT, n LONG")
        for term, n in counted.groupBy("term").agg(F.sum("n")).collect():
            out[term] = n
    return out


def _bounds(queries: _Queries, row: dict) -> np.ndarray:
    """Upper bounds of the scores, for each query and document of a matrix."""
    bits, n = row["bits"], np.array(row["n"], np.int64)
    slices = np.frombuffer(row["slices"], np.uint8).reshape(bits, -1)
    penalty = queries.penalty(n)
    out = np.zeros((len(queries.ids), len(n)), np.int64)
    present, terms = None, np.flatnonzero(queries.weight > 0)
    below = np.zeros(len(n), np.int64)
    for step in range(row["steps"]):
        at = _bits(_elements(queries.vocabulary[terms], step), bits)
        bitmap = slices[at[0]]
        for more in at[1:]:
            bitmap &= slices[more]
        # A step counts only for documents that have reached the one before.
        bitmap = bitmap if present is None else bitmap & present
        some = bitmap.any(1)
        terms, present = terms[some], bitmap[some]
        if not len(terms):
            break
        last = step + 1 == len(STEPS)
        most = np.maximum(n, STEPS[step]) if last else np.full(len(n), STEPS[step + 1] - 1)
        share = _shares(most, penalty)
        weighted = np.zeros((len(queries.vocabulary), len(n)), np.float32)
        weighted[terms] = (np.unpackbits(present, axis=1, count=len(n))
                           * queries.weight[terms, None].astype(np.float32))
        for i, own in enumerate(queries.terms):
            out[i] += weighted[own].sum(0, dtype=np.float64).astype(np.int64) * (share - below)
        below = share
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _pairs(query: np.ndarray, doc: np.ndarray, text_hash: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(query.astype(np.int32)), pa.array(doc), pa.array(text_hash)], ["query", "doc", "hash"])


_PAIRS = "query INT NOT NULL, doc LONG NOT NULL, hash LONG NOT NULL"


def _best_bounds(queries: _Queries, tried: int) -> Callable:
    """For each query the documents of a task with the highest bounds."""
    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = len(queries.ids)
        best = np.zeros((count, 0), np.int64)
        doc, text_hash = best.copy(), best.copy()
        for row in _rows(batches):
            bound = np.concatenate([best, _bounds(queries, row)], axis=1)
            doc = np.concatenate([doc, np.tile(np.array(row["doc"], np.int64), (count, 1))], axis=1)
            text_hash = np.concatenate(
                [text_hash, np.tile(np.array(row["hash"], np.int64), (count, 1))], axis=1)
            keep = np.argsort(-bound, axis=1, kind="stable")[:, :tried]
            best, doc, text_hash = (np.take_along_axis(x, keep, 1) for x in (bound, doc, text_hash))
        query, at = np.nonzero(best > 0)
        yield pa.RecordBatch.from_arrays(
            [*_pairs(query, doc[query, at], text_hash[query, at]).columns, pa.array(best[query, at])],
            ["query", "doc", "hash", "bound"])
    return run


def _reaching(queries: _Queries, least: np.ndarray) -> Callable:
    """The documents whose bound reaches the least score of a query."""
    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            query, at = np.nonzero(_bounds(queries, row) >= least[:, None])
            yield _pairs(query, np.array(row["doc"], np.int64)[at],
                         np.array(row["hash"], np.int64)[at])
    return run


def _scoring(queries: _Queries) -> Callable:
    """Exact scores of the queries asked of each document."""
    @freeing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column("queries")
            data, starts = utf8(batch.column("text"))
            for begin, end in parts(starts, PART_BYTES):
                own = starts[begin:end + 1]
                text, value, often, n = _terms_of(data[own[0]:own[-1]], own - own[0])
                found, place = _places(queries.vocabulary, value)
                of, times = text[found], often[found]
                part = queries.weight[place] * _shares(times, queries.penalty(n)[of])
                edges = np.searchsorted(of, np.arange(end - begin + 1))
                # What each term adds to the score of the document at hand.
                adds = np.zeros(len(queries.vocabulary), np.int64)
                query, score, row = [], [], []
                for i in range(end - begin):
                    mine = slice(edges[i], edges[i + 1])
                    adds[place[mine]] = part[mine]
                    for q in asked[begin + i].as_py():
                        total = int(adds[queries.terms[q]].sum())
                        if total > 0:
                            query.append(q)
                            score.append(total)
                            row.append(begin + i)
                    adds[place[mine]] = 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query, pa.int32()),
                     batch.column("doc").take(pa.array(row, pa.int64())),
                     pa.array(score, pa.int64())], ["query", "doc", "score"])
    return run


def _scored(docs: DataFrame, pairs: DataFrame, queries: _Queries, top: int) -> DataFrame:
    """query, doc, score, rank of the best documents of each query among the pairs."""
    asked = pairs.groupBy("doc", "hash").agg(F.collect_set("query").alias("queries"))
    if pairs.limit(BROADCAST_PAIRS + 1).count() <= BROADCAST_PAIRS:
        asked = F.broadcast(asked)
    scores = _keyed(docs).join(asked, ["doc", "hash"]).mapInArrow(
        _scoring(queries), "query INT, doc LONG, score LONG")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _search(docs: DataFrame, index: DataFrame, rows: list, documents: int, length: int,
            top: int) -> DataFrame:
    ids, terms, vocabulary = _read(rows)
    df = _document_counts(docs, vocabulary)
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(n) + 1)))
                       for n in df], np.int64)
    # A term that no document holds adds nothing, whatever its signature says.
    weight[df == 0] = 0
    queries = _Queries(ids, terms, vocabulary, weight, documents, length)
    order = Window.partitionBy("query").orderBy(F.desc("bound"), "doc", "hash")
    tried = (index.mapInArrow(_best_bounds(queries, TRIED), f"{_PAIRS}, bound LONG")
             .withColumn("place", F.row_number().over(order)).where(F.col("place") <= TRIED)
             .select("query", "doc", "hash"))
    reached = _scored(docs, checkpointed(tried), queries, top).where(F.col("rank") == top)
    least = np.ones(len(ids), np.int64)
    for query, score in reached.select("query", "score").collect():
        least[query] = score
    candidates = checkpointed(index.mapInArrow(_reaching(queries, least), _PAIRS))
    found = _scored(docs, candidates, queries, top)
    names = docs.sparkSession.createDataFrame(
        [(i, item) for i, item in enumerate(ids)], "query INT, item_id STRING")
    return found.join(F.broadcast(names), "query")


def search(docs: DataFrame, queries: DataFrame, top: int = TOP,
           block_chars: int = BLOCK_CHARS) -> DataFrame:
    """For each row of `queries` (item_id, text) the `top` best rows of `docs` (doc_id, text).

    Returns item_id, rank (from 1), doc_id and score, of scores above 0 only; equal scores go by
    doc_id, a null one first. Every row of `docs` is a document of its own, also one that is
    repeated or shares its id; every row of `queries` a query. A null or empty text has no terms and
    neither finds nor is found. Other columns are passed over. Empty tables give no rows.
    """
    index = build_index(docs)
    documents, length = index.select(F.explode("n").alias("n")).agg(F.count("n"), F.sum("n")).first()
    asked = queries.select(queries["item_id"].cast("string").alias("item_id"), queries["text"]).where(
        F.col("text").isNotNull())
    chars = asked.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(chars // block_chars) + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = []
    for number in range(blocks if documents else 0):
        rows = asked.where(block == number).collect()
        if rows:
            found.append(_search(docs, index, rows, documents, int(length), top))
    schema = "query INT, doc LONG, score LONG, rank INT, item_id STRING"
    out = reduce(DataFrame.unionByName, found) if found \
        else docs.sparkSession.createDataFrame([], schema)
    return out.select(F.col("item_id").cast(queries.schema["item_id"].dataType).alias("item_id"),
                      F.col("rank").cast("int").alias("rank"),
                      F.nullif(F.col("doc"), F.lit(NULL_ID)).alias("doc_id"), "score")


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The ten best documents of each benchmark item."""
    return search(docs.select("doc_id", "text"), benchmark)


_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE_SQL = rf"""
WITH doc_terms AS (
  SELECT row, doc_id, translate(unnest(regexp_extract_all(text, '{_WORD}')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT row_number() OVER () AS row, doc_id, text FROM documents)),
lengths AS (SELECT row, doc_id, count(*)::HUGEINT AS n FROM doc_terms GROUP BY ALL),
corpus AS (SELECT count(*)::HUGEINT AS docs, sum(n)::HUGEINT AS terms FROM lengths),
item_terms AS (SELECT DISTINCT item, item_id, translate(unnest(regexp_extract_all(text, '{_WORD}')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT row_number() OVER () AS item, item_id, text FROM benchmark)),
found AS (SELECT row, term, count(*)::HUGEINT AS tf FROM doc_terms
  WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL),
weights AS (SELECT term,
    floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::HUGEINT AS w
  FROM found, corpus GROUP BY term, docs),
scores AS (SELECT item, item_id, doc_id, row,
    sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS score
  FROM item_terms JOIN weights USING (term) JOIN found USING (term) JOIN lengths USING (row), corpus
  GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS rank
  FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM ranked WHERE rank <= 10
"""
