"""BPE encoding and decoding with the vocabulary of a tokenizers file.

The file is of the kind "BPE with word ends": text is normalised, split by a pattern, its bytes are
written as printable characters, the last one of a word with the word-end mark, and neighbouring
symbols merge by rank.

A word is a doubly linked list of symbols. Possible merges wait in a priority queue by (rank, place);
one whose symbols have changed meanwhile is stale and skipped. A word of n symbols takes n log n
steps. Decoding concatenates vocabulary strings with the file's decoder, none meaning a space between
them.
"""

from __future__ import annotations

import functools
import gc
import json
import unicodedata
from collections.abc import Callable
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import map_rows

# Words, and pieces between spaces, kept with their tokens: twice so many of each at most, and of so
# many characters.
KEPT, KEPT_CHARS = 3 << 15, 64
# Bits of the second token where a pair of tokens is one number.
PAIR = 20


def _byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or one from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    table = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}
    return [table[b] for b in range(256)]


def _pattern(text: str) -> regex.Pattern:
    # White space is that of Unicode, without the separators U+001C to U+001F.
    return regex.compile(text.replace(r"\s", r"\p{White_Space}"))


def _normalizer(spec: dict | None) -> Callable[[str], str]:
    if spec is None:
        return lambda text: text
    kind = spec["type"]
    if kind == "Sequence":
        steps = [_normalizer(s) for s in spec["normalizers"]]
        return lambda text: functools.reduce(lambda t, step: step(t), steps, text)
    if kind == "NFC":
        return lambda text: unicodedata.normalize("NFC", text)
    if kind == "Replace":
        pattern = _pattern(spec["pattern"]["Regex"])
        content = spec["content"].replace("\\", r"\\")
        return lambda text: pattern.sub(content, text)
    if kind == "Lowercase":
        # Character by character: a sigma at a word's end is no special case.
        return lambda text: text.replace("Σ", "σ").lower()
    raise ValueError(f"unknown normalizer {kind}")


class _Kept:
    """The results of a function, of recent arguments: those not used for a while are dropped."""

    def __init__(self, find: Callable[[str], tuple[int, ...]]):
        self.find = find
        self.young: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def __call__(self, text: str) -> tuple[int, ...]:
        found = self.young.get(text)
        if found is not None:
            return found
        found = self.old.get(text)
        if found is None:
            found = self.find(text)
            if len(text) > KEPT_CHARS:
                return found
        if len(self.young) >= KEPT:
            self.old, self.young = self.young, {}
        self.young[text] = found
        return found


class Tokenizer:
    """Encoder and decoder made from the JSON text of a tokenizers file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        if model["type"] != "BPE" or spec["decoder"] is not None or model["unk_token"] is not None:
            raise ValueError("only BPE without an unknown token and without a decoder is read")
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = self.vocab | self.special
        self.names = {i: name for name, i in names.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        # By the pair of tokens its rank, by the rank the token it becomes.
        self.ranks: dict[int, int] = {}
        self.merged: list[int] = []
        for rank, (a, b) in enumerate(pairs):
            self.ranks[self.vocab[a] << PAIR | self.vocab[b]] = rank
            self.merged.append(self.vocab[a + b])
        self.normalize = _normalizer(spec["normalizer"])
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if [s["type"] for s in steps] != ["Split", "ByteLevel"]:
            raise ValueError("unknown pre-tokenizer")
        self.word = _pattern(steps[0]["pattern"]["Regex"])
        # The pattern takes a run of letters whole: such a piece need not be searched.
        self.letters_are_words = r"|[\p{L}]+|" in steps[0]["pattern"]["Regex"]
        symbols = _byte_symbols()
        # The tokens of each byte, within a word and at its end.
        self.inner = [self.vocab[s] for s in symbols]
        self.last = [self.vocab[s + self.end] for s in symbols]
        longest = sorted(self.special, key=len, reverse=True)
        self.special_text = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")")
        self.word_tokens = _Kept(self.merge)
        self.piece_tokens = _Kept(self._piece)

    def merge(self, word: str) -> tuple[int, ...]:
        """The tokens of one word."""
        symbols = word.encode()
        inner, rank_of = self.inner, self.ranks.get
        ids = [inner[b] for b in symbols]
        ids[-1] = self.last[symbols[-1]]
        n = len(ids)
        # The rank of each symbol with the next one: what the queue has of it is stale if not that.
        ranks = [rank_of(a << PAIR | b, -1) for a, b in zip(ids, ids[1:], strict=False)]
        ranks.append(-1)
        # A merge waits as one number: its rank, then its place.
        bits = n.bit_length()
        places = (1 << bits) - 1
        queue = [r << bits | i for i, r in enumerate(ranks) if r >= 0]
        heapify(queue)
        merged, before, after = self.merged, list(range(-1, n - 1)), list(range(1, n + 1))
        while queue:
            top = heappop(queue)
            left, rank = top & places, top >> bits
            if ranks[left] != rank:
                continue
            right = after[left]
            new = ids[left] = merged[rank]
            ids[right] = ranks[right] = ranks[left] = -1
            following = after[left] = after[right]
            if following < n:
                before[following] = left
                rank = rank_of(new << PAIR | ids[following])
                if rank is not None:
                    ranks[left] = rank
                    heappush(queue, rank << bits | left)
            previous = before[left]
            if previous >= 0:
                rank = ranks[previous] = rank_of(ids[previous] << PAIR | new, -1)
                if rank >= 0:
                    heappush(queue, rank << bits | previous)
        return tuple([i for i in ids if i >= 0])

    def _piece(self, piece: str) -> tuple[int, ...]:
        """The tokens of a piece without white space."""
        if self.letters_are_words and piece.isalpha():
            return self.word_tokens(piece)
        words = self.word.findall(piece)
        return tuple([i for word in words for i in self.word_tokens(word)])

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        recent, find = self.piece_tokens.young, self.piece_tokens
        for number, part in enumerate(self.special_text.split(text)):
            if number % 2:
                ids.append(self.special[part])
                continue
            # No word of the pattern holds a space, so pieces can be looked up by themselves.
            for piece in self.normalize(part).split(" "):
                found = recent.get(piece)
                if found is None:
                    if not piece:
                        continue
                    found = find(piece)
                    recent = find.young
                ids += found
        return ids

    def decode(self, ids: list[int]) -> str:
        names = self.names
        return " ".join([names[i] for i in ids])


@functools.lru_cache(maxsize=2)
def _tokenizer(text: str) -> Tokenizer:
    """One for each task: its kept pieces serve all batches."""
    return Tokenizer(text)


def _forget() -> None:
    _tokenizer.cache_clear()
    gc.collect()


def encode_decode(docs: DataFrame, path: str, keep: list[str] | None = None) -> DataFrame:
    """Every row of `docs` with `ids`, the tokens of its text, and `decoded`, the text of these.

    `path` names a tokenizers file that the driver can read; its text is sent to the tasks and is
    bounded by the vocabulary. No special tokens are added, but those in a text are found. A null
    text is empty. Input columns named like an added one are replaced by it; `keep` names the input
    columns to return.
    """
    with open(path, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())

    def outcome(batch: pa.RecordBatch) -> list[pa.Array]:
        tokenizer = _tokenizer(spec.value)
        rows = [tokenizer.encode(t.as_py() or "") for t in batch.column("text")]
        ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
        flat = np.fromiter(chain.from_iterable(rows), np.int32, int(ends[-1]))
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                pa.array([tokenizer.decode(row) for row in rows], pa.string())]

    return map_rows(docs, {"text": docs["text"]}, "ids ARRAY<INT>, decoded STRING", outcome, keep,
                    _forget)


def digests(encoded: DataFrame) -> dict:
    """Columns of the digests of `ids` and `decoded`."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return {"n_tokens": F.size("ids").cast("long"), "ids_sha256": F.sha2(ids.cast("binary"), 256),
            "decoded_sha256": F.sha2(F.col("decoded").cast("binary"), 256)}


def report(docs: DataFrame, path: str) -> DataFrame:
    """The digests of `encode_decode` per document."""
    encoded = encode_decode(docs.select("doc_id", "text"), path, ["doc_id"])
    return encoded.select("doc_id", *[c.alias(n) for n, c in digests(encoded).items()])
