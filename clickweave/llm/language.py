"""Language of documents whose parts may differ in language.

Each word has a score per language, learned from labelled texts: the log-probabilities of its byte
3-grams and of the word as a whole. The script of a word, told by ranges of its first letter,
narrows the languages to those that use the script. Viterbi then labels the words of a text: going
to another language costs SWITCH, so a text falls into few spans. The language with most letters in
its spans is the prediction, its share of the letters the score.

Every labelled language is learned, each from about as many documents: a rare one is not lost among
the others. Counts are kept for hashed n-grams, in a table of bounded size: the more languages, the
fewer hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import (
    BATCH_BYTES,
    U64,
    Hashes,
    Words,
    bound_batches,
    freeing,
    map_rows,
    parts,
    utf8,
)

# At most about so many labelled documents are learned from, chosen by a hash of their id.
LEARN_DOCS = 20_000
# Bits of a hashed n-gram at most, and entries of the table sent to all tasks (but for a few bits each).
GRAM_BITS, TABLE_ENTRIES, LEAST_BITS = 15, 1 << 24, 8
SWITCH = 12.0
# A word says at most so much against a language.
MOST = 8.0
# A language is a candidate in a script if it has this share of its words there.
SCRIPT_SHARE = 0.01
# Bytes of text for which paths are kept at a time, times the number of languages.
PATH_BYTES = 1 << 24
# So many of the longest texts are followed by a plain loop once the others have ended.
FEW = 8

UNKNOWN = "und"

# Scripts by the first byte of a letter's UTF-8 form, from Unicode's block ranges.
SCRIPT_RANGES = [("latin", 0x00, 0x7F), ("latin", 0xC2, 0xCA), ("modifier", 0xCB, 0xCC),
                 ("greek", 0xCD, 0xCF), ("cyrillic", 0xD0, 0xD4), ("armenian", 0xD5, 0xD5),
                 ("hebrew", 0xD6, 0xD7), ("arabic", 0xD8, 0xDB), ("syriac", 0xDC, 0xDF),
                 ("indic", 0xE0, 0xE0), ("asian", 0xE1, 0xE1), ("sign", 0xE2, 0xE2),
                 ("kana", 0xE3, 0xE3), ("han", 0xE4, 0xE9), ("hangul", 0xEA, 0xED),
                 ("other", 0xEE, 0xFF)]

SCRIPTS = list(dict.fromkeys(name for name, _, _ in SCRIPT_RANGES))

HASHES = Hashes(404)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each byte: whether words have it, its lower case (ASCII), the script of a word's first."""
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    is_word = np.zeros(256, bool)
    is_word[65:91] = is_word[97:123] = is_word[128:] = True
    script = np.zeros(256, np.int64)
    for name, low, high in SCRIPT_RANGES:
        script[low:high + 1] = SCRIPTS.index(name)
    return is_word, fold, script


IS_WORD, FOLD, SCRIPT = _tables()
WORDS = Words(IS_WORD, FOLD, HASHES)


def gram_bits(languages: int) -> int:
    """Bits of a hashed n-gram, of which a row of counts has two kinds, where so many rows are."""
    fit = (TABLE_ENTRIES // max(1, 2 * languages)).bit_length() - 1
    return max(LEAST_BITS, min(GRAM_BITS, fit))


def columns(bits: int) -> int:
    """Of a row of counts: hashed 3-grams, hashed words, scripts of words."""
    return (2 << bits) + len(SCRIPTS)


@dataclass
class _Text:
    """The words of a batch; `kind` numbers the different ones, whose features stand in a row."""

    text: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    kind: np.ndarray
    features: np.ndarray
    first: np.ndarray
    script: np.ndarray


def _read(data: np.ndarray, starts: np.ndarray, bits: int = GRAM_BITS) -> _Text:
    text, begin, end, value = WORDS(data, starts)
    unique, at, kind = np.unique(value, return_index=True, return_inverse=True)
    # The letters of each different word between spaces, all in a row.
    size = end[at] - begin[at]
    total = int(size.sum())
    offset = np.cumsum(size) - size
    place = np.repeat(begin[at] - offset, size) + np.arange(total)
    spaced = np.full(total + len(at) + 1, 32, np.uint8)
    word = np.repeat(np.arange(len(at)), size)
    spaced[np.arange(total) + word + 1] = FOLD[data[place]]
    grams = HASHES.windows(HASHES.symbols[spaced], 3)[0] if total else np.zeros(0, U64)
    # A word of n bytes between spaces has n 3-grams; those across two words are passed over.
    features = (grams[np.arange(total) + word] >> U64(64 - bits)).astype(np.int64)
    whole = (unique >> U64(64 - bits)).astype(np.int64) + (1 << bits)
    features = np.insert(features, offset, whole) if len(at) else features
    return _Text(text, begin, end, kind, features, offset + np.arange(len(at)),
                 SCRIPT[data[begin[at]]])


def _has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


@dataclass(frozen=True)
class Model:
    languages: list[str]
    # Log-probabilities by feature and language, and whether a language is a candidate in a script.
    scores: np.ndarray
    candidates: np.ndarray
    bits: int = GRAM_BITS

    def word_scores(self, words: _Text) -> np.ndarray:
        """For each different word and language, at most 0 and at least -MOST."""
        total = np.add.reduceat(self.scores[words.features], words.first)
        total = np.where(self.candidates[words.script], total, -np.inf)
        best = total.max(1, keepdims=True)
        return np.where(np.isfinite(best), np.maximum(total - best, -MOST), 0)

    def label(self, words: _Text, texts: int) -> np.ndarray:
        """The language of every word, such that scores less switches are greatest in each text."""
        score = self.word_scores(words)
        kind, n_lang = words.kind, len(self.languages)
        count = np.bincount(words.text, minlength=texts)
        start = np.cumsum(count) - count
        order = np.argsort(-count, kind="stable")
        count, start = count[order], start[order]
        alive = np.searchsorted(-count, -np.arange(int(count.max()) + 1), "left")
        # alive[t]: how many of the texts in order have a word t.
        together = int(count[FEW]) if texts > FEW else 0
        value = np.zeros((texts, n_lang))
        # Where a language comes from: the best one before, or (-1) itself.
        source = np.full((len(kind), n_lang), -1, np.int16)
        for t in range(together):
            n = alive[t]
            own = value[:n]
            best = own.argmax(1)
            top = own[np.arange(n), best] - SWITCH
            at = start[:n] + t
            if t:
                source[at] = np.where(own >= top[:, None], -1, best[:, None])
                own = np.maximum(own, top[:, None])
            value[:n] = own + score[kind[at]]
        for i in range(min(FEW, texts)):
            value[i] = self._follow(score, kind, source, value[i], start[i], together, count[i])
        label = np.zeros(len(kind), np.int16)
        now = value.argmax(1)
        for i in range(min(FEW, texts)):
            state = int(now[i])
            own = slice(start[i] + together, start[i] + count[i])
            marks, out = source[own].tolist(), []
            for mark in reversed(marks):
                out.append(state)
                if mark[state] >= 0:
                    state = mark[state]
            label[own] = out[::-1]
            now[i] = state
        for t in range(together - 1, -1, -1):
            n = alive[t]
            at = start[:n] + t
            label[at] = now[:n]
            mark = source[at, now[:n]]
            now[:n] = np.where(mark >= 0, mark, now[:n])
        return label

    @staticmethod
    def _follow(score: np.ndarray, kind: np.ndarray, source: np.ndarray, value: np.ndarray,
                start: int, done: int, count: int) -> np.ndarray:
        """The rest of one text, word by word."""
        now = value.tolist()
        for begin in range(done, count, 1 << 16):
            own = slice(start + begin, start + min(count, begin + (1 << 16)))
            marks = []
            for n, given in enumerate(score[kind[own]].tolist()):
                if begin + n:
                    top = max(now)
                    best = now.index(top)
                    top -= SWITCH
                    marks.append([-1 if v >= top else best for v in now])
                    now = [(v if v >= top else top) + g for v, g in zip(now, given, strict=True)]
                else:
                    marks.append([-1] * len(now))
                    now = [v + g for v, g in zip(now, given, strict=True)]
            source[own] = marks
        return np.array(now)

    def predict(self, column: pa.Array) -> list[pa.Array]:
        """lang_pred, score and spans of all texts, of so many at a time as memory holds paths for."""
        _, starts = utf8(column)
        cut = parts(starts, PATH_BYTES // max(1, len(self.languages)))
        found = [self._predict(column.slice(a, b - a)) for a, b in cut] or [self._predict(column)]
        return [pa.concat_arrays(arrays) for arrays in zip(*found, strict=True)]

    def _predict(self, column: pa.Array) -> list[pa.Array]:
        data, starts = utf8(column)
        texts = len(column)
        name, score, spans = [UNKNOWN] * texts, np.zeros(texts), [[] for _ in range(texts)]
        words = _read(data, starts, self.bits)
        if len(words.text) and self.languages:
            label = self.label(words, texts).astype(np.int64)
            n_lang = len(self.languages)
            letters = np.bincount(words.text * n_lang + label, words.end - words.begin,
                                  texts * n_lang).reshape(texts, n_lang)
            best = letters.argmax(1)
            total = letters.sum(1)
            share = letters[np.arange(texts), best] / np.maximum(total, 1)
            ascii_letter = np.zeros(256, bool)
            ascii_letter[65:91] = ascii_letter[97:123] = True
            running = np.concatenate(([0], np.cumsum(ascii_letter[data])))
            sure = running[starts[1:]] > running[starts[:-1]]
            for i in np.flatnonzero(total):
                if sure[i] or _has_letter(column[int(i)].as_py()):
                    name[i], score[i] = self.languages[best[i]], share[i]
            new = np.concatenate(([True], (words.text[1:] != words.text[:-1])
                                  | (label[1:] != label[:-1])))
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(label)) - 1
            for a, b in zip(first, last, strict=True):
                i = words.text[a]
                if name[i] != UNKNOWN:
                    spans[i].append({"lang": self.languages[label[a]],
                                     "start": int(words.begin[a] - starts[i]),
                                     "end": int(words.end[b] - starts[i])})
        return [pa.array(name), pa.array(score, pa.float64()), pa.array(spans, _SPANS)]


_SPANS = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def learn(labelled: DataFrame, learn_docs: int = LEARN_DOCS) -> Model:
    """A model from rows with doc_id, text and lang; rows without text or lang are passed over.

    Learns from about `learn_docs` of them, an equal quota for each language, chosen by a hash of
    doc_id; what a rare language leaves of its quota goes to the others. Counts are summed in the
    cluster; the driver gets a number of documents for each language, and the counts, of which there
    are about TABLE_ENTRIES at most.
    """
    rows = labelled.select(labelled["doc_id"].cast("string").alias("id"), labelled["text"],
                           labelled["lang"]).where("text IS NOT NULL AND lang IS NOT NULL")
    session = labelled.sparkSession
    number = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(number)
    bits = gram_bits(len(languages))
    scale = 1_000_000
    bounds = session.createDataFrame(
        [(lang, scale * most // number[lang]) for lang, most in _quotas(number, learn_docs).items()],
        "lang STRING, bound LONG")
    part = F.pmod(F.xxhash64(F.lit("learn"), "id"), F.lit(scale))
    # A quota below a millionth still has a chance; a null id hashes like a text of none.
    rows = rows.join(F.broadcast(bounds), "lang").where(part < F.greatest("bound", F.lit(1)))

    @freeing
    def count(batches):
        for batch in batches:
            step = max(1, batch.num_rows * BATCH_BYTES // max(1, batch.nbytes))
            for piece in (batch.slice(i, step) for i in range(0, batch.num_rows, step)):
                data, starts = utf8(piece.column("text"))
                names = piece.column("lang").to_pylist()
                known = sorted(set(names))
                lang = np.array([known.index(n) for n in names], np.int64)
                words = _read(data, starts, bits)
                if not len(words.text):
                    continue
                kinds = len(words.first)
                for i, name in enumerate(known):
                    often = np.bincount(words.kind[lang[words.text] == i], minlength=kinds)
                    size = np.diff(np.append(words.first, len(words.features)))
                    table = np.bincount(words.features, np.repeat(often, size), columns(bits))
                    table += np.bincount(words.script + (2 << bits), often, columns(bits))
                    at = np.flatnonzero(table)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)),
                         pa.array(table[at].astype(np.int64))], ["lang", "feature", "n"])

    bound_batches(session)
    counted = rows.select("text", "lang").mapInArrow(count, "lang STRING, feature INT, n LONG")
    # Columns rather than rows in Python, as there may be millions.
    sums = counted.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toArrow()
    table = np.zeros((columns(bits), len(languages)))
    place = {lang: i for i, lang in enumerate(languages)}
    for batch in sums.to_batches():
        lang = np.array([place[name] for name in batch.column("lang").to_pylist()], np.int64)
        table[batch.column("feature").to_numpy(), lang] = batch.column("n").to_numpy()
    grams = 1 << bits
    kinds = [table[:grams], table[grams:2 * grams]]
    scores = [np.log((p + 0.5) / (p.sum(0) + 0.5 * (np.count_nonzero(p.sum(1)) + 1))) for p in kinds]
    scripts = table[2 * grams:]
    return Model(languages, np.concatenate(scores).astype(np.float32),
                 scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(0), 1), bits)


def _quotas(number: dict[str, int], total: int) -> dict[str, int]:
    """So many of each that they sum up to `total` at most, the largest ones cut to an equal number."""
    left, out = total, {}
    for i, (name, n) in enumerate(sorted(number.items(), key=lambda item: item[1])):
        out[name] = min(n, max(1, left // (len(number) - i)))
        left -= out[name]
    return out


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Every row of `docs` with `lang_pred`, `score` (0 to 1) and `spans` (lang, start and end byte).

    A text that is null or has no letter is `und` with score 0, as is every text if nothing was
    learned. Equally long languages go by name. Input columns named like an added one are replaced
    by it; `keep` names the input columns to return. No rows give no rows.
    """
    return map_rows(docs, {"text": docs["text"]}, "lang_pred STRING, score DOUBLE, "
                    "spans ARRAY<STRUCT<lang: STRING, start: LONG, end: LONG>>",
                    lambda batch: model.predict(batch.column("text")), keep)


def report(docs: DataFrame, learn_docs: int = LEARN_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, learned from the rows not held out."""
    model = learn(docs.where(~held_out(docs["doc_id"])), learn_docs)
    found = identify(docs.select("doc_id", "text"), model, ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def with_a_language(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of `docs` of which at least the share `least` is in one language."""
    model = learn(docs.where(~held_out(docs["doc_id"])))
    found = identify(docs, model)
    return found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select(
        *docs.columns)
