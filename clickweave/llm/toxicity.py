"""Toxicity by a small recurrent network, trained in numpy, over all overlapping windows of a text.

A word enters as two inputs. The character input is a maximum, number by number, over the vectors of
the word's pieces: runs of a few bytes, with marks at the word's ends, and its beginnings of more
bytes; the word input is the vector of the word as a whole. Both kinds of vector are kept for hashes,
in tables of fixed size, so that an unknown word has a character input at least. Gated recurrent units read a window of WINDOW words in both
directions; attention weighs what they say at each word, and a logistic unit takes the weighted sum.

A word repeated without another in between is read once. A text is cut in windows of WINDOW words, one beginning at every STRIDE-th, the last ending with the
text. Its score is a logistic function, fitted on the same documents, of the highest window and of
the mean of the highest two.

Labels are of documents, not of windows: in each round of training the network scores all windows of
the documents learned from, and learns from the highest of each. The first vectors, from which
training starts, hold how much more often a piece or word occurs in documents of label 1; those of
pieces and words of very few documents stay zero, as they would only tell which these are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import U64, Hashes, Words, map_rows, parts, utf8

# Documents learned from at most, of each label, by a hash of their id; and characters of these.
LEARN_DOCS, LEARN_CHARS = 1_500, 3_000_000
THRESHOLD = 0.7
WINDOW, STRIDE = 64, 48
# Sizes: of hash tables, of each input, of the state of one direction, of attention.
TABLE_BITS, DIM, STATE, ATTENTION = 17, 4, 8, 8
# Bytes of pieces from anywhere in a word, and of those from its beginning.
PIECES, BEGINNINGS = (3, 5), (7, 8, 9)
ROUNDS, EPOCHS, BATCH, RATE = 4, 2, 128, 0.02
# Documents of label 1 added to both counts of a feature; what its vector has to pass; and the
# documents that it has to occur in.
SMOOTH, LEAST, LEAST_DOCS = 1.5, 0.7, 4
# How much more the windows of label 1 weigh.
WEIGHT = 2.0
PART_BYTES = 1 << 20
WINDOWS = 1 << 9

HASHES = Hashes(505)
TABLE = 1 << TABLE_BITS
_NONE = 2 * TABLE  # the vector of no word, beyond the end of a text


def _word_bytes() -> tuple[np.ndarray, np.ndarray]:
    fold = np.arange(256, dtype=np.uint8)
    fold[65:91] += 32
    is_word = np.zeros(256, bool)
    is_word[48:58] = is_word[65:91] = is_word[97:123] = is_word[128:] = True
    return is_word, fold


_IS_WORD, _FOLD = _word_bytes()
WORDS = Words(_IS_WORD, _FOLD, HASHES)


@dataclass
class _Read:
    """The words of some texts: of each its text and kind; of each kind its features."""

    text: np.ndarray
    kind: np.ndarray
    word: np.ndarray  # of each kind the place of its vector as a word
    pieces: np.ndarray  # of all kinds in a row, the places of vectors of pieces
    first: np.ndarray  # where those of each kind begin


def _lower(data: np.ndarray) -> np.ndarray:
    """The text's bytes with A-Z, and the capitals of Latin-1 (as two bytes), lower-cased."""
    out = _FOLD[data]
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == 0xC3
    capital = second & (out >= 0x80) & (out <= 0x9E) & (out != 0x97)
    return np.where(capital, out + 32, out).astype(np.uint8)


def read(data: np.ndarray, starts: np.ndarray) -> _Read:
    lower = _lower(data)
    text, begin, end, value = WORDS(lower, starts)
    new = np.ones(len(text), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    text, begin, end, value = text[new], begin[new], end[new], value[new]
    unique, at, kind = np.unique(value, return_index=True, return_inverse=True)
    if not len(at):
        none = np.zeros(0, np.int64)
        return _Read(text, none, none, none, none)
    # The letters of each kind between marks, and fillers so that no piece crosses two of them.
    size = end[at] - begin[at]
    longest = max(*PIECES, *BEGINNINGS)
    width = size + 1 + longest
    offset = np.cumsum(width) - width
    spaced = np.zeros(int(width.sum()) + longest, np.uint8)
    inner = np.repeat(np.arange(len(at)), size)
    place = np.arange(len(inner)) - np.repeat(np.cumsum(size) - size, size)
    spaced[offset] = spaced[offset + size + 1] = 32
    spaced[offset[inner] + 1 + place] = lower[begin[at][inner] + place]
    hashes = HASHES.windows(HASHES.symbols[spaced], *PIECES, *BEGINNINGS)
    # A word and its marks have size + 2 bytes; a shorter one is a piece with its fillers.
    numbers = [np.maximum(size + 3 - n, 1) for n in PIECES] + [np.ones_like(size)] * len(BEGINNINGS)
    first = np.cumsum(sum(numbers)) - sum(numbers)
    found, done = np.empty(int(sum(numbers).sum()), np.int64), first.copy()
    for values, number in zip(hashes, numbers, strict=True):
        own = np.repeat(np.arange(len(at)), number)
        nth = np.arange(len(own)) - np.repeat(np.cumsum(number) - number, number)
        found[done[own] + nth] = (values[offset[own] + nth] >> U64(64 - TABLE_BITS)).astype(np.int64)
        done += number
    return _Read(text, kind, (unique >> U64(64 - TABLE_BITS)).astype(np.int64) + TABLE, found, first)


def _windows(count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts of so many words their windows: the text, the first word of all, the words."""
    number = np.where(count > WINDOW, -(-(count - WINDOW) // STRIDE) + 1, np.minimum(count, 1))
    text = np.repeat(np.arange(len(count)), number)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    start = np.minimum(nth * STRIDE, np.maximum(count[text] - WINDOW, 0))
    return text, (np.cumsum(count) - count)[text] + start, np.minimum(count[text], WINDOW)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """The parameters, a forward pass over windows, and its gradient."""

    def __init__(self, seed: int = 0):
        draw = np.random.default_rng(seed)

        def matrix(rows: int, columns: int) -> np.ndarray:
            return (draw.standard_normal((rows, columns)) / np.sqrt(rows)).astype(np.float32)

        # Vectors of pieces, then of words, then that of no word.
        self.vectors = (0.01 * draw.standard_normal((2 * TABLE + 1, DIM))).astype(np.float32)
        self.vectors[_NONE] = 0
        self.p: dict[str, np.ndarray] = {}
        for way in "fb":  # forwards, backwards: input, state and bias of update, reset, candidate
            self.p |= {f"in_{way}": matrix(2 * DIM, 3 * STATE),
                       f"state_{way}": matrix(STATE, 3 * STATE),
                       f"bias_{way}": np.zeros(3 * STATE, np.float32)}
        self.p |= {"attend": matrix(2 * STATE, ATTENTION),
                   "attend_bias": np.zeros(ATTENTION, np.float32),
                   "query": matrix(ATTENTION, 1)[:, 0], "out": matrix(2 * STATE, 1)[:, 0],
                   "out_bias": np.zeros(1, np.float32)}

    def inputs(self, words: _Read) -> tuple[np.ndarray, np.ndarray]:
        """For each kind of word its input; and where each number of the maximum came from."""
        vector = self.vectors[words.pieces]
        top = np.maximum.reduceat(vector, words.first)
        return np.concatenate([top, self.vectors[words.word]], axis=1), vector

    def _project(self, x: np.ndarray) -> dict[str, np.ndarray]:
        return {way: x @ self.p[f"in_{way}"] + self.p[f"bias_{way}"] for way in "fb"}

    def _unit(self, way: str, given: np.ndarray, before: np.ndarray) -> tuple:
        state = self.p[f"state_{way}"]
        gates = _sigmoid(given[:, :2 * STATE] + before @ state[:, :2 * STATE])
        update, reset = gates[:, :STATE], gates[:, STATE:]
        own = np.tanh(given[:, 2 * STATE:] + (reset * before) @ state[:, 2 * STATE:])
        return before + update * (own - before), update, reset, own

    def logits(self, kinds: np.ndarray, size: np.ndarray, projected: dict[str, np.ndarray],
               trace: dict[str, list] | None = None) -> tuple:
        """For windows (rows of kinds; beyond the size none) their logits, and what was on the way."""
        rows, width = kinds.shape
        inside = np.arange(width) < size[:, None]
        full = inside.all()
        kind = projected["f"].dtype
        states = np.empty((width, rows, 2 * STATE), kind)
        for way, column, steps in (("f", 0, range(width)), ("b", STATE, range(width - 1, -1, -1))):
            before = np.zeros((rows, STATE), kind)
            for t in steps:
                now, update, reset, own = self._unit(way, projected[way][kinds[:, t]], before)
                if not full:
                    now = np.where(inside[:, t, None], now, before)
                if trace is not None:
                    trace[way].append((before, update, reset, own))
                states[t, :, column:column + STATE] = now
                before = now
        hidden = np.tanh(states @ self.p["attend"] + self.p["attend_bias"])
        weight = hidden @ self.p["query"]
        if not full:
            weight = np.where(inside.T, weight, -np.inf)
        weight = np.exp(weight - weight.max(0))
        weight /= weight.sum(0)
        pooled = np.einsum("tb,tbs->bs", weight, states)
        return (pooled @ self.p["out"] + self.p["out_bias"][0], inside, states, hidden, weight, pooled)

    def gradient(self, kinds: np.ndarray, words: _Read, size: np.ndarray, label: np.ndarray,
                 ) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """Gradients of the mean log-loss: of the parameters, of each vector touched."""
        p, (rows, width) = self.p, kinds.shape
        x, vector = self.inputs(words)
        x = np.vstack([x, np.zeros((1, 2 * DIM), x.dtype)])
        trace: dict[str, list] = {"f": [], "b": []}
        logit, inside, states, hidden, weight, pooled = self.logits(
            kinds, size, self._project(x), trace)
        error = ((_sigmoid(logit) - label) * np.where(label, WEIGHT, 1) / rows).astype(x.dtype)
        g = {name: np.zeros_like(value) for name, value in p.items()}
        g["out"], g["out_bias"] = error @ pooled, error.sum(keepdims=True)
        d_pooled = error[:, None] * p["out"]
        along = (states * d_pooled).sum(2)
        d_weight = weight * (along - (weight * along).sum(0))
        g["query"] = np.einsum("tb,tba->a", d_weight, hidden)
        d_hidden = d_weight[:, :, None] * p["query"] * (1 - hidden * hidden)
        g["attend"] = np.einsum("tbs,tba->sa", states, d_hidden)
        g["attend_bias"] = d_hidden.sum((0, 1))
        d_states = weight[:, :, None] * d_pooled + d_hidden @ p["attend"].T
        d_x = np.zeros_like(x)
        order = np.argsort(kinds.T, axis=None, kind="stable")
        edges = np.searchsorted(kinds.T.ravel()[order], np.arange(len(x)))
        for way, column, steps in (("f", 0, range(width - 1, -1, -1)), ("b", STATE, range(width))):
            state, carried = p[f"state_{way}"], np.zeros((rows, STATE), x.dtype)
            d_given = np.empty((width, rows, 3 * STATE), x.dtype)
            for n, t in enumerate(steps):
                before, update, reset, own = trace[way][width - 1 - n]
                total = d_states[t, :, column:column + STATE] + carried
                real = np.where(inside[:, t, None], total, 0)
                d_own = real * update * (1 - own * own)
                through = d_own @ state[:, 2 * STATE:].T
                mine = d_given[t]
                mine[:, :STATE] = real * (own - before) * update * (1 - update)
                mine[:, STATE:2 * STATE] = through * before * reset * (1 - reset)
                mine[:, 2 * STATE:] = d_own
                d_gates = mine[:, :2 * STATE]
                g[f"state_{way}"][:, :2 * STATE] += before.T @ d_gates
                g[f"state_{way}"][:, 2 * STATE:] += (reset * before).T @ d_own
                carried = total - real * update + through * reset + d_gates @ state[:, :2 * STATE].T
            # All places of a kind have the same input: their gradients are summed first.
            flat = d_given.reshape(width * rows, -1)[order]
            some = np.append(edges[1:], len(order)) > edges
            of_kind = np.zeros((len(x), 3 * STATE), x.dtype)
            of_kind[some] = np.add.reduceat(flat, edges[some])
            g[f"in_{way}"] = x.T @ of_kind
            g[f"bias_{way}"] = of_kind.sum(0)
            d_x += of_kind @ p[f"in_{way}"].T
        # A maximum passes its gradient to the pieces that reach it, and the rest are left.
        d_top = d_x[:-1, :DIM]
        of = np.repeat(np.arange(len(words.first)), np.diff(np.append(words.first, len(words.pieces))))
        d_piece = np.where(vector == x[of, :DIM], d_top[of], 0)
        return (g, np.concatenate([words.pieces, words.word]),
                np.concatenate([d_piece, d_x[:-1, DIM:]]))

    def score_windows(self, words: _Read, count: np.ndarray) -> tuple:
        """The windows of texts of so many words, and their logits."""
        text, start, size = _windows(count)
        if not len(text):
            return text, start, size, np.zeros(0, np.float32)
        x, _ = self.inputs(words)
        projected = self._project(np.vstack([x, np.zeros((1, 2 * DIM), np.float32)]))
        none, kinds = len(x), np.append(words.kind, np.full(WINDOW, len(x)))
        logit = np.empty(len(text), np.float32)
        # Windows of about the same size go together: short ones then take few steps.
        order = np.argsort(size, kind="stable")
        for i in range(0, len(order), WINDOWS):
            own = order[i:i + WINDOWS]
            place = np.arange(int(size[own].max()))
            rows = kinds[start[own][:, None] + place]
            rows = np.where(place < size[own][:, None], rows, none)
            logit[own] = self.logits(rows, size[own], projected)[0]
        return text, start, size, logit


def _highest(text: np.ndarray, logit: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """For each text its highest window and its second highest (or again the highest); -1 for none."""
    order = np.lexsort((-logit, text))
    first = np.searchsorted(text[order], np.arange(texts))
    have = np.bincount(text, minlength=texts)
    padded = np.append(order, [-1, -1])
    top = np.where(have > 0, padded[np.minimum(first, len(order))], -1)
    return top, np.where(have > 1, padded[np.minimum(first + 1, len(order))], top)


@dataclass(frozen=True)
class Model:
    network: Network
    # Of the score: a constant, the highest window, the mean of the highest two.
    final: np.ndarray
    # Of a text without words.
    empty: float

    def predict(self, column: pa.Array) -> np.ndarray:
        """The scores of all texts of a column."""
        data, starts = utf8(column)
        out = []
        for begin, end in parts(starts, PART_BYTES):
            own = starts[begin:end + 1]
            words = read(data[own[0]:own[-1]], own - own[0])
            text, _, _, logit = self.network.score_windows(
                words, np.bincount(words.text, minlength=end - begin))
            out.append(self.of_windows(text, logit, end - begin))
        return np.concatenate(out) if out else np.zeros(0)

    def of_windows(self, text: np.ndarray, logit: np.ndarray, texts: int) -> np.ndarray:
        top, second = _highest(text, logit, texts)
        values = np.append(logit, 0).astype(np.float64)
        score = _sigmoid(_final_inputs(values[top], values[second]) @ self.final)
        return np.where(top >= 0, score, self.empty)


def _final_inputs(top: np.ndarray, second: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(top)), top, (top + second) / 2], axis=1)


def _first_vectors(network: Network, words: _Read, label: np.ndarray) -> np.ndarray:
    """Sets the first number of each vector: how much its documents are rather of label 1.

    Returns which vectors belong to features of enough documents; the others are zero.
    """
    of_kind = np.repeat(np.arange(len(words.first)),
                        np.diff(np.append(words.first, len(words.pieces))))
    pair = np.unique(words.text * len(words.first) + words.kind)
    text, kind = pair // len(words.first), pair % len(words.first)
    # Documents of each label by feature, each document once.
    begin, end = np.searchsorted(of_kind, kind), np.searchsorted(of_kind, kind, "right")
    size = end - begin
    at = np.repeat(begin, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    feature = np.concatenate([words.pieces[at], words.word[kind]])
    once = np.unique(np.concatenate([np.repeat(text, size), text]) * (2 * TABLE) + feature)
    text, feature = once // (2 * TABLE), once % (2 * TABLE)
    number = [np.bincount(feature[label[text] == y], minlength=2 * TABLE) for y in (0, 1)]
    share = [max(1, int((label == y).sum())) for y in (0, 1)]
    ratio = share[1] / share[0]
    value = np.log((number[1] + SMOOTH) / (number[0] * ratio + SMOOTH))
    value = np.sign(value) * np.maximum(np.abs(value) - LEAST, 0)
    often = np.append(number[0] + number[1] >= LEAST_DOCS, False)
    network.vectors[:2 * TABLE, 0] = np.clip(value, -2, 4)
    network.vectors[~often] = 0
    return often


def _fit_final(inputs: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton's steps, drawn towards the network's own logit."""
    prior, out = np.array([0.0, 0.5, 0.5]), np.array([0.0, 0.5, 0.5])
    for _ in range(30):
        p = _sigmoid(inputs @ out)
        gradient = inputs.T @ (weight * (p - label)) + (out - prior)
        curve = (inputs * (weight * p * (1 - p))[:, None]).T @ inputs + np.eye(3)
        step = np.linalg.solve(curve, gradient)
        out = out - np.clip(step, -1, 1)
    return out


def train(texts: list[str], labels: list[int], share: float = 0.5, seed: int = 0) -> Model:
    """A model from texts and their labels; `share` is that of label 1 among all documents."""
    label = np.array(labels, np.float32)
    if not len(label) or label.min() == label.max():
        # Nothing tells the labels apart: every score is the only label's.
        only = float(label[0]) if len(label) else 0.0
        return Model(Network(seed), np.array([60.0 * only - 30, 0, 0]), only)
    data, starts = utf8(pa.array(texts, pa.large_string()))
    words = read(data, starts)
    count = np.bincount(words.text, minlength=len(texts))
    network = Network(seed)
    if not len(words.text):
        return Model(network, np.array([0.0, 0, 0]), share)
    often = _first_vectors(network, words, label)
    draw = np.random.default_rng(seed)
    steps: dict[str, tuple[np.ndarray, np.ndarray]] = {
        name: (np.zeros_like(v), np.zeros_like(v)) for name, v in network.p.items()}
    seen = np.full((2 * TABLE + 1, 1), 1e-4, np.float32)
    text, start, size = _windows(count)
    x, _ = network.inputs(words)
    # Before the network has learned anything: the sum of what its words' vectors hold.
    running = np.concatenate([[0], np.cumsum(np.maximum(x[words.kind][:, [0, DIM]], 0).sum(1))])
    logit = (running[start + size] - running[start]).astype(np.float32)
    n = 0
    for round_ in range(ROUNDS):
        if round_:
            logit = network.score_windows(words, count)[3]
        top, second = _highest(text, logit, len(texts))
        # The highest window of every document; of label 0 the second one as well.
        clean = (label == 0) & (second != top)
        chosen = np.concatenate([top[top >= 0], second[clean & (second >= 0)]])
        for _ in range(EPOCHS):
            draw.shuffle(chosen)
            for i in range(0, len(chosen), BATCH):
                n += 1
                _learn(network, words, chosen[i:i + BATCH], (text, start, size), label, steps, seen, often, n)
    _, _, _, logit = network.score_windows(words, count)
    top, second = _highest(text, logit, len(texts))
    some = top >= 0
    inputs = _final_inputs(logit[top[some]].astype(np.float64), logit[second[some]].astype(np.float64))
    mine = label[some]
    weight = np.where(mine == 1, share / max(1, (mine == 1).sum()),
                      (1 - share) / max(1, (mine == 0).sum())) * len(mine)
    return Model(network, _fit_final(inputs, mine, weight), share)


def _learn(network: Network, words: _Read, own: np.ndarray, windows: tuple, label: np.ndarray,
           steps: dict, seen: np.ndarray, often: np.ndarray, n: int) -> None:
    """One step on some windows: Adam for the parameters, Adagrad for the vectors they touch."""
    text, start, size = (w[own] for w in windows)
    place = np.arange(int(size.max()))
    inside = place < size[:, None]
    kinds = words.kind[np.where(inside, start[:, None] + place, 0)]
    # Only the kinds met, numbered anew; beyond the end none.
    met, local = np.unique(kinds[inside], return_inverse=True)
    rows = np.full(kinds.shape, len(met))
    rows[inside] = local
    ends = np.append(words.first, len(words.pieces))
    length = ends[met + 1] - ends[met]
    at = np.repeat(ends[met], length) + np.arange(length.sum()) - np.repeat(
        np.cumsum(length) - length, length)
    mine = _Read(text, local, words.word[met], words.pieces[at], np.cumsum(length) - length)
    g, touched, d_vectors = network.gradient(rows, mine, size, label[text])
    for name, value in g.items():
        mean, square = steps[name]
        mean += 0.1 * (value - mean)
        square += 0.001 * (value * value - square)
        network.p[name] -= RATE * (mean / (1 - 0.9 ** n)) / (
            np.sqrt(square / (1 - 0.999 ** n)) + 1e-8)
    touched, d_vectors = touched[often[touched]], d_vectors[often[touched]]
    places, inverse = np.unique(touched, return_inverse=True)
    total = np.zeros((len(places), DIM), np.float32)
    np.add.at(total, inverse, d_vectors)
    seen[places] += (total * total).mean(1, keepdims=True)
    network.vectors[places] -= RATE * total / np.sqrt(seen[places])


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, learn_docs: int = LEARN_DOCS,
          learn_chars: int = LEARN_CHARS) -> Model:
    """A model from the rows of `docs` whose doc_id has one label (0 or 1) in `labels`.

    Learns from about `learn_docs` documents of each label at most, those of the least hash of their
    id whose texts together have `learn_chars` characters: this sample alone meets the driver. A
    longer text than a hundredth of that is not learned from. Null ids, texts and labels are passed
    over, as are ids with both labels; the share of label 1 is that of all labelled documents.
    """
    toxic = F.col("toxic")
    sure = (labels.select(labels["doc_id"], labels["toxic"]).where(toxic.isin(0, 1))
            .groupBy("doc_id").agg(F.min("toxic").alias("label"), F.max("toxic").alias("other"))
            .where("label = other AND doc_id IS NOT NULL").drop("other"))
    sure = sure.where(~held_out(F.col("doc_id")))
    number = {r.label: r["count"] for r in sure.groupBy("label").count().collect()}
    total = sum(number.values())
    # The hash that so many of each label stay below; twice as many, as some have no text or a long one.
    part = F.pmod(F.xxhash64(F.lit("toxic"), "doc_id"), F.lit(1_000_000))
    bound = F.lit(0)
    for label, n in number.items():
        bound = F.when(F.col("label") == label,
                       F.lit(int(min(1.0, 2 * learn_docs / n) * 1_000_000))).otherwise(bound)
    few = sure.where(part < bound).select("doc_id", "label", part.alias("part"))
    near = docs.select(docs["doc_id"], docs["text"]).where(
        F.length("text") <= learn_chars // 100).join(F.broadcast(few), "doc_id")
    # Repeated rows of an id count once.
    once = near.groupBy("doc_id", "label", "part").agg(F.min("text").alias("text"))
    order = Window.partitionBy("label").orderBy("part", "doc_id")
    kept = once.withColumns({"place": F.row_number().over(order),
                             "chars": F.sum(F.length("text")).over(order)}).where(
        (F.col("place") <= learn_docs) & (F.col("chars") <= learn_chars // 2))
    rows = sorted((r.label, r.part, r.doc_id, r.text) for r in kept.collect())
    return train([r[3] for r in rows], [r[0] for r in rows], number.get(1, 0) / max(1, total))


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Every row of `docs` with `score`, 0 to 1, and `predicted`, 1 from THRESHOLD on.

    A text that is null or has no words has the share of label 1 as its score. Input columns named
    like an added one are replaced by it; `keep` names the input columns to return.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def outcome(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(shared.value.predict(batch.column("text")), pa.float64())]

    found = map_rows(docs, {"text": docs["text"]}, "score DOUBLE", outcome, keep)
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, learned from the rows not held out."""
    model = learn(docs, labels)
    found = score(docs.select("doc_id", "text"), model, ["doc_id"])
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
