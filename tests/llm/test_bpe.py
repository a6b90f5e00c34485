"""BPE against the tokenizers library, and merging against repeated search for the best pair."""

from __future__ import annotations

import hashlib
import random

import pytest

from clickweave.llm import bpe

P = pytest.importorskip("public_tokenizers")
DOCS = "doc_id LONG, text STRING, ids INT, decoded LONG"


@pytest.fixture(scope="module")
def path():
    return P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library(path):
    from tokenizers import Tokenizer
    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def mine(path):
    with open(path, encoding="utf-8") as file:
        return bpe.Tokenizer(file.read())


TEXTS = ["", " ", "Hello, WORLD's  they'll 2024!", "ΑΣ ΟΔΟΣ Σ", "İstanbul", "é é",
         "a\x1cb\x1fc\x85d\xa0e　f​g", "日本語 текст 🙂🙂", "<|startoftext|>x<|endoftext|>",
         "<|STARTOFTEXT|> <|endoftext|", "don't 'S 'lltion ''re", "x" * 5000, "é" * 999 + "!?" * 500,
         "\r\n\t a \v b", "ﬁ ½ ٣ ²", "\u0000\u0007", "a" * 70 + "'s", "#*$%&|<>" * 20]


def slow_merge(t, word):
    data = word.encode()
    ids = [*(t.inner[b] for b in data[:-1]), t.last[data[-1]]]
    while True:
        found = [(t.ranks[a << bpe.PAIR | b], i)
                 for i, (a, b) in enumerate(zip(ids, ids[1:], strict=False))
                 if a << bpe.PAIR | b in t.ranks]
        if not found:
            return tuple(ids)
        rank, i = min(found)
        ids[i:i + 2] = [t.merged[rank]]


def test_the_library_agrees(mine, library):
    rng = random.Random(1)
    alphabet = "aeiorst nhTHE'<|>é1ö\n日"
    texts = TEXTS + ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 300)))
                     for _ in range(500)]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert mine.encode(text) == ids, text
        assert mine.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_merging(mine):
    rng = random.Random(2)
    for _ in range(300):
        word = "".join(rng.choice("aeiorstnhé") for _ in range(rng.randint(1, 40)))
        assert mine.merge(word) == slow_merge(mine, word)


def test_few_kept(mine, library, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT", 3)
    text = " ".join(TEXTS) * 3
    assert mine.encode(text) == library.encode(text, add_special_tokens=False).ids


def test_query(spark, library, path):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, None), (3, TEXTS[3])]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], DOCS)
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(str, (tuple(r) for r in bpe.report(df, path).collect()))) == sorted(
        map(str, want))
    assert bpe.encode_decode(df, path).columns == ["doc_id", "text", "ids", "decoded"]
    assert bpe.report(df.limit(0), path).collect() == []
