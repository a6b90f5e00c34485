"""The pipeline against its stages done by brute force, one after the other."""

from __future__ import annotations

import hashlib

import pytest

import corpus_pipeline
from clickweave.llm.common import table
from tests.llm import test_decontamination, test_simhash

P = pytest.importorskip("public_tokenizers")


def without_repeats(rows, length=100):
    seen, out = set(), {}
    for doc_id, text in sorted(rows.items()):
        data = text.encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i:i + length]
            if window in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[doc_id] = kept.decode(errors="ignore")
    return out


@pytest.fixture
def folder(spark, sf_dir, tmp_path):
    """A few hundred of the given documents, some of them spoilt, and the whole benchmark."""
    docs = table(spark, sf_dir, "documents").where("doc_id < 260").toPandas()
    docs.loc[3, "text"], docs.loc[4, "text"], docs.loc[5, "text"] = None, "123 456 !!", ""
    docs.loc[9, "text"] = docs.loc[8, "text"].replace(" ", "  ")
    spark.createDataFrame(docs).write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, sf_dir, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_pipeline(spark, folder):
    from tokenizers import Tokenizer

    docs = {r.doc_id: r for r in table(spark, folder, "documents").collect()}
    items = [tuple(r) for r in table(spark, folder, "benchmark").collect()]
    rows = {i: r.text for i, r in docs.items() if i not in (3, 4, 5)}
    rows = {i: rows[i] for i, _, least in test_simhash.expected(list(rows.items())) if i == least}
    rows = without_repeats(rows)
    bad = {r[0] for r in test_decontamination.brute(list(rows.items()), items) if r[5]}
    rows = {i: t for i, t in rows.items() if i not in bad}
    assert 100 < len(rows) < 250 and bad
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert set(got) == set(rows)
    for i, row in got.items():
        ids = library.encode(rows[i], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (row.text, row.lang, row.source) == (rows[i], docs[i].lang, docs[i].source)
        assert (row.n_chars, row.ids, row.n_tokens) == (len(rows[i]), ids, len(ids))
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language ID", "SimHash near-dedup", "suffix-array dedup", "benchmark decontamination",
        "BPE encoding and decoding"]
