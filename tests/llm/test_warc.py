"""WARC derivatives: links, digests, and files that read back as written."""

from __future__ import annotations

import gzip
import hashlib
import re
from pathlib import Path

from clickweave.llm import html_text, warc

PAGES = "page_id LONG, url STRING, html STRING, block INT, Headers INT"
HTML = ("<title> A  title\n</title><nav>menu</nav><p>Tom &amp; é</p><p>two", "<p>plain</p>", None,
        "", "x" * 50_000, "<p>WARC/1.1\r\n\r\nx: y</p>")


def rows():
    found = [(i, f"http://h.org/{i}", h, 1, 2) for i, h in enumerate(HTML)]
    return [*found, (None, None, None, None, None), (7, "", "<p>a", 1, 2), found[1]]


def sha(text):
    return "sha256:" + hashlib.sha256(text.encode()).hexdigest()


def test_records(spark):
    pages = spark.createDataFrame(rows(), PAGES)
    got = warc.report(pages).collect()
    assert len(got) == 2 * len(rows())
    sources = {r.record_id: r for r in warc.responses_of(pages).collect()}
    pairs = {}
    for r in got:
        names = [h.name for h in r.headers]
        value = dict(r.headers)
        assert len(names) == len(set(names)) and re.fullmatch(
            r"<urn:uuid:[0-9a-f]{8}-[0-9a-f]{4}-8[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}>",
            r.record_id)
        source = sources[r.refers_to]
        assert value["WARC-Refers-To-Date"] == value["WARC-Date"] == warc.PAGE_DATE
        assert r.target_uri == (source.target_uri or None)
        assert r.source_digest == sha(source.payload) and r.block_digest == sha(r.block)
        assert r.content_length == len(r.block.encode())
        pairs.setdefault(r.refers_to, {})[r.kind] = r
        if r.kind == "conversion":
            assert r.block == "\n".join(b.text for b in html_text.blocks(source.payload, True))
        else:
            fields = dict(line.split(": ", 1) for line in r.block.strip().split("\r\n"))
            assert fields["sourceRecord"] == r.refers_to and fields["status"] == "200"
            assert fields["sourcePayloadDigest"] == sha(source.payload)
            assert fields["source-http-Content-Length"] == str(len(source.payload.encode()))
            assert fields.get("title") == ("A title" if r.page_id == 0 else None)
    for pair in pairs.values():
        assert dict(pair["metadata"].headers)["WARC-Concurrent-To"] == pair["conversion"].record_id
        assert f"conversionRecord: {pair['conversion'].record_id}" in pair["metadata"].block
    assert len({r.record_id for r in got}) == 2 * len(pairs)


def test_nulls_in_responses(spark):
    schema = "record_id STRING, target_uri STRING, date STRING, http STRING, payload STRING, kind INT"
    found = warc.derive(spark.createDataFrame([(None,) * 6], schema)).collect()
    assert [r.kind for r in found] == ["metadata", "conversion"] and found[1].block == ""
    assert "WARC-Refers-To" not in dict(found[0].headers)
    assert warc.derive(spark.createDataFrame([], schema)).collect() == []


def test_files(spark, tmp_path):
    records = warc.derive(warc.responses_of(spark.createDataFrame(rows()[:5], PAGES)), keep=[])
    for compression in ("gzip", "none"):
        path = str(tmp_path / compression)
        warc.write_records(records.repartition(3), path, compression)
        def key(rows):
            return sorted((r.kind, [tuple(h) for h in r.headers], r.block) for r in rows)
        assert key(warc.read_records(spark, path).collect()) == key(records.collect())
    data = b"".join(gzip.open(f).read() for f in sorted(Path(tmp_path / "gzip").glob("part*")))
    at = 0
    while at < len(data):  # by the lengths in the headers
        head, body = data[at:].split(b"\r\n\r\n", 1)
        length = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert head.startswith(b"WARC/1.1\r\n") and body[length:length + 4] == b"\r\n\r\n"
        at += len(head) + 4 + length + 4


def raw(kind, number, block, name="Content-Length"):
    return (f"WARC/1.{number % 2}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{number}>\r\n"
            f"WARC-Target-URI: http://h/{number}\r\n{name}: {len(block)}\r\n\r\n").encode() + block \
        + b"\r\n\r\n"


def test_responses_of_a_file_compressed_by_record(spark, tmp_path):
    """Payloads that quote records, bytes that are no text, and a file that ends too early."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    quote = raw("response", 9, b"quoted") * 2
    blocks = [http + b"<p>one", http + b"<p>a" + quote + b"<p>b", b"", http + b"\xff<p>\xc3\xa9",
              http + quote]
    records = [raw("warcinfo", 100, b"software: x")] + [
        raw("response", i, b, "content-length" if i == 3 else "Content-Length")
        for i, b in enumerate(blocks)] + [raw("request", 101, b"GET /")]
    with open(tmp_path / "a.warc.gz", "wb") as file:
        for record in records:
            file.write(gzip.compress(record))
    with open(tmp_path / "b.warc.gz", "wb") as file:
        file.write(gzip.compress(records[1] + records[2][:-40]))
    found = warc.read_warc(spark, str(tmp_path / "a.warc.gz")).collect()
    assert [bytes(r.block) for r in found] == [b"software: x", *blocks, b"GET /"]
    both = warc.read_warc(spark, str(tmp_path))
    assert both.count() == len(records) + 2
    responses = warc.responses_in(both)
    rows = {r.payload: r for r in responses.collect()}
    assert rows["<p>one"].http.startswith("HTTP/1.1 200 OK\r\n")
    assert rows["\ufffd<p>é"].target_uri == "http://h/3"
    assert rows[(b"<p>a" + quote + b"<p>b").decode()].record_id == "<urn:1>"
    derived = [r for r in warc.derive(responses, ["record_id"]).collect() if r.kind == "conversion"]
    assert len(derived) == 7 and {r.block for r in derived if r.record_id == "<urn:0>"} == {"one"}
