"""Derivatives of WARC responses: a metadata and a plain-text conversion record for each.

Both refer to their response by its record id and keep its address and date; the metadata record's
block holds the response's headers and digests and names the conversion record, which in turn names
the metadata record. Ids are found from the response's id alone, so a task that runs again writes
the same records.

Records are rows: a kind, an ordered list of headers and a block of text. They are written and read
as WARC text files in parallel, split at the empty lines before each record.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm import html_text
from clickweave.llm.common import freeing, map_rows

VERSION = "WARC/1.1"
NEW_LINE = "\r\n"
# The date of responses made from tables of pages, which have none.
PAGE_DATE = "2024-01-01T00:00:00Z"

HEADERS = "ARRAY<STRUCT<name: STRING, value: STRING>>"


def record_id(*parts: Column) -> Column:
    """A urn:uuid made from a hash, of version 8 (custom) as RFC 9562 has it."""
    key = F.concat_ws("\u0000", *parts).cast("binary")
    h = F.sha2(key, 256)
    variant = F.substring(F.lit("89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1, 1)
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4),
                    F.lit("-8"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3),
                    F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def responses_of(pages: DataFrame, date: str = PAGE_DATE) -> DataFrame:
    """Responses (page_id, record_id, target_uri, date, http, payload) of a table of pages.

    A null url is an empty address, a null html an empty payload. Equal pages have equal records.
    """
    payload, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                          "Content-Length: "), F.octet_length(payload), F.lit(NEW_LINE))
    return pages.select("page_id", "url", "html").select(
        "page_id", record_id(F.lit("response"), F.coalesce(F.col("page_id").cast("string"),
                                                           F.lit("")), url).alias("record_id"),
        url.alias("target_uri"), F.lit(date).alias("date"), http.alias("http"),
        payload.alias("payload"))


def _plain_text(batch: pa.RecordBatch) -> list[pa.Array]:
    rows = [html_text.blocks(p.as_py() or "", everything=True) for p in batch.column("payload")]
    return [pa.array(["\n".join(b.text for b in row) for row in rows], pa.string())]


def _fields(**values: Column) -> Column:
    """A list of headers; those without a value are left out."""
    every = F.array(*[F.struct(F.lit(n.replace("_", "-")).alias("name"),
                               v.cast("string").alias("value")) for n, v in values.items()])
    return F.filter(every, lambda f: f["value"].isNotNull())


def _lines(fields: Column) -> Column:
    return F.array_join(F.transform(fields, lambda f: F.concat(
        f["name"], F.lit(": "), f["value"], F.lit(NEW_LINE))), "")


def derive(responses: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Two records for each response: `kind`, `headers` and `block`, after the columns in `keep`.

    Responses have record_id, target_uri, date, http (header lines) and payload (HTML); any of them
    may be null: a header without value is left out, a null payload is empty. The conversion record
    holds all visible text, a line for each block of the page. Input columns outside `keep` are not
    returned (without it only page_id is, if there). No rows give no rows.
    """
    keep = [c for c in responses.columns if c == "page_id"] if keep is None else keep
    needed = ["record_id", "target_uri", "date", "http", "payload"]
    text = map_rows(responses.select(*keep, *[responses[n].alias(f"source_{n}") for n in needed]),
                    {"payload": F.col("source_payload")}, "conversion STRING", _plain_text)
    c = {n: F.col(f"source_{n}") for n in needed}
    source = F.coalesce(c["record_id"], F.lit(""))
    payload = F.coalesce(c["payload"], F.lit(""))
    ids = {kind: record_id(F.lit(kind), source) for kind in ("metadata", "conversion")}
    title = F.regexp_extract(payload, "(?is)<title[^>]*>(.*?)</title", 1)
    status = F.split(F.split(c["http"], NEW_LINE)[0], " ")
    block = _lines(_fields(
        sourceRecord=c["record_id"], sourceAddress=c["target_uri"], sourceDate=c["date"],
        sourcePayloadDigest=digest(payload), sourcePayloadLength=F.octet_length(payload),
        conversionRecord=ids["conversion"], status=F.get(status, F.lit(1)),
        title=F.nullif(F.trim(F.regexp_replace(title, r"\s+", " ")), F.lit(""))))
    # The source's own header lines follow, each named so that none can pass for one of the above.
    lines = F.filter(F.split(c["http"], NEW_LINE), lambda x: F.instr(x, ":") > 0)
    block = F.concat(block, F.coalesce(F.array_join(F.transform(lines, lambda x: F.concat(
        F.lit("source-http-"), x, F.lit(NEW_LINE))), ""), F.lit("")))

    def record(kind: str, content: Column, content_type: str, other: str) -> Column:
        headers = _fields(
            WARC_Type=F.lit(kind), WARC_Record_ID=ids[kind], WARC_Date=c["date"],
            WARC_Target_URI=F.nullif(c["target_uri"], F.lit("")), WARC_Refers_To=c["record_id"],
            WARC_Refers_To_Target_URI=F.nullif(c["target_uri"], F.lit("")),
            WARC_Refers_To_Date=c["date"], WARC_Concurrent_To=ids[other],
            WARC_Source_Payload_Digest=digest(payload), WARC_Block_Digest=digest(content),
            Content_Type=F.lit(content_type), Content_Length=F.octet_length(content))
        return F.struct(F.lit(kind).alias("kind"), headers.alias("headers"), content.alias("block"))

    both = F.array(record("metadata", block, "application/warc-fields", "conversion"),
                   record("conversion", F.col("conversion"), "text/plain; charset=utf-8", "metadata"))
    return text.select(*keep, F.explode(both).alias("derived")).select(*keep, "derived.*")


def header(name: str) -> Column:
    """The value of one of a record's headers, null without it."""
    return F.get(F.filter("headers", lambda h: h["name"] == name), F.lit(0))["value"]


def write_records(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Writes records as WARC text files, one for each partition."""
    text = F.concat(F.lit(VERSION + NEW_LINE), _lines(F.col("headers")), F.lit(NEW_LINE), "block")
    (records.select(text.alias("value")).write.option("lineSep", NEW_LINE * 2)
     .option("compression", compression).text(path))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """kind, headers and block (text) of the records in WARC text files."""
    found = read_warc(spark, path)
    return found.withColumn("block", F.decode("block", "UTF-8"))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """kind, headers and block (bytes) of all records in WARC 1.x files, also compressed by record.

    Files are cut where a record can begin; a record ends by its Content-Length, so a block that quotes
    such a place is put together again. A task holds one record at a time. A record that its file cuts
    short has what is there; one without a length ends where the next can begin. Uncompressed files
    should not be larger than a task's share of the input, as a cut of the input may fall into a quote.
    """
    pieces = spark.read.option("lineSep", _BEGIN).text(path)
    return pieces.select(F.col("value").cast("binary").alias("piece")).mapInArrow(
        _whole_records, f"kind STRING, headers {HEADERS}, block BINARY")


_BEGIN = NEW_LINE * 2 + "WARC/1."


def _record(held: bytes, cut: bool) -> dict | None:
    """The record that begins with the digit of its version; None if bytes of its block are missing."""
    head, _, block = held.partition(b"\r\n\r\n")
    fields = [line.partition(b":") for line in head.split(b"\r\n")[1:] if line.strip()]
    headers = [{"name": n.decode(errors="replace").strip(), "value": v.decode(errors="replace").strip()}
               for n, _, v in fields]
    value = {h["name"].lower(): h["value"] for h in headers}
    size = value.get("content-length", "")
    if size.isdecimal():
        if len(block) < int(size) and not cut:
            return None
        block = block[:int(size)]
    return {"kind": value.get("warc-type"), "headers": headers, "block": block}


@freeing
def _whole_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    begin, file = _BEGIN.encode(), b"WARC/1."
    schema = pa.schema([("kind", pa.string()), ("headers", pa.list_(pa.struct(
        [("name", pa.string()), ("value", pa.string())]))), ("block", pa.binary())])
    held = None
    for batch in batches:
        rows = []
        for piece in batch.column("piece"):
            data = piece.as_py()
            if data.startswith(file):
                # The start of a file; what is held was cut short by the end of the one before.
                rows += [_record(held, True)] if held is not None else []
                held = data[len(file):]
            else:
                held = data if held is None else held + begin + data
            record = _record(held, False)
            if record is not None:
                rows.append(record)
                held = None
        yield pa.RecordBatch.from_pylist(rows, schema)
    if held is not None and held.strip():
        yield pa.RecordBatch.from_pylist([_record(held, True)], schema)


def responses_in(records: DataFrame) -> DataFrame:
    """Responses as `derive` takes them, of the `response` records of `read_warc`.

    The block is cut at its first empty line into header lines and payload, which is read as UTF-8;
    bytes that are none are replaced.
    """
    def value(name: str) -> Column:
        return F.get(F.filter("headers", lambda h: F.lower(h["name"]) == name), F.lit(0))["value"]

    found = map_rows(
        records.where("kind = 'response'").select(
            value("warc-record-id").alias("record_id"), value("warc-target-uri").alias("target_uri"),
            value("warc-date").alias("date"), "block"),
        {"block": F.col("block")}, "http STRING, payload STRING", _http_parts,
        ["record_id", "target_uri", "date"])
    return found.select("record_id", "target_uri", "date", "http", "payload")


def _http_parts(batch: pa.RecordBatch) -> list[pa.Array]:
    cut = [(b.as_py() or b"").partition(b"\r\n\r\n") for b in batch.column("block")]
    return [pa.array([(head + b"\r\n").decode(errors="replace") for head, _, _ in cut], pa.string()),
            pa.array([body.decode(errors="replace") for _, _, body in cut], pa.string())]


def report(pages: DataFrame) -> DataFrame:
    """The two records of every row of `pages`, by their most telling headers."""
    found = derive(responses_of(pages))
    return found.select(
        "page_id", "kind", header("WARC-Record-ID").alias("record_id"),
        header("WARC-Refers-To").alias("refers_to"), header("WARC-Target-URI").alias("target_uri"),
        header("WARC-Source-Payload-Digest").alias("source_digest"),
        header("WARC-Block-Digest").alias("block_digest"),
        header("Content-Length").cast("long").alias("content_length"), "headers", "block")
