"""Operator 9: WARC archives, written and read back as whole transactions.

A page becomes three records: the request, the response (or, if another page
has the same payload, a revisit that refers to that page's response) and a
metadata record; request and metadata name the main record as concurrent.
The records may lie in any file in any order. Reading assembles them again:
records are joined through the concurrent-to identifiers into one nested row
for each capture.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import join_with_hot, materialise, scratch, text_bytes

FILE_BYTES = 16 << 20        # of an archive, about; a reading task holds one
CRLF = "\r\n"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"      # fixed by RFC 4648
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"   # fixed by the standard


def base32(hex_digest: F.Column) -> F.Column:
    """Base32 of a hexadecimal digest of a multiple of 20 bits (SHA-1: 160)."""
    digits = "0123456789ABCDEFGHIJKLMNOPQRSTUV"  # of Spark's conv
    parts = [F.translate(F.lpad(F.conv(F.substring(hex_digest, 5 * i + 1, 5), 16, 32), 4, "0"), digits, BASE32)
             for i in range(8)]
    return F.concat(*parts)


def _record(kind: str, headers: list[F.Column], block: F.Column) -> F.Column:
    lines = [F.lit(f"WARC/1.1{CRLF}WARC-Type: {kind}{CRLF}"), *headers,
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit(CRLF + CRLF)), block]
    return F.concat(*lines)


def _header(name: str, value: F.Column) -> F.Column:
    """A header line, none if the value is null; line ends in it are escaped."""
    clean = F.regexp_replace(F.regexp_replace(value, "\r", "%0D"), "\n", "%0A")
    return F.coalesce(F.concat(F.lit(f"{name}: "), clean, F.lit(CRLF)), F.lit(""))


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", uri: str = "url", payload: str = "html",
                   date: str = "2024-01-01T00:00:00Z", least_revisit: int = 0) -> None:
    """Writes the records of all pages below ``path``, through Spark's writer,
    as gzipped archives of about ``FILE_BYTES`` before compression.

    The payload is the column's UTF-8 (null: empty). Of pages with equal
    payloads of at least ``least_revisit`` bytes the one with the largest id
    (null is smallest; of rows that repeat it, one) becomes a response, the
    others revisits; smaller payloads are all responses. Groups are found by
    SHA-256; a hot payload's pages are joined without meeting in one task.
    """
    run = uuid.uuid4().hex
    raw = text_bytes(payload)
    rows = materialise(pages.select(
        F.col(page_id).cast("long").alias("page"), F.col(uri).cast("string").alias("uri"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("body"), F.sha2(raw, 256).alias("sha"),
        base32(F.sha1(raw)).alias("digest"), F.octet_length(raw).cast("long").alias("n"))
        .withColumn("row", F.monotonically_increasing_id()), "pages")
    groups = rows.groupBy("sha").agg(F.max(F.struct("page", "row")).alias("head"), F.count("*").alias("copies"))
    rows = join_with_hot(rows, materialise(groups, "payloads"), ["sha"], "copies")

    def name(kind: str, row: F.Column) -> F.Column:
        h = F.md5(F.concat(F.lit(f"{run}/{kind}/"), row.cast("string")))
        return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "(.{8})(.{4})(.{4})(.{4})(.{12})", "$1-$2-$3-$4-$5"), F.lit(">"))

    own = name("main", F.col("row"))
    common = [_header("WARC-Target-URI", F.col("uri")), F.lit(f"WARC-Date: {date}{CRLF}")]
    path_of = F.coalesce(F.regexp_extract("uri", r"^[^/]*//[^/\s]*([^\s#]*)", 1), F.lit(""))
    host = F.coalesce(F.regexp_extract("uri", r"^[^/]*//([^/\s?#]*)", 1), F.lit(""))
    request = _record("request", [
        _header("WARC-Record-ID", name("request", F.col("row"))), *common, _header("WARC-Concurrent-To", own),
        F.lit(f"Content-Type: application/http; msgtype=request{CRLF}")],
        F.concat(F.lit("GET "), F.when(path_of == "", "/").otherwise(path_of), F.lit(f" HTTP/1.1{CRLF}Host: "), host, F.lit(CRLF + CRLF)))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("n").cast("string"), F.lit(CRLF + CRLF))
    main = [_header("WARC-Record-ID", own), *common, F.lit(f"Content-Type: application/http; msgtype=response{CRLF}"),
            F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest"), F.lit(CRLF))]
    response = _record("response", main, F.concat(http, F.col("body")))
    revisit = _record("revisit", [*main, _header("WARC-Refers-To", name("main", F.col("head.row"))),
                                  F.lit(f"WARC-Profile: {REVISIT_PROFILE}{CRLF}")], http)
    metadata = _record("metadata", [
        _header("WARC-Record-ID", name("metadata", F.col("row"))), *common, _header("WARC-Concurrent-To", own),
        F.lit(f"Content-Type: application/warc-fields{CRLF}")],
        F.concat(_header("page-id", F.col("page").cast("string")), _header("payload-length", F.col("n").cast("string"))))
    again = (F.col("row") != F.col("head.row")) & (F.col("n") >= least_revisit)
    records = rows.select(F.explode(F.array(request, F.when(again, revisit).otherwise(response), metadata)).alias("value"))
    size = rows.agg(F.coalesce(F.avg(F.when(again, 0).otherwise(F.col("n"))), F.lit(0.0))).first()[0]
    # the writer ends each line, that is each record, with the two line ends of the standard
    (records.write.option("lineSep", CRLF + CRLF).option("compression", "gzip")
     .option("maxRecordsPerFile", max(3, int(3 * FILE_BYTES / (size + 1200)))).text(path))


_RECORD = ("file string, record_id string, type string, uri string, concurrent_to string, refers_to string, "
           "payload_digest string, payload_bytes long, headers map<string,string>, block binary")


def parse_records(data: bytes, file: str = "") -> Iterator[dict]:
    """Records of an archive, plain or gzipped (in one member or many), by
    their declared lengths."""
    stream = gzip.GzipFile(fileobj=io.BytesIO(data)) if data.startswith(b"\x1f\x8b") else io.BytesIO(data)
    while line := stream.readline():
        if not line.strip():
            continue                                     # the line ends between records
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC record where one should begin in {file}: {line[:40]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError(f"a record is cut off in {file}")
        yield {"file": file, "record_id": headers.get("warc-record-id"), "type": headers.get("warc-type"),
               "uri": headers.get("warc-target-uri"), "concurrent_to": headers.get("warc-concurrent-to"),
               "refers_to": headers.get("warc-refers-to"), "payload_digest": headers.get("warc-payload-digest"),
               "payload_bytes": None, "headers": headers, "block": block}


def _checked(record: dict, keep: bool) -> dict:
    """A response with its payload's length, its SHA-1 verified if it has one;
    without the payload unless it is to be kept."""
    if record["type"] != "response":
        return record
    head, split, payload = record["block"].partition(b"\r\n\r\n")
    if not split:
        head, payload = b"", record["block"]
    stated = record["payload_digest"]
    if stated and stated.startswith("sha1:") and stated[5:] != base64.b32encode(hashlib.sha1(payload).digest()).decode():
        raise ValueError(f"a payload does not have its digest {stated} in {record['file']}")
    return record | {"payload_bytes": len(payload)} | ({} if keep else {"block": head + split})


def read_records(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row for each record of all archives below ``path``; responses are
    verified against their digests. Without ``payloads`` a response's block is
    cut behind its HTTP header. A task holds one file as it lies on disk, and
    the records of a few MB."""
    schema = pa.schema([(n, pa.string()) for n in ("file", "record_id", "type", "uri", "concurrent_to", "refers_to", "payload_digest")]
                       + [("payload_bytes", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("block", pa.binary())])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for file, data in zip(batch.column("path"), batch.column("content")):
                held, size = [], 0
                for r in parse_records(data.as_py(), file.as_py()):
                    r = _checked(r, payloads)
                    held.append(r | {"headers": list(r["headers"].items())})
                    size += len(r["block"])
                    if size > 4 << 20 or len(held) >= 5000:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInArrow(run, _RECORD)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row for each capture, that is each response or revisit:
    record_id, type, uri, refers_to, payload_digest, payload_bytes, http
    (header), payload (null for a revisit), requests and metadata (lists of records that name
    it as concurrent, empty if none does). Records concurrent to no capture
    are left out."""
    split = F.expr("position(X'0D0A0D0A' in block)")
    http = F.when(split > 0, F.expr("substring(block, 1, position(X'0D0A0D0A' in block) - 1)").cast("string"))
    body = F.expr("substring(block, position(X'0D0A0D0A' in block) + 4)")
    main = records.filter("type in ('response', 'revisit')").select(
        "record_id", "type", "uri", "refers_to", "payload_digest", "payload_bytes", http.alias("http"),
        F.when(F.col("type") == "response", F.when(split > 0, body).otherwise(F.col("block"))).alias("payload"))
    side = records.filter("type in ('request', 'metadata') and concurrent_to is not null").groupBy("concurrent_to").agg(
        *(F.collect_list(F.when(F.col("type") == kind, F.struct("record_id", F.col("block").cast("string").alias("block")))).alias(name)
          for kind, name in (("request", "requests"), ("metadata", "metadata"))))
    joined = main.join(side.withColumnRenamed("concurrent_to", "record_id"), "record_id", "left")
    none = "cast(array() as array<struct<record_id:string,block:string>>)"
    return joined.withColumns({c: F.coalesce(F.col(c), F.expr(none)) for c in ("requests", "metadata")})


def captures(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of
    each capture in the archives. Digests of responses are verified; a
    revisit's length is the one its metadata record states."""
    field = lambda name: F.regexp_extract(F.concat_ws(CRLF, "metadata.block"), rf"(?:^|\n){name}: (-?\d+)", 1)
    # payloads are checked where they are read: only the small rest is joined
    rows = materialise(assemble(read_records(spark, path, payloads=False)).select(
        "record_id", "type", "refers_to", "payload_digest", "payload_bytes",
        F.nullif(field("page-id"), F.lit("")).cast("long").alias("page_id"),
        F.nullif(field("payload-length"), F.lit("")).cast("long").alias("stated")), "captures")
    first = rows.filter("type = 'response'").select("record_id", F.col("page_id").alias("target"))
    again = rows.filter("type = 'revisit'")
    copies = again.groupBy(F.col("refers_to").alias("record_id")).agg(F.count("*").alias("copies"))
    targets = materialise(copies.join(first, "record_id", "left").withColumnRenamed("record_id", "refers_to"), "targets")
    again = join_with_hot(again.filter("refers_to is not null"), targets, ["refers_to"], "copies").select(*rows.columns, "target")
    alone = rows.filter("type = 'response' or refers_to is null").withColumn("target", F.lit(None).cast("long"))
    return again.unionByName(alone).select(
        "page_id", F.coalesce("payload_bytes", "stated").alias("payload_bytes"),
        F.regexp_replace("payload_digest", "^sha1:", "").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("target").alias("refers_to"))


def q_warc(spark, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"), path)
    return captures(spark, path)


SQL_WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
g AS (SELECT t, max(page_id) AS head, sha1(t) AS h FROM p GROUP BY t)
SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('{BASE32}',
    CAST(((CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS INTEGER) >> CAST(5 * (3 - i % 4) AS INTEGER)) & 31) + 1 AS BIGINT), 1)), '')
    AS payload_digest,
  CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = head THEN NULL ELSE head END AS refers_to
FROM p JOIN g USING (t)"""
