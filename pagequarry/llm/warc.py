"""WARC archives in which repeated payloads are revisit records.

Headers alone are shuffled by payload digest to find the first page of each payload; the
payloads move once, to meet the decisions on their pages. Archives are text files written
by Spark (one gzip stream each), read back whole files at a time and parsed by the length
each record states, so payloads may hold anything, also what looks like a record.

Defined cases: a null html is an empty payload. Payloads of fewer than ``least`` bytes are
always responses. Pages without an id take part as the last of their payload. Repeated rows
(same id and payload) are all responses if their id is the smallest of the payload, else
all revisits. A line break in an address is written as %0D or %0A.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagequarry.scratch import materialise

# Fixed values of the archive format.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n\r\n"

LEAST_BYTES = 100
CHUNK = 1 << 20
ROWS = 500
RECORD = (
    "page_id long, record_type string, record_id string, refers_id string, uri string, "
    "stated_digest string, payload binary"
)


def _record_id(page_id: Column, digest: Column) -> Column:
    raw = F.md5(F.concat_ws("|", page_id.cast("string"), digest))
    parts = [F.substring(raw, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def revisits(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(page_id, digest, first_id) of the pages whose payload a smaller page has already.

    ``pages`` has page_id, digest, bytes. The smallest id of a payload is a minimum that
    is taken before the shuffle, so a payload that half of all pages share is no hot group.
    """
    large = pages.where(F.col("bytes") >= least).select("page_id", "digest")
    first = (
        large.groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("n"))
        .where("n > 1 AND first_id IS NOT NULL")
        .drop("n")
    )
    return (
        large.join(first, "digest")
        .where(~F.col("page_id").eqNullSafe(F.col("first_id")))
        .select("page_id", "digest", "first_id")
        .distinct()
    )


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> None:
    """Write a record for each row of (page_id, url, html) below ``path``."""
    html = F.coalesce("html", F.lit(""))
    pages = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        html.alias("html"),
        F.sha2(html, 256).alias("digest"),
        F.octet_length(html).alias("bytes"),
    )
    again = revisits(pages.select("page_id", "digest", "bytes"), least).select(
        F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "first_id"
    )
    same = F.col("page_id").eqNullSafe(F.col("again_id")) & (
        F.col("digest") == F.col("again_digest")
    )
    revisit = F.col("again_digest").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("bytes").cast("string"),
        F.lit(END),
    )
    block = F.when(revisit, F.col("http")).otherwise(F.concat("http", "html"))
    uri = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    refers = F.when(revisit, _record_id(F.col("first_id"), F.col("digest")))
    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        _line("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _line("WARC-Target-URI", uri),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", refers),
        _line("X-Page-Id", F.col("page_id").cast("string")),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", F.octet_length("block").cast("string")),
    )
    (
        pages.join(again, same, "left")
        .withColumn("http", http)
        .withColumn("block", block)
        .select(F.concat(header, F.lit("\r\n"), "block").alias("value"))
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .text(path)
    )


class _Stream:
    """Lines and blocks of a compressed file, a chunk in memory at a time."""

    def __init__(self, content: memoryview):
        self.content, self.at = content, 0
        self.unzip = zlib.decompressobj(31)
        self.ready = bytearray()
        self.used = 0

    def more(self) -> bool:
        while True:
            if self.unzip.eof:
                rest = self.unzip.unused_data
                if not rest and self.at >= len(self.content):
                    return False
                self.unzip = zlib.decompressobj(31)
            else:
                rest = self.unzip.unconsumed_tail
            if not rest:
                rest = self.content[self.at : self.at + CHUNK]
                self.at += len(rest)
                if not len(rest):
                    return False
            new = self.unzip.decompress(rest, CHUNK)
            if new:
                if self.used:
                    del self.ready[: self.used]
                    self.used = 0
                self.ready += new
                return True

    def line(self) -> bytes | None:
        while (end := self.ready.find(b"\r\n", self.used)) < 0:
            if not self.more():
                return None
        line = bytes(self.ready[self.used : end])
        self.used = end + 2
        return line

    def block(self, size: int) -> bytes:
        while len(self.ready) - self.used < size:
            if not self.more():
                raise ValueError("the archive ends inside a record")
        block = bytes(self.ready[self.used : self.used + size])
        self.used += size
        return block


def records(content: bytes | memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and payload of every record of a gzip-compressed archive."""
    stream = _Stream(memoryview(content))
    while (line := stream.line()) is not None:
        if not line:
            continue  # the end of the record before
        if line.decode() != VERSION:
            raise ValueError(f"not the beginning of a record: {line[:80]!r}")
        headers = {}
        while line := stream.line():
            name, _, value = line.decode().partition(": ")
            headers[name] = value
        block = stream.block(int(headers["Content-Length"]))
        yield headers, block.partition(END.encode())[2]


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below ``path``, with its payload (empty for a revisit)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORD.split(", ")]
        kinds = [pa.int64(), *[pa.string()] * 5, pa.binary()]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
            )

        rows, size = [], 0
        for files in parts:
            for content in files.column("content"):
                for headers, payload in records(content.as_buffer()):
                    page = headers.get("X-Page-Id")
                    rows.append(
                        (
                            int(page) if page is not None else None,
                            headers["WARC-Type"],
                            headers["WARC-Record-ID"],
                            headers.get("WARC-Refers-To"),
                            headers.get("WARC-Target-URI"),
                            headers["WARC-Payload-Digest"].removeprefix("sha256:"),
                            payload,
                        )
                    )
                    size += len(payload)
                    if len(rows) >= ROWS or size >= CHUNK:
                        yield batch(rows)
                        rows, size = [], 0
        if rows:
            yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(run, RECORD)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Join revisit records to the responses they name, which have the payload."""
    short = materialise(
        records.select(
            "page_id",
            "record_type",
            "record_id",
            "refers_id",
            F.octet_length("payload").cast("long").alias("bytes"),
            F.sha2("payload", 256).alias("digest"),
        ),
        "records",
    )
    whole = (
        short.where("record_type = 'response'")
        .select(
            F.col("record_id").alias("refers_id"),
            F.col("page_id").alias("refers_to"),
            F.col("bytes").alias("full_bytes"),
            F.col("digest").alias("full_digest"),
        )
        .distinct()
    )
    again = short.where("record_type = 'revisit'").join(whole, "refers_id", "left")
    return (
        short.where("record_type = 'response'")
        .select(
            "page_id",
            F.col("bytes").alias("payload_bytes"),
            F.col("digest").alias("payload_digest"),
            "record_type",
            F.lit(None).cast("long").alias("refers_to"),
        )
        .unionByName(
            again.select(
                "page_id",
                F.col("full_bytes").alias("payload_bytes"),
                F.col("full_digest").alias("payload_digest"),
                "record_type",
                "refers_to",
            )
        )
    )
