"""WARC records in a content-addressed archive.

Two Parquet tables make an archive. ``payloads`` holds the bytes of every distinct payload once, under its SHA-256;
``headers`` holds one row a record: the exact bytes that stand before the payload (WARC header, and the HTTP header of
the block), its digest and its place. A record is the header, the payload unless it is a revisit, and two line ends, so
a join on the digest gives the original bytes back. The digest is verified where it is written (rows of one digest must
agree in length and in a second hash) and where it is read (it is taken of the stored bytes anew); a mismatch ends the
job.

Records of equal payloads of ``MIN_BYTES`` or more: that with the smallest page_id is the response and the others
are revisits that name it; shorter payloads are always responses. Copies are reduced to one in the task that reads them
and again over all, so a payload that a third of all pages share is neither gathered nor sent twice by a task.

A null html is an empty payload. A null url leaves out the target; line ends and other control characters in it are
percent-encoded, so that no url can add a header. Rows of one page_id are records apart, and of those that repeat the
smallest page_id of a payload one is the response, the others revisit it. A null page_id is a record too, but the response
only where no page of that payload has an id; its revisits then refer to null. Columns other than those named are not
looked at. An empty table gives an empty archive.

``write_warc`` and ``read_warc`` exchange records with WARC files.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.llm.common import kept, packed, scratch_path

MIN_BYTES = 100
# Records carry no fetch time of their own.
DATE = "1970-01-01T00:00:00Z"
END = "\r\n"
ENDS = (END + END).encode()
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CONTROL = r"[\x00-\x20\x7F]"

HEADERS_DDL = "page_id bigint, header binary, payload_digest string, has_payload boolean"
PAYLOADS_DDL = "payload_digest string, payload binary"


def payload_of(html: str) -> Column:
    return F.coalesce(F.encode(F.col(html).cast("string"), "UTF-8"), F.lit(b""))


def _distinct(pages: DataFrame) -> DataFrame:
    """Each payload once under its digest; the job ends if payloads of one digest differ."""
    second = F.xxhash64("payload", F.octet_length("payload"))
    hashed = pages.select(F.sha2("payload", 256).alias("payload_digest"), "payload", second.alias("second"))
    one = hashed.groupBy("payload_digest").agg(F.first("payload").alias("payload"), F.min("second").alias("least"), F.max("second").alias("most"))
    clash = F.raise_error(F.concat(F.lit("different payloads of digest "), F.col("payload_digest")))
    return one.select("payload_digest", F.when(F.col("least") == F.col("most"), F.col("payload")).otherwise(clash.cast("binary")).alias("payload"))


def _encoded(url: str) -> Column:
    """The url with control characters and spaces percent-encoded, byte by byte (they are ASCII)."""
    letters = F.split(F.col(url), "")
    safe = F.transform(letters, lambda c: F.when(c.rlike(f"^{CONTROL}$"), F.format_string("%%%02X", F.ascii(c))).otherwise(c))
    return F.when(F.col(url).rlike(CONTROL), F.array_join(safe, "")).otherwise(F.col(url))


def record_name(page_id: Column, digest: Column, copy: Column) -> Column:
    """A urn of the record: a hash of its page, payload and number among repeated rows, in the layout of a uuid."""
    hashed = F.sha2(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("null")), digest, copy.cast("string")), 256)
    return F.concat(F.lit("urn:uuid:"), F.regexp_replace(F.substring(hashed, 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def _line(name: str, value: Column) -> Column:
    """A header line, nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(END)), F.lit(""))


def records(pages: DataFrame, min_bytes: int = MIN_BYTES, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, header, payload_digest, has_payload`` of the WARC record of every page."""
    named = pages.select(F.col(page_id).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), payload_of(html).alias("payload"))
    # Written, so that a row keeps its number; a number tells repeated rows apart.
    index = kept(named.select("page_id", "url", F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("bigint").alias("size"), F.monotonically_increasing_id().alias("row")), "pages")
    shared = index.filter(F.col("size") >= min_bytes).groupBy("payload_digest").agg(F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "row", "url")).alias("first"), F.count("*").alias("copies"))
    joined = index.join(shared.filter("copies > 1").drop("copies"), "payload_digest", "left")
    is_first = F.col("first").isNull() | (F.col("first.row") == F.col("row"))
    typed = joined.select("*", is_first.alias("has_payload"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "), F.col("size").cast("string"), F.lit(END + END))
    block = F.octet_length(http) + F.when(F.col("has_payload"), F.col("size")).otherwise(0)
    revisit = ~F.col("has_payload")
    original = record_name(F.col("first.page_id"), F.col("payload_digest"), F.col("first.row"))
    header = F.concat(
        F.lit(f"WARC/1.1{END}WARC-Type: "), F.when(revisit, "revisit").otherwise("response"), F.lit(END),
        _line("WARC-Record-ID", F.concat(F.lit("<"), record_name(F.col("page_id"), F.col("payload_digest"), F.col("row")), F.lit(">"))),
        F.lit(f"WARC-Date: {DATE}{END}"),
        _line("WARC-Target-URI", _encoded("url")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        _line("WARC-Profile", F.when(revisit, PROFILE)),
        _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<"), original, F.lit(">")))),
        _line("WARC-Refers-To-Target-URI", F.when(revisit, _encoded("first.url"))),
        _line("WARC-Refers-To-Page", F.when(revisit, F.col("first.page_id").cast("string"))),
        F.lit(f"Content-Type: application/http; msgtype=response{END}"),
        _line("Content-Length", block.cast("string")),
        F.lit(END), http,
    )
    return typed.select("page_id", F.encode(header, "UTF-8").alias("header"), "payload_digest", "has_payload")


class Archive:
    """The two tables below a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def write(self, pages: DataFrame, min_bytes: int = MIN_BYTES, html: str = "html", **columns: str) -> Archive:
        """Store the pages' payloads, each once, and the records that point to them."""
        _distinct(pages.select(payload_of(html).alias("payload"))).write.parquet(f"{self.folder}/payloads")
        records(pages, min_bytes, html=html, **columns).write.parquet(f"{self.folder}/headers")
        return self

    def headers(self) -> DataFrame:
        return self.spark.read.schema(HEADERS_DDL).parquet(f"{self.folder}/headers")

    def payloads(self) -> DataFrame:
        """Digests with their bytes and size; bytes that no longer have their digest end the job."""
        stored = self.spark.read.schema(PAYLOADS_DDL).parquet(f"{self.folder}/payloads")
        damaged = F.raise_error(F.concat(F.lit("damaged payload "), F.col("payload_digest")))
        whole = F.when(F.sha2("payload", 256) == F.col("payload_digest"), F.octet_length("payload").cast("bigint")).otherwise(damaged.cast("bigint"))
        return stored.select("payload_digest", "payload", whole.alias("payload_bytes"))

    def resolved(self) -> DataFrame:
        """Every record's header fields, with the size of the payload that its digest names, taken of the stored bytes."""
        sizes = self.payloads().select("payload_digest", "payload_bytes")
        known = self.headers().join(sizes, "payload_digest", "left")
        lost = F.raise_error(F.concat(F.lit("no payload of digest "), F.col("payload_digest")))
        text = F.col("header").cast("string")

        def field(name: str) -> Column:
            found = F.regexp_extract(text, rf"\r\n{name}: ([^\r]*)\r\n", 1)
            return F.when(found != "", found)

        return known.select(
            "page_id",
            field("WARC-Type").alias("record_type"),
            field("WARC-Target-URI").alias("target"),
            F.replace(field("WARC-Payload-Digest"), F.lit("sha256:"), F.lit("")).alias("payload_digest"),
            F.coalesce("payload_bytes", lost.cast("bigint")).alias("payload_bytes"),
            field("WARC-Refers-To-Page").cast("bigint").alias("refers_to"),
        )

    def restored(self) -> DataFrame:
        """``page_id, record``: the bytes of every record as it would stand in a WARC file."""
        held = self.headers().withColumn("wanted", F.when(F.col("has_payload"), F.col("payload_digest")))
        stored = self.payloads().filter("payload_bytes IS NOT NULL").select(F.col("payload_digest").alias("wanted"), "payload")
        body = F.coalesce("payload", F.lit(b""))
        return held.join(stored, "wanted", "left").select("page_id", F.concat("header", body, F.lit(ENDS)).alias("record"))


def write_warc(restored: DataFrame, folder: str) -> None:
    """WARC files, one a task, each compressed as a whole. Records end in two line ends, and so do Spark's lines here."""
    bare = F.substring("record", F.lit(1), F.octet_length("record") - len(ENDS))
    restored.select(bare.cast("string").alias("value")).write.option("lineSep", END + END).option("compression", "gzip").text(folder)


def records_in(pieces: Iterable[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(header, payload) of the records of a file that has been cut at double line ends; blocks may hold such too."""
    held, head, want = bytearray(), b"", None
    for piece in pieces:
        held += piece + ENDS
        while True:
            if want is None:
                while held[:2] == END.encode():
                    del held[:2]
                stop = held.find(ENDS) + len(ENDS)
                if stop < len(ENDS):
                    break
                head = bytes(held[:stop])
                size = re.search(rb"(?i)\r\ncontent-length:[ \t]*(\d+)[ \t]*\r\n", head)
                if not head.startswith(b"WARC/") or not size:
                    raise ValueError(f"no WARC record: {head[:40]!r}")
                del held[:stop]
                want = int(size[1])
            if len(held) < want + len(ENDS):
                break
            if held[want : want + len(ENDS)] != ENDS:
                raise ValueError("a WARC record of another length than its header says")
            block = bytes(held[:want])
            del held[: want + len(ENDS)]
            want = None
            split = block.find(ENDS) + len(ENDS) if b"application/http" in head and ENDS in block else 0
            yield head + block[:split], block[split:]
    if want is not None or held.strip(END.encode()):
        raise ValueError("a WARC record is cut off")


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """``header, payload, payload_digest`` of the records of WARC files that are compressed as a whole (``.gz``).

    Such a file is not split: one task streams it, and holds a record at a time.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = (value or b"" for batch in batches for value in batch.column("value").to_pylist())
        yield from packed(records_in(pieces), pa.schema([("header", pa.binary()), ("payload", pa.binary())]), 64)

    lines = spark.read.option("lineSep", END + END).option("pathGlobFilter", "*.gz").text(folder)
    parsed = lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(run, "header binary, payload binary")
    return parsed.withColumn("payload_digest", F.sha2("payload", 256))


def digest(pages: DataFrame) -> DataFrame:
    """Every page's record, read back from an archive written for it."""
    archive = Archive(pages.sparkSession, scratch_path(pages.sparkSession, "warc")).write(pages)
    return archive.resolved().select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE = f"""
SELECT page_id, strlen(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest,
    CASE WHEN later THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN later THEN first END AS refers_to
FROM (SELECT page_id, body, min(page_id) OVER (PARTITION BY body) AS first,
        strlen(body) >= {MIN_BYTES} AND row_number() OVER (PARTITION BY body ORDER BY page_id) > 1 AS later
    FROM (SELECT page_id, coalesce(html, '') AS body FROM pages))
"""
