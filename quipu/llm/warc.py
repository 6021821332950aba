"""Web captures as WARC archives, and their transactions put together again.

Writing makes three records for each page: the request, the response or a revisit of an
earlier equal payload, and metadata.  Request and metadata name the response by
``WARC-Concurrent-To``.  Reading parses any number of archives into one row per record
by content length; assembly joins the three records of a capture through those
identifiers into one nested row.

A null payload counts as empty, and empty payloads equal each other.  A null address has
no ``WARC-Target-URI`` and reads back as null; line breaks in one are written as percent
codes.  A null page id is written without a value and reads back as null.  Record
identifiers follow from page, address and payload, so rows that repeat all three are one
capture; with ``repeats`` each is a capture of its own, and the identifiers count them.
Of equal payloads that reach the least size, the records with the smallest page id are
responses, and revisits name the first of them; null page ids come last.  Columns beside
the three named ones are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quipu.session import materialize

# Fixed values of the archive format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

PAGES_PER_FILE = 2048
CAPTURED = "2000-01-01T00:00:00Z"


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base32 form of a SHA-1 digest."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", BASE32_DIGITS)


def _record_id(kind: str, copy: Column, page: str = "page_id", url: str = "url") -> Column:
    page_id = F.coalesce(F.col(page).cast("string"), F.lit(""))
    address = F.concat(F.col(url).isNull().cast("string"), F.lit("|"), F.coalesce(F.col(url), F.lit("")))
    named = F.md5(F.concat_ws("|", F.lit(kind), page_id, F.col("secure"), copy.cast("string"), address))
    pieces = [F.substring(named, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *pieces), F.lit(">"))


def _record(kind: Column | str, block: Column, **headers: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    lines = [F.concat(F.lit("WARC-Type: "), kind), F.lit(f"WARC-Date: {CAPTURED}")]
    for name, value in headers.items():
        lines.append(F.concat(F.lit(name.replace("_", "-") + ": "), value))  # null, and so left out, without a value
    lines.append(F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string")))
    return F.concat(F.concat_ws("\r\n", F.lit(VERSION), *lines), F.lit("\r\n\r\n"), block)


def write(
    pages: DataFrame, path: str, id: str = "page_id", url: str = "url", payload: str = "html",
    least_bytes: int = 0, pages_per_file: int = PAGES_PER_FILE, repeats: bool = False,
) -> None:
    """Write gzip archives of bounded length below ``path`` through Spark's writer.

    With ``repeats``, rows that repeat page, address and payload are captures of their own.
    """
    body = F.make_valid_utf8(F.coalesce(F.col(payload), F.lit("")))
    rows = pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("body"))
    rows = rows.withColumn("secure", F.sha2("body", 256)).withColumn("size", F.octet_length("body"))

    # One small row for each payload that occurs more than once.
    key = ["page_id", "url", "secure"]
    which = F.struct(*key).eqNullSafe(F.col("which"))
    many = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.struct(*key).alias("which"), "n")
    order = F.struct(F.col("page_id").isNull().alias("nameless"), "page_id", F.col("url").isNotNull().alias("addressed"), "url")
    first = rows.where(F.col("size") >= least_bytes).groupBy("secure").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
    rows = rows.join(first.where("n > 1").select("secure", "first"), "secure", "left").withColumn("copy", F.lit(0).cast("long"))
    many = materialize(many, "repeated-pages") if repeats else None
    if many is not None and not many.isEmpty():
        # Only rows that others repeat meet again: one body for each, and a small row for each copy.
        copies = many.select("which", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n") - 1)).alias("copy_"))
        bodies = rows.join(many, which, "left_semi").dropDuplicates(key)
        more = bodies.join(copies, which).withColumn("copy", F.col("copy_")).drop("which", "copy_")
        rows = rows.join(many, which, "left_anti").unionByName(bodies).unionByName(more)
    same = F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.col("page_id").isNotNull() | (F.col("url").eqNullSafe(F.col("first.url")) & (F.col("copy") == 0)))
    revisit = F.col("first").isNotNull() & ~same
    copy = F.col("copy")

    uri = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    host = F.coalesce(F.regexp_extract(uri, "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1), F.lit(""))
    target = F.coalesce(F.regexp_extract(uri, "^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)", 1), F.lit(""))
    ask = F.concat(F.lit("GET "), F.when(target.startswith("/"), target).otherwise(F.concat(F.lit("/"), target)), F.lit(" HTTP/1.1\r\nHost: "), host, F.lit("\r\n\r\n"))
    size = F.col("size").cast("string")
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    answer = _record_id("response", copy)
    refers = F.when(revisit, _record_id("response", F.lit(0), "first.page_id", "first.url"))
    request = _record(
        "request", ask,
        WARC_Record_ID=_record_id("request", copy), WARC_Concurrent_To=answer, WARC_Target_URI=uri,
        Content_Type=F.lit("application/http;msgtype=request"),
    )
    response = _record(
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("body"))),
        WARC_Record_ID=answer, WARC_Target_URI=uri,
        WARC_Payload_Digest=F.concat(F.lit("sha1:"), base32_sha1(F.col("body"))),
        WARC_Refers_To=refers, WARC_Profile=F.when(revisit, F.lit(REVISIT_PROFILE)),
        Content_Type=F.lit("application/http;msgtype=response"),
    )
    notes = F.concat(F.lit("page-id: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit("\r\npayload-bytes: "), size, F.lit("\r\n"))
    metadata = _record(
        "metadata", notes,
        WARC_Record_ID=_record_id("metadata", copy), WARC_Concurrent_To=answer, WARC_Target_URI=uri,
        Content_Type=F.lit("application/warc-fields"),
    )
    end = F.lit("\r\n\r\n")
    # The writer adds the last line feed of each capture's last record.
    capture = F.concat(request, end, response, end, metadata, F.lit("\r\n\r"))
    lines = rows.select(capture.alias("value"))
    lines.write.option("compression", "gzip").option("lineSep", "\n").option("maxRecordsPerFile", pages_per_file).text(path)


RECORD_SCHEMA = (
    "type string, record_id string, concurrent_to string, refers_to string, target_uri string, payload_digest string, "
    "payload binary, payload_bytes long, payload_sha1 string"
)


def parse(data: bytes) -> Iterator[tuple]:
    """The records of one uncompressed archive, each found by its content length."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode("utf-8").split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {name.lower(): value for name, _, value in (line.partition(": ") for line in lines)}
        start = end + 4
        at = start + int(headers["content-length"])
        block = data[start:at]
        at += 4
        kind = headers["warc-type"]
        if headers.get("content-type", "").startswith("application/http"):
            block = block[block.index(b"\r\n\r\n") + 4 :]
        digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
        yield (
            kind,
            headers["warc-record-id"],
            headers.get("warc-concurrent-to"),
            headers.get("warc-refers-to"),
            headers.get("warc-target-uri"),
            headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            *((None, None, None) if kind == "revisit" else (block, len(block), digest)),
        )


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [part.split()[0] for part in RECORD_SCHEMA.split(", ")]
    types = [pa.string()] * 6 + [pa.binary(), pa.int64(), pa.string()]
    for batch in batches:
        for content in batch.column(0):
            rows = list(parse(gzip.decompress(content.as_buffer())))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 9, types)], names=names)


def read(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives below ``path``; an empty folder has none."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path)
    return files.select("content").mapInArrow(_records, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture; a capture without request or metadata has a null there.

    Records with a repeated identifier count once.
    """
    answers = records.where("type IN ('response', 'revisit')")
    once = Window.partitionBy("record_id").orderBy("record_id")
    answers = answers.withColumn("copy", F.row_number().over(once)).where("copy = 1")
    sides = records.where("type IN ('request', 'metadata') AND concurrent_to IS NOT NULL")
    sides = sides.select(F.col("concurrent_to").alias("record_id"), "type", F.struct(F.col("record_id").alias("id"), "payload").alias("side"))
    both = sides.groupBy("record_id").agg(
        F.min(F.when(F.col("type") == "request", F.col("side"))).alias("request"),
        F.min(F.when(F.col("type") == "metadata", F.col("side"))).alias("metadata"),
    )
    own = ["type", "target_uri", "payload_digest", "refers_to", "payload", "payload_bytes", "payload_sha1"]
    return answers.join(both, "record_id", "left").select("record_id", F.struct(*own).alias("response"), "request", "metadata")


def field(name: str) -> Column:
    """A field of a capture's metadata record."""
    return F.regexp_extract(F.col("metadata.payload").cast("string"), rf"(?m)^{name}: ([^\r\n]*)", 1)


def captures(transactions: DataFrame) -> DataFrame:
    """Page, size, digest, type and revisited page of each assembled capture."""
    flat = transactions.select(
        "record_id",
        F.nullif(field("page-id"), F.lit("")).cast("long").alias("page_id"),
        F.coalesce("response.payload_bytes", field("payload-bytes").cast("long")).alias("payload_bytes"),
        F.coalesce("response.payload_sha1", "response.payload_digest").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        F.col("response.refers_to").alias("refers_id"),
    )
    flat = materialize(flat, "captures")
    firsts = flat.where("record_type = 'response'").select(F.col("record_id").alias("refers_id"), F.col("page_id").alias("refers_to"))
    return flat.join(firsts, "refers_id", "left").drop("refers_id", "record_id")
