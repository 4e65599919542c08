"""WARC records in a content-addressed archive.

An archive is a folder with two tables: ``payloads`` keeps the bytes of every
distinct payload once under its SHA-256, ``headers`` keeps every record's
exact header bytes with the SHA-256 that it refers to.  A record is its header
bytes, its payload and two CRLF; ``records`` joins the two tables to rebuild
them byte for byte, ``index`` reads headers and verified payload facts back
without moving payload bytes.

``first`` rows (the smallest page_id of equal payloads) are ``response``
records, the others ``revisit`` records that name the response they repeat;
payloads shorter than ``min_revisit`` bytes are always responses.

Defined cases: a null html is an empty payload, a null url an empty target
URI; rows with an equal page_id and payload give one response and revisits of
it; an empty table gives an empty archive; extra columns are not stored.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

CRLF = "\r\n"
# fixed value: the base32 alphabet of RFC 4648
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# fixed value: the digits that ``conv`` writes for base 32
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1: 20 bits (5 hex, 4 base32 digits)
    at a time, so it stays in SQL."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), DIGITS32, BASE32)


def _header(kind: Column, page_id: Column, url: Column, digest: Column, length: Column, refers: Column) -> Column:
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: <urn:page:"), page_id.cast("string"), F.lit(">")),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce(url, F.lit("")), r"[\r\n]", "")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), digest),
        F.when(kind == "revisit", F.concat(F.lit("WARC-Refers-To: <urn:page:"), refers.cast("string"), F.lit(">"))),
        F.concat(F.lit("Content-Length: "), length.cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF)).cast("binary")


def write(pages: DataFrame, path: str, min_revisit: int = 0) -> str:
    """Writes ``(page_id, url, html)`` rows as an archive under ``path``."""
    spark = pages.sparkSession
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    facts = rows.select("page_id", "url", F.sha2("payload", 256).alias("content"),
                        base32_sha1(F.col("payload")).alias("digest"), F.length("payload").cast("long").alias("n"),
                        F.monotonically_increasing_id().alias("copy"))       # tells equal rows apart
    facts.write.parquet(f"{path}/facts")
    # copies of a payload fall together on the map side already
    rows.groupBy(F.sha2("payload", 256).alias("content")).agg(F.first("payload").alias("payload")) \
        .write.option("compression", "zstd").parquet(f"{path}/payloads")
    facts = spark.read.parquet(f"{path}/facts")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "copy")
    first = facts.groupBy("content").agg(F.min(order).alias("first"))
    facts = facts.join(first, "content")
    is_first = F.col("copy") == F.col("first.copy")
    kind = F.when(is_first | (F.col("n") < min_revisit), "response").otherwise("revisit")
    facts.select(
        "page_id", "content",
        _header(kind, F.coalesce(F.col("page_id").cast("string"), F.lit("null")), F.col("url"), F.col("digest"),
                F.col("n"), F.col("first.page_id")).alias("header")).write.parquet(f"{path}/headers")
    return path


def records(spark: SparkSession, path: str) -> DataFrame:
    """Every record rebuilt: ``page_id, header, payload, record`` (bytes)."""
    headers, payloads = spark.read.parquet(f"{path}/headers"), spark.read.parquet(f"{path}/payloads")
    end = F.lit(CRLF + CRLF).cast("binary")
    return headers.join(payloads.select("content", "payload"), "content").select(
        "page_id", "header", "payload", F.concat("header", "payload", end).alias("record"))


def index(spark: SparkSession, path: str) -> DataFrame:
    """What the archive says about each record, its payload verified.

    Every stored payload is read and digested again; the digest and length so
    found join the parsed headers.  A payload whose SHA-256 is not its address,
    or a header that names another digest or length, raises an error.
    """
    payloads = spark.read.parquet(f"{path}/payloads").select(
        "content", F.sha2("payload", 256).alias("__sha256"), base32_sha1(F.col("payload")).alias("payload_digest"),
        F.length("payload").cast("long").alias("payload_bytes"))
    head = F.col("header").cast("string")

    def field(name: str) -> Column:
        return F.regexp_extract(head, rf"\r\n{name}: ([^\r]*)\r", 1)

    headers = spark.read.parquet(f"{path}/headers").select(
        "page_id", "content", field("WARC-Type").alias("record_type"), field("WARC-Payload-Digest").alias("__digest"),
        field("Content-Length").cast("long").alias("__n"), field("WARC-Refers-To").alias("__refers"))
    ok = (F.col("__sha256") == F.col("content")) & (F.concat(F.lit("sha1:"), "payload_digest") == F.col("__digest")) \
        & (F.col("__n") == F.col("payload_bytes"))
    joined = headers.join(payloads, "content", "left")
    kind = F.when(F.coalesce(ok, F.lit(False)), F.col("record_type")).otherwise(
        F.raise_error(F.concat(F.lit("archive damaged at page "), F.coalesce(F.col("page_id").cast("string"), F.lit("null")))))
    return joined.select("page_id", "payload_bytes", "payload_digest", kind.alias("record_type"),
                         F.expr("try_cast(regexp_extract(__refers, 'page:(-?[0-9]+)>', 1) as bigint)").alias("refers_to"))


def fresh_path(spark: SparkSession) -> str:
    """A new archive folder under the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), "archives", uuid.uuid4().hex[:12])
