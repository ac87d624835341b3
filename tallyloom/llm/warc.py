"""Content-addressed WARC archive.

Payload bytes are stored once per content, under their SHA-256; record headers are stored apart, byte for byte, with the
address of the payload. Original records come back by joining the two. A digest is verified twice: writing, two rows with one
digest must have one length and one SHA-1 besides; reading, both digests are computed again from the stored bytes.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import stage_table

# The base-32 digits of Java and of RFC 4648.
_DIGITS, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_CRLF = "\r\n"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: the 160 bits in eight groups of four digits."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), _DIGITS, _BASE32)


@dataclass(frozen=True)
class Archive:
    """Where the two tables of an archive are."""

    payloads: str
    headers: str


def write_archive(pages: DataFrame, path: str | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  date: str = "2024-01-01T00:00:00Z", least: int = 0) -> Archive:
    """Archives one WARC record per row of ``pages`` under ``path`` (a new folder in the shared one by default).

    A null payload is empty, a null URL leaves its header field out. Of rows with equal payloads of ``least`` bytes or more
    the one with the largest id is the response and the others revisit it; smaller ones are all responses. A row without an id
    is a response or revisit like any other and loses to any id; rows repeated with the largest id are all responses, sharing
    one payload. Other columns are not read. An empty table makes an empty archive.
    """
    spark = pages.sparkSession
    path = path or f"{shared_dir(spark).rstrip('/')}/archive-{uuid.uuid4().hex}"
    archive = Archive(f"{path}/payloads", f"{path}/headers")
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload"))
    narrow = stage_table(rows.select("page_id", "url", F.sha2("payload", 256).alias("address"), F.octet_length("payload").cast("long").alias("bytes"),
                                     base32_sha1(F.col("payload")).alias("sha1")))
    groups = narrow.groupBy("address").agg(F.max("page_id").alias("keeper"), F.min("bytes").alias("bytes_"), F.max("bytes").alias("bytes_2"),
                                           F.min("sha1").alias("sha1_"), F.max("sha1").alias("sha1_2"), F.count("*").alias("copies"))
    checked = F.when((F.col("bytes_") != F.col("bytes_2")) | (F.col("sha1_") != F.col("sha1_2")), F.raise_error(F.lit("two payloads have one digest")).cast("string")).otherwise(F.col("address"))
    groups = stage_table(groups.select(checked.alias("address"), "keeper", "copies"))
    named = narrow.join(groups, "address")
    first = F.coalesce(F.col("page_id") == F.col("keeper"), F.col("keeper").isNull())
    named = named.withColumn("kind", F.when(first | (F.col("bytes") < least), "response").otherwise("revisit"))
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("none")), F.lit(">"))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(_CRLF))
    revisit = F.col("kind") == "revisit"
    header = F.concat(
        F.lit(f"WARC/1.1{_CRLF}"), field("WARC-Type", F.col("kind")), field("WARC-Record-ID", uri(F.col("page_id"))),
        F.when(F.col("url").isNotNull(), field("WARC-Target-URI", F.regexp_replace("url", "[\r\n]", ""))).otherwise(""), field("WARC-Date", F.lit(date)),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                                 field("WARC-Refers-To", uri(F.col("keeper"))))).otherwise(""),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("bytes").cast("string"))), F.lit(_CRLF))
    named.select("page_id", header.alias("header"), "address").write.parquet(archive.headers)
    # a payload is stored from its keeper's row; rows of single payloads need no comparison
    spare = stage_table(named.filter("copies > 1 AND (kind = 'revisit' OR page_id IS NULL)").select(F.col("page_id").alias("_id"), F.col("address").alias("_address")).distinct())
    stored = rows.withColumn("address", F.sha2("payload", 256)).join(spare, F.expr("page_id <=> _id AND address = _address"), "left_anti")
    extra = rows.withColumn("address", F.sha2("payload", 256)).join(
        groups.filter("keeper IS NULL AND copies > 1").select(F.col("address").alias("_address")), F.expr("page_id IS NULL AND address = _address"), "left_semi")
    stored = stored.union(extra).select("address", "payload")
    shared = groups.filter("copies > 1").select(F.col("address").alias("_address"))
    # a repeated keeper row would store its payload twice
    twice = stored.join(shared, F.col("address") == F.col("_address"), "left_semi").dropDuplicates(["address"])
    once = stored.join(shared, F.col("address") == F.col("_address"), "left_anti")
    once.union(twice).write.parquet(archive.payloads)
    return archive


def read_headers(spark: SparkSession, archive: Archive) -> DataFrame:
    """page_id, header, address, and what the header says: record_type, digest, length, refers_to."""
    held = spark.read.parquet(archive.headers)
    return held.select("page_id", "header", "address", *_said())


def _said() -> list[Column]:
    """record_type, digest, length, refers_to of a column ``header``."""
    said = lambda name, form: F.nullif(F.regexp_extract("header", f"\n{name}: {form}\r\n", 1), F.lit(""))
    return [said("WARC-Type", "(\\w+)").alias("record_type"), said("WARC-Payload-Digest", "sha1:(\\w+)").alias("digest"),
            said("Content-Length", "(\\d+)").cast("long").alias("length"), said("WARC-Refers-To", "<urn:page:(-?\\d+)>").cast("long").alias("refers_to")]


def read_payloads(spark: SparkSession, archive: Archive) -> DataFrame:
    """address, payload, bytes, sha1; an address that its bytes do not have is an error."""
    held = spark.read.parquet(archive.payloads)
    sound = F.when(F.sha2("payload", 256) == F.col("address"), F.col("address")).otherwise(F.raise_error(F.lit("stored payload has another digest")).cast("string"))
    return held.select(sound.alias("address"), "payload", F.octet_length("payload").cast("long").alias("bytes"), base32_sha1(F.col("payload")).alias("sha1"))


def reconstruct(spark: SparkSession, archive: Archive) -> DataFrame:
    """page_id, record (bytes of the WARC record, as written to a file), payload (also of a record that revisits another)."""
    joined = read_headers(spark, archive).join(read_payloads(spark, archive), "address", "left")
    lost = F.raise_error(F.lit("header and payload disagree")).cast("binary")
    joined = joined.withColumn("payload", F.coalesce("payload", lost))
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return joined.select("page_id", F.concat(F.col("header").cast("binary"), body, F.lit((_CRLF * 2).encode())).alias("record"), "payload")


def archive_facts(spark: SparkSession, archive: Archive) -> DataFrame:
    """Per record, read back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    All is read from the reconstructed records: the header from a record's bytes, bytes and digest computed from its joined
    payload, which must agree with the header and with the record's body.
    """
    whole = reconstruct(spark, archive)
    header = F.concat(F.substring_index(F.col("record").cast("string"), _CRLF * 2, 1), F.lit(_CRLF))
    read = whole.select("page_id", "record", "payload", header.alias("header")).select("*", *_said())
    body = F.expr("substring(record, octet_length(header) + 3, octet_length(record) - octet_length(header) - 6)")
    stored = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    sha1 = base32_sha1(F.col("payload"))
    agrees = (F.col("digest") == sha1) & (F.col("length") == F.octet_length(body)) & (body == stored)
    digest = F.when(agrees, F.col("digest")).otherwise(F.raise_error(F.lit("header and payload disagree")).cast("string"))
    return read.select("page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", "refers_to")


def export_files(spark: SparkSession, archive: Archive, path: str) -> None:
    """Writes the records as WARC files: Spark's text writer ends each row with the blank lines that end a record."""
    text = reconstruct(spark, archive).select(F.expr("cast(substring(record, 1, length(record) - 4) as string)").alias("value"))
    text.write.option("lineSep", _CRLF * 2).text(path)
