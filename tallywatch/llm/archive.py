"""A content-addressed web archive of WARC records.

The archive is two tables: ``payloads`` holds the bytes of every distinct
payload once, by SHA-256, and ``heads`` the exact WARC and HTTP headers of every
record with the digest of its payload. Records are put together again by a
join on the digest; revisit records carry no payload, so a payload that a
third of all pages share is joined to one record only.

Of pages with equal payloads the one with the largest page_id is written as
the response and the others as revisits that refer to it. Payloads below
``least_bytes`` are always responses.

Digests are verified both ways: pages that share a SHA-256 must agree in SHA-1
and length when written, and payloads must hash to their key when read;
otherwise the query fails.

Defined results: a null html is the empty payload; rows that repeat the
responding page_id are each a response; a null page_id is a revisit where
some page with that payload has an id, else a response; control characters and
line separators in urls are percent-encoded and a null url leaves its field out; an empty table gives
an empty archive. Other columns are ignored.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DATE = "2024-01-01T00:00:00Z"
# Digits of base 32 in the order conv() writes them, and as digests use them: fixed values.
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_of_hex(digest: Column) -> Column:
    """Upper-case base 32 of 40 hexadecimal digits: five digits make four characters."""
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*groups)), CONV_DIGITS, BASE32_DIGITS)


# control characters and line separators, which would end a field or hide in it
NOT_IN_FIELDS = [*map(chr, range(0x20)), *map(chr, range(0x7F, 0xA0)), "\u2028", "\u2029"]


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", page_id.cast("string"), digest).cast("binary"))
    parts = [F.substring(h, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_archive(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write ``pages`` (page_id, url, html) as ``path/payloads`` and ``path/heads``."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).select(
        "page_id",
        "url",
        "payload",
        F.sha2("payload", 256).alias("digest"),
        F.sha1("payload").alias("sha1"),
        F.octet_length("payload").cast("long").alias("n"),
    )
    once = rows.groupBy("digest").agg(
        F.max("page_id").alias("responder"),
        F.first("payload").alias("payload"),
        F.min("sha1").alias("sha1"),
        F.max("sha1").alias("other_sha1"),
        F.min("n").alias("n"),
        F.max("n").alias("other_n"),
    )
    agreed = (F.col("sha1") == F.col("other_sha1")) & (F.col("n") == F.col("other_n"))
    checked = F.when(agreed, F.col("payload")).otherwise(F.raise_error(F.lit("different payloads with one digest")).cast("binary"))
    once.select("digest", "responder", checked.alias("payload")).write.parquet(f"{path}/payloads")
    stored = pages.sparkSession.read.parquet(f"{path}/payloads").select("digest", "responder")
    heads = rows.select("page_id", "url", "digest", "sha1", "n").join(stored, "digest")
    _with_heads(heads, least_bytes).write.parquet(f"{path}/heads")


def _with_heads(rows: DataFrame, least_bytes: int) -> DataFrame:
    is_response = F.col("page_id").eqNullSafe(F.col("responder")) | (F.col("n") < least_bytes)
    kind = F.when(is_response, F.lit("response")).otherwise(F.lit("revisit"))
    end = F.lit("\r\n")

    def field(name: str, value: Column) -> Column:
        # concat() is null for a null value, which leaves the field out
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, end), F.lit(""))

    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("n").cast("string"), end, end
    )
    revisit = F.col("record_type") == "revisit"
    length = F.octet_length("http_head") + F.when(revisit, F.lit(0)).otherwise(F.col("n"))
    encoded = F.col("url")
    for character in NOT_IN_FIELDS:
        encoded = F.replace(encoded, F.lit(character), F.lit(quote(character)))
    url = F.when(F.col("url").rlike(f"[{''.join(NOT_IN_FIELDS)}]"), encoded).otherwise(F.col("url"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        field("WARC-Date", F.lit(DATE)),
        field("WARC-Target-URI", url),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_of_hex(F.col("sha1")))),
        field("WARC-Profile", F.when(revisit, F.lit(REVISIT_PROFILE))),
        field("WARC-Refers-To", F.when(revisit, _record_id(F.col("responder"), F.col("digest")))),
        field("X-Page-ID", F.col("page_id").cast("string")),
        field("X-Refers-To-Page-ID", F.when(revisit, F.col("responder").cast("string"))),
        field("Content-Type", F.lit("application/http;msgtype=response")),
        field("Content-Length", length.cast("string")),
        end,
    )
    named = rows.withColumn("record_type", kind).withColumn("http_head", http)
    return named.select("digest", "record_type", head.alias("warc_head"), "http_head")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archive as ``record``, its exact bytes."""
    heads = spark.read.parquet(f"{path}/heads")
    payloads = spark.read.parquet(f"{path}/payloads").select("digest", "payload")
    start = F.concat(F.col("warc_head"), F.col("http_head")).cast("binary")
    end = F.lit(b"\r\n\r\n")
    sound = F.sha2("payload", 256) == F.col("digest")
    verified = F.when(sound, F.col("payload")).otherwise(F.raise_error(F.lit("payload does not match its digest")).cast("binary"))
    full = heads.where("record_type = 'response'").join(payloads, "digest", "left").select(F.concat(start, verified, end).alias("record"))
    return full.unionByName(heads.where("record_type <> 'response'").select(F.concat(start, end).alias("record")))


def parse_records(records: DataFrame) -> DataFrame:
    """Fields and payload of WARC response and revisit records, from their bytes.

    ``payload_bytes`` is the length of the full payload, which for revisits is
    the one their HTTP header states. A response whose payload does not match
    its digest fails the query.
    """
    gap = F.lit(b"\r\n\r\n")
    head_size = F.position(gap, F.col("record")) + F.lit(3)
    cut = records.select("record", head_size.alias("head_size"))
    cut = cut.select(
        F.expr("cast(substring(record, 1, head_size) as string)").alias("head"),
        F.expr("substring(record, head_size + 1, octet_length(record) - head_size - 4)").alias("block"),
    )
    cut = cut.select("head", "block", (F.position(gap, F.col("block")) + F.lit(3)).alias("http_size"))

    def field(text: str, name: str) -> Column:
        found = F.regexp_extract(F.col(text), rf"(?md)^{name}: ([^\r\n]*)", 1)
        return F.when(found == "", F.lit(None)).otherwise(found)

    parts = cut.select(
        field("head", "WARC-Type").alias("record_type"),
        field("head", "WARC-Record-ID").alias("record_id"),
        field("head", "WARC-Target-URI").alias("url"),
        F.substring_index(field("head", "WARC-Payload-Digest"), ":", -1).alias("payload_digest"),
        field("head", "X-Page-ID").cast("long").alias("page_id"),
        field("head", "X-Refers-To-Page-ID").cast("long").alias("refers_to"),
        F.expr("cast(substring(block, 1, http_size) as string)").alias("http_head"),
        F.expr("substring(block, http_size + 1, octet_length(block) - http_size)").alias("payload"),
    )
    is_response = F.col("record_type") == "response"
    sound = ~is_response | (base32_of_hex(F.sha1("payload")) == F.col("payload_digest"))
    digest = F.when(sound, F.col("payload_digest")).otherwise(F.raise_error(F.lit("record does not match its payload digest")))
    stated = field("http_head", "Content-Length").cast("long")
    return parts.select(
        "page_id",
        "url",
        "record_type",
        "record_id",
        "refers_to",
        digest.alias("payload_digest"),
        F.when(is_response, F.octet_length("payload").cast("long")).otherwise(stated).alias("payload_bytes"),
        F.when(is_response, F.col("payload")).alias("payload"),
    )
