"""A content-addressed WARC archive.

Payload bytes are stored once per SHA-256 in ``payloads``; the exact header bytes of
every record stand in ``headers``. Records come back by joining the two on the digest,
and every payload read back is hashed again: a payload that does not have its digest
raises an error. Column expressions only.

Of records with equal payloads the one with the largest page id is the response, the
others revisit it; payloads below ``min_revisit_bytes`` are all responses.

Defined results: a null payload counts as empty; a null url leaves out the target field;
a null page id is written as an empty id and loses to any other as response; rows with
equal page id and equal payload are records of the same type; other columns are ignored;
an empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The digits of base 32, as conv() and as RFC 4648 writes them.
_CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base 32: 5 hexadecimal digits are 4 of base 32."""
    hexed = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), _CONV_DIGITS, _BASE32_DIGITS)


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _header() -> Column:
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.col("size").cast("string"),
        F.lit(CRLF + CRLF),
    )
    revisit = F.col("record_type") == "revisit"
    target = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    block = F.length(http) + F.when(revisit, F.lit(0)).otherwise(F.col("size"))
    return F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        _field("WARC-Date", F.col("date")),
        _field("WARC-Target-URI", target),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("refers_to").cast("string"), F.lit(">")))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", block.cast("string")),
        F.lit(CRLF),
        http,
    )


def write_archive(
    pages: DataFrame, path: str, min_revisit_bytes: int = 0, date: str = "2024-01-01T00:00:00Z"
) -> None:
    """Write ``payloads`` (key, payload) and ``headers`` (key, header) below ``path``.

    Only digests are grouped; a payload moves once, to the row of its owner. That join is
    by digest and page id, so a payload that a third of all pages share stays spread out.
    """
    spark = pages.sparkSession
    rows = pages.select(
        "page_id",
        "url",
        F.coalesce("html", F.lit("")).cast("binary").alias("payload"),
    ).withColumn("key", F.sha2("payload", 256))
    rows.select(
        "key", "page_id", "url", base32_sha1(F.col("payload")).alias("sha1"), F.length("payload").cast("long").alias("size")
    ).write.parquet(f"{path}/facts")
    facts = spark.read.parquet(f"{path}/facts")
    owners = facts.groupBy("key").agg(F.max("page_id").alias("owner"))

    # both sides name a page by text, null by none: the join and the dropping of repeated
    # rows then share one partitioning, and payloads move once
    page = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias("page")
    owned = rows.select("key", page("page_id"), "payload").join(owners.select("key", page("owner")), ["key", "page"])
    stored = owned.dropDuplicates(["key", "page"]).select("key", "payload")
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")
    responds = (F.col("size") < min_revisit_bytes) | F.col("page_id").eqNullSafe(F.col("owner"))
    records = facts.join(owners, "key").select(
        "*",
        F.when(responds, "response").otherwise("revisit").alias("record_type"),
        F.col("owner").alias("refers_to"),
        F.lit(date).alias("date"),
    )
    records.select("key", _header().cast("binary").alias("header")).write.parquet(f"{path}/headers")


def _value(name: str) -> Column:
    found = F.regexp_extract("_text", rf"\r\n{name}: ([^\r\n]*)", 1)
    return F.when(found != "", found)


def _id(name: str) -> Column:
    return F.regexp_extract(F.coalesce(_value(name), F.lit("")), r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record: ``page_id, record_type, refers_to, url, payload_digest, payload_bytes,
    header, payload, record``.

    ``payload`` is the full payload, also of a revisit; ``record`` the bytes as a WARC
    file holds them. Digests and lengths are those of the bytes read back.
    """
    stored = spark.read.parquet(f"{path}/payloads").select(
        "key",
        "payload",
        F.length("payload").cast("long").alias("payload_bytes"),
        F.when(F.sha2("payload", 256) == F.col("key"), base32_sha1(F.col("payload")))
        .otherwise(F.raise_error(F.lit("a stored payload does not have its digest")))
        .alias("payload_digest"),
    )
    headers = spark.read.parquet(f"{path}/headers").withColumn("_text", F.col("header").cast("string"))
    fields = headers.select(
        "key",
        "header",
        _id("WARC-Record-ID").alias("page_id"),
        _value("WARC-Type").alias("record_type"),
        _id("WARC-Refers-To").alias("refers_to"),
        _value("WARC-Target-URI").alias("url"),
        _value("WARC-Payload-Digest").alias("_digest"),
    )
    end = F.lit((CRLF + CRLF).encode())
    block = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return fields.join(stored, "key").select(
        "page_id",
        "record_type",
        "refers_to",
        "url",
        F.when(F.col("_digest") == F.concat(F.lit("sha1:"), F.col("payload_digest")), F.col("payload_digest"))
        .otherwise(F.raise_error(F.lit("a header names another digest than its payload has")))
        .alias("payload_digest"),
        "payload_bytes",
        "header",
        "payload",
        F.concat(F.col("header"), block, end).alias("record"),
    )


def export_warc(records: DataFrame, path: str) -> None:
    """Write records as ``.warc`` text files, each record closed by two line ends."""
    block = F.when(F.col("record_type") == "response", F.col("payload").cast("string")).otherwise("")
    text = F.concat(F.col("header").cast("string"), block)
    records.select(text.alias("value")).write.option("lineSep", CRLF + CRLF).text(path)
