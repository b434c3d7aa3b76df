"""A content-addressed WARC archive.

Method: a payload is stored once, under its SHA-256; the exact header bytes of every record are stored apart. Reading
verifies every payload against its digest and reconstructs each record by joining its header with the payload of its
digest. Both stores are Parquet tables in a folder that all executors share.

Scale: payloads are combined by digest before the exchange, so a payload that a third of all pages share moves once a
task. Reading joins on the digest; a reader that does not ask for the payloads moves only digests and lengths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch_dir

CRLF = "\r\n"


def _headers(kind: Column, page_id: Column, url: Column, digest: Column, size: Column, refers_to: Column, date: str) -> Column:
    uri = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7f]+", "%20")
    name = lambda i: F.concat(F.lit("<urn:page:"), F.coalesce(i.cast("string"), F.lit("null")), F.lit(">"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), name(page_id)),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), uri),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), digest),
        F.when(kind == "revisit", F.concat(F.lit("WARC-Refers-To: "), name(refers_to))),
        F.when(kind == "revisit", F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(kind == "revisit", F.lit("0")).otherwise(size.cast("string"))),
        F.concat(F.lit("X-Payload-Length: "), size.cast("string")),
    ]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF))


def write_archive(pages: DataFrame, path: str | None = None, min_revisit: int = 100, date: str = "2000-01-01T00:00:00Z", id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> str:
    """Write a record for each row of ``pages``; returns the archive's folder (``payloads`` and ``headers`` tables).

    Of records with equal payloads of at least ``min_revisit`` bytes that with the smallest id is a response and the
    others revisit it; shorter payloads are responses each. Null html is an empty payload; rows that repeat the id of a
    response are responses too; null ids come last; other columns are ignored whatever their names.
    """
    path = path or scratch_dir(pages.sparkSession)
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    rows.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("page_id").alias("first_id")).write.parquet(f"{path}/payloads")
    small = rows.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("size"))
    # by digest alone: equal digests are equal payloads, which the readers verify
    first = pages.sparkSession.read.parquet(f"{path}/payloads").select("digest", "first_id")
    typed = small.join(first, "digest").withColumn("again", (F.col("size") >= min_revisit) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id")))
    kind = F.when(F.col("again"), F.lit("revisit")).otherwise(F.lit("response"))
    header = _headers(kind, F.col("page_id"), F.col("url"), F.col("digest"), F.col("size"), F.col("first_id"), date)
    typed.select("page_id", "digest", F.encode(header, "UTF-8").alias("header")).write.parquet(f"{path}/headers")
    return path


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """page_id, record_type, refers_to, payload_digest, payload_bytes, header, payload, record of every record.

    Type, reference and length come from the header bytes, the digest from the stored payload; a payload that does not
    match its key or its record's length raises an error. ``record`` is the original record's bytes.
    """
    stored = spark.read.parquet(f"{path}/payloads").select("digest", "payload", F.sha2("payload", 256).alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    text = F.decode(F.col("header"), "UTF-8")
    field = lambda name: F.regexp_extract(text, rf"\r\n{name}: ([^\r]*)\r\n", 1)
    heads = spark.read.parquet(f"{path}/headers").select(
        "page_id", "header", F.col("digest").alias("_digest"), field("WARC-Type").alias("record_type"),
        F.expr("nullif(regexp_extract(decode(header, 'UTF-8'), '\\r\\nWARC-Refers-To: <urn:page:([0-9-]+)>', 1), '')").cast("long").alias("refers_to"),
        field("X-Payload-Length").cast("long").alias("_length"),
    )
    joined = heads.join(stored, F.col("_digest") == F.col("digest"), "left")
    intact = (F.col("payload_digest") == F.col("_digest")) & (F.col("payload_bytes") == F.col("_length"))
    checked = joined.withColumn("payload_digest", F.when(intact, F.col("payload_digest")).otherwise(F.raise_error(F.concat(F.lit("payload lost or damaged: "), "_digest"))))
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat("header", body, F.lit(b"\r\n\r\n"))
    return checked.select("page_id", "record_type", "refers_to", "payload_digest", "payload_bytes", "header", "payload", record.alias("record"))
