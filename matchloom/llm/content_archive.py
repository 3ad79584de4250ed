"""Content-addressed WARC archive: payload bytes once per digest, exact record headers apart, records rebuilt by a join.

An archive is a folder of two Parquet tables. `payloads` has one row per SHA-256 digest: the bytes, their number and the
least id that has them. `headers` has one row per record: the bytes that stand before the payload in a WARC file (record
header, blank line, HTTP header, blank line) and the digest. Of equal payloads of at least `least_bytes` bytes those of the
least id are response records, the others revisits that refer to it; smaller payloads are always responses, though stored
once. Everything is DataFrame functions: payloads are shuffled once, combined before, and a digest in a third of all records
is joined as a skewed join of its small columns.

A null payload is empty. A null id counts as the largest; rows of the least id with one payload are all responses. A null URL
leaves its line out; line breaks in one are percent-encoded. Extra columns are not stored. A payload whose bytes don't hash to
its digest, and a header whose payload is missing, stop the read. On writing, payloads of one digest are compared by their length and a
second, independent hash; if any differ, the write stops, so nothing is stored under another payload's digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST_BYTES = 100
CRLF = "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _records(pages: DataFrame, id_col: str, url_col: str, payload_col: str) -> DataFrame:
    payload = F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("record"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    return rows.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload").cast("long"))


def _name(record: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(record.cast("string"), F.lit("none")), F.lit(">"))


def _header(date: str) -> Column:
    """What stands before the payload, as text."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes").cast("string"), F.lit(CRLF * 2))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _name(F.col("record"))),
        F.concat(F.lit("WARC-Target-URI: "), url),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _name(F.col("refers_to")))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}")),
        F.lit("Content-Type: application/http;msgtype=response"),
        F.concat(F.lit("Content-Length: "), (F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))).cast("string")),
    )
    return F.concat(lines, F.lit(CRLF * 2), http)


def write_archive(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = LEAST_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """Writes `payloads` and `headers` under root."""
    spark = pages.sparkSession
    rows = _records(pages, id_col, url_col, payload_col)
    second = F.xxhash64("bytes", "payload")
    stored = rows.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("record").alias("first"), F.min(second).alias("low"), F.max(second).alias("high"))
    same = F.when(F.col("low") == F.col("high"), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("different payloads hash to "), F.col("digest"))).cast("binary"))
    stored.select("digest", same.alias("payload"), F.octet_length("payload").cast("long").alias("bytes"), "first").write.option("compression", "zstd").parquet(f"{root}/payloads")
    first = spark.read.parquet(f"{root}/payloads").select("digest", "first")
    records = rows.drop("payload").join(first, "digest")
    later = (F.col("bytes") >= least_bytes) & F.col("first").isNotNull() & (F.col("record").isNull() | (F.col("record") > F.col("first")))
    records = records.withColumn("refers_to", F.when(later, F.col("first")))
    records.select(F.encode(_header(date), "UTF-8").alias("header"), "digest").write.option("compression", "zstd").parquet(f"{root}/headers")


def _field(header: Column, name: str, what: str) -> Column:
    """A field of the record header, which ends at the first blank line."""
    found = F.regexp_extract(F.substring_index(header, CRLF * 2, 1), f"\r\n{name}: {what}", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, root: str) -> DataFrame:
    """One row per record: record, record_type, url, refers_to, digest, bytes, header, payload. Read only the columns that you need."""
    stored = spark.read.parquet(f"{root}/payloads").select(
        F.col("digest").alias("of"),
        F.when(F.sha2("payload", 256) == F.col("digest"), F.octet_length("payload").cast("long")).otherwise(F.raise_error(F.concat(F.lit("payload does not hash to "), F.col("digest"))).cast("long")).alias("held"),
        "payload",
    )
    text = F.decode("header", "UTF-8")
    heads = spark.read.parquet(f"{root}/headers").select(
        _field(text, "WARC-Record-ID", "<urn:record:(-?[0-9]+)>").cast("long").alias("record"),
        _field(text, "WARC-Type", "([a-z]+)").alias("record_type"),
        _field(text, "WARC-Target-URI", "([^\r\n]*)").alias("url"),
        _field(text, "WARC-Refers-To", "<urn:record:(-?[0-9]+)>").cast("long").alias("refers_to"),
        _field(text, "WARC-Payload-Digest", "sha256:([0-9a-f]+)").alias("digest"),
        "header",
    )
    missing = F.raise_error(F.concat(F.lit("no payload for "), F.col("digest"))).cast("long")
    both = heads.join(stored, F.col("digest") == F.col("of"), "left").withColumn("bytes", F.when(F.col("of").isNull(), missing).otherwise(F.col("held")))
    return both.select("record", "record_type", "url", "refers_to", "digest", "bytes", "header", "payload")


def warc_records(spark: SparkSession, root: str) -> DataFrame:
    """record and warc: each record's bytes as they stand in a WARC file; of a revisit these are its headers alone."""
    end = F.encode(F.lit(CRLF * 2), "UTF-8")
    whole = F.when(F.col("record_type") == "response", F.concat("header", "payload", end)).otherwise(F.concat("header", end))
    return read_archive(spark, root).where("bytes >= 0").select("record", whole.alias("warc"))


def rebuilt_facts(spark: SparkSession, root: str) -> DataFrame:
    """record, record_type, refers_to, payload_bytes, payload_digest and warc_bytes, worked out from each record's rebuilt bytes: header and payload are
    joined to the response as it was fetched, and what stands after the header is measured and hashed anew (a revisit's, too, with the payload that
    it refers to)."""
    end = F.encode(F.lit(CRLF * 2), "UTF-8")
    at = F.octet_length("header")
    rows = read_archive(spark, root).where("bytes >= 0").withColumn("fetched", F.concat("header", "payload", end))
    body = F.substring(F.col("fetched"), at + 1, F.octet_length("fetched") - at - len(CRLF * 2))
    stored = F.when(F.col("record_type") == "response", F.octet_length("fetched")).otherwise(at + len(CRLF * 2))
    return rows.select("record", "record_type", "refers_to", F.octet_length(body).cast("long").alias("payload_bytes"), F.sha2(body, 256).alias("payload_digest"), stored.cast("long").alias("warc_bytes"))
