"""Content-addressed WARC archive: payload bytes once by SHA-256, exact record headers apart, records rebuilt by joins.

Two tables in the shared folder: `headers` (page_id, header, digest), one row a
record, with the header block exactly as it stands in a WARC file; `payloads`
(digest, payload), one row for each distinct payload. Reading verifies every
payload against its digest once, then joins; nothing is trusted that was only
written. Hashes, base32 and parsing are DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import scratch, stage

#: Alphabet of base32 (RFC 4648) beside that of Spark's conv.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
CONV32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
CRLF = "\r\n"
DATE = "2020-01-01T00:00:00Z"


def base32(hexed: Column) -> Column:
    """Bare upper-case base32 of a SHA-1 given as 40 hex digits."""
    chunk = lambda i: F.lpad(F.conv(F.substring(hexed, 10 * i + 1, 10), 16, 32), 8, "0")
    return F.translate(F.concat(*(chunk(i) for i in range(4))), CONV32, BASE32)


def _facts(rows: DataFrame, payload: str) -> DataFrame:
    return rows.withColumn("payload_bytes", F.octet_length(payload).cast("long")).withColumn(
        "payload_digest", base32(F.sha1(payload)))


def _escaped(url: Column) -> Column:
    """A url as a header line can hold it: control characters and blanks as % and their code."""
    odd = r"[\x00-\x20\x7F]"
    code = lambda c: F.concat(F.lit("%"), F.lpad(F.hex(F.ascii(c)), 2, "0"))
    one = lambda c: F.when(c.rlike(odd), code(c)).otherwise(c)
    return F.when(url.rlike(odd), F.array_join(F.transform(F.split(url, ""), one), "")).otherwise(url)


def write(pages: DataFrame, path: str | None = None, least_bytes: int = 0, date: str = DATE) -> str:
    """Writes a record for every row of pages (page_id, url, html) and returns the archive's path.

    The payload is html in UTF-8, null as no bytes. Of records whose payloads are
    equal and of least_bytes or more, those with the least page_id are responses
    and the others revisits of it; rows with a null page_id revisit it too, and
    are responses if there is no page_id. The url stands in the headers with %
    codes for blanks and control characters, and beside them as it is; a null url
    has no line. Other columns are ignored; repeated rows give repeated records.
    """
    path = path or scratch(pages.sparkSession)
    rows = pages.select("page_id", "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    records = stage(_facts(rows, "payload").drop("payload"))
    first = stage(records.groupBy("digest").agg(F.min("page_id").alias("first")))
    # Copies drop out by digest and id, so a payload that is everywhere is not one task; what is left of a digest repeats its first page_id too.
    who = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias("who")
    won = rows.select("digest", who("page_id"), "payload").join(first.select("digest", who("first")), ["digest", "who"], "left_semi")
    won.dropDuplicates(["digest", "who"]).select("digest", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")
    records = records.join(first, "digest")
    again = (F.col("payload_bytes") >= least_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    kind = F.when(again, "revisit").otherwise("response")
    line = lambda name, *value: F.concat(F.lit(name + ": "), *value, F.lit(CRLF))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    http = F.concat(
        F.lit("HTTP/1.1 200 OK" + CRLF), line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.col("payload_bytes").cast("string")), F.lit(CRLF))
    block = F.octet_length(F.col("http")) + F.when(again, F.lit(0)).otherwise(F.col("payload_bytes"))
    header = F.concat(
        F.lit("WARC/1.1" + CRLF),
        line("WARC-Type", kind),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", _escaped(F.col("url"))), F.lit("")),
        line("WARC-Payload-Digest", F.lit("sha1:"), "payload_digest"),
        F.when(again, F.concat(
            line("WARC-Refers-To", urn(F.col("first"))),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        )).otherwise(F.lit("")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", block.cast("string")),
        F.lit(CRLF),
        F.col("http"),
    )
    out = records.withColumn("http", http).select("page_id", "url", F.encode(header, "UTF-8").alias("header"), "digest")
    out.write.option("compression", "zstd").parquet(f"{path}/headers")
    return path


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """(digest, payload, payload_bytes, payload_digest) of each stored payload; fails if the bytes don't match their digest."""
    stored = spark.read.schema("digest binary, payload binary").parquet(f"{path}/payloads")
    true = F.unhex(F.sha2("payload", 256)) == F.col("digest")
    damaged = F.raise_error(F.concat(F.lit("payload does not match its digest "), F.hex("digest")))
    return _facts(stored.withColumn("digest", F.when(true, F.col("digest")).otherwise(damaged.cast("binary"))), "payload")


def _field(header: Column, name: str) -> Column:
    return F.nullif(F.regexp_extract(header, rf"\r\n{name}: ([^\r]*)\r\n", 1), F.lit(""))


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record: page_id, record_type, refers_to, url, header, payload, payload_bytes, payload_digest.

    The fields come from the stored header (the url as it was given), the payload
    and its figures from the verified store; a header whose digest differs from
    the payload's fails. Columns that the caller drops are not moved through the join.
    """
    headers = spark.read.schema("page_id long, url string, header binary, digest binary").parquet(f"{path}/headers")
    text = F.decode("header", "UTF-8")
    parsed = headers.select(
        "digest", "header", "url",
        F.regexp_extract(_field(text, "WARC-Record-ID"), r"<urn:page:(-?[0-9]+)>", 1).alias("id"),
        _field(text, "WARC-Type").alias("record_type"),
        F.regexp_extract(F.coalesce(_field(text, "WARC-Refers-To"), F.lit("")), r"<urn:page:(-?[0-9]+)>", 1).alias("to"),
        _field(text, "WARC-Payload-Digest").alias("claimed"),
    )
    joined = parsed.join(payloads(spark, path), "digest")
    agrees = F.col("claimed") == F.concat(F.lit("sha1:"), "payload_digest")
    digest = F.when(agrees, F.col("payload_digest")).otherwise(F.raise_error(F.lit("header and payload differ")).cast("string"))
    return joined.select(
        F.nullif("id", F.lit("")).cast("long").alias("page_id"), "record_type",
        F.nullif("to", F.lit("")).cast("long").alias("refers_to"), "url", "header", "payload", "payload_bytes",
        digest.alias("payload_digest"),
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """The columns of read() and record: each record's bytes as they stand in a WARC file."""
    body = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return read(spark, path).withColumn("record", F.concat("header", body, F.lit(b"\r\n\r\n")))


def pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, url, html): the rows that were written, revisits included; a null html comes back empty."""
    return read(spark, path).select("page_id", "url", F.decode("payload", "UTF-8").alias("html"))
