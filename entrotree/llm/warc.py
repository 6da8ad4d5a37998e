"""Operator 5: a content-addressed WARC archive.

``write_archive`` makes one WARC record per page.  Payload bytes are stored
once, under their SHA-256; the exact record headers stand in a table of their
own.  Of records with equal payloads the one with the smallest page_id is the
response, the others are revisits that refer to it.  ``read_records`` checks
every stored payload against its digest and rebuilds the records by a join.

Scale: who is the response is decided on (digest, page_id) alone.  Payloads are
shuffled once, to store each one time, and merged before the shuffle, so a
payload that a third of all pages share costs one row a task.  The headers of
such a payload are many rows of one join key on the large side; its payload is
a single row, which the planner copies when it splits the key.

Defined cases: a null html is the empty payload, a null url an absent header; a
null page_id is an absent header and comes last among equals (its revisits
refer to null if all ids are null); of repeated rows one is the response and the
others revisit it; payloads below ``min_bytes`` are all responses; an empty
table makes an empty archive; extra columns are ignored.  Text that isn't the
stored digest's raises an error.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..runtime import checkpoint_dir

MIN_BYTES = 0
DATE = "1970-01-01T00:00:00Z"  # pages carry no time of capture
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1 (160 bits: 32 characters) of a binary column."""
    h = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(h, a, n), 16, 32), n * 4 // 5, "0")
             for a, n in ((1, 15), (16, 15), (31, 10))]
    return F.translate(F.concat(*parts), DIGITS32, BASE32)


def _record_id(digest: Column, page_id: Column, copy: Column) -> Column:
    h = F.md5(F.concat_ws(":", digest, F.coalesce(page_id.cast("string"), F.lit("")), copy.cast("string")))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_archive(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Write ``path``/payloads (digest, payload) and ``path``/headers (digest, header)."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    full = pages.select("page_id", "url", payload.alias("payload")).withColumn("digest", F.sha2("payload", 256))
    (full.select("digest", "payload").dropDuplicates(["digest"])
     .write.option("compression", "zstd").parquet(f"{path}/payloads"))
    rows = full.select("page_id", "url", "digest", F.octet_length("payload").cast("long").alias("bytes"),
                       base32_sha1(F.col("payload")).alias("sha1"))
    heads = rows.groupBy("digest").agg(F.min("page_id").alias("first"))
    copy = F.row_number().over(Window.partitionBy("digest", "page_id").orderBy("url"))
    # Joined on a hash as well: the planner deals both sides out for it, and can split the pages of one payload.
    hashed = F.xxhash64("digest").alias("_h")
    d = rows.withColumn("copy", copy).select("*", hashed).join(heads.select("*", hashed), ["digest", "_h"])
    lone = F.col("bytes") < min_bytes
    response = lone | (F.col("page_id").eqNullSafe(F.col("first")) & (F.col("copy") == 1))
    url = F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = F.when(~response, F.concat(
        _line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        _line("WARC-Refers-To", _record_id(F.col("digest"), F.col("first"), F.lit(1))),
        _line("X-Refers-To-Page-Id", F.col("first").cast("string")))).otherwise(F.lit(""))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(response, F.lit("response")).otherwise(F.lit("revisit"))),
        _line("WARC-Record-ID", _record_id(F.col("digest"), F.col("page_id"), F.col("copy"))),
        _line("WARC-Date", F.lit(DATE)), _line("WARC-Target-URI", url),
        _line("X-Page-Id", F.col("page_id").cast("string")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))), revisit,
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(response, F.col("bytes")).otherwise(F.lit(0)).cast("string")),
        F.lit("\r\n"))
    (d.select("digest", header.alias("header"))
     .write.option("compression", "zstd").parquet(f"{path}/headers"))


def field(name: str) -> Column:
    """Value of a header field, null when it is absent."""
    got = F.regexp_extract("header", rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(F.contains("header", F.lit(f"\r\n{name}: ")), got)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: header, payload, record (the exact bytes), bytes and sha1 of the payload.

    The payload of a revisit is that of its response; its record has the header alone.
    """
    stored = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    checked = F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its digest "), F.col("digest"))))
    payloads = stored.select("digest", checked.alias("payload")).select(
        "digest", "payload", F.octet_length("payload").cast("long").alias("bytes"),
        base32_sha1(F.col("payload")).alias("sha1"))
    headers = spark.read.schema("digest string, header string").parquet(f"{path}/headers")
    block = F.when(field("WARC-Type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return headers.join(payloads, "digest").select(
        "header", "payload", "bytes", "sha1",
        F.concat(F.encode("header", "UTF-8"), block, F.lit(b"\r\n\r\n")).alias("record"))


def parsed(records: DataFrame) -> DataFrame:
    """header, payload_bytes and payload_digest of every record, read out of its exact bytes.

    A response has its payload in its own block, whose length and digest must be
    the header's; a revisit has none, and its header's digest must be that of the
    payload it was joined to.
    """
    header = F.concat(F.split_part(F.decode("record", "UTF-8"), F.lit("\r\n\r\n"), F.lit(1)), F.lit("\r\n"))
    cut = records.select("record", "bytes", "sha1", header.alias("header"))
    at, size = F.octet_length("header") + 2, F.octet_length("record")
    cut = cut.withColumn("block", F.substring("record", at + 1, size - at - 4))  # four bytes end the record
    response = field("WARC-Type") == "response"
    digest = F.substring(field("WARC-Payload-Digest"), len("sha1:") + 1, 32)
    length = field("Content-Length").cast("long")
    found = F.when(response, F.struct(F.octet_length("block").cast("long").alias("bytes"),
                                      base32_sha1(F.col("block")).alias("sha1"))).otherwise(
        F.struct(F.col("bytes").alias("bytes"), F.col("sha1").alias("sha1")))
    good = (length == F.octet_length("block")) & (digest == F.col("found.sha1"))
    return cut.withColumns({"found": found}).select(
        "header", F.col("found.bytes").alias("payload_bytes"),
        F.when(good, digest).otherwise(F.raise_error(F.concat(F.lit("record does not match its header: "), "header")))
        .alias("payload_digest"))


def round_trip(pages: DataFrame, path: str | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write the archive (a new folder in the shared one by default), read it back, one row per page."""
    spark = pages.sparkSession
    path = path or f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_archive(pages, path, min_bytes)
    kind = pages.schema["page_id"].dataType
    return parsed(read_records(spark, path)).select(
        field("X-Page-Id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
        field("WARC-Type").alias("record_type"), field("X-Refers-To-Page-Id").cast(kind).alias("refers_to"))


_PARTS = " || ".join(
    f"list_aggregate(list_transform(range({n} - 1, -1, -1), lambda i: substr('{BASE32}', "
    f"CAST((CAST('0x' || substr(h, {a}, {m}) AS BIGINT) >> CAST(5 * i AS BIGINT)) & 31 AS INT) + 1, 1)), 'string_agg', '')"
    for a, m, n in ((1, 15, 12), (16, 15, 12), (31, 10, 8)))
ORACLE = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, payload_bytes, {_PARTS} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN f USING (h)
"""
