"""Content-addressed WARC archive in built-in expressions.

An archive is two tables. ``payloads`` holds the bytes of every distinct payload
once, under their SHA-256. ``headers`` holds the exact header bytes of every
record (WARC header and HTTP header) and the digest of its payload. Records, as
they stand in a WARC file and as they were captured, come back by a join.

Payloads are compared by SHA-256, SHA-1 and length together, and every read
computes the digests of the stored bytes again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_path, stage

DATE = "2024-01-01T00:00:00Z"
LEAST_REVISITED = 0  # payload bytes from which an equal payload becomes a revisit
_ID = "urn:page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: The digits of base 32 as ``conv`` writes them, and as digests do.
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32: four groups of 40 bits, eight digits each."""
    hexed = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(hexed, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)
    ]
    return F.translate(F.concat(*groups), _DIGITS, _BASE32)


def records_of(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url``, ``payload`` (the html in UTF-8, NULL: empty) and its digests."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    return (
        pages.select("page_id", "url", payload.alias("payload"))
        .withColumn("digest", F.sha2("payload", 256))
        .withColumn("sha1", base32_sha1(F.col("payload")))
        .withColumn("length", F.octet_length("payload").cast("bigint"))
    )


def _line(name: str, value: Column | str) -> Column:
    """A header line; NULL, which leaves the line out, if the value is NULL."""
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value)


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit(f"<{_ID}"), F.coalesce(page_id.cast("string"), F.lit("-")), F.lit(">"))


def _header() -> Column:
    """WARC header and HTTP header of a record as bytes."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat_ws(
        "\r\n",
        F.lit("HTTP/1.1 200 OK"),
        F.lit("Content-Type: text/html; charset=utf-8"),
        _line("Content-Length", F.col("length").cast("string")),
        F.lit("\r\n"),
    )
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    own = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("length"))
    warc = F.concat_ws(
        "\r\n",
        F.lit("WARC/1.1"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Date", DATE),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, _line("WARC-Profile", _PROFILE)),
        F.when(revisit, _line("WARC-Refers-To", _record_id(F.col("refers_to")))),
        F.lit("Content-Type: application/http; msgtype=response"),
        _line("Content-Length", own.cast("string")),
        F.lit("\r\n"),
    )
    return F.concat(warc, http).cast("binary")


def write_archive(pages: DataFrame, path: str, least: int = LEAST_REVISITED) -> None:
    """Writes ``headers`` and ``payloads`` below ``path``.

    Of equal payloads of at least ``least`` bytes the record with the greatest
    page id is the response, and all others revisit it; smaller payloads are all
    responses. Rows that repeat the greatest id are responses too, as are rows
    without an id if no equal payload has one. Whatever the record types, every
    payload is stored once.

    Only digests are grouped. Payloads that occur once are written where they
    were read; of those that occur more often, map tasks pass on one each.
    """
    records = records_of(pages)
    identity = ["digest", "sha1", "length"]
    counts = records.groupBy(*identity).agg(
        F.count("*").alias("copies"), F.max("page_id").alias("greatest")
    )
    copied = stage(counts.where("copies > 1"), "copied-payloads").withColumnsRenamed(
        {"digest": "c_digest", "sha1": "c_sha1", "length": "c_length"}
    )
    same = (
        (F.col("digest") == F.col("c_digest"))
        & (F.col("sha1") == F.col("c_sha1"))
        & (F.col("length") == F.col("c_length"))
    )
    other = (F.col("length") >= least) & ~F.col("page_id").eqNullSafe(F.col("greatest"))
    headers = (
        records.drop("payload")
        .join(copied, same, "left")
        .withColumn("refers_to", F.when(other, F.col("greatest")))
        .select("page_id", "digest", _header().alias("header"))
    )
    headers.write.parquet(f"{path}/headers")

    alone = records.join(copied, same, "left_anti").select("digest", "payload")
    shared = records.join(copied, same, "left_semi")
    once = shared.groupBy(*identity).agg(F.first("payload").alias("payload"))
    stored = alone.unionByName(once.select("digest", "payload"))
    stored.write.option("compression", "zstd").parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every record rebuilt: ``header``, ``payload``, its digests and the fields of the header.

    Raises if stored bytes do not have the digest that they are filed under, or
    if a header has no payload.
    """
    payloads = spark.read.parquet(f"{path}/payloads").select(
        F.col("digest").alias("p_digest"),
        "payload",
        F.sha2("payload", 256).alias("computed"),
        F.octet_length("payload").cast("bigint").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
    )
    text = F.col("header").cast("string")
    number = lambda name: F.regexp_extract(text, rf"\r\n{name}: <{_ID}(-?\d+)>\r\n", 1)
    whole = lambda name: F.when(number(name) != "", number(name).cast("bigint"))
    joined = spark.read.parquet(f"{path}/headers").join(
        payloads, F.col("digest") == F.col("p_digest"), "left"
    )
    stated = F.regexp_extract(text, r"\r\nWARC-Payload-Digest: sha1:(\w+)\r\n", 1)
    sound = F.col("computed").eqNullSafe(F.col("digest")) & (stated == F.col("payload_digest"))
    checked = F.when(
        F.coalesce(sound, F.lit(False)), F.col("payload_digest")
    ).otherwise(F.raise_error(F.concat(F.lit("stored payload does not match "), "digest")))
    return joined.select(
        whole("WARC-Record-ID").alias("page_id"),
        "header",
        "payload",
        "payload_bytes",
        checked.cast("string").alias("payload_digest"),
        F.regexp_extract(text, r"\r\nWARC-Type: (\w+)\r\n", 1).alias("record_type"),
        whole("WARC-Refers-To").alias("refers_to"),
    )


def record_bytes(archive: DataFrame) -> DataFrame:
    """``record``: the bytes of every record of a WARC file, with the two line ends behind it."""
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return archive.withColumn("record", F.concat("header", body, F.lit(b"\r\n\r\n")))


def original_bytes(archive: DataFrame) -> DataFrame:
    """``original``: the HTTP message as captured, also for revisits."""
    head = F.expr("substring(header, position(encode('\\r\\n\\r\\n', 'utf-8'), header) + 4)")
    return archive.withColumn("original", F.concat(head, "payload"))


def write_files(archive: DataFrame, path: str) -> None:
    """Plain WARC files: the text sink writes each record as it is, then the two line ends."""
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    record = F.concat("header", body).cast("string")
    archive.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").text(path)


def archived(pages: DataFrame) -> DataFrame:
    """Writes an archive of ``pages`` to the shared folder and reads it back."""
    path = new_path(pages.sparkSession, "warc")
    write_archive(pages, path)
    return read_archive(pages.sparkSession, path)
