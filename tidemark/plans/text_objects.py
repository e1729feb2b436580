"""Text jobs on ``documents``, ``pages`` and ``conversations``.

A row is an object with a name; the file jobs first write the texts as files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import objects, text
from tidemark.operators.line_stats import file_stats, text_stats
from tidemark.session import new_path
from tidemark.sources.tables import table
from tidemark.streaming.arrivals import stream_line_counts as start_line_counts

# Suffixes given to object names in turn; the last three are not text suffixes.
NAME_SUFFIXES = ("txt", "csv", "log", "md", "py", "js", "html", "XML", "json", "jpg", "bin", "gz")


def object_name() -> Column:
    """Name of a document: its source as folder, a suffix in turn."""
    suffixes = F.array(*[F.lit(suffix) for suffix in NAME_SUFFIXES])
    suffix = F.get(suffixes, (F.col("doc_id") % len(NAME_SUFFIXES)).cast("int"))
    top = F.when(F.col("doc_id") % 5 == 0, "archive").otherwise(objects.LABEL_FOLDER)
    stem = F.concat_ws("/", top, "source", F.col("doc_id").cast("string"))
    return F.concat(stem, F.lit("."), suffix)


def doc_line_counts(spark: SparkSession, folder: str) -> DataFrame:
    stats = text_stats(table(spark, folder, "documents"), "text", "doc_id")
    return stats.drop("word_count")


def doc_word_counts(spark: SparkSession, folder: str) -> DataFrame:
    return text_stats(table(spark, folder, "documents"), "text", "doc_id").select(
        "doc_id", "word_count"
    )


def page_stats(spark: SparkSession, folder: str) -> DataFrame:
    return text_stats(table(spark, folder, "pages"), "html", "page_id", unicode_breaks=True)


def conversation_stats(spark: SparkSession, folder: str) -> DataFrame:
    return text_stats(table(spark, folder, "conversations"), "text", "conv_id", "turn")


def _written_by_source(spark: SparkSession, folder: str) -> str:
    """Documents as text files, one folder per source; a text ends with a break."""
    path = new_path(spark, "documents-by-source")
    table(spark, folder, "documents").select("source", "text").write.partitionBy("source").text(path)
    return path


def _totals_by_source(stats: DataFrame) -> DataFrame:
    source = F.regexp_extract("path", "source=([^/]+)/", 1)
    return stats.groupBy(source.alias("source")).agg(
        *[F.sum(name).alias(name) for name in ("line_count", "word_count", "file_size_bytes")]
    )


def text_file_stats(spark: SparkSession, folder: str) -> DataFrame:
    return _totals_by_source(file_stats(spark, _written_by_source(spark, folder), "*.txt"))


def stream_line_counts(spark: SparkSession, folder: str) -> DataFrame:
    target = new_path(spark, "line-counts")
    checkpoint = new_path(spark, "line-counts-checkpoint")
    source = _written_by_source(spark, folder)
    start_line_counts(
        spark, source, target, checkpoint, "*.txt", unicode_breaks=True
    ).awaitTermination()
    return _totals_by_source(spark.read.parquet(target))


def extension_filter(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "documents").select("doc_id", object_name().alias("name"))
    return names.filter(text.has_text_suffix(F.col("name")))


def path_label(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "documents").select("doc_id", object_name().alias("name"))
    return names.withColumn("label", objects.path_label(F.col("name")))


def base64_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    encoded = objects.base64_text(F.encode("text", "UTF-8"))
    rows = table(spark, folder, "documents").select("doc_id", "text", encoded.alias("encoded"))
    decoded = objects.bytes_of_base64(F.col("encoded"))
    return rows.select(
        "doc_id",
        F.md5("encoded").alias("encoded_md5"),
        F.octet_length(decoded).cast("bigint").alias("decoded_bytes"),
        (decoded.cast("string") == F.col("text")).alias("same_text"),
    )


def text_decode_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Texts stored as Latin-1 where that can hold them, else as UTF-8, decoded again."""
    fits = F.col("text").rlike(r"\A[\x{00}-\x{ff}]*\z")
    content = F.when(fits, F.encode("text", "ISO-8859-1")).otherwise(F.encode("text", "UTF-8"))
    rows = table(spark, folder, "documents").select("doc_id", content.alias("content"))
    decoded = text.decode_text(F.col("content"))
    return rows.select(
        "doc_id", F.md5(decoded).alias("text_md5"), F.length(decoded).cast("bigint").alias("chars")
    )


QUERIES = {
    function.__name__: function
    for function in (
        doc_line_counts,
        doc_word_counts,
        page_stats,
        conversation_stats,
        text_file_stats,
        stream_line_counts,
        extension_filter,
        path_label,
        base64_roundtrip,
        text_decode_fallback,
    )
}


def _lines(column: str) -> str:
    """Texts here have line feeds only."""
    return f"""CASE WHEN {column} = '' THEN 0 ELSE
    length({column}) - length(replace({column}, chr(10), ''))
    + CASE WHEN right({column}, 1) = chr(10) THEN 0 ELSE 1 END END"""


def _words(column: str) -> str:
    return rf"len(regexp_extract_all({column}, '\S+'))"


def _stats(name: str, column: str, keep: str) -> str:
    return f"""SELECT {keep}, {_lines(column)} AS line_count, {_words(column)} AS word_count,
  strlen({column}) AS file_size_bytes FROM {name}"""


_NAME = """(CASE WHEN doc_id % 5 = 0 THEN 'archive' ELSE 'flower_photos' END || '/' || source || '/'
  || doc_id || '.' || ['txt', 'csv', 'log', 'md', 'py', 'js', 'html', 'XML', 'json', 'jpg', 'bin',
  'gz'][doc_id % 12 + 1])"""
_BY_SOURCE = f"""
SELECT source, CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS line_count,
  CAST(sum({_words('text')}) AS BIGINT) AS word_count,
  CAST(sum(strlen(text) + 1) AS BIGINT) AS file_size_bytes
FROM documents GROUP BY source"""

SQL = {
    "doc_line_counts": f"""
SELECT doc_id, {_lines('text')} AS line_count, strlen(text) AS file_size_bytes FROM documents""",
    "doc_word_counts": f"SELECT doc_id, {_words('text')} AS word_count FROM documents",
    "page_stats": _stats("pages", "html", "page_id"),
    "conversation_stats": _stats("conversations", "text", "conv_id, turn"),
    "text_file_stats": _BY_SOURCE,
    "stream_line_counts": _BY_SOURCE,
    "extension_filter": f"""
SELECT doc_id, name FROM (SELECT doc_id, {_NAME} AS name FROM documents)
WHERE regexp_matches(lower(name), '\\.(txt|csv|log|md|py|js|html|xml|json)$')""",
    "path_label": f"SELECT doc_id, {_NAME} AS name, source AS label FROM documents",
    "base64_roundtrip": """
SELECT doc_id, md5(to_base64(encode(text))) AS encoded_md5, strlen(text) AS decoded_bytes,
  true AS same_text
FROM documents""",
    "text_decode_fallback": """
SELECT doc_id, md5(text) AS text_md5, length(text) AS chars FROM documents""",
}
