"""Lines, words and bytes per text object."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import objects, text


def text_stats(df: DataFrame, column: str, *keep: str, unicode_breaks: bool = False) -> DataFrame:
    """Counts of a text column, one row per object, without a shuffle."""
    body = F.col(column)
    return df.select(
        *keep,
        text.line_count(body, unicode_breaks).alias("line_count"),
        text.word_count(body).alias("word_count"),
        text.byte_count(body).alias("file_size_bytes"),
    )


def stats_of_lines(lines: DataFrame, unicode_breaks: bool = False) -> DataFrame:
    """Counts per file from rows ``value, _metadata`` cut at ``\\n``.

    A big file is read by many tasks and its lines are summed on the map side,
    so one file holding most of the data is no bottleneck. Breaks other than
    ``\\n`` are counted inside each piece; every piece is one line more than it
    has inner breaks. The single exception is a file whose last piece has no
    ``\\n`` and ends in one of the extra breaks: it then holds no further line.
    """
    value = F.col("value")
    # A \r at the end belongs to the \n, or ends the last line just as well.
    inner_breaks = text.inner_breaks(value, unicode_breaks) - value.endswith("\r").cast("int")
    ends_in_extra = text.ends_in_break(value, unicode_breaks) & ~value.endswith("\r")
    rows = lines.select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_size").alias("file_size_bytes"),
        F.col("_metadata.file_block_start").alias("block"),
        (inner_breaks + 1).alias("pieces"),
        text.word_count(value).alias("words"),
        (F.octet_length(value) + 1).alias("bytes"),
        ends_in_extra.alias("ends_in_extra"),
        # One task reads a block from front to back.
        F.monotonically_increasing_id().alias("place"),
    )
    sums = [F.sum(name).alias(name) for name in ("pieces", "words", "bytes")]
    per_block = rows.groupBy("path", "file_size_bytes", "block").agg(
        *sums,
        F.max("place").alias("last"),
        F.max(F.when(F.col("ends_in_extra"), F.col("place"))).alias("last_extra"),
    )
    per_file = per_block.groupBy("path", "file_size_bytes").agg(
        *sums, F.max_by(F.col("last").eqNullSafe(F.col("last_extra")), "block").alias("extra_end")
    )
    # One byte more than the file has: no break after the last piece. A byte
    # order mark, three bytes, is not part of the first line.
    unfinished = (F.col("bytes") - F.col("file_size_bytes")).isin(1, -2)
    no_last_line = F.col("extra_end") & unfinished
    return per_file.select(
        "path",
        objects.file_name(F.col("path")).alias("file_name"),
        (F.col("pieces") - no_last_line.cast("int")).cast("bigint").alias("line_count"),
        F.col("words").alias("word_count"),
        "file_size_bytes",
    )


def file_stats(
    spark: SparkSession, path: str, pattern: str = "*", unicode_breaks: bool = False
) -> DataFrame:
    """Counts for every file below ``path`` that is not empty.

    Spark leaves files without a byte out of its listings; ``listed_stats`` adds
    them where the names are known from elsewhere, say from upload events.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("lineSep", "\n")
        .text(path)
        .select("value", "_metadata")
    )
    return stats_of_lines(lines, unicode_breaks)


def listed_stats(listed: DataFrame, stats: DataFrame) -> DataFrame:
    """Counts for every listed ``path``; a file without counts is an empty one."""
    counts = ("line_count", "word_count", "file_size_bytes")
    counted = stats.select(objects.plain_path(F.col("path")).alias("_path"), *counts)
    same_file = objects.plain_path(F.col("path")) == F.col("_path")
    return listed.join(counted, same_file, "left").select(
        *listed.columns,
        *[F.coalesce(name, F.lit(0)).cast("bigint").alias(name) for name in counts],
    )
