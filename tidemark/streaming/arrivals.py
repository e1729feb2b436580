"""Line counts of files as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.line_stats import stats_of_lines
from tidemark.sinks.streams import replace_batch, to_batches
from tidemark.sources.streams import text_file_stream


def line_count_writer(path: str, unicode_breaks: bool = False) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        replace_batch(stats_of_lines(batch, unicode_breaks), path, batch_id)

    return write


def stream_line_counts(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    pattern: str = "*",
    files_per_batch: int | None = None,
    unicode_breaks: bool = False,
    every: str | None = None,
) -> StreamingQuery:
    """Counts per arriving file, stored per micro-batch under ``target``.

    The file source hands over a file in exactly one batch, so each batch is
    counted by itself and no state has to be kept. An empty file brings no
    lines and gets no row.
    """
    lines = text_file_stream(spark, source, pattern, files_per_batch)
    return to_batches(lines, line_count_writer(target, unicode_breaks), checkpoint, every)
