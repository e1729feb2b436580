"""Scoring of images that arrive as files or messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.functions import objects
from tidemark.operators.scoring import prediction_table
from tidemark.sinks.streams import fan_out, to_batches
from tidemark.streaming.messages import parse_messages


def labeled_files(
    files: DataFrame, size_of: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Binary files with the label of their path and, on request, their size."""
    extra = [size_of(F.col("content")).alias("size")] if size_of else []
    return files.select(
        "path",
        "modificationTime",
        objects.path_label(F.col("path")).alias("label"),
        *extra,
        "content",
    )


def image_messages(raw: DataFrame) -> DataFrame:
    """Image messages with their bytes; text that is not base64 gives NULL bytes."""
    parsed = parse_messages(raw, schemas.IMAGE_MESSAGE)
    return parsed.withColumn("content", objects.bytes_of_base64(F.col("image_data"))).drop(
        "image_data"
    )


def scored(assets: DataFrame, top1: Callable[[Column], Column]) -> DataFrame:
    return prediction_table(assets.withColumn("prediction", top1(F.col("content"))))


def score_stream(
    assets: DataFrame,
    top1: Callable[[Column], Column],
    target: str,
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    """Score each batch once and store all predictions and the counts per class."""
    outputs = {
        "predictions": lambda batch: batch,
        "class_counts": lambda batch: batch.groupBy("predicted_class").count(),
    }
    return to_batches(scored(assets, top1), fan_out(outputs, target), checkpoint, every)
