"""Streams of messages and files behind one set of columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import schemas


def message_stream(spark: SparkSession, kind: str, **options) -> DataFrame:
    """Keyed messages with ``key, value, topic, partition, offset, timestamp``.

    ``kind="kafka"`` needs the connector on the class path and the options
    ``servers`` and ``topic``; ``starting`` is ``latest`` or ``earliest``.
    ``kind="file"`` reads the same columns from JSON lines under ``path``.
    """
    if kind == "kafka":
        rows = (
            spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", options["servers"])
            .option("subscribe", options["topic"])
            .option("startingOffsets", options.get("starting", "latest"))
            .option("failOnDataLoss", str(options.get("fail_on_data_loss", False)).lower())
            .load()
        )
        return rows.selectExpr(
            "CAST(key AS STRING) AS key",
            "CAST(value AS STRING) AS value",
            "topic",
            "partition",
            "offset",
            "timestamp",
        )
    if kind == "file":
        reader = spark.readStream.schema(schemas.MESSAGE)
        if options.get("files_per_batch"):
            reader = reader.option("maxFilesPerTrigger", options["files_per_batch"])
        return reader.json(options["path"])
    raise ValueError(f"unknown message stream: {kind}")


def text_file_stream(
    spark: SparkSession, path: str, pattern: str = "*", files_per_batch: int | None = None
) -> DataFrame:
    """Lines of files as they arrive, with the path and size of their file."""
    reader = (
        spark.readStream.format("text")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .option("lineSep", "\n")
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("value", "_metadata")


def notification_stream(spark: SparkSession, path: str) -> DataFrame:
    """Raw notification lines, one per row, so that bad JSON can be set aside."""
    return spark.readStream.text(path)


def binary_file_stream(spark: SparkSession, path: str, pattern: str = "*.jpg") -> DataFrame:
    return (
        spark.readStream.format("binaryFile")
        .schema(schemas.BINARY_FILE)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(path)
    )
