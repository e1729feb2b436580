"""Parquet tables, read whole or as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(folder, name))


def table_stream(
    spark: SparkSession, folder: str, name: str, files_per_batch: int | None = None
) -> DataFrame:
    """The same table as a file stream.

    The trailing ``*`` lets the path be one file or a folder of part files.
    """
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(table_path(folder, name) + "*")
