"""File sinks of batch jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


SMALL_ROWS = 100_000


def _one_task(df: DataFrame, most: int) -> DataFrame:
    """The rows in one partition; fails where there are more than ``most``."""
    found = df.limit(most + 1).count()
    if found > most:
        raise ValueError(f"more than {most} rows would go through one task")
    return df.coalesce(1)


def write_small_csv(df: DataFrame, path: str, most: int = SMALL_ROWS) -> None:
    """One CSV file, for results that are a few rows by nature; more than ``most`` are refused."""
    write_csv(_one_task(df, most), path)


def write_parquet(df: DataFrame, path: str) -> DataFrame:
    """Replace the table at ``path`` and return it as stored."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_sorted(df: DataFrame, path: str, *order_by: str) -> None:
    """Replace ``path`` by files that are in order among themselves.

    Files by name, and rows by place in them, follow ``order_by``. Ranges are cut
    on all its columns, so a value that many rows share fills several files.
    """
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    ordered.write.mode("overwrite").parquet(path)


def read_with_places(spark: SparkSession, path: str) -> DataFrame:
    """Rows of stored parquet with the name of their file and their place in it."""
    return spark.read.parquet(path).select(
        "*",
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.row_index").alias("row_index"),
    )


def register_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """External table over stored parquet, replacing one of the same name."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.catalog.createTable(name, path, source="parquet")


def write_report(rows: DataFrame, path: str, most: int = SMALL_ROWS) -> None:
    """Report rows ``(position, section, name, value)`` as one text file; not more than ``most``."""
    line = F.concat_ws(" ", F.concat("section", F.lit("."), "name", F.lit(":")), "value")
    (
        _one_task(rows, most)
        .sortWithinPartitions("position")
        .select(line.alias("value"))
        .write.mode("overwrite")
        .text(path)
    )


def write_messages(messages: DataFrame, servers: str, topic: str) -> None:
    """Append keyed JSON messages to a Kafka topic; needs the connector."""
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .mode("append")
        .save()
    )
