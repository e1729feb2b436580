"""What a stopped stream still remembers, read from its checkpoint."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def state_operators(spark: SparkSession, checkpoint: str) -> DataFrame:
    """One row per state store of a query: operator, partitions, first and last batch on record."""
    return spark.read.format("state-metadata").load(checkpoint)


def _distinct(names: list[str]) -> list[str]:
    """The names, numbered from the second time on that one occurs."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        seen[name] = seen.get(name, 0) + 1
        out.append(name if seen[name] == 1 else f"{name}_{seen[name]}")
    return out


def state_rows(
    spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None
) -> DataFrame:
    """Keys and values of an operator's state after a batch, the last one by default.

    Fields of the key come first, then those of the value. Buffers of several
    aggregates may have one name; they are numbered in the order of the aggregates.
    """
    reader = spark.read.format("statestore").option("operatorId", operator)
    if batch is not None:
        reader = reader.option("batchId", batch)
    stored = reader.load(checkpoint)
    key, value = stored.schema["key"].dataType, stored.schema["value"].dataType
    names = _distinct([*key.names, *value.names])
    # A cast goes by position, which names that occur twice do not allow.
    parts = []
    for column, fields, own in (
        ("key", key.fields, names[: len(key)]), ("value", value.fields, names[len(key) :])
    ):
        renamed = T.StructType([T.StructField(n, f.dataType) for n, f in zip(own, fields)])
        parts.append(F.col(column).cast(renamed).alias(column))
    return stored.select(*parts).select("key.*", "value.*")


def open_windows(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """Windows that a windowed count still holds open, with their rows so far."""
    return state_rows(spark, checkpoint, batch=batch).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("count").alias("record_count"),
    )


def state_sizes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Keys in the state after every batch that Spark still keeps; one small read per batch."""
    kept = state_operators(spark, checkpoint).agg(F.min("minBatchId"), F.max("maxBatchId")).first()
    sizes = [
        state_rows(spark, checkpoint, batch=batch).agg(
            F.lit(batch).cast("bigint").alias("batch_id"), F.count("*").alias("keys")
        )
        for batch in range(kept[0], kept[1] + 1)
    ]
    return reduce(DataFrame.unionAll, sizes)
