"""Replay of a table as numbered micro-batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.transactions import Transactions
from tidemark.session import new_path
from tidemark.sources.stored_batches import FOLDER, batch_numbers, opened, stored_batches


def _folder(batch: str, per_folder: int) -> Column:
    return F.expr(f"CAST(({batch} - 1) DIV {per_folder} AS INT)").alias(FOLDER)


def store_batches(
    batches: DataFrame, path: str, names: Transactions = Transactions(), per_folder: int = 1
) -> None:
    """Write numbered rows so that ``per_folder`` batches share a folder.

    Rows are cut into ranges of their batch numbers, so a folder of many rows is
    written by several tasks and small batches share a file. Rows without a
    number belong to no batch and are left out.
    """
    numbered = batches.where(F.col(names.batch).isNotNull())
    placed = numbered.select("*", _folder(names.batch, per_folder))
    placed.repartitionByRange(FOLDER, names.batch).write.partitionBy(FOLDER).parquet(path)


def arrow_reaches(path: str) -> bool:
    try:
        opened(path)
    except (ValueError, OSError):
        return False
    return True


def replay_stored(
    stored: DataFrame,
    path: str,
    names: Transactions,
    batches_per_trigger: int,
    per_folder: int,
    by_tasks: bool | None = None,
) -> DataFrame:
    """Stream over what ``store_batches`` has written, in order of the batch numbers.

    The files of the batches that are due are read by Arrow in tasks. In a store
    that only Spark can open (or with ``by_tasks=False``) the stream is the
    numbers, joined to the stored table; each micro-batch then reads the
    table's batch column whole, as Spark prunes no folders for a stream.
    """
    spark = stored.sparkSession
    first, last = stored.agg(F.min(names.batch), F.max(names.batch)).first()
    first, last = (1, 0) if first is None else (first, last)
    columns = [name for name in stored.columns if name != FOLDER]
    if arrow_reaches(path) if by_tasks is None else by_tasks:
        schema = T.StructType([stored.schema[name] for name in columns])
        return stored_batches(
            spark, path, schema, names.batch, first, last, per_folder, batches_per_trigger
        )
    number = F.col("batch").cast(stored.schema[names.batch].dataType).alias(names.batch)
    due = batch_numbers(spark, first, last, batches_per_trigger).select(number)
    # One row per batch of the trigger: small by its definition.
    due = F.broadcast(due.select(names.batch, _folder(names.batch, per_folder)))
    return stored.join(due, [FOLDER, names.batch]).select(*columns)


def replay_batches(
    batches: DataFrame,
    names: Transactions = Transactions(),
    batches_per_trigger: int = 1,
    by_tasks: bool | None = None,
) -> DataFrame:
    """Stream over rows that carry a batch number from 1 on, ``batches_per_trigger`` at a time.

    The table is written while the stream is built; see ``replay_stored``.
    """
    spark = batches.sparkSession
    path = new_path(spark, "replay")
    store_batches(batches, path, names, batches_per_trigger)
    schema = T.StructType([*batches.schema.fields, T.StructField(FOLDER, T.IntegerType())])
    stored = spark.read.schema(schema).parquet(path)
    return replay_stored(stored, path, names, batches_per_trigger, batches_per_trigger, by_tasks)


def run_to_end(query: StreamingQuery) -> StreamingQuery:
    """Waits until a query on a timer has taken all there is, then ends it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query
