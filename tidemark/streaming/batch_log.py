"""A log of processed micro-batches and the totals that follow from it.

Batches lie in segments of equal numbers of batches. A segment is closed once a
later batch is on record: Spark repeats none but the last batch, so its rows
cannot change any more. Closed segments are kept as one file and one row of
totals, so a log without end stays small in files and quick to add up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.transactions import MONEY
from tidemark.sinks.streams import replace_batch

SEGMENT = 1000
_VALUE = "decimal(36,8)"  # leaves room for sums without losing decimals
_LOG = T.StructType(
    [
        T.StructField("record_count", T.LongType()),
        T.StructField("total_value", T.DecimalType(38, 8)),
        T.StructField("first_time", T.TimestampType()),
        T.StructField("last_time", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("segment", T.LongType()),
    ]
)
_TOTALS = T.StructType([f for f in _LOG.fields if f.name != "batch_id"])
_COLUMNS = ["batch_id", "record_count", "total_value", "first_time", "last_time"]


def _totals() -> list[Column]:
    """Aggregates that add up rows of the log, or totals of such rows."""
    return [
        F.sum("record_count").alias("record_count"),
        F.sum("total_value").cast("decimal(38,8)").alias("total_value"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
    ]


def log_writer(
    path: str, time: str, amount: str, segment: int = SEGMENT
) -> Callable[[DataFrame, int], None]:
    """Batch writer that stores one row of totals per micro-batch of input rows.

    The row goes to the batch's own folder within its segment's, so a batch that
    is run again after a failure replaces its row instead of counting twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        totals = batch.agg(
            F.count("*").alias("record_count"),
            F.sum(F.col(amount).cast(MONEY)).cast("decimal(38,8)").alias("total_value"),
            F.min(time).alias("first_time"),
            F.max(time).alias("last_time"),
        )
        replace_batch(totals, f"{path}/segment={batch_id // segment}", batch_id)

    return write


def batch_log(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a log that was never compacted."""
    return spark.read.schema(_LOG).parquet(path).select(*_COLUMNS)


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    system, place = _files(spark, path)
    if not system.exists(place):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _closed_before(spark: SparkSession, closed: str) -> int:
    """Number of the first segment that is not closed; totals are written last."""
    last = _read(spark, f"{closed}/totals", _TOTALS).agg(F.max("segment")).first()[0]
    return 0 if last is None else last + 1


def compact_log(spark: SparkSession, path: str, closed: str) -> int:
    """Closes the segments that can no longer change; gives the number of closed ones.

    First the rows of the new segments are written, then their totals, then the
    folders they came from are removed, one call per segment. Readers take a
    segment from ``closed`` only once it has totals, and from the log only until
    then, so a run that stops in between loses and repeats nothing; the next run
    goes on. No two runs at the same time.
    """
    first = _closed_before(spark, closed)
    log = _read(spark, path, _LOG)
    last = log.agg(F.max("segment")).first()[0]
    done = first if last is None else max(first, last)
    if done > first:
        new = log.where((F.col("segment") >= first) & (F.col("segment") < done))
        rows = new.repartition("segment").sortWithinPartitions("segment", "batch_id")
        overwrite = {"partitionOverwriteMode": "dynamic"}
        rows.write.options(**overwrite).mode("overwrite").partitionBy("segment").parquet(
            f"{closed}/rows"
        )
        kept = spark.read.schema(_LOG).parquet(f"{closed}/rows").where(F.col("segment") >= first)
        totals = kept.groupBy("segment").agg(*_totals())
        totals.write.options(**overwrite).mode("overwrite").partitionBy("segment").parquet(
            f"{closed}/totals"
        )
    system, root = _files(spark, path)
    if system.exists(root):
        for status in system.listStatus(root):
            name, _, number = status.getPath().getName().partition("=")
            if name == "segment" and int(number) < done:
                system.delete(status.getPath(), True)
    return done


def whole_log(spark: SparkSession, path: str, closed: str) -> DataFrame:
    """Rows of closed and open segments."""
    first = _closed_before(spark, closed)
    old = _read(spark, f"{closed}/rows", _LOG).where(F.col("segment") < first)
    return old.unionByName(_open(spark, path, first)).select(*_COLUMNS)


def _open(spark: SparkSession, path: str, first: int) -> DataFrame:
    return _read(spark, path, _LOG).where(F.col("segment") >= first)


def whole_totals(spark: SparkSession, path: str, closed: str) -> DataFrame:
    """Totals of the whole log: a row per closed segment is read, and the open rows."""
    first = _closed_before(spark, closed)
    names = _TOTALS.names
    old = _read(spark, f"{closed}/totals", _TOTALS).select(*names)
    return log_totals(old.unionByName(_open(spark, path, first).select(*names)))


def _before(rows: DataFrame, key: str, greatest: int, size: int) -> DataFrame:
    """Totals of all rows with a smaller key, for each key.

    Rows are added up in groups of ``size`` keys; what lies before a group comes
    from the groups' own totals in the same way. No window holds more than
    ``size`` rows, and there are as many levels as the greatest key has digits
    to the base ``size``.
    """
    group = f"{key}_group"
    grouped = rows.withColumn(group, F.expr(f"{key} DIV {size}"))
    earlier = Window.partitionBy(group).orderBy(key)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    inside = grouped.select(
        key,
        group,
        F.sum("record_count").over(earlier).alias("count_before"),
        F.sum("total_value").over(earlier).cast(_VALUE).alias("value_before"),
        F.min("first_time").over(earlier).alias("first_before"),
        F.max("last_time").over(earlier).alias("last_before"),
    )
    if greatest < size:
        return inside.drop(group)
    totals = grouped.groupBy(group).agg(*_totals())
    upper = _before(totals, group, greatest // size, size)
    names = [name for name in upper.columns if name != group]
    upper = upper.select(group, *(F.col(n).alias(f"upper_{n}") for n in names))
    nothing = F.lit(0)
    seen = F.col("value_before").isNotNull() | F.col("upper_value_before").isNotNull()
    value = F.coalesce("value_before", nothing) + F.coalesce("upper_value_before", nothing)
    count = F.coalesce("count_before", nothing) + F.coalesce("upper_count_before", nothing)
    return inside.join(upper, group).select(
        key,
        count.alias("count_before"),
        F.when(seen, value).cast(_VALUE).alias("value_before"),
        F.least("first_before", "upper_first_before").alias("first_before"),
        F.greatest("last_before", "upper_last_before").alias("last_before"),
    )


def running_totals(log: DataFrame, size: int = SEGMENT) -> DataFrame:
    """Totals after each batch; batch numbers are whole, from 0 on, and may have gaps."""
    rows = log.select(*_COLUMNS)
    greatest = rows.agg(F.max("batch_id")).first()[0]
    before = _before(rows, "batch_id", greatest or 0, size)
    nothing = F.lit(0)
    value = F.coalesce("value_before", nothing) + F.coalesce(
        F.col("total_value").cast(_VALUE), nothing
    )
    seen = F.col("value_before").isNotNull() | F.col("total_value").isNotNull()
    return rows.join(before, "batch_id").select(
        "batch_id",
        "record_count",
        (F.coalesce("count_before", nothing) + F.col("record_count")).alias("total_records"),
        F.when(seen, value).cast("double").alias("total_value"),
        F.least("first_time", "first_before").alias("first_time"),
        F.greatest("last_time", "last_before").alias("last_time"),
    )


def log_totals(log: DataFrame) -> DataFrame:
    return log.agg(
        F.sum("record_count").alias("total_records"),
        F.sum("total_value").cast("double").alias("total_value"),
        F.min("first_time").alias("first_time"),
        F.max("last_time").alias("last_time"),
    )
