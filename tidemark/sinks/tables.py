"""Managed tables laid out for repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame


def save_bucketed(
    df: DataFrame, name: str, by: str, buckets: int, partition_by: str | None = None
) -> DataFrame:
    """Replace table ``name``, hashed into ``buckets`` files by ``by``.

    Joins and aggregations on ``by`` then need no shuffle of this table. Take
    the number of buckets from its size at about 128 MB per bucket, and as many
    shuffle partitions: a join with a feed then shuffles only the feed, once. With
    ``partition_by``, say the flag of open versions, a filter on that column
    skips the other files altogether.
    """
    writer = df.repartition(buckets, by).write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.bucketBy(buckets, by).sortBy(by).saveAsTable(name)
    return df.sparkSession.table(name)
