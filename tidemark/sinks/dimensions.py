"""A versioned dimension kept in files and merged in place.

Each merge is a run with a number. A run writes the versions that it closed,
which no later run touches, and all versions that are open after it; then it
commits. Readers take the open versions of the last committed run and the closed
ones of all committed runs, so they see a merge whole or not at all. A run that
stopped before its commit is written over by the next one, which has its number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.scd2 import (
    CUSTOMER,
    Dimension,
    is_current,
    numbered_changes,
    touched_versions,
)

_RUN, _OPEN = "merge_run", "open_part"
RUNS = "changed bigint, new bigint, open_versions bigint, closed_versions bigint, merge_run int"


def _write_run(rows: DataFrame, path: str, run: int, dim: Dimension) -> None:
    """Versions of a run by whether they are open, in one pass; a repeat replaces them."""
    parts = rows.select(*dim.columns, is_current(dim).alias(_OPEN))
    parts.write.mode("overwrite").partitionBy(_OPEN).parquet(f"{path}/versions/{_RUN}={run}")


def _commit(
    spark: SparkSession, path: str, run: int, changed: int, new: int, schema: T.StructType
) -> None:
    """Counts of the run as one file; it is there whole or not at all."""
    rows = _parts(spark, path, schema).where(F.col(_RUN) == run)
    counts = rows.agg(
        F.lit(changed).cast("bigint").alias("changed"),
        F.lit(new).cast("bigint").alias("new"),
        F.count_if(_OPEN).alias("open_versions"),
        F.count_if(~F.col(_OPEN)).alias("closed_versions"),
    )
    counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/runs/{_RUN}={run}")


def _parts(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    own = [T.StructField(_RUN, T.IntegerType()), T.StructField(_OPEN, T.BooleanType())]
    full = T.StructType([*schema.fields, *own])
    return spark.read.schema(full).parquet(f"{path}/versions")


def dimension_runs(spark: SparkSession, path: str) -> DataFrame:
    """Committed runs: versions changed and new, versions open after it and closed by it."""
    return spark.read.schema(RUNS).parquet(f"{path}/runs")


def _last_run(spark: SparkSession, path: str) -> int:
    return dimension_runs(spark, path).agg(F.max(_RUN)).first()[0]


def create_dimension(rows: DataFrame, path: str, dim: Dimension = CUSTOMER) -> None:
    """Stores a dimension as run 0, replacing what a run 0 that failed has left."""
    spark, schema = rows.sparkSession, rows.select(*dim.columns).schema
    _write_run(rows, path, 0, dim)
    _commit(spark, path, 0, 0, 0, schema)


def read_dimension(
    spark: SparkSession, path: str, schema: T.StructType, dim: Dimension = CUSTOMER
) -> DataFrame:
    """All versions as of the last committed run; only the folders of its parts are read."""
    last = _last_run(spark, path)
    schema = T.StructType([schema[name] for name in dim.columns])
    rows = _parts(spark, path, schema)
    open_now = F.col(_OPEN) & (F.col(_RUN) == last)
    return rows.where(open_now | (~F.col(_OPEN) & (F.col(_RUN) <= last))).select(*dim.columns)


def merge_dimension(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    feed: DataFrame,
    dim: Dimension = CUSTOMER,
    duplicates: str = "error",
    close_offset_days: int = 0,
) -> int:
    """Applies a feed as ``scd2_merge`` does; gives the number of the run that holds the result.

    A feed that changes nothing writes nothing and makes no run, so applying a
    feed twice is the same as once. Versions closed before are not read but for
    the highest key, and their files stay as they are. One merge at a time.
    """
    existing = read_dimension(spark, path, schema, dim)
    changes = numbered_changes(existing, feed, dim, duplicates)
    counts = changes.agg(F.count_if(~F.col("is_new")), F.count_if("is_new")).first()
    run = _last_run(spark, path)
    if not any(counts):
        return run
    nameless = existing.where(is_current(dim) & F.col(dim.business_id).isNull())
    touched = touched_versions(existing, changes, dim, close_offset_days)
    _write_run(touched.unionByName(nameless.select(*dim.columns)), path, run + 1, dim)
    _commit(spark, path, run + 1, *counts, existing.schema)
    return run + 1


def drop_old_runs(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Removes the open versions of runs that are ``keep`` or more behind the last one.

    Closed versions stay. Readers that began before those runs lose their files.
    """
    last = _last_run(spark, path)
    for run in range(last - keep + 1):
        place = spark._jvm.org.apache.hadoop.fs.Path(
            f"{path}/versions/{_RUN}={run}/{_OPEN}=true"
        )
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
