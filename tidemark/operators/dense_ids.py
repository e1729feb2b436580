"""Gap-free row numbers without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import stage

_PLACE = "_place"
_TASK_BITS = 33  # monotonically_increasing_id keeps the partition above this bit


def dense_ids(
    df: DataFrame,
    order_by: Sequence[str],
    name: str = "row_id",
    start: int = 1,
    unique: bool = False,
    at_most: int | None = None,
) -> DataFrame:
    """Number the rows ``start, start + 1, ...`` in the order of ``order_by``.

    Rows that are equal in these columns get their numbers in any order. Rows
    are range partitioned and sorted, each one notes its partition and its
    place there, and the result is written to the shared folder. A row's number
    is its place plus the sizes of the partitions before it. As the noted places
    are stored, both passes see the same ones whatever is re-run in between. A
    frequent leading value is no hot spot: ranges are cut on all columns.

    With ``unique``, which says that no two rows are equal in ``order_by``, only
    these columns are sorted and stored, and the numbers are joined to the rows,
    which then move once. Take it where ``df`` is cheap to read twice, as a scan
    is. The job fails if two rows are equal after all.

    ``at_most`` keeps the first rows only. The sizes of the partitions tell which
    are kept whole, which are left out unread, and where one is cut.
    """
    keys = df.select(*order_by) if unique else df
    placed = (
        keys.repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn(_PLACE, F.monotonically_increasing_id())
    )
    stored = stage(placed, "dense-ids")
    part = F.shiftright(_PLACE, _TASK_BITS)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition: small by construction, whatever the data size.
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset")
    )
    place_in_part = F.col(_PLACE) - F.shiftleft(F.col("_part"), _TASK_BITS)
    number = place_in_part + F.col("_offset")
    if at_most is not None:
        offsets = offsets.where(F.col("_offset") < at_most)
    numbered = stored.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    if at_most is not None:
        numbered = numbered.where(number < at_most)
    numbered = numbered.withColumn(name, (number + F.lit(start)).cast("bigint"))
    numbered = numbered.drop("_part", "_offset", _PLACE)
    return _rejoined(df, numbered, order_by, name) if unique else numbered


def _rejoined(df: DataFrame, numbers: DataFrame, order_by: Sequence[str], name: str) -> DataFrame:
    """The rows of ``df`` with the number of their key; NULLs in keys are values like any other."""
    message = F.concat(F.lit("rows are not unique in "), F.lit(", ".join(order_by)))
    alone = F.when(F.col("_copies") == 1, True).otherwise(F.raise_error(message).cast("boolean"))
    single = numbers.groupBy(*order_by).agg(F.min(name).alias(name), F.count("*").alias("_copies"))
    single = single.where(alone).select(
        name, *(F.col(key).alias(f"_key{k}") for k, key in enumerate(order_by))
    )
    same = F.lit(True)
    for k, key in enumerate(order_by):
        same = same & df[key].eqNullSafe(F.col(f"_key{k}"))
    return df.join(single, same).select(*(df[column] for column in df.columns), name)
