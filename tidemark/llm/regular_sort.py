"""Exact ranks of all rows by parallel sorting by regular sampling.

Every task sorts its rows, which makes one run per task. Every so many rows a
run gives a sample; the samples in order give regular splitters. Runs are cut
at the splitters, the segments of a range go to one task, which merges them,
and the number of rows in earlier ranges is added to the place in a range.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import new_path, ship_package, stage

ROWS_PER_RANGE = 1_000_000
SAMPLES_PER_RANGE = 16
_PLACE_BITS = 33  # of monotonically_increasing_id
_KEY = ["score", "no_id", "id", "run", "place"]


def packed_keys(columns: list[np.ndarray]) -> np.ndarray:
    """Byte strings that compare as the rows of signed 64-bit columns do."""
    bits = np.stack([c.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63) for c in columns], 1)
    return np.ascontiguousarray(bits.astype(">u8")).view(f"V{8 * len(columns)}").ravel()


def _comparable(keys: np.ndarray) -> np.ndarray:
    # Trailing zero bytes do not count in this type, which keeps the order.
    return keys.view(f"S{keys.dtype.itemsize}")


def splitters(samples: np.ndarray, ranges: int) -> np.ndarray:
    """At most ``ranges`` - 1 of the sorted samples, at regular distances."""
    if len(samples) < 2 or ranges < 2:
        return samples[:0]
    at = np.unique(np.arange(1, ranges) * len(samples) // ranges)
    return samples[at[at > 0]]


def ranked(
    rows: DataFrame,
    score: str,
    tie: str,
    rows_per_range: int = ROWS_PER_RANGE,
    samples_per_range: int = SAMPLES_PER_RANGE,
) -> DataFrame:
    """Adds ``rank``: 1, 2, 3 ... by descending ``score``, then ascending ``tie``, NULL ties last.

    Both columns are whole numbers and ``score`` is never NULL. Rows that are
    equal in both are ranked by run and place, so a value that many rows share
    is cut over several ranges too. The driver sees ``samples_per_range`` times
    the number of ranges plus one row per run at most, and one count per range.
    The rows are stored once; no rows give no rows.
    """
    spark = rows.sparkSession
    ship_package(spark)
    names = rows.columns
    whole = F.struct(*(F.col(f"`{name}`") for name in names)).alias("row")
    place = F.monotonically_increasing_id()
    runs = stage(
        rows.select(
            (-F.col(f"`{score}`").cast("bigint")).alias("score"),
            F.col(f"`{tie}`").isNull().cast("bigint").alias("no_id"),
            F.coalesce(F.col(f"`{tie}`").cast("bigint"), F.lit(0)).alias("id"),
            whole,
        )
        .sortWithinPartitions("score", "no_id", "id")
        .select(
            "*",
            F.shiftright(place, _PLACE_BITS).alias("run"),
            place.bitwiseAND((1 << _PLACE_BITS) - 1).alias("place"),
        ),
        "runs",
    )
    total = runs.count()
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, min(total, max(least, math.ceil(total / rows_per_range))))
    stride = max(1, total // (ranges * samples_per_range))
    table = runs.where(F.col("place") % stride == stride // 2).select(*_KEY).toArrow()
    samples = _comparable(packed_keys([table[name].to_numpy() for name in _KEY]))
    cuts = splitters(np.sort(samples), ranges)
    ranges = len(cuts) + 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = packed_keys([batch[name].to_numpy() for name in _KEY])
            at = np.searchsorted(cuts, _comparable(keys), side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(at)], names=[*batch.schema.names, "range"]
            )

    columns = runs.select(*_KEY, "row")
    segments = columns.mapInArrow(
        cut, columns.schema.simpleString()[len("struct<") : -1] + ",range:int"
    )
    path = new_path(spark, "segments")
    segments.write.parquet(path)
    segments = spark.read.schema(segments.schema).parquet(path)
    held = {r["range"]: r["count"] for r in segments.groupBy("range").count().collect()}
    before = np.concatenate([[0], np.cumsum([held.get(k, 0) for k in range(ranges)])])
    offsets = spark.createDataFrame(
        [(k, int(n)) for k, n in enumerate(before[:-1])], "range int, before bigint"
    )
    in_range = F.monotonically_increasing_id().bitwiseAND((1 << _PLACE_BITS) - 1)
    return (
        segments.repartitionById(ranges, "range")
        .sortWithinPartitions(*_KEY)
        .select("row", "range", in_range.alias("place"))
        .join(F.broadcast(offsets), "range")
        .select("row.*", (F.col("before") + F.col("place") + 1).alias("rank"))
    )
