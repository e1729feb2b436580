"""Expressions on arrays of class probabilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def top1_of(probabilities: Column, classes: Sequence[str]) -> Column:
    """Most likely class as ``(class, desc, score)``; the first one wins a tie."""
    score = F.array_max(probabilities)
    index = (F.array_position(probabilities, score) - 1).cast("int")
    names = F.array(*[F.lit(name) for name in classes])
    name = F.coalesce(F.get(names, index), F.concat(F.lit("class_"), index.cast("string")))
    return F.struct(
        index.cast("string").alias("class"), name.alias("desc"), score.cast("float").alias("score")
    )
