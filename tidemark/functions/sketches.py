"""Distinct counts from sketches that can be stored and merged.

A sketch keeps up to a tenth of 2^LG_K values apart exactly and estimates
larger numbers with a relative deviation of 1.04 / 2^(LG_K / 2), in 2^LG_K
bytes at most.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LG_K = 16
DEVIATION = 1.04 / 2 ** (LG_K / 2)


def sketch_of(values: Column | str, lg_k: int = LG_K) -> Column:
    """Aggregate: a sketch of the values that are not NULL; works in streams too."""
    return F.hll_sketch_agg(values, F.lit(lg_k))


def merged(sketches: Column | str) -> Column:
    """Aggregate: one sketch of all values behind the sketches."""
    return F.hll_union_agg(sketches)


def estimated(sketch: Column) -> Column:
    """Number of different values behind a sketch.

    A sketch remembers whether it was filled in one go, which would let the
    estimate depend on how rows were dealt out. Merged with itself it only has
    the values to go by, so equal values give equal numbers, whatever the way.
    """
    return F.hll_sketch_estimate(F.hll_union(sketch, sketch))
