"""Event-time window metrics over a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.transactions import APPROX, Transactions, window_metrics, window_states


def stream_window_metrics(
    stream: DataFrame,
    time: str,
    delay: str,
    width: str,
    slide: str | None = None,
    names: Transactions = Transactions(),
) -> DataFrame:
    """Window metrics with a watermark on the time inside the message.

    Distinct customers come from a sketch, as a stream keeps no exact set. In
    append mode a window comes out once it ends before the watermark; rows
    later than that are dropped and counted in the query's progress.
    """
    return window_metrics(
        stream.withWatermark(time, delay), time, width, slide, names, distinct=APPROX
    )


def stream_window_states(
    stream: DataFrame,
    time: str,
    delay: str,
    width: str,
    slide: str | None = None,
    names: Transactions = Transactions(),
) -> DataFrame:
    """Mergeable states per window, to be stored and merged over windows and batches later."""
    return window_states(stream.withWatermark(time, delay), time, width, slide, names)


def closed_before(window_end: Column, latest: Column, delay: str) -> Column:
    """True for windows that append mode has emitted once ``latest`` was seen."""
    return window_end <= latest - F.expr(f"INTERVAL {delay}")
