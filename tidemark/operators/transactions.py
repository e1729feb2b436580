"""Transactions: windowed metrics, numbered batches and roll-ups.

Money is summed as decimal and given as double, so that sums do not depend on
the order in which partitions arrive. Amounts keep eight decimals; nothing is
rounded to cents before or after the sum.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.sketches import estimated, merged, sketch_of
from tidemark.operators.dense_ids import dense_ids

MONEY = "decimal(30,8)"
EXACT, APPROX = "exact", "approx"


@dataclass(frozen=True)
class Transactions:
    """Column names the metrics are computed from."""

    amount: str = "final_amount"
    customer: str = "customer_id"
    batch: str = "batch_number"
    record: str = "record_id"


def money_sum(amount: str) -> Column:
    return F.sum(F.col(amount).cast(MONEY)).cast("double")


def money_mean(amount: str) -> Column:
    return money_sum(amount) / F.nullif(F.count(amount), F.lit(0))


def _customers(column: str, distinct: str) -> Column:
    return estimated(sketch_of(column)) if distinct == APPROX else F.countDistinct(column)


def _metrics(names: Transactions, distinct: str) -> list[Column]:
    return [
        F.count("*").alias("record_count"),
        money_sum(names.amount).alias("total_transaction_value"),
        money_mean(names.amount).alias("avg_transaction_value"),
        _customers(names.customer, distinct).alias("unique_customers"),
    ]


def window_metrics(
    rows: DataFrame,
    time: str,
    width: str,
    slide: str | None = None,
    names: Transactions = Transactions(),
    distinct: str = EXACT,
) -> DataFrame:
    """Metrics per sliding window, or tumbling window without ``slide``.

    Works on tables and, with ``distinct="approx"``, on streams. Rows are summed
    before the shuffle, so a window that holds most rows is not a hot spot.
    """
    return (
        rows.groupBy(F.window(time, width, slide) if slide else F.window(time, width))
        .agg(
            *_metrics(names, distinct),
            F.min(names.batch).alias("min_batch_number"),
            F.max(names.batch).alias("max_batch_number"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "record_count",
            "total_transaction_value",
            "avg_transaction_value",
            "unique_customers",
            "min_batch_number",
            "max_batch_number",
        )
    )


def batch_metrics(
    rows: DataFrame, names: Transactions = Transactions(), distinct: str = EXACT
) -> DataFrame:
    """The window metrics per numbered batch."""
    return rows.groupBy(names.batch).agg(
        *_metrics(names, distinct),
        F.min(names.record).alias("min_record_id"),
        F.max(names.record).alias("max_record_id"),
    )


def _states(names: Transactions) -> list[Column]:
    """What can be merged later: counts, exact sums, a customer sketch."""
    amount = F.col(names.amount).cast(MONEY)
    return [
        F.count("*").alias("record_count"),
        F.count(amount).alias("amount_count"),
        F.sum(amount).alias("amount_sum"),
        sketch_of(names.customer).alias("customers"),
    ]


def batch_states(rows: DataFrame, names: Transactions = Transactions()) -> DataFrame:
    """The mergeable states per numbered batch."""
    return rows.groupBy(names.batch).agg(*_states(names))


def window_states(
    rows: DataFrame,
    time: str,
    width: str,
    slide: str | None = None,
    names: Transactions = Transactions(),
) -> DataFrame:
    """The mergeable states per window, of a table or a stream."""
    window = F.window(time, width, slide) if slide else F.window(time, width)
    return (
        rows.groupBy(window)
        .agg(*_states(names))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "record_count",
            "amount_count",
            "amount_sum",
            "customers",
        )
    )


def merged_metrics(states: DataFrame, *by: Column | str) -> DataFrame:
    """Metrics of stored states, merged by what is asked for; one row without ``by``.

    A customer seen in many windows or batches counts once. Windows that overlap
    would count their common rows twice, so merge tumbling ones.
    """
    total = F.sum("amount_sum").cast("double")
    return states.groupBy(*by).agg(
        F.sum("record_count").alias("record_count"),
        total.alias("total_transaction_value"),
        (total / F.nullif(F.sum("amount_count"), F.lit(0))).alias("avg_transaction_value"),
        estimated(merged("customers")).alias("unique_customers"),
    )


def grand_total(states: DataFrame) -> DataFrame:
    """Totals over all batches; the mean is sum over count, not a mean of means."""
    return merged_metrics(states).select(
        F.col("record_count").alias("total_records_processed"),
        F.col("total_transaction_value").alias("grand_total_value"),
        F.col("avg_transaction_value").alias("overall_avg_value"),
        F.col("unique_customers").alias("approx_unique_customers"),
    )


def category_stats(
    rows: DataFrame, category: str, names: Transactions = Transactions()
) -> DataFrame:
    """Records, value and exact distinct customers per category, in order."""
    per_customer = rows.groupBy(category, names.customer).agg(
        F.count("*").alias("n"),
        F.count(names.amount).alias("amounts"),
        F.sum(F.col(names.amount).cast(MONEY)).alias("amount"),
    )
    total = F.sum("amount").cast("double")
    return (
        per_customer.groupBy(category)
        .agg(
            F.sum("n").alias("record_count"),
            total.alias("total_value"),
            (total / F.nullif(F.sum("amounts"), F.lit(0))).alias("avg_value"),
            F.count(names.customer).alias("unique_customers"),
        )
        .orderBy(category)
    )


def transaction_profile(
    rows: DataFrame, date: str, premium: Column, names: Transactions = Transactions()
) -> DataFrame:
    """Total, mean, date range and premium share in one pass."""
    count = F.count("*")
    return rows.agg(
        count.alias("record_count"),
        money_sum(names.amount).alias("total_value"),
        money_mean(names.amount).alias("avg_value"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
        F.count_if(premium).alias("premium_records"),
        F.round(F.count_if(premium).cast("double") * 100 / F.nullif(count, F.lit(0)), 1).alias(
            "premium_percentage"
        ),
    )


def order_amounts(rows: DataFrame, quantity: str, unit_price: Column, discount: Column) -> DataFrame:
    """Adds total, discount and final amount of each line, rounded to cents."""
    total = F.round(F.col(quantity).cast("decimal(12,2)") * unit_price.cast("decimal(18,4)"), 2)
    reduction = F.round(total * discount.cast("decimal(6,4)"), 2)
    return rows.select(
        "*",
        total.cast("double").alias("total_amount"),
        reduction.cast("double").alias("discount_amount"),
        (total - reduction).cast("double").alias("final_amount"),
    )


def numbered_batches(
    rows: DataFrame,
    order_by: Sequence[str],
    batch_size: int,
    max_records: int | None = None,
    names: Transactions = Transactions(),
    unique: bool = False,
) -> DataFrame:
    """Adds record id, batch number and place in the batch, in order of ``order_by``.

    ``max_records`` keeps only the first records, for a publisher that was told
    to stop there; no task holds more than its range of them. ``unique`` says that
    no two rows are equal in ``order_by``, see ``dense_ids``.
    """
    numbered = dense_ids(
        rows, order_by, name=names.record, unique=unique, at_most=max_records
    )
    before = f"({names.record} - 1)"
    return numbered.withColumns(
        {
            names.batch: F.expr(f"CAST({before} DIV {batch_size} + 1 AS INT)"),
            "batch_position": F.expr(f"CAST({before} % {batch_size} + 1 AS INT)"),
        }
    )


def published_messages(
    batches: DataFrame, key: str, produced_at: Column | None = None
) -> DataFrame:
    """JSON messages keyed by ``key``; ``produced_at`` adds the time of sending."""
    if produced_at is not None:
        batches = batches.withColumns(
            {
                "producer_timestamp": produced_at.cast("double"),
                "producer_timestamp_str": F.date_format(produced_at, "yyyy-MM-dd HH:mm:ss"),
            }
        )
    return batches.select(
        F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value")
    )
