"""Registered queries: each runs a job on the given tables, most with a SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


def all_queries() -> tuple[dict[str, Run], dict[str, str]]:
    """Every registered query and the SQL of those that have one."""
    from tidemark.plans import assets, clicks, dimension, models, text_objects, transactions

    runs: dict[str, Run] = {}
    sql: dict[str, str] = {}
    for module in (clicks, text_objects, dimension, transactions, models, assets):
        runs.update(module.QUERIES)
        sql.update(module.SQL)
    return runs, sql
