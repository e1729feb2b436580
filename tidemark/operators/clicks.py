"""Click log: parsing, quality counters and time-of-day analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import clicks as fn
from tidemark.functions import text

OK, MALFORMED, UNKNOWN = "OK", "MALFORMED", "UNKNOWN"


def parse_clicks(lines: DataFrame, *keep: str, mode: str = "loose") -> DataFrame:
    """Split ``DATE TIME USER`` lines; no row is dropped, ``status`` tells the bad ones.

    ``loose`` takes two or more words, ``strict`` exactly three, and
    ``single_space`` splits at each blank and wants three parts. A line with
    too few words is MALFORMED; one whose hour is not 0 to 23 is UNKNOWN.
    """
    value = F.col("value")
    enough = {
        "loose": F.size("parts") >= 2,
        "strict": F.size("parts") == 3,
        "single_space": F.size("parts") >= 3,
    }[mode]
    words = {
        name: F.when(enough, F.get("parts", F.lit(place)))
        for place, name in enumerate(("date", "time", "user_id"))
    }
    fields = {
        "tokens_ok": F.coalesce(enough, F.lit(False)),
        **words,
        "hour": fn.hour_of(words["time"]),
    }
    # inline() of one struct computes the row once. A plain select would be
    # merged into later filters, which then repeat the splitting per condition.
    parts = F.split(value, " ") if mode == "single_space" else text.words(value)
    split = lines.select(*keep, "value", parts.alias("parts")).select(
        *keep,
        "value",
        F.inline(F.array(F.struct(*[field.alias(name) for name, field in fields.items()]))),
    )
    interval = fn.time_interval(F.col("hour"))
    return split.select(
        "*",
        interval.alias("time_interval"),
        F.when(~F.col("tokens_ok"), MALFORMED)
        .when(fn.interval_number(F.col("hour")).isNull(), UNKNOWN)
        .otherwise(OK)
        .alias("status"),
    )


def valid_clicks(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("status") == OK)


def valid_by_regex(
    rows: DataFrame, date_pattern: str = fn.ISO_DATE, time_pattern: str = fn.ISO_TIME
) -> DataFrame:
    """Rows whose date and time have the given shape and that name a user."""
    return rows.filter(
        F.col("date").rlike(date_pattern)
        & F.col("time").rlike(time_pattern)
        & F.col("user_id").isNotNull()
    )


def click_quality(parsed: DataFrame) -> DataFrame:
    """Line counters and success rate in one pass."""
    status = F.col("status")
    valid = F.count_if(status == OK)
    return parsed.agg(
        F.count("*").alias("total_lines"),
        valid.alias("valid_lines"),
        F.count_if(status != OK).alias("invalid_lines"),
        F.count_if(status == MALFORMED).alias("malformed_lines"),
        F.count_if(status == UNKNOWN).alias("unknown_lines"),
        F.count_if("tokens_ok").alias("tokens_ok_lines"),
        F.count_if(F.col("hour").between(0, 23)).alias("time_ok_lines"),
        F.round(valid.cast("double") * 100 / F.nullif(F.count("*"), F.lit(0)), 1).alias(
            "success_rate"
        ),
    )


def interval_counts(clicks: DataFrame, label: Column | str = "time_interval") -> DataFrame:
    """Clicks per interval, most first."""
    label = F.col(label) if isinstance(label, str) else label
    return (
        clicks.groupBy(label.alias("time_interval"))
        .agg(F.count("*").alias("click_count"))
        .orderBy(F.desc("click_count"), "time_interval")
    )


def intervals(spark: SparkSession, style: str = "plain") -> DataFrame:
    """The four intervals in order of the day."""
    rows = list(enumerate(fn.INTERVAL_LABELS[style]))
    return spark.createDataFrame(rows, "interval_order int, time_interval string")


def zero_filled(counts: DataFrame, style: str = "plain") -> DataFrame:
    """All four intervals in order, with 0 for those without a click."""
    return (
        intervals(counts.sparkSession, style)
        .join(counts, "time_interval", "left")
        .select(
            "interval_order",
            "time_interval",
            F.coalesce("click_count", F.lit(0)).cast("bigint").alias("click_count"),
        )
        .orderBy("interval_order")
    )


def interval_share(counts: DataFrame) -> DataFrame:
    """Share of the grand total; the window runs over the few counted rows."""
    total = F.sum("click_count").over(Window.partitionBy())
    return counts.select(
        "time_interval",
        "click_count",
        total.cast("bigint").alias("total_clicks"),
        F.round(F.col("click_count").cast("double") * 100 / total, 1).alias("percentage"),
    )


def interval_detail(
    clicks: DataFrame, user: Column, minute_of_day: Column, *by: str
) -> DataFrame:
    """Clicks, users, share and time range per interval (and ``by`` columns).

    Times are compared by the clock, not as text. The distinct count is reduced
    per (interval, user) before the interval is formed, so that four big groups
    still use all tasks.
    """
    per_user = clicks.groupBy(*by, "time_interval", user.alias("user_id")).agg(
        F.count("*").alias("n"),
        F.min(minute_of_day).alias("first_minute"),
        F.max(minute_of_day).alias("last_minute"),
    )
    per_interval = per_user.groupBy(*by, "time_interval").agg(
        F.sum("n").alias("click_count"),
        F.count("user_id").alias("unique_users"),
        F.min("first_minute").alias("first_minute"),
        F.max("last_minute").alias("last_minute"),
    )
    total = F.sum("click_count").over(Window.partitionBy())
    clicks_per_user = F.col("click_count").cast("double") / F.nullif(
        F.col("unique_users"), F.lit(0)
    )
    return per_interval.select(
        *by,
        "time_interval",
        "click_count",
        "unique_users",
        F.round(F.col("click_count").cast("double") * 100 / total, 2).alias("percentage"),
        F.round(clicks_per_user, 2).alias("avg_clicks_per_user"),
        fn.clock(F.col("first_minute")).alias("earliest_time"),
        fn.clock(F.col("last_minute")).alias("latest_time"),
    )


def user_activity(
    clicks: DataFrame, top: int | None = 10, style: str = "plain"
) -> DataFrame:
    """Clicks and active intervals per user, the ``top`` busiest first.

    ``intervals`` lists each interval with its clicks, at most four entries in
    order of their labels: the same multiset as a list of one entry per click,
    which would not fit in one row for a user who owns a third of the log. As
    the intervals are known, four counters per user are enough, and one shuffle.
    Ties go to the smaller id.
    """
    labels = sorted(fn.INTERVAL_LABELS[style])
    in_interval = F.col("time_interval")
    counted = clicks.groupBy("user_id").agg(
        F.count("*").alias("total_clicks"),
        *[F.count_if(in_interval == label).alias(f"clicks_{i}") for i, label in enumerate(labels)],
    )
    ranked = counted.orderBy(F.desc("total_clicks"), "user_id")
    if top is not None:
        ranked = ranked.limit(top)
    entries = F.array(
        *[
            F.struct(F.lit(label).alias("time_interval"), F.col(f"clicks_{i}").alias("clicks"))
            for i, label in enumerate(labels)
        ]
    )
    active = F.filter(entries, lambda entry: entry["clicks"] > 0)
    return ranked.select(
        "user_id",
        "total_clicks",
        F.size(active).cast("bigint").alias("active_intervals"),
        active.alias("intervals"),
    )


def user_clicks(clicks: DataFrame, top: int | None = None) -> DataFrame:
    """Clicks per user, most first."""
    ranked = (
        clicks.groupBy("user_id")
        .agg(F.count("*").alias("click_count"))
        .orderBy(F.desc("click_count"), "user_id")
    )
    return ranked if top is None else ranked.limit(top)


def click_summary(clicks: DataFrame) -> DataFrame:
    """Clicks, distinct users and clicks per user over the whole log."""
    per_user = clicks.groupBy("user_id").agg(F.count("*").alias("n"))
    totals = per_user.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_clicks"),
        F.count("user_id").alias("unique_users"),
    )
    return totals.withColumn(
        "avg_clicks_per_user",
        F.round(
            F.col("total_clicks").cast("double") / F.nullif(F.col("unique_users"), F.lit(0)), 2
        ),
    )


def interval_peak(clicks: DataFrame) -> DataFrame:
    """The busiest interval and its share; the earlier one wins a tie."""
    counted = clicks.groupBy("time_interval", fn.interval_number(F.col("hour")).alias("at")).agg(
        F.count("*").alias("n")
    )
    return counted.agg(
        F.max_by("time_interval", F.struct("n", -F.col("at"))).alias("peak_interval"),
        F.max("n").alias("peak_clicks"),
        F.sum("n").alias("total_clicks"),
    ).withColumn(
        "peak_percentage",
        F.round(F.col("peak_clicks").cast("double") * 100 / F.col("total_clicks"), 1),
    )
