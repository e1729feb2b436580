"""Click jobs on the ``events`` table.

One event is one click. The text jobs see it as a line ``dd-MMM HH:mm user``;
some lines are damaged by a rule on the event id that SQL can repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import clicks as fn
from tidemark.operators import clicks as op
from tidemark.session import new_path
from tidemark.sinks.files import register_table, write_parquet
from tidemark.sources.tables import table

DAMAGE_EVERY = 97
RESULTS_TABLE = "tidemark_interval_results"


def click_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Events as ``event_id, value`` text lines, damaged ones included."""
    events = table(spark, folder, "events")
    day, clock = F.date_format("ts", "dd-MMM"), F.date_format("ts", "HH:mm")
    user = F.col("user_id").cast("string")
    kind = F.expr(f"event_id DIV {DAMAGE_EVERY} % 5")
    line = (
        F.when(F.col("event_id") % DAMAGE_EVERY != 0, F.concat_ws(" ", day, clock, user))
        .when(kind == 0, day)
        .when(kind == 1, F.concat_ws(" ", day, F.lit("24:00"), user))
        .when(kind == 2, F.concat_ws(" ", day, F.lit("ab:cd"), user))
        .when(kind == 3, F.concat(day, F.lit("  "), clock, F.lit("\t"), user, F.lit(" extra")))
        .otherwise("")
    )
    return events.select("event_id", line.alias("value"))


def parsed(spark: SparkSession, folder: str, mode: str = "loose") -> DataFrame:
    return op.parse_clicks(click_lines(spark, folder), "event_id", mode=mode)


def valid(spark: SparkSession, folder: str) -> DataFrame:
    return op.valid_clicks(parsed(spark, folder))


def columnar(spark: SparkSession, folder: str, style: str = "plain") -> DataFrame:
    """Events with hour and interval taken from the timestamp, without text."""
    hour = F.hour("ts")
    return table(spark, folder, "events").select(
        "user_id",
        "event_type",
        hour.alias("hour"),
        (hour * 60 + F.minute("ts")).alias("minute"),
        fn.time_interval(hour, style, "Unknown").alias("time_interval"),
    )


def _parse_columns(rows: DataFrame) -> DataFrame:
    return rows.drop("tokens_ok")


def click_parse(spark: SparkSession, folder: str) -> DataFrame:
    return _parse_columns(parsed(spark, folder))


def click_parse_strict(spark: SparkSession, folder: str) -> DataFrame:
    rows = op.valid_clicks(parsed(spark, folder, "strict"))
    return rows.select("event_id", "date", "time", "user_id", "time_interval")


def click_parse_single_space(spark: SparkSession, folder: str) -> DataFrame:
    rows = op.valid_clicks(parsed(spark, folder, "single_space"))
    return rows.select("event_id", "date", "time", "user_id", "hour")


def click_regex_valid(spark: SparkSession, folder: str) -> DataFrame:
    damaged = F.col("event_id") % DAMAGE_EVERY == 0

    def shown(good: str, bad: str) -> Column:
        return F.when(damaged, F.date_format("ts", bad)).otherwise(F.date_format("ts", good))

    rows = table(spark, folder, "events").select(
        "event_id",
        shown("yyyy-MM-dd", "dd-MMM").alias("date"),
        shown("HH:mm:ss", "HH:mm").alias("time"),
        "user_id",
    )
    return op.valid_by_regex(rows)


def click_quality(spark: SparkSession, folder: str) -> DataFrame:
    return op.click_quality(parsed(spark, folder))


def interval_counts(spark: SparkSession, folder: str) -> DataFrame:
    return op.interval_counts(valid(spark, folder))


def interval_counts_named(spark: SparkSession, folder: str) -> DataFrame:
    return op.interval_counts(columnar(spark, folder, "named"))


def interval_counts_zero_filled(spark: SparkSession, folder: str) -> DataFrame:
    return op.zero_filled(op.interval_counts(columnar(spark, folder)))


def interval_counts_daytime(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks outside the night, whose interval is listed with none."""
    day = columnar(spark, folder).filter(F.col("time_interval") != fn.INTERVAL_LABELS["plain"][0])
    return op.zero_filled(op.interval_counts(day))


def interval_share(spark: SparkSession, folder: str) -> DataFrame:
    return op.interval_share(op.interval_counts(valid(spark, folder)))


def interval_detail(spark: SparkSession, folder: str) -> DataFrame:
    return op.interval_detail(columnar(spark, folder), F.col("user_id"), F.col("minute"))


def interval_detail_of_lines(spark: SparkSession, folder: str) -> DataFrame:
    return op.interval_detail(
        valid(spark, folder), F.col("user_id"), fn.minute_of_day(F.col("time"))
    )


def interval_by_activity(spark: SparkSession, folder: str) -> DataFrame:
    return op.interval_detail(
        columnar(spark, folder), F.col("user_id"), F.col("minute"), "event_type"
    )


def user_activity_top10(spark: SparkSession, folder: str) -> DataFrame:
    pair = lambda item: F.concat_ws("=", item["time_interval"], item["clicks"])
    return op.user_activity(columnar(spark, folder)).withColumn(
        "intervals", F.array_join(F.transform("intervals", pair), ",")
    )


def user_clicks(spark: SparkSession, folder: str) -> DataFrame:
    return op.user_clicks(table(spark, folder, "events"))


def click_summary(spark: SparkSession, folder: str) -> DataFrame:
    return op.click_summary(table(spark, folder, "events"))


def interval_peak(spark: SparkSession, folder: str) -> DataFrame:
    return op.interval_peak(columnar(spark, folder))


def interval_results_table(spark: SparkSession, folder: str) -> DataFrame:
    """The stored results, read through an external table."""
    path = new_path(spark, "interval-results")
    write_parquet(interval_detail(spark, folder), path)
    return register_table(spark, RESULTS_TABLE, path)


QUERIES = {
    function.__name__: function
    for function in (
        click_parse,
        click_parse_strict,
        click_parse_single_space,
        click_regex_valid,
        click_quality,
        interval_counts,
        interval_counts_named,
        interval_counts_zero_filled,
        interval_counts_daytime,
        interval_share,
        interval_detail,
        interval_detail_of_lines,
        interval_by_activity,
        user_activity_top10,
        user_clicks,
        click_summary,
        interval_peak,
        interval_results_table,
    )
}

_LINES = """
lines AS (
  SELECT event_id,
    CASE WHEN event_id % 97 <> 0 THEN day || ' ' || clock || ' ' || user_id
         WHEN (event_id // 97) % 5 = 0 THEN day
         WHEN (event_id // 97) % 5 = 1 THEN day || ' 24:00 ' || user_id
         WHEN (event_id // 97) % 5 = 2 THEN day || ' ab:cd ' || user_id
         WHEN (event_id // 97) % 5 = 3 THEN day || '  ' || clock || chr(9) || user_id || ' extra'
         ELSE '' END AS value
  FROM (SELECT *, strftime(ts, '%d-%b') AS day, strftime(ts, '%H:%M') AS clock FROM events)
)"""
_INTERVAL = """CASE WHEN hour BETWEEN 0 AND 5 THEN '0-6' WHEN hour BETWEEN 6 AND 11 THEN '6-12'
       WHEN hour BETWEEN 12 AND 17 THEN '12-18' WHEN hour BETWEEN 18 AND 23 THEN '18-24' END"""


def _parsed(tokens: str, enough: str) -> str:
    return f"""{_LINES},
tokens AS (SELECT *, {tokens} AS parts FROM lines),
fields AS (
  SELECT event_id, value, {enough} AS tokens_ok,
    CASE WHEN {enough} THEN parts[1] END AS date,
    CASE WHEN {enough} THEN parts[2] END AS time,
    CASE WHEN {enough} THEN parts[3] END AS user_id
  FROM tokens),
hours AS (SELECT *, TRY_CAST(split_part(time, ':', 1) AS INTEGER) AS hour FROM fields),
parsed AS (
  SELECT *, CASE WHEN NOT tokens_ok THEN 'MALFORMED' WHEN time_interval IS NULL THEN 'UNKNOWN'
                 ELSE 'OK' END AS status
  FROM (SELECT *, {_INTERVAL} AS time_interval FROM hours))"""


_LOOSE = _parsed(r"regexp_extract_all(value, '\S+')", "len(parts) >= 2")
_STRICT = _parsed(r"regexp_extract_all(value, '\S+')", "len(parts) = 3")
_SINGLE = _parsed("string_split(value, ' ')", "len(parts) >= 3")
_COLUMNAR = f"""
columnar AS (
  SELECT *, {_INTERVAL} AS time_interval
  FROM (SELECT user_id, event_type, hour(ts) AS hour, hour(ts) * 60 + minute(ts) AS minute
        FROM events))"""


def _detail(source: str, by: str = "") -> str:
    return f"""
SELECT {by} time_interval, count(*) AS click_count, count(DISTINCT user_id) AS unique_users,
  round(count(*)::DOUBLE * 100 / sum(count(*)) OVER (), 2) AS percentage,
  round(count(*)::DOUBLE / count(DISTINCT user_id), 2) AS avg_clicks_per_user,
  printf('%02d:%02d', min(minute) // 60, min(minute) % 60) AS earliest_time,
  printf('%02d:%02d', max(minute) // 60, max(minute) % 60) AS latest_time
FROM {source} GROUP BY {by} time_interval"""


_DETAIL = f"WITH {_COLUMNAR} {_detail('columnar')}"

SQL = {
    "click_parse": f"""WITH {_LOOSE}
SELECT event_id, value, date, time, user_id, hour, time_interval, status FROM parsed""",
    "click_parse_strict": f"""WITH {_STRICT}
SELECT event_id, date, time, user_id, time_interval FROM parsed WHERE status = 'OK'""",
    "click_parse_single_space": f"""WITH {_SINGLE}
SELECT event_id, date, time, user_id, hour FROM parsed WHERE status = 'OK'""",
    "click_regex_valid": r"""
SELECT * FROM (
  SELECT event_id,
    CASE WHEN event_id % 97 = 0 THEN strftime(ts, '%d-%b') ELSE strftime(ts, '%Y-%m-%d') END AS date,
    CASE WHEN event_id % 97 = 0 THEN strftime(ts, '%H:%M') ELSE strftime(ts, '%H:%M:%S') END AS time,
    user_id
  FROM events)
WHERE regexp_matches(date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$')
  AND regexp_matches(time, '^[0-9]{2}:[0-9]{2}:[0-9]{2}$') AND user_id IS NOT NULL""",
    "click_quality": f"""WITH {_LOOSE}
SELECT count(*) AS total_lines,
  count(*) FILTER (status = 'OK') AS valid_lines,
  count(*) FILTER (status <> 'OK') AS invalid_lines,
  count(*) FILTER (status = 'MALFORMED') AS malformed_lines,
  count(*) FILTER (status = 'UNKNOWN') AS unknown_lines,
  count(*) FILTER (tokens_ok) AS tokens_ok_lines,
  count(*) FILTER (hour BETWEEN 0 AND 23) AS time_ok_lines,
  round(count(*) FILTER (status = 'OK')::DOUBLE * 100 / count(*), 1) AS success_rate
FROM parsed""",
    "interval_counts": f"""WITH {_LOOSE}
SELECT time_interval, count(*) AS click_count FROM parsed WHERE status = 'OK' GROUP BY 1""",
    "interval_counts_named": """
SELECT CASE WHEN hour(ts) < 6 THEN '00-06 Night' WHEN hour(ts) < 12 THEN '06-12 Morning'
            WHEN hour(ts) < 18 THEN '12-18 Afternoon' ELSE '18-24 Evening' END AS time_interval,
  count(*) AS click_count
FROM events GROUP BY 1""",
    "interval_counts_zero_filled": f"""WITH {_COLUMNAR},
labels(interval_order, time_interval) AS (VALUES (0, '0-6'), (1, '6-12'), (2, '12-18'), (3, '18-24'))
SELECT interval_order, time_interval,
  (SELECT count(*) FROM columnar c WHERE c.time_interval = l.time_interval) AS click_count
FROM labels l""",
    "interval_counts_daytime": f"""WITH {_COLUMNAR},
labels(interval_order, time_interval) AS (VALUES (0, '0-6'), (1, '6-12'), (2, '12-18'), (3, '18-24'))
SELECT interval_order, time_interval, (
    SELECT count(*) FROM columnar c
    WHERE c.time_interval = l.time_interval AND c.time_interval <> '0-6') AS click_count
FROM labels l""",
    "interval_share": f"""WITH {_LOOSE},
counts AS (SELECT time_interval, count(*) AS click_count FROM parsed WHERE status = 'OK' GROUP BY 1)
SELECT *, CAST(sum(click_count) OVER () AS BIGINT) AS total_clicks,
  round(click_count::DOUBLE * 100 / sum(click_count) OVER (), 1) AS percentage
FROM counts""",
    "interval_detail": _DETAIL,
    "interval_detail_of_lines": f"""WITH {_LOOSE},
timed AS (SELECT *, hour * 60 + CAST(split_part(time, ':', 2) AS INTEGER) AS minute
          FROM parsed WHERE status = 'OK')
{_detail('timed')}""",
    "interval_by_activity": f"WITH {_COLUMNAR} {_detail('columnar', 'event_type,')}",
    "user_activity_top10": f"""WITH {_COLUMNAR},
per_interval AS (SELECT user_id, time_interval, count(*) AS n FROM columnar GROUP BY 1, 2)
SELECT user_id, CAST(sum(n) AS BIGINT) AS total_clicks, count(*) AS active_intervals,
  string_agg(time_interval || '=' || n, ',' ORDER BY time_interval) AS intervals
FROM per_interval GROUP BY user_id ORDER BY total_clicks DESC, user_id LIMIT 10""",
    "user_clicks": "SELECT user_id, count(*) AS click_count FROM events GROUP BY user_id",
    "click_summary": """
SELECT count(*) AS total_clicks, count(DISTINCT user_id) AS unique_users,
  round(count(*)::DOUBLE / count(DISTINCT user_id), 2) AS avg_clicks_per_user
FROM events""",
    "interval_peak": f"""WITH {_COLUMNAR},
counts AS (SELECT time_interval, min(hour) AS first_hour, count(*) AS n FROM columnar GROUP BY 1)
SELECT arg_max(time_interval, n * 100 - first_hour) AS peak_interval, max(n) AS peak_clicks,
  CAST(sum(n) AS BIGINT) AS total_clicks,
  round(max(n)::DOUBLE * 100 / sum(n), 1) AS peak_percentage
FROM counts""",
    "interval_results_table": _DETAIL,
}
