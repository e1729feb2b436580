"""JSON messages: parsing, message time and arrival time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.objects import epoch_timestamp

OK, DOUBLE_ENCODED, BAD_JSON = "ok", "double_encoded", "bad_json"
_CORRUPT = "_corrupt_record"


def unwrapped(value: Column) -> Column:
    """The text inside a message that was encoded as a JSON string."""
    wrapped = F.concat(F.lit('{"text":'), value, F.lit("}"))
    inner = F.from_json(wrapped, "text string")["text"]
    return F.when(_is_quoted(value), inner).otherwise(value)


def _is_quoted(value: Column) -> Column:
    return F.ltrim(value).startswith('"')


def parse_messages(raw: DataFrame, schema: T.StructType, *keep: str) -> DataFrame:
    """Columns of the JSON ``value`` beside the ``keep`` columns of the source.

    ``parse_status`` is ``ok``, ``double_encoded`` (read all the same) or
    ``bad_json``; no message is dropped here.
    """
    value = F.col("value").cast("string")
    with_corrupt = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    data = F.from_json(unwrapped(value), with_corrupt, {"columnNameOfCorruptRecord": _CORRUPT})
    bad = F.col("data").isNull() | F.col(f"data.{_CORRUPT}").isNotNull()
    status = F.when(bad, BAD_JSON).when(F.col("quoted"), DOUBLE_ENCODED).otherwise(OK)
    # explode() of one value computes it once; from a plain select it would be
    # merged into later filters and parsed again there.
    parsed = raw.select(
        *keep, _is_quoted(value).alias("quoted"), F.explode(F.array(data)).alias("data")
    )
    return parsed.select(
        *keep,
        *[F.col(f"data.{name}").alias(name) for name in schema.names],
        status.alias("parse_status"),
    )


def with_message_time(
    rows: DataFrame, name: str = "event_time", epoch: str = "producer_timestamp",
    text: str = "transaction_date",
) -> DataFrame:
    """Event time carried by the message: epoch seconds, else a formatted time."""
    written = F.try_to_timestamp(F.col(text), F.lit("yyyy-MM-dd HH:mm:ss"))
    return rows.withColumn(name, F.coalesce(epoch_timestamp(F.col(epoch)), written))


def with_arrival_time(rows: DataFrame) -> DataFrame:
    """When the row was processed, as time and as text; never used as event time."""
    now = F.current_timestamp()
    return rows.withColumns(
        {
            "processing_timestamp": now,
            "processing_timestamp_str": F.date_format(now, "yyyy-MM-dd HH:mm:ss"),
        }
    )
