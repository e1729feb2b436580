"""Upload events and line-count requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.sinks.streams import fan_out, to_batches
from tidemark.streaming.messages import BAD_JSON, parse_messages

# Words of the event types that stand for an upload, and the
# request that the counting job serves.
UPLOAD_WORDS = "finalize|create"
LINE_COUNT_REQUEST = "line_count"
OK, MISSING_FIELDS, OTHER_REQUEST = "ok", "missing_fields", "other_request"


def wanted_uploads(events: DataFrame) -> DataFrame:
    """Upload events of ordinary files: no folders, no hidden names."""
    name = F.coalesce("name", F.lit(""))
    return events.filter(
        F.lower("eventType").rlike(UPLOAD_WORDS) & ~name.endswith("/") & ~name.startswith(".")
    )


def line_count_requests(
    uploads: DataFrame, scheme: str, lines: Column | None = None, size: Column | None = None
) -> DataFrame:
    """The notification for each upload, as JSON in ``value`` keyed by file path.

    Lines and size are -1 where the file could not be counted.
    """
    unknown = F.lit(-1)
    file_path = F.concat(F.lit(f"{scheme}://"), "bucket", F.lit("/"), "name")
    fields = {
        "bucket_name": F.col("bucket"),
        "file_name": F.col("name"),
        "event_type": F.col("eventType"),
        "time_created": F.col("timeCreated"),
        "file_path": file_path,
        "processing_request": F.lit(LINE_COUNT_REQUEST),
        "function_triggered_at": F.col("timeCreated"),
        "LINE_COUNT": F.coalesce(lines if lines is not None else unknown, unknown),
        "FILE_SIZE": F.coalesce(size if size is not None else unknown, unknown),
        "PROCESSING_COMPLETE": F.lit(True),
    }
    message = F.struct(*[value.alias(name) for name, value in fields.items()])
    return uploads.select(file_path.alias("key"), F.to_json(message).alias("value"))


def route_notifications(raw: DataFrame, *keep: str) -> DataFrame:
    """Notifications with their ``route``; only ``ok`` ones ask for a count here."""
    parsed = parse_messages(raw, schemas.NOTIFICATION, *keep)
    has_file = (F.coalesce("bucket_name", F.lit("")) != "") & (
        F.coalesce("file_name", F.lit("")) != ""
    )
    is_request = F.coalesce("processing_request", F.lit("")) == LINE_COUNT_REQUEST
    route = (
        F.when(F.col("parse_status") == BAD_JSON, BAD_JSON)
        .when(~has_file, MISSING_FIELDS)
        .when(~is_request, OTHER_REQUEST)
        .otherwise(OK)
    )
    return parsed.withColumn("route", route).drop("parse_status")


def process_notifications(
    stream: DataFrame, target: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Store requests and rejects of each batch apart, parsing it once.

    A failing batch is run again from the checkpoint and replaces what it wrote;
    unreadable and unrelated messages end in ``rejects`` and are not retried.
    """
    wanted = F.col("route") == OK
    outputs = {
        "requests": lambda batch: batch.filter(wanted),
        "rejects": lambda batch: batch.filter(~wanted),
    }
    return to_batches(
        route_notifications(stream, "value"), fan_out(outputs, target), checkpoint, every
    )
