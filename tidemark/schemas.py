"""Declared schemas of files, messages and result tables."""

from __future__ import annotations

from pyspark.sql import types as T


def struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()

# Space-delimited click file.
CLICK_FILE = struct(("date", _S), ("time", _S), ("user_id", _S))

# Dimension and feed files. Dates are read as text and parsed after trimming.
DIMENSION_FILE = struct(
    ("customer_key", _I),
    ("customer_id", _I),
    ("customer_name", _S),
    ("address", _S),
    ("phone", _S),
    ("email", _S),
    ("effective_start_date", _S),
    ("effective_end_date", _S),
    ("is_current", T.BooleanType()),
)
FEED_FILE = struct(
    ("customer_id", _I),
    ("customer_name", _S),
    ("address", _S),
    ("phone", _S),
    ("email", _S),
    ("source_date", _S),
)

# Transaction record as it stands in the CSV file. The zip code is text so that
# leading zeros survive.
TRANSACTION_FILE = struct(
    ("customer_id", _S),
    ("transaction_id", _S),
    ("transaction_date", _S),
    ("first_name", _S),
    ("last_name", _S),
    ("email", _S),
    ("phone", _S),
    ("age", _I),
    ("gender", _S),
    ("city", _S),
    ("state", _S),
    ("zip_code", _S),
    ("product_category", _S),
    ("quantity", _I),
    ("unit_price", _D),
    ("total_amount", _D),
    ("discount", _D),
    ("final_amount", _D),
    ("payment_method", _S),
    ("is_premium_customer", T.BooleanType()),
    ("customer_since", _S),
    ("loyalty_points", _I),
    ("record_id", _I),
)

# The same record as a message: the publisher adds four columns.
TRANSACTION_MESSAGE = T.StructType(
    TRANSACTION_FILE.fields
    + struct(
        ("batch_number", _I),
        ("batch_position", _I),
        ("producer_timestamp", _D),
        ("producer_timestamp_str", _S),
    ).fields
)

# Columns of a keyed message stream, whatever carries it.
MESSAGE = struct(
    ("key", _S),
    ("value", _S),
    ("topic", _S),
    ("partition", _I),
    ("offset", _L),
    ("timestamp", T.TimestampType()),
)

# Upload event as it arrives, and the line-count request made from it.
UPLOAD_EVENT = struct(("bucket", _S), ("name", _S), ("eventType", _S), ("timeCreated", _S))
NOTIFICATION = struct(
    ("bucket_name", _S),
    ("file_name", _S),
    ("event_type", _S),
    ("time_created", _S),
    ("file_path", _S),
    ("processing_request", _S),
    ("function_triggered_at", _S),
    ("LINE_COUNT", _L),
    ("FILE_SIZE", _L),
    ("PROCESSING_COMPLETE", T.BooleanType()),
)

# Binary files, and images sent as messages.
BINARY_FILE = struct(
    ("path", _S),
    ("modificationTime", T.TimestampType()),
    ("length", _L),
    ("content", T.BinaryType()),
)
IMAGE_MESSAGE = struct(
    ("image_id", _S),
    ("image_data", _S),
    ("path", _S),
    ("label", _S),
    ("timestamp", _S),
    ("modificationTime", _D),
    ("size", _L),
)

PREDICTION = struct(("class", _S), ("desc", _S), ("score", T.FloatType()))
PREDICTION_TABLE = struct(
    ("image_path", _S),
    ("label", _S),
    ("predicted_class", _S),
    ("predicted_description", _S),
    ("confidence", T.FloatType()),
    ("processed_at", T.TimestampType()),
)
