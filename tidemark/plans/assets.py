"""Scoring and notification jobs on ``embeddings`` and ``documents``.

Embeddings are scored by a linear softmax model whose weights follow a formula.
Documents stand for uploaded files; their events and requests are made from
their names, some of them invalid by a rule on the document id.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.functions.images import image_size
from tidemark.functions.objects import base64_text
from tidemark.operators import scoring
from tidemark.operators.line_stats import file_stats, listed_stats
from tidemark.plans.text_objects import _BY_SOURCE, _NAME, _lines, object_name
from tidemark.session import new_path, ship_package, stage
from tidemark.sinks.streams import to_files
from tidemark.sources.files import binary_files
from tidemark.sources.streams import binary_file_stream, message_stream, notification_stream
from tidemark.sources.tables import table, table_stream
from tidemark.streaming import notifications
from tidemark.streaming.assets import image_messages, score_stream

WIDTH = 64
CLASSES = tuple(f"kind {i}" for i in range(10))
MODEL = "sine-weights"
TEXTS_PER_FILE = 200  # a file is one cell when read as binary


def sine_model(model_id: str) -> scoring.Model:
    """Weight of feature i for class c is sin((c + 1) * (i + 1))."""
    classes = np.arange(1, len(CLASSES) + 1)[:, None]
    features = np.arange(1, WIDTH + 1)[None, :]
    return scoring.LinearModel(np.sin(classes * features))


def _vectors(embeddings: DataFrame) -> DataFrame:
    """Embeddings in the columns of an asset: path, label, content."""
    return embeddings.select(
        F.concat(F.lit("vectors/"), "label", F.lit("/"), "vec_id").alias("path"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").alias("content"),
        "vec_id",
    )


def _top1(spark: SparkSession) -> Callable[[Column], Column]:
    ship_package(spark)
    return scoring.top1_udf(MODEL, sine_model, CLASSES)


def _rounded(results: DataFrame) -> DataFrame:
    return results.withColumn("confidence", F.round(F.col("confidence").cast("double"), 4))


def _results(spark: SparkSession, folder: str) -> DataFrame:
    """The result table; a row counts as processed as many seconds in as its id says."""
    vectors = _vectors(table(spark, folder, "embeddings"))
    scored = vectors.withColumn("prediction", _top1(spark)(F.col("content")))
    seconds = F.make_dt_interval(secs=F.col("vec_id").cast("decimal(18,6)"))
    processed_at = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + seconds
    return _rounded(scoring.prediction_table(scored, processed_at=processed_at))


def stream_score_top1(spark: SparkSession, folder: str) -> DataFrame:
    """The predictions by a stream that scores once and stores two results."""
    target, checkpoint = new_path(spark, "scores"), new_path(spark, "scores-checkpoint")
    vectors = _vectors(table_stream(spark, folder, "embeddings"))
    score_stream(vectors, _top1(spark), target, checkpoint).awaitTermination()
    stored = spark.read.parquet(f"{target}/predictions")
    return _rounded(stored.drop("processed_at", "batch_id"))


def stream_class_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The second result of the same stream: images per class, summed over its batches."""
    target, checkpoint = new_path(spark, "counts"), new_path(spark, "counts-checkpoint")
    vectors = _vectors(table_stream(spark, folder, "embeddings"))
    score_stream(vectors, _top1(spark), target, checkpoint).awaitTermination()
    stored = spark.read.parquet(f"{target}/class_counts")
    return stored.groupBy("predicted_class").agg(F.sum("count").alias("images"))


def doubles_of(content: bytes) -> np.ndarray:
    """The numbers of a vector that was sent as text separated by blanks."""
    return np.array(content.split(), dtype=np.float64)


def stream_image_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors sent as base64 in JSON messages, scored by a stream; every seventh is damaged."""
    numbers = F.transform("embedding", lambda x: x.cast("double").cast("string"))
    damaged = F.col("vec_id") % 7 == 0
    content = F.base64(F.array_join(numbers, " ").cast("binary"))
    message = F.struct(
        F.col("vec_id").cast("string").alias("image_id"),
        F.when(damaged, "no base64!").otherwise(content).alias("image_data"),
        F.concat(F.lit("vectors/"), "label", F.lit("/"), "vec_id").alias("path"),
        F.col("label").cast("string").alias("label"),
    )
    source, target = new_path(spark, "images"), new_path(spark, "image-scores")
    sent = table(spark, folder, "embeddings").select(F.to_json(message).alias("value"))
    sent.write.json(source)
    ship_package(spark)
    top1 = scoring.top1_udf(MODEL, sine_model, CLASSES, decode=doubles_of)
    images = image_messages(message_stream(spark, "file", path=source))
    checkpoint = new_path(spark, "image-checkpoint")
    score_stream(images, top1, target, checkpoint).awaitTermination()
    stored = spark.read.parquet(f"{target}/predictions")
    return _rounded(stored.drop("processed_at", "batch_id"))


def score_top1(spark: SparkSession, folder: str) -> DataFrame:
    return _results(spark, folder).drop("processed_at")


def latest_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """From the stored result table: scores are not computed again to find the latest."""
    stored = stage(_results(spark, folder), "predictions")
    return scoring.latest_predictions(stored)


def asset_label_counts(spark: SparkSession, folder: str) -> DataFrame:
    names = table(spark, folder, "documents").select(object_name().alias("path"))
    labeled = names.withColumn("label", scoring.objects.path_label(F.col("path")))
    return scoring.asset_label_counts(labeled)


def _written_assets(spark: SparkSession, folder: str) -> str:
    """Document texts as files of bounded size below one folder per source."""
    path = new_path(spark, "assets") + f"/{scoring.objects.LABEL_FOLDER}"
    texts = table(spark, folder, "documents").select("source", "text")
    writer = texts.write.option("maxRecordsPerFile", TEXTS_PER_FILE)
    writer.partitionBy("source").text(path)
    return path


def asset_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes per label over the catalog of the written files."""
    catalog = scoring.asset_catalog(spark, _written_assets(spark, folder), "*.txt")
    return catalog.groupBy("label").agg(F.sum("length").alias("total_bytes"))


def stream_assets(spark: SparkSession, folder: str) -> DataFrame:
    """The same by a stream of the files; their contents are not read."""
    files = binary_file_stream(spark, _written_assets(spark, folder), "*.txt")
    label = scoring.objects.path_label(F.col("path"))
    sizes = files.select(label.alias("label"), F.col("length").alias("bytes"))
    target, checkpoint = new_path(spark, "asset-sizes"), new_path(spark, "asset-checkpoint")
    to_files(sizes, target, checkpoint).awaitTermination()
    stored = spark.read.schema(sizes.schema).json(target)
    return stored.groupBy("label").agg(F.sum("bytes").alias("total_bytes"))


def text_size(content: bytes) -> tuple[int, int]:
    """Size of a text seen as a picture: its longest line by its lines."""
    lines = content.decode().removesuffix("\n").split("\n")
    return max(map(len, lines)), len(lines)


def asset_dims(spark: SparkSession, folder: str) -> DataFrame:
    """Largest width and total height per label over the written files."""
    ship_package(spark)
    files = binary_files(spark, _written_assets(spark, folder), "*.txt")
    label = scoring.objects.path_label(F.col("path"))
    sizes = files.select(
        label.alias("label"), scoring.dims_udf(text_size)(F.col("content")).alias("size")
    )
    return sizes.groupBy("label").agg(
        F.max("size.width").alias("largest_width"), F.sum("size.height").alias("total_height")
    )


def _hex_number(value: Column, size: int, little: bool = False) -> Column:
    """A whole number as ``size`` bytes in hexadecimal digits."""
    digits = F.lpad(F.hex(value.cast("bigint")), 2 * size, "0")
    if not little:
        return digits
    return F.concat(*(F.substring(digits, 2 * k + 1, 2) for k in reversed(range(size))))


def _pictures(spark: SparkSession, folder: str) -> DataFrame:
    """A picture for each vector, up to its first pixels, in five kinds by its id.

    PNG, GIF and BMP headers; JPEG with as many comments before the frame as the
    last digit of the id says; and JPEG that is cut off within the frame header.
    """
    rows = table(spark, folder, "embeddings").select("vec_id", "label")
    width, height = F.col("vec_id") % 3000 + 1, F.col("label") + 1
    w4, h4 = _hex_number(width, 4), _hex_number(height, 4)
    comments = F.repeat(F.lit("FFFE0005414243"), (F.col("vec_id") % 10).cast("int"))
    frame = F.concat(F.lit("FFC2001108"), _hex_number(height, 2), _hex_number(width, 2))
    jpeg = F.concat(F.lit("FFD8FFE000104A46494600010100000100010000"), comments, frame)
    kinds = (
        F.concat(F.lit("89504E470D0A1A0A0000000D49484452"), w4, h4, F.lit("0806000000")),
        F.concat(
            F.lit("474946383961"), _hex_number(width, 2, True), _hex_number(height, 2, True),
            F.lit("800000"),
        ),
        F.concat(
            F.lit("424D00000000000000003600000028000000"), _hex_number(width, 4, True),
            _hex_number(height, 4, True), F.lit("01001800"),
        ),
        F.concat(jpeg, F.lit("03011100")),
        F.substring(jpeg, F.lit(1), F.length(jpeg) - 4),
    )
    content = kinds[-1]
    for k, kind in enumerate(kinds[:-1]):
        content = F.when(F.col("vec_id") % len(kinds) == k, kind).otherwise(content)
    return rows.select("vec_id", F.unhex(content).alias("content"))


def image_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """Size of each vector's picture, read from its bytes; 0 x 0 for the damaged ones."""
    return _pictures(spark, folder).select("vec_id", image_size(F.col("content")).alias("size")).select(
        "vec_id", "size.*"
    )


def stream_image_sizes(spark: SparkSession, folder: str) -> DataFrame:
    """The same pictures as base64 messages: pixels, and damaged pictures, by kind of picture."""
    message = F.struct(
        F.col("vec_id").cast("string").alias("image_id"),
        F.concat(F.lit("pictures/"), F.col("vec_id") % 5, F.lit("/"), "vec_id").alias("path"),
        (F.col("vec_id") % 5).cast("string").alias("label"),
        base64_text(F.col("content")).alias("image_data"),
    )
    source, target = new_path(spark, "pictures"), new_path(spark, "sizes")
    _pictures(spark, folder).select(F.to_json(message).alias("value")).write.json(source)
    images = image_messages(message_stream(spark, "file", path=source))
    sizes = images.select("label", image_size(F.col("content")).alias("size")).select("label", "size.*")
    to_files(sizes, target, new_path(spark, "sizes-checkpoint"), "parquet").awaitTermination()
    pixels = F.col("width").cast("bigint") * F.col("height")
    return spark.read.schema(sizes.schema).parquet(target).groupBy("label").agg(
        F.sum(pixels).alias("pixels"),
        F.max("width").alias("largest_width"),
        F.count_if(pixels == 0).alias("damaged"),
    )


# Event types given to documents in turn by language; the last is for all others.
_EVENT_TYPES = {"en": "OBJECT_FINALIZE", "fr": "object.create", "de": "OBJECT_DELETE"}
_OTHER_EVENT = "metadata.update"


def _event_type() -> Column:
    kind = F.when(F.lit(False), None)
    for lang, event_type in _EVENT_TYPES.items():
        kind = kind.when(F.col("lang") == lang, event_type)
    return kind.otherwise(_OTHER_EVENT)


def upload_events(spark: SparkSession, folder: str) -> DataFrame:
    name = (
        F.when(F.col("doc_id") % 11 == 0, F.concat("source", F.lit("/")))
        .when(F.col("doc_id") % 13 == 0, F.concat(F.lit("."), "source"))
        .otherwise(object_name())
    )
    return table(spark, folder, "documents").select(
        "doc_id",
        F.col("source").alias("bucket"),
        name.alias("name"),
        _event_type().alias("eventType"),
        F.lit("2024-01-15T00:00:00Z").alias("timeCreated"),
        F.octet_length("text").alias("size"),
        text.line_count(F.col("text")).alias("lines"),
    )


def notification_filter(spark: SparkSession, folder: str) -> DataFrame:
    return notifications.wanted_uploads(upload_events(spark, folder)).select(
        "doc_id", "name", "eventType"
    )


def notification_messages(spark: SparkSession, folder: str) -> DataFrame:
    """The message of each upload, with the counts of its text."""
    uploads = notifications.wanted_uploads(upload_events(spark, folder))
    return notifications.line_count_requests(
        uploads, "file", lines=F.col("lines"), size=F.col("size")
    )


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    """Requests for all documents, some damaged in one of three ways."""
    requests = notifications.line_count_requests(
        table(spark, folder, "documents").select(
            F.col("source").alias("bucket"),
            F.when(F.col("doc_id") % 7 != 1, F.col("doc_id").cast("string"))
            .otherwise("")
            .alias("name"),
            F.lit("OBJECT_FINALIZE").alias("eventType"),
            F.lit("2024-01-15T00:00:00Z").alias("timeCreated"),
            "doc_id",
        ),
        "file",
    )
    name = F.get_json_object("value", "$.file_name").try_cast("bigint")
    damaged = (
        F.when(name % 7 == 2, F.replace("value", F.lit("line_count"), F.lit("word_count")))
        .when(name % 7 == 3, F.concat(F.lit("not json "), "value"))
        .otherwise(F.col("value"))
    )
    return requests.withColumn("value", damaged)


def notification_route(spark: SparkSession, folder: str) -> DataFrame:
    routed = notifications.route_notifications(_requests(spark, folder), "key")
    return routed.select("key", "bucket_name", "file_name", "route")


def stream_notifications(spark: SparkSession, folder: str) -> DataFrame:
    """Requests and rejects as a stream stores them, counted by route."""
    source, target = new_path(spark, "requests"), new_path(spark, "routed")
    _requests(spark, folder).select("value").write.text(source)
    notifications.process_notifications(
        notification_stream(spark, source), target, new_path(spark, "routed-checkpoint")
    ).awaitTermination()
    stored = [spark.read.parquet(f"{target}/{name}") for name in ("requests", "rejects")]
    return stored[0].unionByName(stored[1]).groupBy("route").agg(F.count("*").alias("messages"))


def stream_requested_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Written files are announced by message, and those asked for are counted."""
    root = _written_assets(spark, folder)
    uploads = scoring.asset_catalog(spark, root, "*.txt").select(
        F.col("label").alias("bucket"),
        F.col("file_name").alias("name"),
        F.lit("OBJECT_FINALIZE").alias("eventType"),
        F.lit("2024-01-15T00:00:00Z").alias("timeCreated"),
    )
    source, target = new_path(spark, "uploads"), new_path(spark, "requested")
    requests = notifications.line_count_requests(notifications.wanted_uploads(uploads), "file")
    requests.select("value").write.text(source)
    notifications.process_notifications(
        notification_stream(spark, source), target, new_path(spark, "requested-checkpoint")
    ).awaitTermination()
    listed = spark.read.parquet(f"{target}/requests").select(
        F.col("bucket_name").alias("label"),
        F.concat_ws("/", "bucket_name", "file_name").alias("path"),
    )
    below_root = F.regexp_extract("path", "([^/]+/[^/]+)$", 1)
    counts = file_stats(spark, root, "*.txt").withColumn("path", below_root)
    return listed_stats(listed, counts).groupBy("label").agg(
        *[F.sum(name).alias(name) for name in ("line_count", "word_count", "file_size_bytes")]
    )


QUERIES = {
    function.__name__: function
    for function in (
        score_top1,
        stream_score_top1,
        stream_class_counts,
        stream_image_messages,
        latest_predictions,
        asset_label_counts,
        asset_catalog,
        stream_assets,
        asset_dims,
        image_sizes,
        stream_image_sizes,
        notification_filter,
        notification_messages,
        notification_route,
        stream_notifications,
        stream_requested_counts,
    )
}

_SCORES = """
logits AS (
  SELECT vec_id, label, list_transform(range(1, 11), lambda c: list_sum(list_transform(range(1, 65),
    lambda i: sin((c * i)::DOUBLE) * embedding[i]::DOUBLE))) AS z
  FROM embeddings),
results AS (
  SELECT vec_id, 'vectors/' || label || '/' || vec_id AS image_path,
    CAST(label AS VARCHAR) AS label,
    CAST(list_position(z, list_max(z)) - 1 AS VARCHAR) AS predicted_class,
    'kind ' || (list_position(z, list_max(z)) - 1) AS predicted_description,
    round(CAST(CAST(1 / list_sum(list_transform(z, lambda v: exp(v - list_max(z)))) AS FLOAT)
      AS DOUBLE), 4) AS confidence
  FROM logits)"""
_EVENTS = f"""
uploads AS (
  SELECT doc_id, source, strlen(text) AS size, {_lines("text")} AS lines,
    CASE WHEN doc_id % 11 = 0 THEN source || '/' WHEN doc_id % 13 = 0 THEN '.' || source
         ELSE {_NAME} END AS name,
    CASE lang WHEN 'en' THEN 'OBJECT_FINALIZE' WHEN 'fr' THEN 'object.create'
              WHEN 'de' THEN 'OBJECT_DELETE' ELSE 'metadata.update' END AS "eventType"
  FROM documents),
wanted AS (
  SELECT * FROM uploads
  WHERE regexp_matches(lower("eventType"), 'finalize|create')
    AND NOT ends_with(name, '/') AND NOT starts_with(name, '.'))"""
_BYTES = """
SELECT 'source=' || source AS label, CAST(sum(strlen(text) + 1) AS BIGINT) AS total_bytes
FROM documents GROUP BY source"""

_PICTURES = """
SELECT vec_id, CASE WHEN vec_id % 5 = 4 THEN 0 ELSE vec_id % 3000 + 1 END AS width,
  CASE WHEN vec_id % 5 = 4 THEN 0 ELSE label + 1 END AS height
FROM embeddings"""

_PREDICTIONS = f"""WITH {_SCORES}
SELECT image_path, label, predicted_class, predicted_description, confidence FROM results"""

SQL = {
    "score_top1": _PREDICTIONS,
    "stream_score_top1": _PREDICTIONS,
    "stream_class_counts": f"""WITH {_SCORES}
SELECT predicted_class, count(*) AS images FROM results GROUP BY predicted_class""",
    "stream_image_messages": f"""WITH {_SCORES}
SELECT image_path, label,
  CASE WHEN vec_id % 7 = 0 THEN 'unknown' ELSE predicted_class END AS predicted_class,
  CASE WHEN vec_id % 7 = 0 THEN 'unknown' ELSE predicted_description END AS predicted_description,
  CASE WHEN vec_id % 7 = 0 THEN 0.0 ELSE confidence END AS confidence
FROM results""",
    "latest_predictions": f"""WITH {_SCORES}
SELECT image_path, label, predicted_class, predicted_description, confidence,
  TIMESTAMP '1970-01-01' + vec_id * INTERVAL 1 SECOND AS processed_at
FROM results ORDER BY vec_id DESC LIMIT 5""",
    "asset_label_counts": """
SELECT source AS label, count(*) AS assets FROM documents GROUP BY source""",
    "asset_catalog": _BYTES,
    "stream_assets": _BYTES,
    "asset_dims": """
SELECT 'source=' || source AS label,
  CAST(max(list_max(list_transform(string_split(text, chr(10)), lambda x: length(x)))) AS INTEGER)
    AS largest_width,
  CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS total_height
FROM documents GROUP BY source""",
    "image_sizes": f"""
SELECT vec_id, CAST(width AS INTEGER) AS width, CAST(height AS INTEGER) AS height
FROM ({_PICTURES})""",
    "stream_image_sizes": f"""
SELECT CAST(vec_id % 5 AS VARCHAR) AS label, CAST(sum(width * height) AS BIGINT) AS pixels,
  CAST(max(width) AS INTEGER) AS largest_width, count(*) FILTER (width * height = 0) AS damaged
FROM ({_PICTURES}) GROUP BY 1""",
    "notification_filter": f"""WITH {_EVENTS}
SELECT doc_id, name, "eventType" FROM wanted""",
    "notification_messages": f"""WITH {_EVENTS}
SELECT 'file://' || source || '/' || name AS key,
  '{{"bucket_name":"' || source || '","file_name":"' || name || '","event_type":"' || "eventType"
  || '","time_created":"2024-01-15T00:00:00Z","file_path":"file://' || source || '/' || name
  || '","processing_request":"line_count","function_triggered_at":"2024-01-15T00:00:00Z"'
  || ',"LINE_COUNT":' || lines || ',"FILE_SIZE":' || size || ',"PROCESSING_COMPLETE":true}}' AS value
FROM wanted""",
    "notification_route": """
SELECT 'file://' || source || '/' || CASE WHEN doc_id % 7 <> 1 THEN doc_id::VARCHAR ELSE '' END
    AS key,
  CASE WHEN doc_id % 7 <> 3 THEN source END AS bucket_name,
  CASE doc_id % 7 WHEN 3 THEN NULL WHEN 1 THEN '' ELSE doc_id::VARCHAR END AS file_name,
  CASE doc_id % 7 WHEN 1 THEN 'missing_fields' WHEN 2 THEN 'other_request' WHEN 3 THEN 'bad_json'
       ELSE 'ok' END AS route
FROM documents""",
    "stream_notifications": """
SELECT CASE doc_id % 7 WHEN 1 THEN 'missing_fields' WHEN 2 THEN 'other_request'
            WHEN 3 THEN 'bad_json' ELSE 'ok' END AS route, count(*) AS messages
FROM documents GROUP BY 1""",
    "stream_requested_counts": f"""
SELECT 'source=' || source AS label, line_count, word_count, file_size_bytes FROM ({_BY_SOURCE})""",
}
