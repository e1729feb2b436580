"""Text, CSV, libsvm and binary files as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas

DAY = "yyyy-MM-dd"


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def delimited(spark: SparkSession, path: str, schema: T.StructType, delimiter: str) -> DataFrame:
    """Delimited file without a header row."""
    return spark.read.schema(schema).option("delimiter", delimiter).csv(path)


def csv_with_header(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """CSV with a header row; values are trimmed so that ``"true "`` is a boolean.

    Without a schema the types are inferred, which costs one more scan.
    """
    reader = (
        spark.read.option("header", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
    )
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def dimension_file(spark: SparkSession, path: str) -> DataFrame:
    """Dimension rows with real dates; ``rejected`` marks rows lacking a required value."""
    rows = csv_with_header(spark, path, schemas.DIMENSION_FILE)
    dates = {
        name: F.try_to_date(F.trim(name), DAY)
        for name in ("effective_start_date", "effective_end_date")
    }
    required = ("customer_key", "customer_id", *dates, "is_current")
    return rows.withColumns(dates).withColumn(
        "rejected", F.greatest(*[F.col(name).isNull() for name in required])
    )


def feed_file(spark: SparkSession, path: str) -> DataFrame:
    rows = csv_with_header(spark, path, schemas.FEED_FILE)
    return rows.withColumn("source_date", F.try_to_date(F.trim("source_date"), DAY))


def transactions_with_rejects(
    spark: SparkSession, path: str, schema: T.StructType = schemas.TRANSACTION_FILE
) -> DataFrame:
    """Every row, typed; ``rejected`` marks rows whose numbers or dates do not parse.

    The columns are read as text and converted here, so the verdict covers the
    whole row also when a query uses only some columns. ``raw_record`` keeps the
    text of a rejected row.
    """
    as_text = T.StructType([T.StructField(field.name, T.StringType()) for field in schema])
    typed = {
        field.name: (F.lower(field.name) == "true")
        if isinstance(field.dataType, T.BooleanType)
        else F.col(field.name).try_cast(field.dataType)
        for field in schema
        if not isinstance(field.dataType, T.StringType)
    }
    must_parse = [name for name in typed if not isinstance(schema[name].dataType, T.BooleanType)]
    failed = reduce(or_, [typed[name].isNull() for name in must_parse], F.lit(False))
    raw = csv_with_header(spark, path, as_text)
    record = F.when(failed, F.to_csv(F.struct(*[F.col(name) for name in schema.names])))
    return raw.select(
        *[typed.get(name, F.col(name)).alias(name) for name in schema.names],
        failed.alias("rejected"),
        record.alias("raw_record"),
    )


def transactions(
    spark: SparkSession, path: str, schema: T.StructType = schemas.TRANSACTION_FILE
) -> DataFrame:
    """The well-typed transaction rows."""
    rows = transactions_with_rejects(spark, path, schema)
    return rows.filter(~F.col("rejected")).drop("rejected", "raw_record")


def libsvm(spark: SparkSession, path: str, num_features: int) -> DataFrame:
    """Labeled sparse vectors; the width is fixed so that train and test agree."""
    return spark.read.format("libsvm").option("numFeatures", num_features).load(path)


def labeled_csv(
    spark: SparkSession, path: str, feature_names: Sequence[str], label: str = "label"
) -> DataFrame:
    """CSV columns as doubles, assembled into ``label`` and ``features``."""
    fields = [T.StructField(name, T.DoubleType()) for name in (label, *feature_names)]
    rows = csv_with_header(spark, path, T.StructType(fields)).withColumnRenamed(label, "label")
    assembler = VectorAssembler(inputCols=list(feature_names), outputCol="features")
    return assembler.transform(rows).select("label", "features")


def training_data(spark: SparkSession, path: str, kind: str, **options) -> DataFrame:
    """Training rows by format name: ``libsvm``, ``csv`` or ``parquet``."""
    if kind == "libsvm":
        return libsvm(spark, path, **options)
    if kind == "csv":
        return labeled_csv(spark, path, **options)
    if kind == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unknown training data format: {kind}")


def binary_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
    )


def image_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Path and size of the images below ``path`` as Spark's own reader decodes them.

    Every image is decoded in the JVM, so the size is that of an image that can
    really be shown; what cannot be decoded has 0 x 0. ``functions.images`` reads
    sizes from headers alone, at a fraction of the price.
    """
    images = (
        spark.read.format("image")
        .option("dropInvalid", False)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(path)
    )
    return images.select(
        F.col("image.origin").alias("path"),
        F.greatest("image.width", F.lit(0)).alias("width"),
        F.greatest("image.height", F.lit(0)).alias("height"),
    )
