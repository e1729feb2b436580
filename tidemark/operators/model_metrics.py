"""Label distribution, confusion matrix and metrics as plain aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Lowest accuracy of each rating.
RATINGS = ((0.95, "EXCELLENT"), (0.90, "VERY GOOD"), (0.80, "GOOD"), (0.70, "FAIR"))
LOWEST_RATING = "NEEDS IMPROVEMENT"


def label_distribution(rows: DataFrame, label: str = "label") -> DataFrame:
    """Rows and share per label; the window runs over one row per label."""
    total = F.sum("samples").over(Window.partitionBy())
    return (
        rows.groupBy(label)
        .agg(F.count("*").alias("samples"))
        .withColumn("percentage", F.round(F.col("samples").cast("double") * 100 / total, 1))
        .orderBy(label)
    )


def confusion_matrix(
    rows: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    return (
        rows.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction"))
        .agg(F.count("*").alias("samples"))
        .orderBy("label", "prediction")
    )


def rating(accuracy: Column) -> Column:
    levels = F.when(accuracy.isNull(), None)
    for lowest, name in RATINGS:
        levels = levels.when(accuracy >= lowest, name)
    return levels.otherwise(LOWEST_RATING)


def class_metrics(confusion: DataFrame) -> DataFrame:
    """Support, precision, recall and F1 per label; the input has one row per pair."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("samples")).otherwise(0)
    by_label = confusion.groupBy("label").agg(
        F.sum("samples").alias("support"), F.sum(hit).alias("hits")
    )
    by_prediction = confusion.groupBy(F.col("prediction").alias("label")).agg(
        F.sum("samples").alias("predicted")
    )
    hits = F.col("hits").cast("double")
    joined = by_label.join(by_prediction, "label", "left").select(
        "label",
        "support",
        "hits",
        F.coalesce(hits / F.col("predicted"), F.lit(0.0)).alias("precision"),
        (hits / F.col("support")).alias("recall"),
    )
    both = F.col("precision") + F.col("recall")
    f1 = F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0)
    return joined.withColumn("f1", f1)


def classification_metrics(confusion: DataFrame) -> DataFrame:
    """Accuracy and support-weighted F1, precision and recall, with a rating."""
    support = F.col("support")

    def weighted(name: str) -> Column:
        return F.sum(F.col(name) * support) / F.sum(support)

    return (
        class_metrics(confusion)
        .agg(
            F.sum(support).alias("samples"),
            (F.sum("hits").cast("double") / F.sum(support)).alias("accuracy"),
            weighted("f1").alias("f1"),
            weighted("precision").alias("weighted_precision"),
            weighted("recall").alias("weighted_recall"),
        )
        .withColumn("rating", rating(F.col("accuracy")))
    )
