"""Decision tree with a parameter grid and k-fold cross-validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from math import prod

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import IndexToString, StringIndexer, VectorIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SEED = 42
MAX_CATEGORIES = 10
# The full and the quick parameter grid.
FULL_GRID = {
    "maxDepth": [3, 5, 7, 10, 15],
    "minInstancesPerNode": [1, 5, 10, 20],
    "minInfoGain": [0.0, 0.01, 0.05],
    "impurity": ["gini", "entropy"],
    "maxBins": [16, 32, 64],
}
QUICK_GRID = {"maxDepth": [3, 5], "minInstancesPerNode": [5, 10]}
METRICS = {
    "accuracy": "accuracy",
    "f1": "f1",
    "weighted_precision": "weightedPrecision",
    "weighted_recall": "weightedRecall",
}


def grid_size(grid: Mapping[str, Sequence]) -> int:
    return prod(len(values) for values in grid.values())


def vector_rows(rows: DataFrame, embedding: str, label: str, *keep: str) -> DataFrame:
    """Array column as the labeled vectors that the learner takes."""
    return rows.select(
        *keep,
        F.col(label).cast("double").alias("label"),
        array_to_vector(F.col(embedding).cast("array<double>")).alias("features"),
    )


def tree_pipeline(label_text: str | None = None) -> tuple[Pipeline, DecisionTreeClassifier]:
    """Feature indexer and tree; ``label_text`` names a string label to index.

    Categories that a fold has not seen get a bin of their own.
    """
    indexer = VectorIndexer(
        inputCol="features",
        outputCol="indexedFeatures",
        maxCategories=MAX_CATEGORIES,
        handleInvalid="keep",
    )
    tree = DecisionTreeClassifier(labelCol="label", featuresCol="indexedFeatures", seed=SEED)
    stages = [indexer, tree]
    if label_text:
        stages.insert(0, StringIndexer(inputCol=label_text, outputCol="label"))
    return Pipeline(stages=stages), tree


def with_label_names(predictions: DataFrame, names: Sequence[str]) -> DataFrame:
    """Adds the text of the predicted label, for a model on indexed labels."""
    back = IndexToString(inputCol="prediction", outputCol="predicted_label", labels=list(names))
    return back.transform(predictions)


def train_tree(train: DataFrame) -> PipelineModel:
    return tree_pipeline()[0].fit(train)


def train_tree_cv(
    train: DataFrame,
    grid: Mapping[str, Sequence] = QUICK_GRID,
    folds: int = 5,
    parallelism: int = 2,
    fold_by: str | None = None,
) -> CrossValidatorModel:
    """Best tree of the grid by mean accuracy over the folds.

    With ``fold_by`` a row's fold follows from that column's hash, so a rebuilt
    partition puts its rows into the same folds again.
    """
    pipeline, tree = tree_pipeline()
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(tree.getParam(name), list(values))
    validator = CrossValidator(
        estimator=pipeline,
        estimatorParamMaps=builder.build(),
        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
        numFolds=folds,
        parallelism=parallelism,
        seed=SEED,
        collectSubModels=False,
    )
    if fold_by:
        train = train.withColumn("fold", F.pmod(F.xxhash64(fold_by), F.lit(folds)).cast("int"))
        validator = validator.setFoldCol("fold")
    train.persist()
    try:
        return validator.fit(train)
    finally:
        train.unpersist()


def out_of_fold(train: DataFrame, fold_by: str, folds: int = 2) -> DataFrame:
    """Predictions of every row by a tree that was trained on the other folds.

    A row's fold follows from the hash of ``fold_by``, as in the search.
    """
    fold = F.pmod(F.xxhash64(fold_by), F.lit(folds)).cast("int")
    predicted = None
    for k in range(folds):
        model = train_tree(train.where(fold != k))
        part = model.transform(train.where(fold == k))
        predicted = part if predicted is None else predicted.unionByName(part)
    return predicted


def cv_table(spark: SparkSession, model: CrossValidatorModel) -> DataFrame:
    """One row per combination and parameter: ``(combination, param, value, metric)``.

    The driver holds these few numbers anyway, as the search runs there.
    """
    rows = [
        (number, param.name, str(value), float(metric))
        for number, (params, metric) in enumerate(
            zip(model.getEstimatorParamMaps(), model.avgMetrics), 1
        )
        for param, value in params.items()
    ]
    return spark.createDataFrame(rows, "combination int, param string, value string, metric double")


def _combinations(table: DataFrame) -> DataFrame:
    return table.groupBy("combination").agg(
        F.first("metric").alias("metric"),
        F.array_join(
            F.array_sort(F.collect_list(F.concat_ws("=", "param", "value"))), ", "
        ).alias("params"),
    )


def cv_metric_stats(table: DataFrame) -> DataFrame:
    """Best, worst and sample deviation (0 for one value) over the combinations."""
    return _combinations(table).agg(
        F.count("*").alias("combinations"),
        F.max("metric").alias("best_metric"),
        F.min("metric").alias("worst_metric"),
        F.coalesce(F.stddev_samp("metric"), F.lit(0.0)).alias("metric_std"),
    )


def top_params(table: DataFrame, top: int = 5) -> DataFrame:
    return _combinations(table).orderBy(F.desc("metric"), "combination").limit(top)


def param_impact(table: DataFrame) -> DataFrame:
    """Mean metric of all combinations that share a parameter value."""
    return (
        table.groupBy("param", "value")
        .agg(F.avg("metric").alias("avg_metric"), F.count("*").alias("runs"))
        .orderBy("param", "value")
    )


def best_params(spark: SparkSession, model: CrossValidatorModel) -> DataFrame:
    """Parameters of the winning tree as one row."""
    tree = model.bestModel.stages[-1]
    row = tuple(tree.getOrDefault(name) for name in FULL_GRID)
    return spark.createDataFrame(
        [row],
        "maxDepth int, minInstancesPerNode int, minInfoGain double, impurity string, maxBins int",
    )


def evaluator_metrics(predictions: DataFrame) -> dict[str, float]:
    """The four metrics by MLlib's evaluator."""
    return {
        name: MulticlassClassificationEvaluator(metricName=metric).evaluate(predictions)
        for name, metric in METRICS.items()
    }


def model_report(
    model: CrossValidatorModel, train: DataFrame, test: DataFrame, metrics: DataFrame
) -> DataFrame:
    """Report rows ``(position, section, name, value)``: sizes, parameters, metrics, search."""
    spark = train.sparkSession
    sizes = train.select(F.lit("train").alias("part")).unionAll(
        test.select(F.lit("test").alias("part"))
    )
    sections = (
        (
            "data",
            sizes.agg(
                F.count_if(F.col("part") == "train").alias("training_samples"),
                F.count_if(F.col("part") == "test").alias("test_samples"),
                F.count("*").alias("total_samples"),
            ),
        ),
        ("best", best_params(spark, model)),
        ("metrics", metrics),
        ("search", cv_metric_stats(cv_table(spark, model))),
    )
    report = None
    for number, (section, one_row) in enumerate(sections):
        pairs = [
            F.struct(
                F.lit(100 * number + place).alias("position"),
                F.lit(section).alias("section"),
                F.lit(name).alias("name"),
                F.col(name).cast("string").alias("value"),
            )
            for place, name in enumerate(one_row.columns)
        ]
        rows = one_row.select(F.inline(F.array(*pairs)))
        report = rows if report is None else report.unionByName(rows)
    return report.orderBy("position")
