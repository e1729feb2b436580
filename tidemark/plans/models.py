"""Model selection and metric jobs on ``embeddings`` and ``labels``.

For the metrics, a document's quality is the label and its toxicity flag the
prediction; both are 0 or 1.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import model_metrics as metrics
from tidemark.operators import tree_selection as trees
from tidemark.operators.nested_search import nested_search
from tidemark.session import new_path
from tidemark.sources.files import training_data
from tidemark.sources.tables import table, table_path

WIDTH = 64
FOLDS = 3
PARALLEL_FITS = 4
HOLDOUT = 5  # every fifth vector is kept for the evaluation
#: Rules "feature above threshold means an even label", which SQL can evaluate too.
RULES = [
    (number, feature, threshold)
    for number, (feature, threshold) in enumerate(
        ((f, t) for f in (0, 1, 2, 3) for t in ("-0.1", "0.0", "0.1")), 1
    )
]


def _rounded(rows: DataFrame, *names: str) -> DataFrame:
    return rows.withColumns({name: F.round(name, 6) for name in names})


def ml_label_distribution(spark: SparkSession, folder: str) -> DataFrame:
    rows = training_data(spark, table_path(folder, "embeddings"), "parquet")
    return metrics.label_distribution(rows)


def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.confusion_matrix(table(spark, folder, "labels"), "quality", "toxic")


def class_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = metrics.class_metrics(confusion_matrix(spark, folder)).drop("hits")
    return _rounded(rows, "precision", "recall", "f1")


def classification_metrics(spark: SparkSession, folder: str) -> DataFrame:
    rows = metrics.classification_metrics(confusion_matrix(spark, folder))
    return _rounded(rows, "accuracy", "f1", "weighted_precision", "weighted_recall")


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    return trees.vector_rows(table(spark, folder, "embeddings"), "embedding", "label", "vec_id")


def libsvm_load(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings written as libsvm text and read back, summed per label."""
    path = new_path(spark, "libsvm")
    _vectors(spark, folder).select("label", "features").write.format("libsvm").save(path)
    loaded = training_data(spark, path, "libsvm", num_features=WIDTH)
    values = vector_to_array("features")
    total = F.aggregate(values, F.lit(0.0), lambda so_far, value: so_far + value)
    return loaded.groupBy("label").agg(
        F.count("*").alias("samples"),
        F.max(F.size(values)).cast("bigint").alias("width"),
        F.round(F.sum(total), 3).alias("feature_sum"),
    )


def csv_training_load(spark: SparkSession, folder: str) -> DataFrame:
    """Embeddings written as CSV columns, read with types and assembled again."""
    path = new_path(spark, "training-csv")
    names = [f"f{i}" for i in range(WIDTH)]
    columns = [F.get("embedding", F.lit(i)).cast("double").alias(name) for i, name in enumerate(names)]
    table(spark, folder, "embeddings").select("label", *columns).write.option("header", True).csv(
        path
    )
    loaded = training_data(spark, path, "csv", feature_names=names)
    values = vector_to_array("features")
    total = F.aggregate(values, F.lit(0.0), lambda so_far, value: so_far + value)
    return loaded.groupBy("label").agg(
        F.count("*").alias("samples"),
        F.round(F.sum(F.get(values, F.lit(0))), 4).alias("first_feature_sum"),
        F.round(F.sum(total), 3).alias("feature_sum"),
    )


def tree_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector's label beside the prediction of a tree that has not seen it."""
    predicted = trees.out_of_fold(_vectors(spark, folder), "vec_id")
    return predicted.select("vec_id", "label", "prediction")


def _search(spark: SparkSession, folder: str, grid=trees.QUICK_GRID) -> DataFrame:
    rows = _vectors(spark, folder)
    search = nested_search(rows, grid, FOLDS, PARALLEL_FITS, "vec_id", folds_at_once=FOLDS)
    return search.table(spark)


def cv_full_grid(spark: SparkSession, folder: str) -> DataFrame:
    """All 360 combinations with their mean accuracy, from 24 fits per fold."""
    found = _search(spark, folder, trees.FULL_GRID)
    params = found.groupBy("combination", "metric").pivot("param", list(trees.FULL_GRID))
    return params.agg(F.first("value"))


def cv_metric_stats(spark: SparkSession, folder: str) -> DataFrame:
    return trees.cv_metric_stats(_search(spark, folder))


def param_impact(spark: SparkSession, folder: str) -> DataFrame:
    return trees.param_impact(_search(spark, folder))


def tree_holdout_report(spark: SparkSession, folder: str) -> DataFrame:
    """Report of a search over the training part, its metrics from the part kept away."""
    rows = _vectors(spark, folder)
    held = F.col("vec_id") % HOLDOUT == 0
    train, test = rows.where(~held), rows.where(held)
    model = trees.train_tree_cv(train, folds=FOLDS, parallelism=PARALLEL_FITS, fold_by="vec_id")
    confusion = metrics.confusion_matrix(model.transform(test))
    return trees.model_report(model, train, test, metrics.classification_metrics(confusion))


def _rule_search(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy of every rule from one scan, in the form of a stored search."""
    even = F.col("label") % 2 == 0
    rows = table(spark, folder, "embeddings")
    accuracies = rows.agg(
        *[
            F.avg(((F.get("embedding", F.lit(f)) > float(t)) == even).cast("int")).alias(f"m{n}")
            for n, f, t in RULES
        ]
    )
    entries = [
        F.struct(
            F.lit(number).alias("combination"),
            F.lit(param).alias("param"),
            F.lit(str(value)).alias("value"),
            F.col(f"m{number}").alias("metric"),
        )
        for number, feature, threshold in RULES
        for param, value in (("feature", feature), ("threshold", threshold))
    ]
    return accuracies.select(F.inline(F.array(*entries)))


def rule_metric_stats(spark: SparkSession, folder: str) -> DataFrame:
    rows = trees.cv_metric_stats(_rule_search(spark, folder))
    return _rounded(rows, "best_metric", "worst_metric", "metric_std")


def rule_param_impact(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(trees.param_impact(_rule_search(spark, folder)), "avg_metric")


def rule_top_params(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(trees.top_params(_rule_search(spark, folder)), "metric")


QUERIES = {
    function.__name__: function
    for function in (
        ml_label_distribution,
        confusion_matrix,
        class_metrics,
        classification_metrics,
        libsvm_load,
        csv_training_load,
        tree_predictions,
        cv_metric_stats,
        cv_full_grid,
        param_impact,
        tree_holdout_report,
        rule_metric_stats,
        rule_param_impact,
        rule_top_params,
    )
}

_PER_CLASS = """
per_class AS (
  SELECT label, support, hits / support AS recall,
    CASE WHEN predicted > 0 THEN hits / predicted ELSE 0 END AS precision
  FROM (SELECT c AS label, count(*) FILTER (quality = c)::DOUBLE AS support,
          count(*) FILTER (toxic = c)::DOUBLE AS predicted,
          count(*) FILTER (quality = c AND toxic = c)::DOUBLE AS hits
        FROM labels, (SELECT DISTINCT quality AS c FROM labels) GROUP BY c)),
scored AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                 ELSE 0 END AS f1
  FROM per_class)"""

_RULE_VALUES = ", ".join(f"({n}, {f}, '{t}')" for n, f, t in RULES)
_RULE_SEARCH = f"""
rules(combination, feature, threshold) AS (VALUES {_RULE_VALUES}),
searched AS (
  SELECT combination, feature, threshold,
    avg(((embedding[feature + 1]::DOUBLE > threshold::DOUBLE) = (label % 2 = 0))::INT) AS metric
  FROM embeddings, rules GROUP BY ALL)"""

SQL = {
    "rule_metric_stats": f"""WITH {_RULE_SEARCH}
SELECT count(*) AS combinations, round(max(metric), 6) AS best_metric,
  round(min(metric), 6) AS worst_metric, round(stddev_samp(metric), 6) AS metric_std
FROM searched""",
    "rule_param_impact": f"""WITH {_RULE_SEARCH}
SELECT param, value, round(avg(metric), 6) AS avg_metric, count(*) AS runs
FROM (SELECT 'feature' AS param, feature::VARCHAR AS value, metric FROM searched
  UNION ALL SELECT 'threshold', threshold, metric FROM searched)
GROUP BY param, value""",
    "rule_top_params": f"""WITH {_RULE_SEARCH}
SELECT combination, round(metric, 6) AS metric,
  'feature=' || feature || ', threshold=' || threshold AS params
FROM searched ORDER BY searched.metric DESC, combination LIMIT 5""",
    "ml_label_distribution": """
SELECT label, count(*) AS samples,
  round(count(*)::DOUBLE * 100 / sum(count(*)) OVER (), 1) AS percentage
FROM embeddings GROUP BY label""",
    "confusion_matrix": """
SELECT quality AS label, toxic AS prediction, count(*) AS samples FROM labels GROUP BY 1, 2""",
    "class_metrics": f"""WITH {_PER_CLASS}
SELECT label, CAST(support AS BIGINT) AS support, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1
FROM scored""",
    "classification_metrics": f"""WITH {_PER_CLASS},
total AS (SELECT count(*) AS samples, avg((quality = toxic)::INT::DOUBLE) AS accuracy FROM labels)
SELECT samples, round(accuracy, 6) AS accuracy,
  round((SELECT sum(f1 * support) FROM scored) / samples, 6) AS f1,
  round((SELECT sum(precision * support) FROM scored) / samples, 6) AS weighted_precision,
  round((SELECT sum(recall * support) FROM scored) / samples, 6) AS weighted_recall,
  CASE WHEN accuracy >= 0.95 THEN 'EXCELLENT' WHEN accuracy >= 0.9 THEN 'VERY GOOD'
       WHEN accuracy >= 0.8 THEN 'GOOD' WHEN accuracy >= 0.7 THEN 'FAIR'
       ELSE 'NEEDS IMPROVEMENT' END AS rating
FROM total""",
    "libsvm_load": """
SELECT CAST(label AS DOUBLE) AS label, count(*) AS samples, CAST(64 AS BIGINT) AS width,
  round(sum(list_sum(list_transform(embedding, lambda v: v::DOUBLE))), 3) AS feature_sum
FROM embeddings GROUP BY label""",
    "csv_training_load": """
SELECT CAST(label AS DOUBLE) AS label, count(*) AS samples,
  round(sum(embedding[1]::DOUBLE), 4) AS first_feature_sum,
  round(sum(list_sum(list_transform(embedding, lambda v: v::DOUBLE))), 3) AS feature_sum
FROM embeddings GROUP BY label""",
}
