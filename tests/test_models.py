from __future__ import annotations

import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from conftest import tuples
from tidemark.operators import model_metrics as metrics
from tidemark.operators import tree_selection as trees
from tidemark.sinks.files import write_report
from tidemark.sources.files import training_data

PAIRS = [(0.0, 0.0)] * 3 + [(0.0, 1.0)] + [(1.0, 1.0)] * 2 + [(1.0, 0.0)] * 2


def rounded(row):
    return {k: round(v, 6) if isinstance(v, float) else v for k, v in row.asDict().items()}


def test_metric_fixture(spark):
    df = spark.createDataFrame(PAIRS, "label double, prediction double")
    confusion = metrics.confusion_matrix(df)
    assert tuples(confusion) == [(0.0, 0.0, 3), (0.0, 1.0, 1), (1.0, 0.0, 2), (1.0, 1.0, 2)]
    got = [rounded(r) for r in metrics.class_metrics(confusion).orderBy("label").collect()]
    assert [(r["precision"], r["recall"], r["f1"]) for r in got] == [
        (0.6, 0.75, 0.666667),
        (0.666667, 0.5, 0.571429),
    ]
    assert rounded(metrics.classification_metrics(confusion).first()) == {
        "samples": 8,
        "accuracy": 0.625,
        "f1": 0.619048,
        "weighted_precision": 0.633333,
        "weighted_recall": 0.625,
        "rating": "NEEDS IMPROVEMENT",
    }


def test_aggregation_agrees_with_the_evaluator(spark):
    """Also with a class that is never predicted and one that is only predicted."""
    rng = random.Random(3)
    rows = [(float(rng.choice([0, 1, 2, 3])), float(rng.choice([0, 1, 2, 4]))) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    got = metrics.classification_metrics(metrics.confusion_matrix(df)).first()
    for name, value in trees.evaluator_metrics(df).items():
        assert got[name] == pytest.approx(value), name


def test_ratings(spark):
    df = spark.createDataFrame([(x,) for x in (0.96, 0.95, 0.9, 0.85, 0.7, 0.1, None)], "a double")
    assert [r[0] for r in df.select(metrics.rating(F.col("a"))).collect()] == [
        "EXCELLENT",
        "EXCELLENT",
        "VERY GOOD",
        "GOOD",
        "FAIR",
        "NEEDS IMPROVEMENT",
        None,
    ]


def test_label_distribution(spark):
    df = spark.createDataFrame([(0.0,), (0.0,), (1.0,)], "label double")
    assert tuples(metrics.label_distribution(df)) == [(0.0, 2, 66.7), (1.0, 1, 33.3)]


def test_grid_sizes():
    assert trees.grid_size(trees.FULL_GRID) == 360
    assert trees.grid_size(trees.QUICK_GRID) == 4


def test_training_data_formats(spark, tmp_path):
    (tmp_path / "a.libsvm").write_text("1 1:0.5 3:2\n0 2:1\n")
    rows = training_data(spark, str(tmp_path / "a.libsvm"), "libsvm", num_features=4)
    assert tuples(rows) == [
        (0.0, Vectors.sparse(4, [1], [1.0])),
        (1.0, Vectors.sparse(4, [0, 2], [0.5, 2.0])),
    ]
    (tmp_path / "a.csv").write_text("y,f1,f2\n1,0.5,2\n0,1,0\n")
    rows = training_data(
        spark, str(tmp_path / "a.csv"), "csv", feature_names=["f1", "f2"], label="y"
    )
    assert {r["label"]: list(r["features"].toArray()) for r in rows.collect()} == {
        1.0: [0.5, 2.0],
        0.0: [1.0, 0.0],
    }
    rows.write.parquet(str(tmp_path / "a.parquet"))
    assert training_data(spark, str(tmp_path / "a.parquet"), "parquet").count() == 2
    with pytest.raises(ValueError):
        training_data(spark, "x", "xml")


@pytest.fixture(scope="module")
def samples(spark):
    rng = random.Random(11)
    rows = []
    for number in range(300):
        x, y = rng.random(), rng.random()
        rows.append((number, [x, y, float(number % 3)], int(x > 0.5) + int(y > 0.5)))
    df = spark.createDataFrame(rows, "id int, embedding array<double>, kind int")
    return trees.vector_rows(df, "embedding", "kind", "id")


@pytest.fixture(scope="module")
def searched(samples):
    return trees.train_tree_cv(
        samples, {"maxDepth": [1, 4], "minInstancesPerNode": [1, 5]}, folds=3, fold_by="id"
    )


def test_search_results(spark, samples, searched):
    table = trees.cv_table(spark, searched)
    assert table.count() == 8
    stats = trees.cv_metric_stats(table).first()
    assert stats["combinations"] == 4
    assert stats["best_metric"] == max(searched.avgMetrics)
    assert stats["worst_metric"] == min(searched.avgMetrics)
    mean = sum(searched.avgMetrics) / 4
    deviation = (sum((m - mean) ** 2 for m in searched.avgMetrics) / 3) ** 0.5
    assert stats["metric_std"] == pytest.approx(deviation)
    impact = {(r["param"], r["value"]): r for r in trees.param_impact(table).collect()}
    assert {r["runs"] for r in impact.values()} == {2}
    by_value = lambda v: [
        m
        for p, m in zip(searched.getEstimatorParamMaps(), searched.avgMetrics)
        if {k.name: x for k, x in p.items()}["maxDepth"] == v
    ]
    assert impact["maxDepth", "4"]["avg_metric"] == pytest.approx(sum(by_value(4)) / 2)
    assert trees.top_params(table, 2).count() == 2
    assert trees.top_params(table, 1).first()["metric"] == max(searched.avgMetrics)
    assert trees.best_params(spark, searched).first()["maxDepth"] == 4


def test_folds_do_not_depend_on_partitioning(spark, samples, searched):
    again = trees.train_tree_cv(
        samples.repartition(5),
        {"maxDepth": [1, 4], "minInstancesPerNode": [1, 5]},
        folds=3,
        fold_by="id",
    )
    assert again.avgMetrics == pytest.approx(searched.avgMetrics, abs=0.02)


def test_deviation_of_one_value_is_zero(spark):
    table = spark.createDataFrame(
        [(1, "p", "1", 0.5)], "combination int, param string, value string, metric double"
    )
    assert tuples(trees.cv_metric_stats(table)) == [(1, 0.5, 0.5, 0.0)]


def test_report(spark, samples, searched, tmp_path):
    predictions = searched.transform(samples)
    scores = metrics.classification_metrics(metrics.confusion_matrix(predictions))
    assert scores.first()["accuracy"] > 0.9
    report = trees.model_report(searched, samples, samples, scores)
    rows = {(r["section"], r["name"]): r["value"] for r in report.collect()}
    assert rows["data", "total_samples"] == "600"
    assert rows["best", "maxDepth"] == "4"
    assert rows["search", "combinations"] == "4"
    write_report(report, str(tmp_path / "report"))
    lines = [r[0] for r in spark.read.text(str(tmp_path / "report")).collect()]
    assert lines[0] == "data.training_samples: 300"
    assert len(lines) == len(rows)


def test_no_row_is_predicted_by_a_tree_that_saw_it(samples):
    got = {r["id"]: r["prediction"] for r in trees.out_of_fold(samples, "id", 3).collect()}
    assert len(got) == samples.count()
    fold = F.pmod(F.xxhash64("id"), F.lit(3))
    for k in range(3):
        model = trees.train_tree(samples.where(fold != k))
        for r in model.transform(samples.where(fold == k)).collect():
            assert got[r["id"]] == r["prediction"]


def test_text_labels_and_unseen_categories(spark):
    rows = [(["red", "blue"][i % 2], Vectors.dense(float(i % 2), float(i % 4))) for i in range(40)]
    df = spark.createDataFrame(rows, ["color", "features"])
    model = trees.tree_pipeline("color")[0].fit(df)
    unseen = spark.createDataFrame([("red", Vectors.dense(0.0, 9.0))], ["color", "features"])
    named = trees.with_label_names(model.transform(df.union(unseen)), model.stages[0].labels)
    assert named.filter("predicted_label <> color").count() == 0


def test_holdout_report_agrees_with_its_predictions(spark):
    """Sizes follow the split; the metrics are those of the evaluator on the rows kept away."""
    rng = random.Random(5)
    rows = []
    for vec_id in range(200):
        label = rng.choice([0.0, 1.0])
        rows.append((vec_id, label, Vectors.dense([label + rng.random() * 1.2, rng.random()])))
    df = spark.createDataFrame(rows, ["vec_id", "label", "features"])
    held = F.col("vec_id") % 5 == 0
    train, test = df.where(~held), df.where(held)
    model = trees.train_tree_cv(train, {"maxDepth": [1, 2]}, folds=2, fold_by="vec_id")
    predicted = model.transform(test)
    confusion = metrics.confusion_matrix(predicted)
    counts = {}
    for r in predicted.select("label", "prediction").collect():
        counts[tuple(r)] = counts.get(tuple(r), 0) + 1
    assert {(r[0], r[1]): r[2] for r in confusion.collect()} == counts
    report = trees.model_report(model, train, test, metrics.classification_metrics(confusion))
    values = {(r["section"], r["name"]): r["value"] for r in report.collect()}
    assert values["data", "training_samples"] == "160"
    assert values["data", "test_samples"] == "40"
    for name, value in trees.evaluator_metrics(predicted).items():
        assert float(values["metrics", name]) == pytest.approx(value), name
