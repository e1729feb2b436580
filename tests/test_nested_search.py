from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from conftest import tuples
from tidemark.operators import nested_search as nested
from tidemark.operators import tree_selection as trees


@pytest.fixture(scope="module")
def noisy(spark):
    """Labels that follow the vector only in part, so that deep trees grow and gains get small."""
    rng = random.Random(23)
    rows = []
    for number in range(400):
        x, y, z = rng.random(), rng.random(), float(rng.randrange(4))
        label = int(x > 0.5) + int(y > 0.3) if rng.random() < 0.8 else rng.randrange(3)
        rows.append((number, [x, y, z, rng.gauss(0, 1)], label))
    df = spark.createDataFrame(rows, "id int, embedding array<double>, kind int")
    return trees.vector_rows(df, "embedding", "kind", "id")


def by_crossvalidator(rows, grid, folds):
    model = trees.train_tree_cv(rows, grid, folds=folds, parallelism=4, fold_by="id")
    params = [{p.name: v for p, v in m.items()} for m in model.getEstimatorParamMaps()]
    return model, params


@pytest.mark.parametrize(
    "grid",
    [
        trees.QUICK_GRID,
        {"maxDepth": [1, 2, 6], "minInfoGain": [0.0, 0.01, 0.05], "impurity": ["gini", "entropy"]},
        {"minInstancesPerNode": [1, 20], "maxBins": [8, 32]},
        {"minInfoGain": [0.02, 0.3]},
    ],
)
def test_equal_to_crossvalidator(spark, noisy, grid):
    model, params = by_crossvalidator(noisy, grid, 3)
    search = nested.nested_search(noisy, grid, folds=3, fold_by="id", folds_at_once=2)
    assert search.combinations == params
    assert search.metrics == pytest.approx(model.avgMetrics, abs=1e-12)
    assert tuples(trees.cv_metric_stats(search.table(spark))) == [
        pytest.approx(row) for row in tuples(trees.cv_metric_stats(trees.cv_table(spark, model)))
    ]
    best = search.best
    tree = model.bestModel.stages[-1]
    assert {name: tree.getOrDefault(name) for name in grid} == best
    own = search.fit_best(noisy).stages[-1]
    assert own.toDebugString.split("\n", 1)[1] == tree.toDebugString.split("\n", 1)[1]


def test_full_grid_takes_a_fit_for_each_of_24(spark, noisy, monkeypatch):
    fits = []
    monkeypatch.setattr(nested, "_fold_accuracies", lambda train, test, f, c, *_: fits.extend(f) or [
        [float(len(c))] * len(c) for _ in f
    ])
    search = nested.nested_search(noisy, trees.FULL_GRID, folds=1, fold_by="id")
    assert len(fits) == 24 and len(search.metrics) == 360 and set(search.metrics) == {15.0}


def test_tasks_of_a_fit_do_not_follow_the_files(spark, noisy, monkeypatch):
    """A task sends statistics of all nodes, so tasks without rows to speak of only add to them."""
    seen = []
    fit = trees.DecisionTreeClassifier._fit
    monkeypatch.setattr(
        trees.DecisionTreeClassifier,
        "_fit",
        lambda self, rows: seen.append(rows.rdd.getNumPartitions()) or fit(self, rows),
    )
    grid = {"maxDepth": [2, 6], "impurity": ["gini", "entropy"]}
    cut = nested.nested_search(noisy.repartition(40), grid, 2, fold_by="id", folds_at_once=2)
    assert seen == [1] * 4
    assert cut == nested.nested_search(noisy, grid, 2, fold_by="id", folds_at_once=2)
    assert nested.tree_tasks(400_000, 12, 12) == 2 and nested.tree_tasks(1_000_000, 12, 12) == 4
    assert nested.tree_tasks(400, 12, 4) == 3 and nested.tree_tasks(0, 4, 12) == 1


def test_nodes_of_a_saved_tree_in_sql(spark, noisy, tmp_path):
    """Children share out their parent's rows, and gains are the falls in impurity."""
    pipeline, tree = trees.tree_pipeline()
    tree.setMaxDepth(8)
    model = pipeline.fit(noisy)
    nested.save_nodes(model.stages[-1], str(tmp_path / "0"))
    nodes = spark.read.parquet(str(tmp_path / "0/data"))
    nodes.createOrReplaceTempView("nodes")
    wrong = spark.sql("""
        SELECT p.id FROM nodes p JOIN nodes l ON p.leftChild = l.id JOIN nodes r ON p.rightChild = r.id
        WHERE p.rawCount <> l.rawCount + r.rawCount
          OR abs(p.gain - (p.impurity - (l.rawCount * l.impurity + r.rawCount * r.impurity)
                                        / p.rawCount)) > 1e-9
          OR l.id <> p.id + 1 OR r.id <= l.id""")
    assert wrong.count() == 0
    table = nested.node_table(spark, str(tmp_path), 1)
    assert table.where("tree = 0").count() == model.stages[-1].numNodes
    assert nodes.where("leftChild < 0").agg(F.sum("rawCount")).first()[0] == 400


def test_cuts_of_a_hand_made_tree():
    node = nested.Node
    nodes = {0: node(0.0, 0.5, 1, 4), 1: node(1.0, 0.1, 2, 3), 2: node(1.0, -1.0, -1, -1),
             3: node(2.0, -1.0, -1, -1), 4: node(0.0, -1.0, -1, -1)}
    paths = nested.leaf_paths(nodes)
    assert [[n.prediction for n in p] for p in paths] == [[0, 1, 1], [0, 1, 2], [0, 0]]
    counts = {(0, 1.0): 3, (1, 2.0): 2, (1, 1.0): 1, (2, 0.0): 4}
    cuts = [(0, 0.0), (1, 0.0), (2, 0.0), (9, 0.0), (9, 0.2), (9, 0.6)]
    assert nested.cut_accuracies(paths, counts, cuts) == [0.4, 0.8, 0.9, 0.9, 0.8, 0.4]


def test_a_fold_without_rows_is_told(spark, noisy):
    with pytest.raises(ValueError, match="fold"):
        nested.nested_search(noisy.where("id < 3"), {"maxDepth": [1]}, folds=40, fold_by="id")
