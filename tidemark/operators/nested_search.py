"""Grid search over decision trees in which shallower trees are cuts of deeper ones.

A tree is grown node by node, and what happens above a node does not depend on
how deep the tree may get. A tree of less depth is therefore the deepest tree
cut at that depth. A higher least gain likewise turns into leaves the nodes
whose best split gains less, and all below them. So one fit serves every depth
and least gain of the grid; the other parameters need fits of their own.

Every task of a fit sends the statistics of all nodes, features and bins of a
level, whatever few rows it has. A fold's rows therefore lie in few partitions:
as many as bound a task's rows, or as the fits at a time leave cores without
work. That number, not that of the input's files, sets what a fit shuffles.

The fitted trees are read back from MLlib's saved form, one row per node. The
rows of a fold pass once through all its trees, which count labels per leaf;
every cut's accuracy follows from these counts and the nodes above the leaves.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.tree_selection import QUICK_GRID, tree_pipeline
from tidemark.session import new_path

DEPTH, GAIN = "maxDepth", "minInfoGain"
ROWS_PER_TASK = 250_000  # 128 MB of 64 features
_FOLD = "search_fold"
_NODE = "id int, prediction double, gain double, leftChild int, rightChild int, rawCount long"


@dataclass(frozen=True)
class Node:
    prediction: float
    gain: float
    left: int
    right: int


def save_nodes(model: DecisionTreeClassificationModel, path: str) -> None:
    model.write().save(path)


def node_table(spark: SparkSession, folder: str, trees: int) -> DataFrame:
    """Nodes of the trees saved in the folders 0 to ``trees`` - 1, with the number of their tree.

    Ids follow the order of the first visit; leaves have children -1.
    """
    rows = spark.read.schema(_NODE).parquet(*(f"{folder}/{k}/data" for k in range(trees)))
    number = F.regexp_extract("_metadata.file_path", r"/(\d+)/data/[^/]+$", 1)
    return rows.select(number.cast("int").alias("tree"), "*")


def leaf_paths(nodes: Mapping[int, Node]) -> list[list[Node]]:
    """Nodes from the root to each leaf, in the order in which MLlib numbers leaves."""
    paths: list[list[Node]] = []
    waiting = [(0, [])]
    while waiting:
        number, above = waiting.pop()
        path = [*above, nodes[number]]
        if nodes[number].left < 0:
            paths.append(path)
        else:
            waiting += [(nodes[number].right, path), (nodes[number].left, path)]
    return paths


def cut_prediction(path: Sequence[Node], depth: int, gain: float) -> float:
    """What a row at the end of the path is predicted by the tree cut at depth and gain."""
    for node in path[:depth]:
        if node.left < 0 or node.gain < gain:
            return node.prediction
    return path[min(depth, len(path) - 1)].prediction


def cut_accuracies(
    paths: Sequence[Sequence[Node]],
    counts: Mapping[tuple[int, float], int],
    cuts: Sequence[tuple[int, float]],
) -> list[float]:
    """Accuracy of each cut, from the number of rows per (leaf, label)."""
    total = sum(counts.values())
    out = []
    for depth, gain in cuts:
        predicted = [cut_prediction(path, depth, gain) for path in paths]
        hits = sum(n for (leaf, label), n in counts.items() if predicted[leaf] == label)
        out.append(hits / total)
    return out


def tree_tasks(rows: int, cores: int, fits_at_once: int) -> int:
    """Tasks of one fit: enough for its rows, and for the cores together with the other fits."""
    return max(1, math.ceil(rows / ROWS_PER_TASK), math.ceil(cores / fits_at_once))


def _fold_accuracies(
    train: DataFrame,
    test: DataFrame,
    fits: list[dict],
    cuts: list,
    parallelism: int,
    folder: str,
    folds_at_once: int = 1,
) -> list[list[float]]:
    """Accuracies of every cut for each fit on one fold."""
    spark = train.sparkSession
    pipeline, tree = tree_pipeline()
    indexer = pipeline.getStages()[0].fit(train)
    at_once = min(parallelism, len(fits)) * folds_at_once
    tasks = tree_tasks(train.count(), spark.sparkContext.defaultParallelism, at_once)
    # Trees read their rows many times over.
    train = indexer.transform(train).select("label", tree.getFeaturesCol()).coalesce(tasks)
    train.persist()
    depth, gain = max(d for d, _ in cuts), min(g for _, g in cuts)

    def fit(number: int) -> DecisionTreeClassificationModel:
        own = {tree.getParam(name): value for name, value in fits[number].items()}
        own |= {tree.getParam(DEPTH): depth, tree.getParam(GAIN): gain}
        model = tree.fit(train, own)
        save_nodes(model, f"{folder}/{number}")
        return model

    pool = ThreadPool(min(parallelism, len(fits)))
    try:
        models = pool.map(inheritable_thread_target(spark)(fit), range(len(fits)), chunksize=1)
    finally:
        pool.close()
        train.unpersist()
    rows = indexer.transform(test)
    for number, model in enumerate(models):
        model.setLeafCol(f"leaf{number}").setPredictionCol("").setProbabilityCol("")
        rows = model.setRawPredictionCol("").transform(rows)
    leaves = F.array(*(F.col(f"leaf{number}").cast("int") for number in range(len(models))))
    # A row per (fit, leaf, label) at most, summed in the tasks first.
    held = rows.select("label", F.posexplode(leaves).alias("fit", "leaf"))
    counts: list[dict] = [{} for _ in fits]
    for r in held.groupBy("fit", "leaf", "label").count().collect():
        counts[r["fit"]][r["leaf"], r["label"]] = r["count"]
    if not counts[0]:
        raise ValueError("a fold has no rows; use fewer folds or another column to fold by")
    # As many rows as the fitted trees have nodes, which the driver held before.
    nodes: list[dict[int, Node]] = [{} for _ in fits]
    for r in node_table(spark, folder, len(fits)).collect():
        nodes[r["tree"]][r["id"]] = Node(
            r["prediction"], r["gain"], r["leftChild"], r["rightChild"]
        )
    return [cut_accuracies(leaf_paths(n), c, cuts) for n, c in zip(nodes, counts)]


@dataclass(frozen=True)
class Search:
    """Mean accuracies of all combinations, in the order of the grid."""

    combinations: list[dict]
    metrics: list[float]

    @property
    def best(self) -> dict:
        return self.combinations[self.metrics.index(max(self.metrics))]

    def table(self, spark: SparkSession) -> DataFrame:
        """``(combination, param, value, metric)``, as ``tree_selection.cv_table`` has it."""
        rows = [
            (number, name, str(value), float(metric))
            for number, (params, metric) in enumerate(zip(self.combinations, self.metrics), 1)
            for name, value in params.items()
        ]
        return spark.createDataFrame(
            rows, "combination int, param string, value string, metric double"
        )

    def fit_best(self, train: DataFrame) -> PipelineModel:
        """The best combination's tree on all rows."""
        pipeline, tree = tree_pipeline()
        return pipeline.fit(train, {tree.getParam(k): v for k, v in self.best.items()})


def nested_search(
    train: DataFrame,
    grid: Mapping[str, Sequence] = QUICK_GRID,
    folds: int = 5,
    parallelism: int = 4,
    fold_by: str = "id",
    folds_at_once: int = 1,
) -> Search:
    """Mean accuracy over the folds of every combination of the grid.

    Equal to ``tree_selection.train_tree_cv`` with the same column to fold by,
    at one fit per fold for all depths and least gains together. NULLs in that
    column fall into one fold. Each of ``folds_at_once`` keeps its training rows
    in memory or on disk, and grows up to ``parallelism`` trees at a time.
    """
    pipeline, tree = tree_pipeline()
    depths = list(grid.get(DEPTH, [tree.getOrDefault(DEPTH)]))
    least = list(grid.get(GAIN, [tree.getOrDefault(GAIN)]))
    cuts = list(product(depths, least))
    others = {name: values for name, values in grid.items() if name not in (DEPTH, GAIN)}
    fits = [dict(zip(others, values)) for values in product(*others.values())]
    fold = F.pmod(F.xxhash64(fold_by), F.lit(folds)).cast("int")
    rows = train.select("label", "features", fold.alias(_FOLD)).persist()
    spark = train.sparkSession
    folder = new_path(spark, "trees")  # here, as threads do not know the staging block

    def accuracies(k: int) -> list[list[float]]:
        part = F.col(_FOLD) == k
        return _fold_accuracies(
            rows.where(~part),
            rows.where(part),
            fits,
            cuts,
            parallelism,
            f"{folder}/{k}",
            min(folds_at_once, folds),
        )

    pool = ThreadPool(folds_at_once)
    try:
        found = pool.map(inheritable_thread_target(spark)(accuracies), range(folds), chunksize=1)
    finally:
        pool.close()
        rows.unpersist()
    combinations = [dict(zip(grid, values)) for values in product(*grid.values())]
    metrics = []
    for params in combinations:
        own = {name: value for name, value in params.items() if name in others}
        cut = params.get(DEPTH, depths[0]), params.get(GAIN, least[0])
        fit, place = fits.index(own), cuts.index(cut)
        metrics.append(sum(of_fold[fit][place] for of_fold in found) / folds)
    return Search(combinations, metrics)
