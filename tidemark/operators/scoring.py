"""Distributed model scoring and the catalog of binary assets."""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import objects
from tidemark.sources.files import binary_files

#: Fixed values of the result: batch size, and what stands for no prediction.
MINI_BATCH = 64
NO_PREDICTION = ("unknown", "unknown", 0.0)


class Model(Protocol):
    def logits(self, batch: np.ndarray) -> np.ndarray:
        """One row of class scores per input row."""


class LinearModel:
    """Scores are weighted sums of the features."""

    def __init__(self, weights: np.ndarray):
        self.weights = np.asarray(weights, dtype=np.float64)

    def logits(self, batch: np.ndarray) -> np.ndarray:
        return batch @ self.weights.T


MOST_MODELS = 4
# The models last used in a Python worker, by id and version.
_loaded: OrderedDict[tuple[str, str], Model] = OrderedDict()


def cached_model(model_id: str, load: Callable[[str], Model], version: str = "") -> Model:
    """The model of an id and version; a new version is loaded anew."""
    key = (model_id, version)
    if key not in _loaded:
        _loaded[key] = load(model_id)
        if len(_loaded) > MOST_MODELS:
            _loaded.popitem(last=False)
    _loaded.move_to_end(key)
    return _loaded[key]


def loader_version(load: Callable[[str], Model]) -> str:
    """A hash of the loader as Spark would ship it, with all it refers to by value."""
    return hashlib.sha256(cloudpickle.dumps(load)).hexdigest()


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _stacked(payloads: pd.Series) -> np.ndarray | None:
    """All rows as one matrix; None when some row is missing or of another length."""
    try:
        matrix = np.stack(payloads.to_numpy()).astype(np.float64)
    except (TypeError, ValueError):
        return None
    return matrix if matrix.ndim == 2 and np.isfinite(matrix).all() else None


def _decoded(
    payloads: pd.Series, decode: Callable[[Any], np.ndarray]
) -> tuple[np.ndarray, list[np.ndarray]]:
    """Places and vectors of the rows that can be decoded."""
    places, vectors = [], []
    for place, value in enumerate(payloads):
        try:
            vector = np.asarray(decode(value), dtype=np.float64)
        except Exception:  # any unreadable payload is scored as unknown
            continue
        if vector.ndim == 1 and np.isfinite(vector).all():
            places.append(place)
            vectors.append(vector)
    return np.array(places, dtype=int), vectors


def _predict(
    payloads: pd.Series,
    model: Model,
    classes: Sequence[str],
    decode: Callable[[Any], np.ndarray] | None,
    mini_batch: int,
) -> pd.DataFrame:
    matrix = _stacked(payloads) if decode is None else None
    if matrix is not None:
        places, vectors = np.arange(len(matrix)), matrix
    else:
        places, vectors = _decoded(payloads, decode or np.asarray)
    names, descriptions, scores = (
        np.full(len(payloads), value, dtype=object) for value in NO_PREDICTION
    )
    for first in range(0, len(places), mini_batch):
        batch = slice(first, first + mini_batch)
        probability = softmax(model.logits(np.stack(vectors[batch])))
        best = probability.argmax(axis=1)
        known = np.array(
            [*classes, *(f"class_{i}" for i in range(len(classes), probability.shape[1]))],
            dtype=object,
        )
        names[places[batch]] = best.astype(str)
        descriptions[places[batch]] = known[best]
        scores[places[batch]] = probability.max(axis=1)
    return pd.DataFrame(
        {"class": names, "desc": descriptions, "score": scores.astype(np.float64)}
    )


def top1_udf(
    model_id: str,
    load: Callable[[str], Model],
    classes: Sequence[str],
    decode: Callable[[Any], np.ndarray] | None = None,
    mini_batch: int = MINI_BATCH,
    version: str | None = None,
) -> Callable[[Column], Column]:
    """Column function giving the most likely class as ``(class, desc, score)``.

    ``load`` runs once per Python worker for each id and ``version``, which is a
    hash of ``load`` unless given; let it read large weights from a file
    that Spark ships. ``decode`` turns one payload into a feature vector; without
    it the column holds the vectors. Rows that cannot be decoded are ``unknown``
    with score 0. The model sees ``mini_batch`` rows at a time.
    """

    loaded_version = loader_version(load) if version is None else version

    @F.pandas_udf(schemas.PREDICTION)
    def top1(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = cached_model(model_id, load, loaded_version)
        for payloads in batches:
            yield _predict(payloads, model, classes, decode, mini_batch)

    # Keeps later filters on the prediction from scoring the rows again.
    return top1.asNondeterministic()


def dims_udf(size_of: Callable[[bytes], tuple[int, int]]) -> Callable[[Column], Column]:
    """Column function giving an image's size; 0 x 0 where ``size_of`` fails."""

    def size_or_zero(content: bytes) -> tuple[int, int]:
        try:
            return size_of(content)
        except Exception:  # unreadable content has no size
            return (0, 0)

    @F.pandas_udf("width int, height int")
    def dims(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for contents in batches:
            sizes = [size_or_zero(content) for content in contents]
            yield pd.DataFrame(sizes, columns=["width", "height"])

    return dims


def asset_catalog(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Files below ``path`` with their label; contents are not read."""
    return binary_files(spark, path, pattern).select(
        "path",
        objects.file_name(F.col("path")).alias("file_name"),
        objects.path_label(F.col("path")).alias("label"),
        "length",
        "modificationTime",
    )


def asset_label_counts(catalog: DataFrame) -> DataFrame:
    return catalog.groupBy("label").agg(F.count("*").alias("assets")).orderBy("label")


def prediction_table(
    scored: DataFrame, prediction: str = "prediction", processed_at: Column | None = None
) -> DataFrame:
    """The six columns of the result table."""
    return scored.select(
        F.col("path").alias("image_path"),
        "label",
        F.col(f"{prediction}.class").alias("predicted_class"),
        F.col(f"{prediction}.desc").alias("predicted_description"),
        F.col(f"{prediction}.score").alias("confidence"),
        (F.current_timestamp() if processed_at is None else processed_at).alias("processed_at"),
    )


def latest_predictions(results: DataFrame, top: int = 5) -> DataFrame:
    return results.orderBy(F.desc("processed_at"), "image_path").limit(top)
