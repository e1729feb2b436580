from __future__ import annotations

import base64
import json
import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import functions as F

from conftest import tuples
from tidemark import schemas
from tidemark.functions.scores import top1_of
from tidemark.operators import scoring
from tidemark.sinks import streams as sinks
from tidemark.sources import streams as sources
from tidemark.streaming import assets

# Workers cannot import a test module, so its functions travel with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CLASSES = ("even", "odd")


def parity_model(model_id):
    """Weights that tell the second feature from the first."""
    return scoring.LinearModel(np.array([[1.0, 0.0], [0.0, 1.0]]))


def decode_bytes(content):
    """First two bytes as features; anything shorter is unreadable."""
    return np.array([content[0], content[1]], dtype=float)


def size_of(content):
    return content[0], content[1]


def top1():
    return scoring.top1_udf("parity", parity_model, CLASSES, decode_bytes)


def softmax_of(a, b):
    return float(np.exp(max(a, b)) / (np.exp(a) + np.exp(b)))


def test_top1_over_many_mini_batches(spark):
    rows = [(i, [float(i % 3), float(i % 5)]) for i in range(500)]
    df = spark.createDataFrame(rows, "id int, v array<double>")
    udf = scoring.top1_udf("parity", parity_model, CLASSES)
    got = df.select("id", udf(F.col("v")).alias("p")).select("id", "p.*").collect()
    assert len(got) == 500
    for row in got:
        a, b = rows[row["id"]][1]
        assert row["class"] == str(int(b > a))
        assert row["desc"] == CLASSES[int(b > a)]
        assert abs(row["score"] - softmax_of(a, b)) < 1e-6


def test_unreadable_payloads_are_unknown(spark):
    df = spark.createDataFrame([(1, b"\x01\x02"), (2, b"\x01"), (3, None)], "id int, c binary")
    got = df.select("id", top1()(F.col("c")).alias("p")).select("id", "p.class", "p.score")
    assert [(i, c, round(s, 4)) for i, c, s in tuples(got)] == [
        (1, "1", 0.7311),
        (2, "unknown", 0.0),
        (3, "unknown", 0.0),
    ]


def test_ragged_and_missing_vectors(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [2.0, 1.0]), (4, [float("nan"), 1.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>").coalesce(1)
    udf = scoring.top1_udf("parity", parity_model, CLASSES, mini_batch=1)
    got = df.select("id", udf(F.col("v")).alias("p")).select("id", "p.desc")
    assert tuples(got) == [(1, "odd"), (2, "unknown"), (3, "even"), (4, "unknown")]


def test_top1_of_probabilities(spark):
    df = spark.createDataFrame([([0.2, 0.7, 0.1],), ([0.4, 0.4, 0.2],), ([0.1, 0.1, 0.8],)], "p array<double>")
    got = [tuple(r[0]) for r in df.select(top1_of(F.col("p"), CLASSES)).collect()]
    assert [(c, d, round(s, 4)) for c, d, s in got] == [
        ("1", "odd", 0.7),
        ("0", "even", 0.4),
        ("2", "class_2", 0.8),
    ]


def test_class_without_a_name(spark):
    df = spark.createDataFrame([([0.0, 1.0],)], "v array<double>")
    udf = scoring.top1_udf("parity-short", parity_model, CLASSES[:1])
    assert df.select(udf(F.col("v")).alias("p")).first()["p"]["desc"] == "class_1"


def test_models_are_loaded_once_per_id():
    calls = []

    def load(model_id):
        calls.append(model_id)
        return parity_model(model_id)

    first = scoring.cached_model("cache-a", load)
    assert scoring.cached_model("cache-a", load) is first
    assert scoring.cached_model("cache-b", load) is not first
    assert calls == ["cache-a", "cache-b"]
    newer = scoring.cached_model("cache-a", load, "2")
    assert newer is not first and scoring.cached_model("cache-a", load, "2") is newer
    for number in range(10):
        scoring.cached_model(f"many-{number}", load)
    assert len(scoring._loaded) == scoring.MOST_MODELS
    assert scoring.loader_version(lambda _: 1) != scoring.loader_version(lambda _: 2)


def write_assets(root):
    for label, name, content in (
        ("roses", "1.jpg", b"\x01\x02"),
        ("roses", "2.jpg", b"\x03\x01"),
        ("tulips", "3.jpg", b"\x05"),
    ):
        folder = root / "flower_photos" / label
        folder.mkdir(parents=True, exist_ok=True)
        (folder / name).write_bytes(content)
    (root / "flower_photos" / "notes.txt").write_text("no image")


def test_catalog_and_sizes(spark, tmp_path):
    write_assets(tmp_path)
    catalog = scoring.asset_catalog(spark, str(tmp_path), "*.jpg")
    assert tuples(catalog, "file_name", "label", "length") == [
        ("1.jpg", "roses", 2),
        ("2.jpg", "roses", 2),
        ("3.jpg", "tulips", 1),
    ]
    assert tuples(scoring.asset_label_counts(catalog)) == [("roses", 2), ("tulips", 1)]
    df = spark.createDataFrame([(1, b"\x07\x09"), (2, b"")], "id int, c binary")
    dims = df.select("id", scoring.dims_udf(size_of)(F.col("c")).alias("size"))
    assert tuples(dims, "id", "size.width", "size.height") == [(1, 7, 9), (2, 0, 0)]


def test_stream_of_files_is_scored_once_and_fanned_out(spark, tmp_path):
    write_assets(tmp_path / "in")
    stream = sources.binary_file_stream(spark, str(tmp_path / "in"))
    files = assets.labeled_files(stream, scoring.dims_udf(size_of))
    target = str(tmp_path / "out")
    assets.score_stream(files, top1(), target, str(tmp_path / "ck")).awaitTermination()
    results = spark.read.parquet(f"{target}/predictions").drop("batch_id")
    assert results.schema.names == schemas.PREDICTION_TABLE.names
    assert [f.dataType for f in results.schema] == [f.dataType for f in schemas.PREDICTION_TABLE]
    assert tuples(results, "label", "predicted_class", "predicted_description") == [
        ("roses", "0", "even"),
        ("roses", "1", "odd"),
        ("tulips", "unknown", "unknown"),
    ]
    assert spark.read.parquet(f"{target}/class_counts").count() == 3
    latest = scoring.latest_predictions(results, top=2)
    assert latest.count() == 2


def test_image_messages(spark, tmp_path):
    payloads = {"a": base64.b64encode(b"\x01\x02").decode(), "b": "not base64!"}
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "m.json").write_text(
        "\n".join(
            json.dumps({"key": k, "value": json.dumps({"path": k, "label": "x", "image_data": v})})
            for k, v in payloads.items()
        )
    )
    raw = sources.message_stream(spark, "file", path=str(folder))
    scored = assets.scored(assets.image_messages(raw), top1())
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    sinks.to_files(scored, out, ck).awaitTermination()
    rows = spark.read.schema(schemas.PREDICTION_TABLE).json(out)
    assert tuples(rows, "image_path", "predicted_class") == [("a", "1"), ("b", "unknown")]
