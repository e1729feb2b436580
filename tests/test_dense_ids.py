from __future__ import annotations

import random
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemark.operators.dense_ids import dense_ids
from tidemark.session import shared_dir, sizing, stage, staging
from tidemark.sinks.files import read_with_places, write_report, write_small_csv, write_sorted


def numbered(df, order_by, **options):
    rows = dense_ids(df, order_by, **options).collect()
    return [tuple(r) for r in sorted(rows, key=lambda r: r[-1])]


def test_ids_follow_the_order_without_gaps(spark):
    values = list(range(1000))
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v, str(v)) for v in values], "id int, text string").repartition(7)
    assert numbered(df, ["id"]) == [(v, str(v), v + 1) for v in range(1000)]


def test_hot_leading_value_is_spread_and_ordered(spark):
    """A third of the rows share the first column; they still fill several ranges."""
    rows = [(5 if i % 3 == 0 else i, i) for i in range(30000)]
    df = spark.createDataFrame(rows, "a int, b int")
    ids = dense_ids(df, ["a", "b"])
    got = [(r["a"], r["b"]) for r in ids.orderBy("row_id").collect()]
    assert got == sorted(rows)
    # Partitions are bounded on both columns, so the hot value is in more than one.
    placed = df.repartitionByRange(8, "a", "b").withColumn("p", F.spark_partition_id())
    assert placed.filter("a = 5").select("p").distinct().count() > 1


def test_text_keys_start_and_nothing_left_behind(spark):
    df = spark.createDataFrame([("b",), ("c",), ("a",)], "k string")
    assert numbered(df, ["k"], name="n", start=10) == [("a", 10), ("b", 11), ("c", 12)]
    assert dense_ids(df.limit(0), ["k"]).count() == 0


@pytest.mark.parametrize("unique", [False, True])
def test_the_first_rows_by_counts(spark, unique):
    rows = [(None if i == 7 else i // 3, i, f"text {i}") for i in range(5000)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "a int, b int, text string").repartition(9)
    expected = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for most in (0, 1, 777, 4999, 5000, 9000):
        ids = dense_ids(df, ["a", "b"], unique=unique, at_most=most, start=5)
        assert ids.columns == ["a", "b", "text", "row_id"]
        got = [tuple(r) for r in ids.orderBy("row_id").collect()]
        assert got == [(*r, k + 5) for k, r in enumerate(expected[:most])]
        plan = ids._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" not in plan and "GlobalLimit" not in plan


def test_only_keys_are_stored_where_they_are_unique(spark, tmp_path):
    df = spark.range(2000).selectExpr("id", "repeat(uuid(), 40) AS payload")
    df = stage(df, "payload")

    def stored_bytes(unique):
        with staging(spark) as folder:
            ids = dense_ids(df, ["id"], unique=unique)
            assert ids.agg(F.sum("row_id")).first()[0] == 2000 * 2001 // 2
            return sum(f.stat().st_size for f in Path(folder).rglob("*.parquet"))

    assert stored_bytes(True) * 10 < stored_bytes(False)


def test_equal_keys_are_numbered_or_refused(spark):
    df = spark.createDataFrame([(1, "x"), (1, "y"), (0, "z")], "k int, text string")
    assert sorted(r["row_id"] for r in dense_ids(df, ["k"]).collect()) == [1, 2, 3]
    with pytest.raises(Exception, match="not unique"):
        dense_ids(df, ["k"], unique=True).collect()


def test_sorted_files_follow_the_order_by_name(spark, tmp_path):
    """One id holds a third of the rows; it is cut over several files."""
    rows = [(3 if i % 3 == 0 else i % 50, i) for i in range(20_000)]
    random.Random(4).shuffle(rows)
    df = spark.createDataFrame(rows, "id int, start int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_sorted(df, str(tmp_path / "sorted"), "id", "start")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    placed = read_with_places(spark, str(tmp_path / "sorted")).collect()
    placed.sort(key=lambda r: (r["file_name"], r["row_index"]))
    assert [(r["id"], r["start"]) for r in placed] == sorted(rows)
    assert len({r["file_name"] for r in placed if r["id"] == 3}) > 1


def test_one_file_is_refused_for_many_rows(spark, tmp_path):
    df = spark.range(30).selectExpr("id", "string(id) AS text")
    write_small_csv(df, str(tmp_path / "few"), most=30)
    assert len(list((tmp_path / "few").glob("*.csv"))) == 1
    with pytest.raises(ValueError, match="one task"):
        write_small_csv(df, str(tmp_path / "many"), most=29)
    assert not (tmp_path / "many").exists()
    report = df.selectExpr("id AS position", "'s' AS section", "text AS name", "text AS value")
    with pytest.raises(ValueError, match="one task"):
        write_report(report, str(tmp_path / "report"), most=10)


def test_stage_reads_back_what_was_written(spark):
    df = spark.range(10).withColumn("twice", F.col("id") * 2)
    stored = stage(df, "test")
    assert sorted(stored.collect()) == sorted(df.collect())
    assert all(name.startswith("file:") for name in stored.inputFiles())
    assert shared_dir(spark) in stored.inputFiles()[0]


def test_sizing_follows_the_input():
    small, large = sizing(0, 8), sizing(100 * 2**40, 4000)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * 2**20)
    assert large["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (128 * 2**20))
    less = sizing(100 * 2**40, 4000, shuffled_bytes=2**40)
    assert less["spark.sql.shuffle.partitions"] == str(2**40 // (128 * 2**20))
    assert large["spark.sql.files.maxPartitionBytes"] == str(2**30)


class Session:
    """The little of a session that finding the shared folder needs."""

    def __init__(self, master, setting=None):
        self.conf = {"spark.checkpoint.dir": setting} if setting else {}
        self.sparkContext = SimpleNamespace(master=master, applicationId="app-" + master)


def test_shared_folder_comes_from_the_session():
    assert shared_dir(Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert shared_dir(Session("local[2]", "/shared")) == "/shared"
    with pytest.raises(RuntimeError):
        shared_dir(Session("yarn"))
    own = shared_dir(Session("local[2]"))
    assert own == shared_dir(Session("local[2]"))
