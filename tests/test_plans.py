"""Shapes of the plans: what must not be in them, and what must."""

from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from tidemark import schemas
from tidemark.operators import scd2, scoring
from tidemark.plans import all_queries
from tidemark.plans.assets import CLASSES, sine_model
from tidemark.sinks.tables import save_bucketed
from tidemark.sources.files import dimension_file, feed_file
from tidemark.streaming.messages import parse_messages

FOLDER = entry_module.SMOKE_FOLDER
QUERIES = all_queries()[0]
WITH_PYTHON = {"score_top1", "asset_dims"}
# These run whole streams or searches while they are being built.
EAGER = {"cv_metric_stats", "cv_full_grid", "param_impact", "tree_predictions", "replay_batches"}
LAZY = sorted(n for n in QUERIES if n not in EAGER and not n.startswith("stream"))


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_joins_and_no_stray_python(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert unwanted not in plan
    assert ("ArrowEvalPython" in plan) == (name in WITH_PYTHON)


@pytest.mark.parametrize(
    ("name", "schema"),
    [
        ("user_clicks", "struct<user_id:bigint>"),
        ("interval_detail", "struct<ts:timestamp_ntz,user_id:bigint>"),
        ("doc_word_counts", "struct<doc_id:bigint,text:string>"),
        ("ml_label_distribution", "struct<label:int>"),
        ("click_summary", "struct<user_id:bigint>"),
    ],
)
def test_scans_read_only_what_is_needed(spark, name, schema):
    assert f"ReadSchema: {schema}" in plan_of(QUERIES[name](spark, FOLDER))


def test_filters_reach_the_scan(spark):
    plan = plan_of(QUERIES["scd2_classify"](spark, FOLDER))
    assert "LessThan(c_nationkey,20)" in plan
    assert "GreaterThanOrEqual(c_nationkey,4)" in plan


def test_click_lines_are_split_once(spark):
    """Filters on parsed columns must not repeat the splitting."""
    assert plan_of(QUERIES["interval_counts"](spark, FOLDER)).count("regexp_extract_all") == 1


def test_messages_are_parsed_once(spark):
    raw = spark.createDataFrame([("{}",)], "value string")
    parsed = parse_messages(raw, schemas.TRANSACTION_MESSAGE)
    plan = plan_of(parsed.filter("parse_status = 'ok' AND final_amount > 0"))
    assert plan.count("from_json(StructField(customer_id") == 1


def test_models_score_each_row_once(spark):
    top1 = scoring.top1_udf("m", sine_model, CLASSES)
    rows = spark.createDataFrame([([0.0] * 64,)], "v array<double>")
    scored = rows.select(top1(F.col("v")).alias("p")).filter("p.class <> 'unknown'")
    assert plan_of(scored.select("p.class", "p.score")).count("[top1(") == 1


def test_bucketed_dimension_is_not_shuffled(spark, fixtures):
    """Only the feed moves; closed versions are not even read."""
    dimension = dimension_file(spark, str(fixtures / "dimension.csv")).drop("rejected")
    stored = save_bucketed(dimension, "dimension", "customer_id", 8, "is_current")
    feed = feed_file(spark, str(fixtures / "feed.csv"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        classified = scd2.classify_changes(stored, feed)
        plan = plan_of(classified)
        assert plan.count("Arguments: hashpartitioning") == 1
        assert "PartitionFilters: [(is_current" in plan
        counts = {r["record_type"]: r["records"] for r in scd2.class_counts(classified).collect()}
        assert counts == {"CHANGED": 2, "NEW": 2, "UNCHANGED": 4}
        merged = scd2.scd2_merge(stored, feed)
        assert merged.count() == 12
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE dimension")


def test_file_counts_use_hash_aggregation(spark):
    assert "SortAggregate" not in plan_of(QUERIES["text_file_stats"](spark, FOLDER))
