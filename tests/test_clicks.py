from __future__ import annotations

from pyspark.sql import functions as F

from conftest import tuples
from tidemark import schemas
from tidemark.functions import clicks as fn
from tidemark.operators import clicks as op
from tidemark.sinks.files import register_table, write_parquet, write_small_csv
from tidemark.sources.files import csv_with_header, delimited, text_lines

EXTRA = [
    ("", "MALFORMED", "MALFORMED", "MALFORMED"),
    ("10-Jan", "MALFORMED", "MALFORMED", "MALFORMED"),
    ("10-Jan 24:00 1", "UNKNOWN", "UNKNOWN", "UNKNOWN"),
    ("10-Jan -1:00 1", "UNKNOWN", "UNKNOWN", "UNKNOWN"),
    ("10-Jan ab:cd 1", "UNKNOWN", "UNKNOWN", "UNKNOWN"),
    ("10-Jan  7:05   1", "OK", "OK", "UNKNOWN"),
    ("10-Jan\t7:05\t1", "OK", "OK", "MALFORMED"),
    ("10-Jan 7:05 1 extra", "OK", "MALFORMED", "OK"),
    ("10-Jan 7:05", "OK", "MALFORMED", "MALFORMED"),
    ("10-Jan 7:05 1", "OK", "OK", "MALFORMED"),
]


def parsed_fixture(spark, fixtures):
    return op.parse_clicks(text_lines(spark, str(fixtures / "clicks.txt")))


def test_golden_counts(spark, fixtures):
    counts = op.interval_counts(op.valid_clicks(parsed_fixture(spark, fixtures)))
    share = op.interval_share(counts).select("time_interval", "click_count", "percentage")
    assert tuples(share) == [
        ("0-6", 4, 13.3),
        ("12-18", 13, 43.3),
        ("18-24", 6, 20.0),
        ("6-12", 7, 23.3),
    ]


def test_golden_detail_uses_the_clock(spark, fixtures):
    clicks = op.valid_clicks(parsed_fixture(spark, fixtures))
    detail = op.interval_detail(clicks, F.col("user_id"), fn.minute_of_day(F.col("time")))
    assert tuples(detail) == [
        ("0-6", 4, 4, 13.33, 1.0, "02:11", "05:34"),
        ("12-18", 13, 13, 43.33, 1.0, "12:00", "17:32"),
        ("18-24", 6, 6, 20.0, 1.0, "18:23", "23:54"),
        ("6-12", 7, 7, 23.33, 1.0, "06:02", "11:30"),
    ]


def test_summary_and_peak(spark, fixtures):
    clicks = op.valid_clicks(parsed_fixture(spark, fixtures))
    assert tuples(op.click_summary(clicks)) == [(30, 30, 1.0)]
    assert tuples(op.interval_peak(clicks)) == [("12-18", 13, 30, 43.3)]


def test_peak_tie_goes_to_the_earlier_interval(spark):
    lines = spark.createDataFrame([("d 13:00 1",), ("d 7:00 2",), ("d 19:00 2",)], "value string")
    clicks = op.valid_clicks(op.parse_clicks(lines))
    assert op.interval_peak(clicks).first()["peak_interval"] == "6-12"


def test_status_of_odd_lines_in_each_mode(spark):
    lines = spark.createDataFrame([(row[0],) for row in EXTRA], "value string")
    for place, mode in enumerate(("loose", "strict", "single_space"), 1):
        got = {r["value"]: r["status"] for r in op.parse_clicks(lines, mode=mode).collect()}
        assert got == {row[0]: row[place] for row in EXTRA}, mode


def test_quality_counts_every_line_once(spark):
    lines = spark.createDataFrame([(row[0],) for row in EXTRA] + [(None,)], "value string")
    row = op.click_quality(op.parse_clicks(lines)).first()
    assert row["total_lines"] == len(EXTRA) + 1
    assert row["valid_lines"] == 5
    assert row["malformed_lines"] == 3
    assert row["unknown_lines"] == 3
    assert row["success_rate"] == 45.5


def test_quality_of_an_empty_log(spark):
    row = op.click_quality(op.parse_clicks(spark.createDataFrame([], "value string"))).first()
    assert (row["total_lines"], row["success_rate"]) == (0, None)


def test_zero_fill_keeps_the_order_of_the_day(spark):
    lines = spark.createDataFrame([("d 13:00 1",), ("d 14:00 1",)], "value string")
    counts = op.interval_counts(op.valid_clicks(op.parse_clicks(lines)))
    rows = op.zero_filled(counts).collect()
    assert [(r["time_interval"], r["click_count"]) for r in rows] == [
        ("0-6", 0),
        ("6-12", 0),
        ("12-18", 2),
        ("18-24", 0),
    ]


def test_interval_styles_and_unknown(spark):
    hours = spark.createDataFrame([(0,), (5,), (6,), (17,), (18,), (23,), (24,), (-1,)], "hour int")
    for style, labels in fn.INTERVAL_LABELS.items():
        got = [
            r[0]
            for r in hours.select(fn.time_interval(F.col("hour"), style, "Unknown")).collect()
        ]
        want = [labels[i] for i in (0, 0, 1, 2, 3, 3)] + ["Unknown", "Unknown"]
        assert got == want


def test_user_activity_lists_each_interval_with_its_clicks(spark):
    lines = [("d 7:00 9",)] * 3 + [("d 13:00 9",)] * 2 + [("d 1:00 8",)] * 5 + [("d 1:00 7",)]
    clicks = op.valid_clicks(op.parse_clicks(spark.createDataFrame(lines, "value string")))
    rows = op.user_activity(clicks, top=2).collect()
    assert [(r["user_id"], r["total_clicks"], r["active_intervals"]) for r in rows] == [
        ("8", 5, 1),
        ("9", 5, 2),
    ]
    assert [tuple(pair) for pair in rows[1]["intervals"]] == [("12-18", 2), ("6-12", 3)]


def test_user_clicks_top(spark, fixtures):
    clicks = op.valid_clicks(parsed_fixture(spark, fixtures))
    assert [r["user_id"] for r in op.user_clicks(clicks, top=5).collect()] == [
        "1001",
        "1002",
        "1003",
        "1004",
        "1005",
    ]


def test_space_delimited_file_and_regex(spark, fixtures):
    rows = delimited(spark, str(fixtures / "clicks.txt"), schemas.CLICK_FILE, " ")
    assert rows.count() == 30
    assert op.valid_by_regex(rows).count() == 0
    assert op.valid_by_regex(rows, r"^\d{2}-\w{3}$", r"^\d{1,2}:\d{2}$").count() == 30


def test_small_csv_is_one_file(spark, fixtures, tmp_path):
    counts = op.interval_counts(op.valid_clicks(parsed_fixture(spark, fixtures)))
    target = tmp_path / "counts"
    write_small_csv(counts, str(target))
    assert len(list(target.glob("part-*"))) == 1
    assert sorted(tuple(r) for r in csv_with_header(spark, str(target)).collect()) == tuples(counts)


def test_results_are_kept_as_an_external_table(spark, fixtures, tmp_path):
    counts = op.interval_counts(op.valid_clicks(parsed_fixture(spark, fixtures)))
    stored = write_parquet(counts, str(tmp_path / "counts"))
    table = register_table(spark, "interval_results", str(tmp_path / "counts"))
    assert tuples(table) == tuples(stored) == tuples(counts)
    query = "SELECT sum(click_count) AS n FROM interval_results"
    assert spark.sql(query).first()["n"] == 30
    spark.sql("DROP TABLE interval_results")
    assert tuples(spark.read.parquet(str(tmp_path / "counts"))) == tuples(counts)


def test_top_of_none(spark):
    clicks = spark.createDataFrame([("u1",), ("u2",)], "user_id string")
    assert op.user_clicks(clicks, top=0).count() == 0
    assert op.user_clicks(clicks).count() == 2
