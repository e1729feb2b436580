from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import objects, text
from tidemark.operators.line_stats import file_stats, listed_stats, text_stats

BREAKS = ["\n", "\r", "\r\n", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", "\x85", " ", " "]
SPACES = [" ", "\t", " ", " ", "　", "\x1f"]
PIECES = st.lists(st.sampled_from(["a", "bc", "é", "語", *BREAKS, *SPACES]), max_size=12)


def plain_lines(value: str) -> int:
    pieces = value.replace("\r\n", "\n").replace("\r", "\n").split("\n")
    return len(pieces) - (pieces[-1] == "")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(PIECES.map("".join), min_size=30, max_size=60))
def test_counts_agree_with_python(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "text string")
    for unicode_breaks in (False, True):
        stats = text_stats(rows, "text", "text", unicode_breaks=unicode_breaks)
        for row in stats.collect():
            value = row["text"]
            lines = len(value.splitlines()) if unicode_breaks else plain_lines(value)
            assert row["line_count"] == lines, repr(value)
            assert row["word_count"] == len(value.split()), repr(value)
            assert row["file_size_bytes"] == len(value.encode())


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(PIECES.map("".join), min_size=20, max_size=20))
def test_file_counts_agree_with_python(spark, tmp_path_factory, values):
    folder = tmp_path_factory.mktemp("files")
    for number, value in enumerate(values):
        (folder / f"{number}.txt").write_bytes(value.encode())
    for unicode_breaks in (False, True):
        for row in file_stats(spark, str(folder), "*.txt", unicode_breaks).collect():
            value = values[int(row["file_name"].split(".")[0])]
            lines = len(value.splitlines()) if unicode_breaks else plain_lines(value)
            assert row["line_count"] == lines, repr(value)
            assert row["word_count"] == len(value.split()), repr(value)
            assert row["file_size_bytes"] == len(value.encode())


def test_published_shapes(spark, tmp_path):
    """468 lines from 467 breaks; five lines in the small text; an empty file."""
    long_text = "\n".join(f"line {i}" for i in range(468))
    files = {
        "long.txt": long_text,
        "five.txt": "Line 1\nLine 2\nLine 3\nLine 4\nLine 5",
        "ended.txt": "a\nb\n",
        "windows.txt": "a\r\nb\r\n",
        "empty.txt": "",
        "newline.txt": "\n",
        "mark.txt": "﻿a\nb",
    }
    nested = tmp_path / "deep" / "er"
    nested.mkdir(parents=True)
    for name, value in files.items():
        (nested / name).write_bytes(value.encode())
    (nested / "other.bin").write_bytes(b"\x00")
    got = {r["file_name"]: r["line_count"] for r in file_stats(spark, str(tmp_path), "*.txt").collect()}
    assert got == {
        "long.txt": 468,
        "five.txt": 5,
        "ended.txt": 2,
        "windows.txt": 2,
        "newline.txt": 1,
        "mark.txt": 2,
    }


def test_listed_empty_file_counts_zero(spark, tmp_path):
    (tmp_path / "full.txt").write_text("a b\nc")
    (tmp_path / "empty.txt").write_text("")
    paths = [(f"file://{tmp_path}/{name}",) for name in ("full.txt", "empty.txt")]
    listed = spark.createDataFrame(paths, "path string")
    got = listed_stats(listed, file_stats(spark, str(tmp_path))).drop("path")
    assert sorted(tuple(r) for r in got.collect()) == [(0, 0, 0), (2, 3, 5)]


def test_big_file_is_cut_into_pieces(spark, tmp_path):
    """A file read by many tasks: the last piece still decides the last line."""
    value = "\n".join("x" * 50 for _ in range(2000)) + "\x0c"
    (tmp_path / "big.txt").write_bytes(value.encode())
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        row = file_stats(spark, str(tmp_path), "*.txt", unicode_breaks=True).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert row["line_count"] == len(value.splitlines()) == 2000


def test_decoding_falls_back_to_latin1(spark):
    rows = [(v,) for v in ("naïve".encode(), "naïve".encode("latin-1"), b"", b"plain")]
    df = spark.createDataFrame(rows, "content binary")
    got = [r[0] for r in df.select(text.decode_text(F.col("content"))).collect()]
    assert got == ["naïve", "naïve", "", "plain"]


def test_suffix_filter(spark):
    names = ["a.txt", "B.CSV", "c.tar.json", "d.jpg", "e", "txt", ".md", "f.txt.gz"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    kept = [r[0] for r in df.filter(text.has_text_suffix(F.col("name"))).collect()]
    assert kept == ["a.txt", "B.CSV", "c.tar.json", ".md"]


def test_path_labels(spark):
    cases = {
        "flower_photos/roses/image1.jpg": "roses",
        "flower_photos/tulips/photo.jpg": "tulips",
        "flower_photos/dandelion/test.jpg": "dandelion",
        "/path/to/flower_photos/sunflowers/img.jpg": "sunflowers",
        "other/path/image.jpg": "path",
        "flower_photos/image.jpg": "flower_photos",
        "my_flower_photos/x/y.jpg": "x",
    }
    df = spark.createDataFrame([(p,) for p in cases], "path string")
    got = {r[0]: r[1] for r in df.select("path", objects.path_label(F.col("path"))).collect()}
    assert got == cases


def test_base64_both_ways(spark):
    payload = bytes(range(256)) * 3
    df = spark.createDataFrame([(payload,)], "content binary")
    encoded = df.select(objects.base64_text(F.col("content")).alias("t"))
    assert "\n" not in encoded.first()["t"]
    assert encoded.select(objects.bytes_of_base64(F.col("t"))).first()[0] == payload
    bad = spark.createDataFrame([("not base64!",)], "t string")
    assert bad.select(objects.bytes_of_base64(F.col("t"))).first()[0] is None
