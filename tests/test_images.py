from __future__ import annotations

import struct

import pytest
from pyspark.sql import functions as F

from tidemark.functions.images import image_size
from tidemark.operators.scoring import dims_udf
from tidemark.sources.files import binary_files, image_files
from tidemark.sources.streams import binary_file_stream
from tidemark.streaming.assets import labeled_files

SIZES = [(1, 1), (17, 3), (640, 480), (3, 301)]
KINDS = ["png", "jpg", "gif", "bmp"]


@pytest.fixture(scope="module")
def pictures(spark, tmp_path_factory):
    """Real images, encoded by the JVM, below a folder per kind."""
    root = tmp_path_factory.mktemp("images") / "flower_photos"
    jvm = spark._jvm
    jvm.java.lang.System.setProperty("java.awt.headless", "true")
    kind_of_pixel = jvm.java.awt.image.BufferedImage.TYPE_INT_RGB
    for kind in KINDS:
        (root / kind).mkdir(parents=True)
        for width, height in SIZES:
            image = jvm.java.awt.image.BufferedImage(width, height, kind_of_pixel)
            file = jvm.java.io.File(str(root / kind / f"{width}x{height}.{kind}"))
            assert jvm.javax.imageio.ImageIO.write(image, kind, file)
    return root


def sizes_of(df):
    return {r["path"].rsplit("/", 1)[1]: (r["width"], r["height"]) for r in df.collect()}


EXPECTED = {f"{w}x{h}.{kind}": (w, h) for kind in KINDS for w, h in SIZES}


def test_real_images_by_header_and_by_decoding(spark, pictures):
    files = binary_files(spark, str(pictures))
    by_header = files.select("path", image_size(F.col("content")).alias("s")).select("path", "s.*")
    assert sizes_of(by_header) == EXPECTED
    plan = by_header._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    assert sizes_of(image_files(spark, str(pictures))) == EXPECTED


def test_damaged_images_have_no_size(spark, pictures, tmp_path):
    good = {kind: (pictures / kind / f"640x480.{kind}").read_bytes() for kind in KINDS}
    bad = {f"{kind}{n}": raw[:n] for kind, raw in good.items() for n in (1, 2, 9, 19)}
    bad |= {"text": b"not an image", "ffd8": b"\xff\xd8\xff" * 50, "zeros": bytes(100)}
    for name, raw in bad.items():
        (tmp_path / name).write_bytes(raw)
    files = binary_files(spark, str(tmp_path))
    sized = files.select("path", image_size(F.col("content")).alias("s")).select("path", "s.*")
    # A GIF says its size in its first ten bytes.
    expected = {name: ((640, 480) if name == "gif19" else (0, 0)) for name in bad}
    assert sizes_of(sized) == expected
    assert set(sizes_of(image_files(spark, str(tmp_path))).values()) == {(0, 0)}


def segment(mark: int, size: int) -> bytes:
    return struct.pack(">BBH", 0xFF, mark, size) + bytes(size - 2)


def frame(width: int, height: int, mark: int = 0xC0) -> bytes:
    return struct.pack(">BBHBHHB", 0xFF, mark, 17, 8, height, width, 3) + bytes(9)


def test_jpeg_segments(spark):
    start, tables = b"\xff\xd8", segment(0xDB, 67) + segment(0xC4, 31)
    cases = {
        "many segments": start + segment(0xE1, 12) * 500 + frame(7, 9),
        "long segment": start + segment(0xE2, 65535) + frame(65535, 65535),
        "fill bytes": start + b"\xff\xff\xff" + segment(0xE0, 16)[1:] + b"\xff\xff" + frame(5, 6),
        "restart marks": start + b"\xff\x01\xff\xd3" + tables + frame(8, 4, 0xC2),
        "scan first": start + tables + segment(0xDA, 12) + frame(8, 4),
        "end first": start + tables + b"\xff\xd9" + frame(8, 4),
        "short length": start + b"\xff\xe0\x00\x01" + frame(8, 4),
        "beyond the end": start + b"\xff\xe0\xff\xff" + frame(8, 4),
        "cut frame": (start + tables + frame(8, 4))[:-12],
        "no frame": start + tables,
    }
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in cases.items()], "name string, c binary")
    sized = df.select("name", image_size(F.col("c")).alias("s"))
    got = {r["name"]: tuple(r["s"]) for r in sized.collect()}
    assert {name: size for name, size in got.items() if size != (0, 0)} == {
        "many segments": (7, 9), "long segment": (65535, 65535), "fill bytes": (5, 6),
        "restart marks": (8, 4),
    }


def test_bmp_rows_from_the_top_and_null(spark):
    head = b"BM" + bytes(12) + struct.pack("<Iii", 40, 12, -34)
    df = spark.createDataFrame([(bytearray(head),), (None,)], "c binary")
    rows = df.select(image_size(F.col("c")).alias("s")).collect()
    assert [tuple(r["s"]) for r in rows] == [(12, 34), (0, 0)]


def test_sizes_in_a_stream_of_files(spark, pictures, tmp_path):
    files = labeled_files(binary_file_stream(spark, str(pictures), "*.png"), image_size)
    query = (
        files.select("path", "label", "size.*").writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "ck"))
        .option("path", str(tmp_path / "out")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert sizes_of(rows) == {k: v for k, v in EXPECTED.items() if k.endswith("png")}
    assert {r["label"] for r in rows.collect()} == {"png"}


def test_python_sizes_agree(spark, pictures):
    """A size function of one's own still works, and fails to 0 x 0."""

    def png_size(content):
        return struct.unpack(">II", content[16:24]) if content[:4] == b"\x89PNG" else 1 / 0

    files = binary_files(spark, str(pictures), "*[gG]*")
    rows = files.select("path", dims_udf(png_size)(F.col("content")).alias("s")).select("path", "s.*")
    got = sizes_of(rows)
    assert {k: v for k, v in got.items() if k.endswith("png")} == {
        k: v for k, v in EXPECTED.items() if k.endswith("png")
    }
    assert {v for k, v in got.items() if not k.endswith("png")} == {(0, 0)}
