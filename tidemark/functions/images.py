"""Sizes of encoded images, read from their headers by expressions on binary columns.

Nothing is decoded, and no Python worker takes part: a few bytes at known
places tell the size of PNG, GIF and BMP images; the segments of a JPEG image
are walked up to the frame header.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First bytes of the formats, and the markers of JPEG segments.
PNG = "89504E470D0A1A0A0000000D49484452"
GIF = ("474946383761", "474946383961")
BMP = "424D"
JPEG = "FFD8FF"
_FRAME = [f"C{k:X}" for k in range(16) if k not in (4, 8, 12)]
_BARE = ["01", "D8", *(f"D{k}" for k in range(8))]  # markers without a length
_LAST = ["D9", "DA"]  # end of image, and the scan, which comes after the frame
_USUAL_STEPS = 64


def _hex(content: Column, at: Column | int, size: int) -> Column:
    """Hexadecimal digits of ``size`` bytes from place ``at``, counted from 0."""
    place = F.lit(at) if isinstance(at, int) else at
    return F.hex(F.substring(content, place + 1, F.lit(size)))


def _number(digits: Column) -> Column:
    return F.conv(digits, 16, 10).cast("bigint")


def _little_endian(content: Column, at: int, size: int) -> Column:
    return _number(F.concat(*(_hex(content, at + k, 1) for k in reversed(range(size)))))


def _size(width: Column, height: Column) -> Column:
    return F.struct(width.cast("int").alias("width"), height.cast("int").alias("height"))


def _walk(content: Column, steps: Column) -> Column:
    """(at, width, height, done) after at most so many segments of a JPEG image."""
    length = F.octet_length(content)

    def state(at: Column, width: Column, height: Column, done: Column) -> Column:
        return F.struct(
            at.cast("int").alias("at"),
            width.cast("int").alias("width"),
            height.cast("int").alias("height"),
            done.alias("done"),
        )

    none, true, false = F.lit(0), F.lit(True), F.lit(False)

    def step(so_far: Column, _: Column) -> Column:
        at = so_far["at"]
        mark, begin = _hex(content, at + 1, 1), _hex(content, at, 1)
        size = _number(_hex(content, at + 2, 2))
        rows, columns = _hex(content, at + 5, 2), _hex(content, at + 7, 2)
        return (
            F.when(so_far["done"], so_far)
            .when((begin != "FF") | mark.isin(_LAST) | (at + 4 > length), state(at, none, none, true))
            .when(mark == "FF", state(at + 1, none, none, false))
            .when(mark.isin(_BARE), state(at + 2, none, none, false))
            .when(
                mark.isin(_FRAME),
                F.when(at + 9 > length, state(at, none, none, true)).otherwise(
                    state(at, _number(columns), _number(rows), true)
                ),
            )
            .when(size < 2, state(at, none, none, true))
            .otherwise(state(at + 2 + size, none, none, false))
        )

    return F.aggregate(F.sequence(F.lit(1), steps), state(F.lit(2), none, none, false), step)


def _jpeg_size(content: Column) -> Column:
    """A few segments come before the frame; an image with more is walked to its end."""
    usual = _walk(content, F.lit(_USUAL_STEPS))
    every = _walk(content, F.greatest(F.lit(1), F.octet_length(content).cast("int")))
    return F.transform(
        F.transform(F.array(usual), lambda x: F.when(x["done"], x).otherwise(every)),
        lambda x: _size(x["width"], x["height"]),
    )[0]


def image_size(content: Column) -> Column:
    """``(width, height)`` of a PNG, GIF, BMP or JPEG image.

    0 x 0 for NULL, empty, cut off or other content. An image whose header is
    whole has its size, whatever comes after. BMP heights below zero, which mean
    rows from the top, count as heights.
    """
    start = _hex(content, 0, 16)
    length = F.octet_length(content)
    nothing = _size(F.lit(0), F.lit(0))
    bmp_height = _little_endian(content, 22, 4)
    signed = F.when(bmp_height >= 1 << 31, (1 << 32) - bmp_height).otherwise(bmp_height)
    size = (
        F.when(
            (start == PNG) & (length >= 24),
            _size(_number(_hex(content, 16, 4)), _number(_hex(content, 20, 4))),
        )
        .when(
            F.substring(start, 1, 12).isin(*GIF) & (length >= 10),
            _size(_little_endian(content, 6, 2), _little_endian(content, 8, 2)),
        )
        .when(
            start.startswith(BMP) & (length >= 26) & (_little_endian(content, 14, 4) >= 40),
            _size(_little_endian(content, 18, 4), signed),
        )
        .when(start.startswith(JPEG), _jpeg_size(content))
    )
    return F.coalesce(size, nothing)
