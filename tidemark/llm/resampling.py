"""Target-distribution importance resampling with hashed word n-grams.

Words and pairs of neighbouring words fall into buckets by their CRC-32. A
bucket's gain compares its share in the target texts with its share in the
documents; a document's weight is the mean gain of its features. Noise that
depends on nothing but the id turns weights into a draw without replacement.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.regular_sort import ranked
from tidemark.session import ship_package, stage

BUCKETS = 10_000
SEED = 7
LEAST_WORDS = 20
DRAWN_PERCENT = 25
_WINDOW = 1 << 20  # bytes of a text that are cut into words at a time
_TABLED = 64  # longest word, in bytes, whose pairs go through tables

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_NO_WORD = re.compile(rb"[^0-9a-z\x80-\xff]")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _shift_tables() -> tuple[np.ndarray, np.ndarray]:
    """What one byte does to a CRC register, and what 0 to _TABLED zero bytes do to each of its bytes."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> 1) ^ np.uint32(0xEDB88320), one >> 1)
    shifts = np.empty((_TABLED + 1, 4, 256), np.uint32)
    for k in range(4):
        shifts[0, k] = np.arange(256, dtype=np.uint32) << np.uint32(8 * k)
    for n in range(_TABLED):
        shifts[n + 1] = one[shifts[n] & 0xFF] ^ (shifts[n] >> np.uint32(8))
    return one, shifts


_ONE, _SHIFTS = _shift_tables()


def pair_crcs(crcs: np.ndarray, words: list[bytes], lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of each word, a space and the next word, from the words' own.

    A CRC of joined bytes is that of the first part, moved on by the length of
    the second, combined with that of the second.
    """
    state = ~crcs[:-1]
    spaced = ~(_ONE[(state ^ np.uint32(0x20)) & 0xFF] ^ (state >> np.uint32(8)))
    size = np.minimum(lengths[1:], _TABLED)
    out = crcs[1:].copy()
    for k in range(4):
        out ^= _SHIFTS[size, k, (spaced >> np.uint32(8 * k)) & 0xFF]
    for at in np.flatnonzero(lengths[1:] > _TABLED):
        out[at] = zlib.crc32(words[at + 1], int(spaced[at]))
    return out


def _windows(raw: bytes) -> Iterator[bytes]:
    """The bytes in parts that cut no word."""
    at = 0
    while at < len(raw):
        stop = at + _WINDOW
        if stop < len(raw):
            gap = _NO_WORD.search(raw, stop)
            stop = gap.start() if gap else len(raw)
        yield raw[at:stop]
        at = stop


def feature_buckets(text: str | None, buckets: int = BUCKETS) -> Iterator[tuple[int, np.ndarray]]:
    """For each part of a text: its number of words, and the buckets of its words and word pairs."""
    last: bytes | None = None
    for part in _windows((text or "").encode().translate(_LOWER)):
        words = _WORD.findall(part)
        if not words:
            continue
        new = len(words)
        if last is not None:
            words.insert(0, last)
        crcs = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        pairs = pair_crcs(crcs, words, lengths)
        last = words[-1]
        yield new, np.concatenate([crcs[-new:], pairs]) % np.uint32(buckets)


def bucket_counts(texts: DataFrame, column: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows; each task sends one number per bucket at most."""
    ship_package(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for _, found in feature_buckets(text.as_py(), buckets):
                    counts += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(counts[held], pa.int64())], ["bucket", "n"]
        )

    partial = texts.select(F.col(column).cast("string")).mapInArrow(run, "bucket int, n bigint")
    counts = np.zeros(buckets, np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, per bucket, rounded down."""
    size = len(raw)
    all_raw, all_target = float(raw.sum() + size), float(target.sum() + size)
    return np.array(
        [
            math.floor(1000 * math.log(float(t + 1) * all_raw / (float(s + 1) * all_target)))
            for s, t in zip(raw.tolist(), target.tolist())
        ],
        np.int64,
    )


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, rounded down; it follows from seed and id alone."""
    named = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(named.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row.

    NULL and empty texts have no features and weight 0. A NULL id counts as the
    empty string in the noise. Repeated rows get equal values.
    """
    ship_package(docs.sparkSession)
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = features = total = 0
                for new, found in feature_buckets(text.as_py(), buckets):
                    words += new
                    features += len(found)
                    total += int(gain[found].sum())
                weight = total // features if features else 0
                rows.append((doc_id, words, features, weight, weight + noise(doc_id, seed)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else [[]] * 5)],
                ["doc_id", "n_words", "n_features", "weight", "score"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint, score bigint"
    )


def resampled(
    docs: DataFrame,
    target: DataFrame,
    least_words: int = LEAST_WORDS,
    percent: int = DRAWN_PERCENT,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """All documents with their score, and the rank of those that are drawn.

    Of the rows with at least ``least_words`` words the ``percent`` with the
    highest scores are drawn, ties to the smaller id, NULL ids last. Repeated
    rows count and rank one by one. Only the gains, one number per bucket, go
    to every task. Other columns of either table are not looked at.
    """
    gain = gains(bucket_counts(docs, buckets=buckets), bucket_counts(target, buckets=buckets))
    rows = stage(scored(docs, gain, seed), "scored")
    fit = F.col("n_words") >= least_words
    drawn = percent * rows.where(fit).count() // 100
    order = ranked(rows.where(fit), "score", "doc_id")
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    return order.withColumn("rank", rank).unionByName(
        rows.where(~fit).withColumn("rank", F.lit(None).cast("bigint"))
    )
