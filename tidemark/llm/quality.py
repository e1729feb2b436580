"""Quality classifier with supervised subword embeddings.

A word's features are its own hash and the hashes of its character n-grams; a
word that repeats the one before counts as one fixed mark. A document is the mean of the learned vectors of all features of all its words,
and a softmax over that mean gives the score. Vectors and softmax are trained
together by stochastic gradient descent in numpy.

The fit takes a bounded sample of labelled rows (``SAMPLE_PER_LABEL`` rows of
each label, texts of at most ``SAMPLE_BYTES``, those with the lowest hash of
their id); scoring covers every whole text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import ship_package

SAMPLE_PER_LABEL = 2_000
SAMPLE_BYTES = 64 << 10
BUCKETS = 1 << 18
WIDTH = 8
EPOCHS = 5
RATE = 2.0
NGRAMS = (3, 4)
LEAST_SCORE = 0.3
FOLDS = 5
SEED = 7
_MOST_KEPT = 300_000
_REPEAT = "\0again"  # no word of a text has this form


def words_of(text: str) -> list[str]:
    words = text.split()
    return [_REPEAT if word == before else word for before, word in zip([None, *words], words)]


def features_of(word: str) -> list[int]:
    """Buckets of a word: itself, then its n-grams between word borders."""
    bordered = f"<{word}>".encode()
    found = [zlib.crc32(bordered)]
    for n in NGRAMS:
        found += [zlib.crc32(bordered[k : k + n]) for k in range(len(bordered) - n + 1)]
    return [x % BUCKETS for x in found]


def bag_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of a document and their share of all its features."""
    counts: Counter[int] = Counter()
    for word, times in Counter(words_of(text)).items():
        for feature in features_of(word):
            counts[feature] += times
    buckets = np.fromiter(counts, np.int64, len(counts))
    shares = np.fromiter(counts.values(), np.float64, len(counts))
    return buckets, shares / max(1.0, shares.sum())


def train(texts: list[str], labels: list[int]) -> np.ndarray:
    """What one feature adds to the score of label 1 against label 0, for each bucket.

    The softmax has no offset, so a text without words scores one half. The
    order of the rows is shuffled with a fixed seed; the rate falls to zero.
    """
    bags = [bag_of(text) for text in texts]
    random = np.random.default_rng(SEED)
    vectors = random.uniform(-1 / WIDTH, 1 / WIDTH, (BUCKETS, WIDTH))
    softmax = np.zeros((2, WIDTH))
    steps, step = EPOCHS * len(bags), 0
    for _ in range(EPOCHS):
        for place in random.permutation(len(bags)):
            rate = RATE * (1 - step / steps)
            step += 1
            buckets, shares = bags[place]
            if not len(buckets):
                continue
            mean = shares @ vectors[buckets]
            odds = np.exp(softmax @ mean - (softmax @ mean).max())
            wrong = -odds / odds.sum()
            wrong[labels[place]] += 1
            back = wrong @ softmax
            softmax += rate * np.outer(wrong, mean)
            vectors[buckets] += rate * np.outer(shares, back)
    return (vectors @ (softmax[1] - softmax[0])).astype(np.float32)


class Scorer:
    """Scores texts with a trained table; remembers what words add, within a bound."""

    def __init__(self, table: np.ndarray) -> None:
        self._table = table
        self._words: dict[str, tuple[float, int]] = {}

    def _word(self, word: str) -> tuple[float, int]:
        features = features_of(word)
        if len(self._words) >= _MOST_KEPT:
            self._words = {}
        found = self._words[word] = float(self._table[features].sum()), len(features)
        return found

    def score(self, text: str) -> float:
        total, features = 0.0, 0
        for word in words_of(text):
            adds, count = self._words.get(word) or self._word(word)
            total += adds
            features += count
        return float(1 / (1 + np.exp(-total / features))) if features else 0.0


def held_out(doc_id: Column) -> Column:
    """Rows kept away from training; rows without an id are not among them."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == 0, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, per_label: int, most_bytes: int) -> list[tuple]:
    """At most ``per_label`` (text, label) rows of each label 0 and 1, none of them held out."""
    usable = labels.where(~held_out(F.col("doc_id")) & F.col("quality").isin(0, 1))
    usable = usable.select("doc_id", F.col("quality").cast("int").alias("label"))
    short = docs.where(F.octet_length("text") <= most_bytes)
    known = usable.join(short.select("doc_id"), "doc_id", "left_semi")
    order = F.xxhash64("doc_id"), F.col("doc_id")
    picked = None
    for label in (0, 1):
        some = known.where(F.col("label") == label).orderBy(*order).limit(per_label)
        picked = some if picked is None else picked.union(some)
    rows = picked.join(short.select("doc_id", "text"), "doc_id").select("doc_id", "text", "label")
    # Repeated rows may exceed the bound again.
    return sorted(rows.orderBy("doc_id", "label", "text").limit(2 * per_label).collect())


def fit(
    docs: DataFrame,
    labels: DataFrame,
    per_label: int = SAMPLE_PER_LABEL,
    most_bytes: int = SAMPLE_BYTES,
) -> np.ndarray:
    """The trained table; zeros, which score all texts with words one half, without rows of both labels."""
    rows = sample(docs, labels, per_label, most_bytes)
    if len({label for _, _, label in rows}) < 2:
        return np.zeros(BUCKETS, np.float32)
    return train([text for _, text, _ in rows], [label for _, _, label in rows])


def score_column(spark: SparkSession, table: np.ndarray) -> Callable[[Column], Column]:
    """Column function: text to score; texts without words, empty and NULL ones, score 0."""
    ship_package(spark)
    shipped = spark.sparkContext.broadcast(table)  # BUCKETS numbers, whatever the data

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shipped.value)
        for texts in batches:
            yield pd.Series([scorer.score(text) for text in texts], dtype="float64")

    return lambda text: run(F.coalesce(text, F.lit("")))


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every row of ``docs``."""
    score = score_column(docs.sparkSession, fit(docs, labels))
    scored = docs.select("doc_id", score(F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= LEAST_SCORE).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are predicted 1, all columns kept."""
    score = score_column(docs.sparkSession, fit(docs, labels))
    return docs.where(score(F.col("text")) >= LEAST_SCORE)
