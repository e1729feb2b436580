"""Importance resampling and the sort behind its ranks."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_helpers import docs_of, texts  # noqa: F401 (fixtures)

from tidemark.llm import regular_sort, resampling
from tidemark.llm.plans import QUERIES
from tidemark.sources.tables import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text):
    words = WORD.findall((text or "").translate(ASCII_LOWER))
    features = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [zlib.crc32(f.encode()) % 10000 for f in features]


def plain(docs, target):
    """The whole contract, row by row."""
    found = [plain_features(text) for _, text in docs]
    s, t = [0] * 10000, [0] * 10000
    for _, buckets in found:
        for b in buckets:
            s[b] += 1
    for text in target:
        for b in plain_features(text)[1]:
            t[b] += 1
    all_s, all_t = sum(s), sum(t)
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
        for b in range(10000)
    ]
    rows = []
    for (doc_id, _), (n_words, buckets) in zip(docs, found):
        weight = math.floor(sum(gain[b] for b in buckets) / len(buckets)) if buckets else 0
        name = "7:" + ("" if doc_id is None else str(doc_id))
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(buckets), weight, score, None, n_words])
    fit = sorted(
        (r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0)
    )
    for rank, row in enumerate(fit[: 25 * len(fit) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def test_whole_table_equals_the_plain_form(spark):
    folder = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in table(spark, folder, "documents").select("doc_id", "text").collect()]
    target = [r["text"] for r in table(spark, folder, "benchmark").collect()]
    df = QUERIES["op11_resampling"](spark, folder)
    assert df.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in df.collect()), key=repr) == plain(docs, target)


def test_odd_rows(spark, docs_of, texts):
    docs = list(enumerate(texts)) + [(None, texts[3]), (None, None), (500, None), (7, texts[7])]
    docs += [(7, texts[7])] * 3 + [(-4, "İK ſ ÀÉ Kelvin ß ÿ\x7f\x80x" * 30)]
    target = [None, "", texts[0], "the of and"]
    held = docs_of(docs).withColumns({n: F.lit(n) for n in ("rank", "n", "bucket", "row", "range")})
    goal = spark.createDataFrame([(t, "x") for t in target], "text string, n string")
    out = resampling.resampled(held, goal).drop("n_words")
    assert sorted((tuple(r) for r in out.collect()), key=repr) == plain(docs, target)


def test_no_rows(spark, docs_of):
    none = docs_of([])
    assert resampling.resampled(none, none).collect() == []
    only = resampling.resampled(docs_of([(1, "a b")]), none).drop("n_words")
    assert [tuple(r) for r in only.collect()] == plain([(1, "a b")], [])


def test_long_texts_in_windows(monkeypatch, texts):
    odd = texts + ["é" * 200 + " b " + "x" * 70 + " y", "a" * 64 + " " + "b" * 64 + " " + "c" * 65]
    for window in (1, 7, 1 << 20):
        monkeypatch.setattr(resampling, "_WINDOW", window)
        for text in odd:
            if window == 1 and len(text) > 6000:
                continue
            parts = list(resampling.feature_buckets(text))
            words, buckets = plain_features(text)
            assert sum(n for n, _ in parts) == words
            assert sorted(b for _, found in parts for b in found.tolist()) == sorted(buckets)


@pytest.mark.parametrize("kind", ["spread", "one score", "one row"])
def test_ranks_and_balance(spark, kind):
    source = random.Random(5)
    rows = {
        "spread": [(source.randint(-50, 50), source.choice([None, *range(40)])) for _ in range(4000)],
        "one score": [(3, i) for i in range(4000)],
        "one row": [(3, 9)] * 4000,
    }[kind]
    df = spark.createDataFrame(rows, "score bigint, id bigint").repartition(7)
    out = regular_sort.ranked(df, "score", "id", rows_per_range=500)
    per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_task) >= 7 and max(per_task) < 1500
    got = sorted((r["rank"], r["score"], r["id"]) for r in out.collect())
    assert [r[0] for r in got] == list(range(1, 4001))
    expected = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
    assert [r[1:] for r in got] == expected


def test_keys_compare_as_numbers():
    source = np.random.default_rng(1)
    columns = [source.integers(-3, 3, 500) << k for k in (0, 40, 61)]
    keys = regular_sort._comparable(regular_sort.packed_keys(columns))
    assert np.array_equal(np.argsort(keys, kind="stable"), np.lexsort(columns[::-1]))
