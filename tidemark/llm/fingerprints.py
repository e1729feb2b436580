"""Document fingerprints: SimHash with weighted terms, searched by permuted block tables.

The hash of every term votes on 64 signed counters with the weight of the term;
the signs are the fingerprint. For a Hamming radius r the bits are cut into
r + 2 blocks. Words within r bits agree on at least two blocks, so there is one
table for each two blocks, keyed by their bits, and a search looks up its own
key in each table and compares the words found there.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.session import new_path, ship_package, stage

BITS = 64
SEED = 42
RADIUS = 3
QUERY_STEP = 100
CHUNK = 512  # fingerprints of one key that are compared as one array
FINE = 8  # quantiles of the ids for each range of them
_WEIGHT_STEPS = 16
_LEAST_ID = -(1 << 63)
_TERMS = 1 << 16


def weighted_fingerprint(raw: bytes) -> int:
    """Fingerprint of UTF-8 text as a signed number; 0 without terms.

    Terms are words in lower case (A to Z); a term that occurs n times votes
    with 1 + ln n, in whole sixteenths, so that sums are exact.
    """
    counts = Counter(raw.lower().split())
    votes = np.zeros(BITS, np.int64)
    terms = list(counts.items())
    for at in range(0, len(terms), _TERMS):
        part = terms[at : at + _TERMS]
        hashes = np.array([xxh64_intdigest(term, SEED) for term, _ in part], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        times = np.array([n for _, n in part], np.float64)
        weights = np.rint(_WEIGHT_STEPS * (1 + np.log(times)))
        votes += (2 * (weights @ bits) - weights.sum()).astype(np.int64)
    return int(np.packbits(votes > 0, bitorder="little").view(np.int64)[0])


def likeness(a: Column, b: Column) -> Column:
    """Share of equal bits."""
    return F.lit(1.0) - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def half_replaced(text: str, following: str) -> str:
    """The last half of the code points gives way to as many from the start of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


# ------------------------------------------------------- text and its successor

_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fp", pa.int64()),
        ("edited_fp", pa.int64()),
        ("next_fp", pa.int64()),
    ]
)


def _dealt(docs: DataFrame, parts: int) -> DataFrame:
    """Rows by ranges of ids, one range a task, each with a copy of the document that follows it.

    The ranges come from ``FINE`` times as many quantiles of the ids. An id that
    is a quantile more than once, or the missing id, holds that many shares of
    the rows and is cut into as many ranges by a hash of the text; only then are
    texts read to find the ranges. The quantiles and at most one first row's id
    and hash for each range reach the driver. The text is shuffled once.
    """
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(_LEAST_ID)).alias("key")
    shares = ",".join(f"{k / (FINE * parts)}D" for k in range(1, FINE * parts))
    found = docs.select(key).agg(
        F.percentile_approx("key", F.expr(f"array({shares})"), F.lit(100 * parts))
    )
    borders = sorted(found.first()[0] or [])
    repeated = len(set(borders)) < len(borders)
    text = F.coalesce("text", F.lit("")).alias("text")
    tie = (F.xxhash64(text) if repeated else F.lit(0).cast("bigint")).alias("tie")

    @F.pandas_udf("int")
    def part_of(key: pd.Series, tie: pd.Series) -> pd.Series:
        keys, known = key.to_numpy(np.int64), np.array(borders, np.int64)
        first = np.searchsorted(known, keys)
        held = np.maximum(1, np.searchsorted(known, keys, side="right") - first)
        share = tie.to_numpy(np.int64) / 2.0**64 + 0.5  # rises with the hash, from 0 to 1
        place = first + np.minimum((share * held).astype(np.int64), held - 1)
        return pd.Series((place // FINE).astype(np.int32))

    ranges = docs.select(key, tie).select("*", part_of("key", "tie").alias("part"))
    heads = ranges.groupBy("part").agg(F.max(F.struct("key", "tie"))).collect()
    heads = sorted(((part, tuple(head)) for part, head in heads), reverse=True)
    # The head of a range follows the range above it; the first follows the last.
    receivers = {head: heads[k - 1][0] for k, (_, head) in enumerate(heads)}

    @F.pandas_udf("int")
    def also_to(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        keys = np.array([key for key, _ in receivers], np.int64)
        for key, tie in batches:
            to = np.full(len(key), -1, np.int32)
            for row in np.flatnonzero(np.isin(key.to_numpy(np.int64), keys)):
                to[row] = receivers.get((key.iloc[row], tie.iloc[row]), -1)
            yield pd.Series(to)

    rows = docs.select("doc_id", text, key, tie)
    rows = rows.select(
        "*", part_of("key", "tie").alias("own"), also_to("key", "tie").alias("other")
    )
    to = F.array(
        F.struct(F.col("own").alias("part"), F.lit(False).alias("copy")),
        F.struct(F.col("other").alias("part"), F.lit(True).alias("copy")),
    )
    return (
        rows.select("doc_id", "text", "key", "tie", F.inline(F.filter(to, lambda x: x["part"] >= 0)))
        .repartitionById(parts, F.col("part"))
        .sortWithinPartitions("part", "copy", F.desc("key"), F.desc("tie"), "text")
        .select("part", "copy", "doc_id", "text")
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text, of its edited text and of the next document.

    The next document is the one with the next lower id; after the last comes
    the first, and a single document follows itself. NULL text counts as empty,
    NULL ids come after all others, and equal ids are in a fixed order by hash
    and text, so that a frequent or missing id fills many tasks. Every row,
    repeated ones too, has a row in the result; no rows give no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = None  # the row still waiting for its successor
        for batch in batches:
            out: list[list] = [[] for _ in _OUT]
            copies = batch.column(1).to_pylist()
            rows = zip(batch.column(0).to_pylist(), copies, batch.column(2).to_pylist())
            for (part, copy, doc_id), text in zip(rows, batch.column(3)):
                text = text.as_py()
                fp = weighted_fingerprint(text.encode())
                if before and before[0] == part:
                    _, was_id, was, was_fp = before
                    edited = half_replaced(was, text).encode()
                    sha = hashlib.sha256(edited).hexdigest()
                    row = (was_id, len(was), sha, was_fp, weighted_fingerprint(edited), fp)
                    for column, value in zip(out, row):
                        column.append(value)
                before = None if copy else (part, doc_id, text, fp)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(out, _OUT)], schema=_OUT
            )

    return _dealt(docs, parts).mapInArrow(
        run,
        "doc_id bigint, n_chars bigint, edited_sha256 string, fp bigint, edited_fp bigint,"
        " next_fp bigint",
    )


# ---------------------------------------------------------------- near search


def _masks(radius: int) -> list[int]:
    """For each table, the bits of its two blocks as a signed word."""
    parts = np.array_split(np.arange(BITS), radius + 2)
    words = [sum(1 << int(bit) for bit in part) for part in parts]
    pairs = [a | b for a, b in combinations(words, 2)]
    return [word - (1 << BITS) if word >> (BITS - 1) else word for word in pairs]


def _entries(fps: DataFrame, masks: list[int]) -> DataFrame:
    keys = [
        F.struct(F.lit(k).alias("place"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key"))
        for k, mask in enumerate(masks)
    ]
    return fps.select("*", F.inline(F.array(*keys)))


def near_pairs(fps: DataFrame, queries: DataFrame, radius: int = RADIUS) -> DataFrame:
    """For each distinct ``fp`` of ``queries``, what distinct ``found`` of ``fps`` lie within ``radius`` bits.

    One row per pair with the number of differing ``bits`` and ``n``, the rows of
    ``fps`` with ``found``. A fingerprint finds itself at 0 bits; NULL finds
    nothing. Pairs of a query are bounded by the words within the radius, not by
    the rows. The documents are those of ``fps`` by ``found``.

    Equal fingerprints are counted first, so copies are looked at once. Only
    keys that a query asks for are kept. What is filed under one key is cut into
    arrays of about ``CHUNK`` words by their hash, so a key shared by a large
    share of all words becomes many arrays, each compared in one go. A pair that
    meets in several tables counts in the first of them.
    """
    masks = _masks(radius)
    counted = stage(fps.groupBy("fp").agg(F.count("*").alias("n")), "counted-fps")
    asked = stage(_entries(queries.select("fp").distinct(), masks), "asked-keys")
    asked_keys = asked.select("place", "key")
    filed = stage(_entries(counted, masks).join(asked_keys, ["place", "key"], "left_semi"), "filed")
    sizes = stage(
        filed.groupBy("place", "key").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")), "key-sizes"
    )
    chunks = (
        filed.join(sizes, ["place", "key"])
        .groupBy("place", "key", F.pmod(F.xxhash64("fp"), "chunks").alias("chunk"))
        .agg(F.collect_list(F.struct("fp", "n")).alias("words"))
    )
    meets = asked.withColumnRenamed("fp", "query").join(chunks, ["place", "key"])
    all_masks = F.array(*map(F.lit, masks))

    def counts(word: Column) -> Column:
        apart = word["fp"].bitwiseXOR(F.col("query"))
        first = F.array_position(
            F.transform(all_masks, lambda mask: apart.bitwiseAND(mask) == 0), True
        )
        return (F.bit_count(apart) <= radius) & (first == F.col("place") + 1)

    return meets.select("query", F.explode(F.filter("words", counts)).alias("word")).select(
        F.col("query").alias("fp"),
        F.col("word.fp").alias("found"),
        F.bit_count(F.col("word.fp").bitwiseXOR(F.col("query"))).alias("bits"),
        F.col("word.n").alias("n"),
    )


def _is_query(step: int) -> Column:
    return F.coalesce(F.col("doc_id") % step == 0, F.lit(False))


def write_near(rows: DataFrame, path: str, radius: int = RADIUS, step: int = QUERY_STEP) -> None:
    """Writes the search of ids divisible by ``step`` as two tables under ``path``.

    ``pairs`` is what ``near_pairs`` gives, ``members`` has the ``fp`` and
    ``doc_id`` of every row; joined on ``found`` they name the documents.
    """
    rows.select("fp", "doc_id").write.parquet(f"{path}/members")
    members = rows.sparkSession.read.parquet(f"{path}/members")
    pairs = near_pairs(members.select("fp"), members.where(_is_query(step)), radius)
    pairs.write.parquet(f"{path}/pairs")


def with_near(rows: DataFrame, radius: int = RADIUS, step: int = QUERY_STEP) -> DataFrame:
    """Adds ``n_near``: other rows within ``radius`` bits, for ids divisible by ``step``, else NULL."""
    stored = stage(rows, "fingerprints")
    is_query = _is_query(step)
    queries = stored.where(is_query)
    pairs = stage(near_pairs(stored.select("fp"), queries, radius), "near-pairs")
    found = pairs.groupBy("fp").agg(F.sum("n").alias("n_within"))
    answered = queries.join(found, "fp").withColumn("n_near", F.col("n_within") - 1)
    rest = stored.where(~is_query).withColumn("n_near", F.lit(None).cast("bigint"))
    return answered.select(*rest.columns).unionByName(rest)


def near_documents(rows: DataFrame, radius: int = RADIUS, step: int = QUERY_STEP) -> DataFrame:
    """Each fingerprint of ids divisible by ``step`` with every document found within ``radius`` bits.

    Copies of a query are asked once: one row per query fingerprint and row of ``rows``.
    """
    path = new_path(rows.sparkSession, "near")
    write_near(rows, path, radius, step)
    read = rows.sparkSession.read.parquet
    members = read(f"{path}/members").withColumnRenamed("fp", "found")
    return read(f"{path}/pairs").join(members, "found").select("fp", "found", "bits", "doc_id")
