"""Near-duplicate documents by SimHash, with pivot distance tables.

Every fingerprint gets a row of Hamming distances to fixed reference
fingerprints (pivots). By the triangle inequality two fingerprints that differ
in at most r bits have distances that differ by at most r to each pivot, so a
pair is discarded as soon as one coordinate differs by more; survivors are
verified on their bits.

The pivots are the zero word and, for each of r + 2 blocks of bits, patterns of
ones inside that block only. The distance to such a pattern minus the distance
to zero depends on that block alone. Any r bits leave at least two blocks
untouched, so a pair within r bits agrees on all these differences for some two
blocks: that tuple is the cell under which candidates meet, and no pair is lost.

Cells of more than ``CELL_PAIRS`` members (many versions of one page) are not
paired. There a second set of pivots takes over: a member and its one-bit
neighbours. Two members within one bit of the same pivot are within two bits of
each other, again by the triangle inequality, and two members within two bits
always share such a pivot. A pivot has at most 65 members, each is linked with
the least of them, so the links stay in proportion to the members and connect
exactly what all pairs would connect.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations, islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tidemark.llm.components import connected_components
from tidemark.llm.spans import fresh
from tidemark.session import ship_package, stage

BITS = 64
SHINGLE_WORDS = 3
MAX_BITS = 2
SEED = 42
CELL_PAIRS = 32  # cells up to this size are paired, larger ones go by one-bit pivots
_CHUNK = 1 << 16


def fingerprint_of(raw: bytes | None, words_per_shingle: int) -> int:
    """The fingerprint of UTF-8 text as a signed 64-bit number; 0 without words.

    A bit is set if it is set in over half of the hashes of the shingles, which
    are counted as often as they occur. Texts of any length use bounded memory
    beyond their words.
    """
    words = raw.lower().split() if raw else []
    if not words:
        return 0
    if len(words) < words_per_shingle:
        shingles = iter([b" ".join(words)])
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(words_per_shingle))))
    votes, count = np.zeros(BITS, np.int64), 0
    while chunk := [xxh64_intdigest(shingle, SEED) for shingle in islice(shingles, _CHUNK)]:
        hashes = np.array(chunk, np.uint64).view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(hashes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        count += len(chunk)
    return int(np.packbits(2 * votes > count, bitorder="little").view(np.int64)[0])


def simhash(words_per_shingle: int) -> Callable[[Column], Column]:
    """Column function: text to fingerprint; NULL counts as empty text."""

    @F.pandas_udf("bigint")
    def run(raw: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(x, words_per_shingle) for x in raw], dtype="int64")

    return lambda text: run(F.coalesce(text, F.lit("")).cast("binary"))


def hex16(fingerprint: Column) -> Column:
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))


def _signed(word: int) -> int:
    return word - (1 << BITS) if word >> (BITS - 1) else word


def blocks(max_bits: int) -> list[list[int]]:
    """Bit positions of the max_bits + 2 blocks."""
    return [part.tolist() for part in np.array_split(np.arange(BITS), max_bits + 2)]


def pivots(block: list[int]) -> list[int]:
    """The whole block, and the bits whose place in it has odd parity with k, for every k."""
    patterns = [block]
    for k in range(1, 1 << (len(block) - 1).bit_length()):
        patterns.append([bit for place, bit in enumerate(block) if (place & k).bit_count() % 2])
    return [_signed(sum(1 << bit for bit in pattern)) for pattern in patterns]


def distances(fingerprint: Column, max_bits: int) -> Column:
    """The row of the distance table: to zero, then to the pivots block by block."""
    words = [0] + [pivot for block in blocks(max_bits) for pivot in pivots(block)]
    to = lambda word: F.bit_count(fingerprint.bitwiseXOR(F.lit(word)))
    return F.array(*[to(word).cast("tinyint") for word in words])


def _block_keys(fingerprint: Column, max_bits: int) -> Column:
    """For each block a hash of its pivots' distances less the distance to zero."""
    to_zero = F.bit_count(fingerprint)
    keys = []
    for block in blocks(max_bits):
        to = [F.bit_count(fingerprint.bitwiseXOR(F.lit(pivot))) for pivot in pivots(block)]
        keys.append(F.xxhash64(*[distance - to_zero for distance in to]))
    return F.array(*keys)


def _cells(keys: Column, max_bits: int) -> Column:
    """One cell for each two blocks."""
    pairs = combinations(range(1, max_bits + 3), 2)
    return F.array(
        *[
            F.xxhash64(F.lit(number), F.element_at(keys, a), F.element_at(keys, b))
            for number, (a, b) in enumerate(pairs)
        ]
    )


def _within(a: str, b: str, max_bits: int) -> Column:
    """Largest coordinate difference first, then the bits themselves."""
    apart = F.zip_with(f"{a}.row", f"{b}.row", lambda x, y: F.abs(x - y))
    bits = F.bit_count(F.col(f"{a}.fp").bitwiseXOR(F.col(f"{b}.fp")))
    return (F.array_max(apart) <= max_bits) & (bits <= max_bits)


def links(fingerprints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct fingerprints ``fp`` within ``max_bits``.

    Every link is within ``max_bits``; in crowded cells only as many are given
    as connect the same fingerprints. ``max_bits`` is 1 or 2.
    """
    if max_bits not in (1, 2):
        raise ValueError("max_bits must be 1 or 2")
    row = distances(F.col("fp"), max_bits)
    # Written before they are combined, so that each distance is taken once.
    keyed = stage(
        fingerprints.select("fp", _block_keys(F.col("fp"), max_bits).alias("keys")), "block-keys"
    )
    cells = keyed.select("fp", F.explode(_cells(F.col("keys"), max_bits)).alias("cell"))
    crowds = cells.groupBy("cell").agg(F.count("*").alias("members")).where("members > 1")
    shared = stage(cells.join(crowds, "cell"), "cells")

    paired = shared.where(F.col("members") <= CELL_PAIRS).select("cell", "fp", row.alias("row"))
    a, b = paired.alias("a"), paired.alias("b")
    meet = (F.col("a.cell") == F.col("b.cell")) & (F.col("a.fp") < F.col("b.fp"))
    near = a.join(b, meet).where(_within("a", "b", max_bits))
    near = near.select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))

    crowded = shared.where(F.col("members") > CELL_PAIRS).select("fp").distinct()
    flips = [F.col("fp").bitwiseXOR(F.lit(_signed(1 << bit))) for bit in range(BITS)]
    around = crowded.select("fp", F.explode(F.array("fp", *flips)).alias("pivot"))
    if max_bits == 2:
        # At most 65 distinct words are within one bit of a pivot.
        stars = around.groupBy("pivot").agg(
            F.min("fp").alias("a"), F.collect_list("fp").alias("fps")
        )
        stars = stars.where(F.size("fps") > 1).select("a", F.explode("fps").alias("b"))
    else:
        at = crowded.select(F.col("fp").alias("pivot"))
        stars = around.join(at, "pivot").select(F.col("pivot").alias("a"), F.col("fp").alias("b"))
    return near.union(stars.where(F.col("a") != F.col("b")))


def near_duplicates(
    docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` for every row of ``docs``.

    Rows are linked by their fingerprints only; equal ids do not link rows.
    Documents without words have fingerprint 0 and are linked like any other.
    ``component_id`` is the least id reachable, NULL ids left out, and NULL if
    there is no other; a repeated row is returned as often as it occurs. Copies
    meet as one fingerprint, so exact copies are never paired.
    """
    ship_package(docs.sparkSession)
    rows = stage(docs.select("doc_id", simhash(words_per_shingle)(F.col("text")).alias("fp")), "fps")
    distinct = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("lowest")), "distinct-fps")
    groups = connected_components(links(distinct, max_bits), "a", "b")
    rooted = stage(
        distinct.join(groups, distinct["fp"] == groups["node"], "left").select(
            "fp", "lowest", F.coalesce("component", "fp").alias("root")
        ),
        "rooted-fps",
    )
    least = stage(rooted.groupBy("root").agg(F.min("lowest").alias("component_id")), "least-ids")
    named = stage(rooted.join(least, "root").select("fp", "component_id"), "named-fps")
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one(
    docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """The rows of ``docs`` with the least id of each group, all columns kept.

    Ids name documents: rows that share an id stay or go together, and rows that
    share id and text count once. Rows without an id stay only for groups in
    which no row has one, one row for each such group.
    """
    rows = stage(near_duplicates(docs, words_per_shingle, max_bits), "groups")
    own = fresh(docs.columns, "kept_id")
    kept = rows.where("component_id is not null").select(F.col("component_id").alias(own)).distinct()
    named = (
        docs.where("doc_id is not null")
        .join(kept, F.col("doc_id") == F.col(own), "left_semi")
        .dropDuplicates(["doc_id", "text"])
    )
    nameless = _nameless(docs, rows, words_per_shingle, max_bits)
    return named if nameless is None else named.unionByName(nameless)


def _nameless(
    docs: DataFrame, rows: DataFrame, words_per_shingle: int, max_bits: int
) -> DataFrame | None:
    """One row without an id for each group that has no id at all; None if there is no such group."""
    alone = rows.where("component_id is null").select("fp").distinct()
    if alone.isEmpty():
        return None
    groups = connected_components(links(alone, max_bits), "a", "b")
    kept = alone.join(groups, alone["fp"] == groups["node"], "left_anti")
    own = fresh(docs.columns, "fp")
    fp = simhash(words_per_shingle)(F.col("text")).alias(own)
    without = docs.where("doc_id is null").select("*", fp)
    chosen = without.join(kept.select(F.col("fp").alias(own)), own, "left_semi")
    return chosen.dropDuplicates([own]).drop(own)
