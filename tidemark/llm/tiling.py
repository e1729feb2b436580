"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are compared as word sequences. Runs of
``SEED_WORDS`` words that both share are the seeds: only documents with a seed
are looked at further, and of those only the words around seeds. For a document
and an item the longest match of unmarked words is marked again and again, as
one tile, until no match of at least ``SEED_WORDS`` words is left; hashes of all
windows of one length come from one running Karp-Rabin hash, and every match is
verified word by word. Tiles may lie in any order, so passages that were cut up
and reordered are found. A document is contaminated by an item of which at least
``COVERAGE`` of the words are tiled.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spans import fresh
from tidemark.session import ship_package, stage

SEED_WORDS = 5
COVERAGE = 0.6
BLOCK_BYTES = 8 << 20  # benchmark text that is shipped to every task at once
_BASE = np.uint64(0x9E3779B97F4A7C15)
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Words in lower case; punctuation, spacing and underscores at the edge of words do not count."""
    return _WORD.findall(text.lower()) if text else []


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes (modulo 2^64) of all windows of ``width`` words."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    hashes = np.zeros(count, np.uint64)
    doubled, block, done = words.astype(np.uint64), 1, 0
    power = np.array([_BASE])  # base to the power of block; arrays wrap around silently
    while True:
        if width & block:
            # Put a window of ``block`` words behind the ``done`` words covered.
            hashes = hashes * power + doubled[done : done + count]
            done += block
        if done == width:
            return hashes
        doubled = doubled[: len(doubled) - block] * power + doubled[block:]
        power, block = power * power, block * 2


def _longest(doc: np.ndarray, item: np.ndarray, least: int, most: int) -> int:
    """Greatest width up to ``most`` at which both share a window; 0 if below ``least``."""
    if most < least or not _meets(doc, item, least).any():
        return 0
    while least < most:
        middle = (least + most + 1) // 2
        if _meets(doc, item, middle).any():
            least = middle
        else:
            most = middle - 1
    return least


def _meets(doc: np.ndarray, item: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``doc``, whether it has no marked word and is a window of ``item``."""
    mine, theirs = window_hashes(doc, width), window_hashes(item, width)
    return np.isin(mine, theirs[_clear(item, width)]) & _clear(doc, width)


def _clear(words: np.ndarray, width: int) -> np.ndarray:
    """Whether a window has no marked word (0)."""
    marked = np.concatenate([[0], np.cumsum(words == 0)])
    if len(words) < width:
        return np.zeros(0, bool)
    return marked[width:] == marked[:-width]


def tiles(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (place in doc, place in item, width), widest first.

    Words are positive numbers, 0 in ``doc`` stands for any word that is not in
    ``item``. Of equal widths the first place in the item and then in the
    document is taken. Ends when no shared run of ``least`` unmarked words is left.
    """
    doc, item = doc.astype(np.uint64), item.astype(np.uint64)
    found = []
    width = min(len(doc), len(item))
    while width := _longest(doc, item, least, width):
        in_doc, in_item = window_hashes(doc, width), window_hashes(item, width)
        places: dict[int, list[int]] = {}
        for place in np.flatnonzero(_meets(doc, item, width)):
            places.setdefault(int(in_doc[place]), []).append(int(place))
        marked = False
        known = np.array(list(places), np.uint64)
        for start in np.flatnonzero(np.isin(in_item, known) & _clear(item, width)):
            if not item[start : start + width].all():
                continue  # a tile of this round covers part of it
            for place in places[int(in_item[start])]:
                window = doc[place : place + width]
                if window.all() and (window == item[start : start + width]).all():
                    found.append((place, int(start), width))
                    doc[place : place + width] = 0
                    item[start : start + width] = 0
                    marked = True
                    break
        if not marked:
            width -= 1  # only a collision of hashes met
    return found


class Benchmark:
    """Word numbers and seeds of a block of benchmark items."""

    def __init__(self, items: list[tuple[int, str]], seed_words: int) -> None:
        self.seed_words = seed_words
        self.numbers: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        for item_id, text in items:
            ids = [self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text)]
            if len(ids) >= seed_words:
                self.items.append((item_id, np.array(ids, np.uint64)))
        seeds, owners = [], []
        for place, (_, ids) in enumerate(self.items):
            hashes = np.unique(window_hashes(ids, seed_words))
            seeds.append(hashes)
            owners.append(np.full(len(hashes), place))
        self.seeds = np.concatenate(seeds) if seeds else np.zeros(0, np.uint64)
        order = np.argsort(self.seeds, kind="stable")
        self.seeds = self.seeds[order]
        self.owners = np.concatenate(owners)[order] if owners else np.zeros(0, np.int64)

    def matches(self, text: str | None) -> Iterator[tuple[int, int, int, int]]:
        """Item id, tiles, tiled words and words of the item, for items that share a seed."""
        number = self.numbers.get
        doc = np.array([number(word, 0) for word in words_of(text)], np.uint64)
        hashes = window_hashes(doc, self.seed_words)
        first = np.searchsorted(self.seeds, hashes)
        after = np.searchsorted(self.seeds, hashes, side="right")
        hits = np.flatnonzero((first < after) & _clear(doc, self.seed_words))
        if not len(hits):
            return
        near = np.zeros(len(doc), bool)
        for step in range(self.seed_words):
            near[hits + step] = True
        spans = np.unique(np.stack([first[hits], after[hits]]), axis=1).T
        owners = {owner for a, b in spans for owner in self.owners[a:b].tolist()}
        # Stretches without a seed shrink to one marked word.
        around = near | np.concatenate([near[1:], [False]])
        doc = np.where(near, doc, 0)[around]
        for owner in sorted(owners):
            item_id, ids = self.items[owner]
            # Words of other items cannot match; they stay as they are.
            found = tiles(doc, ids, self.seed_words)
            yield item_id, len(found), sum(width for _, _, width in found), len(ids)


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("n_tiles", pa.int64()),
        ("tiled_words", pa.int64()),
        ("item_words", pa.int64()),
    ]
)


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_bytes``, by their hash; each is collected on its own."""
    items = benchmark.select(F.col("item_id").cast("bigint"), "text").where("text is not null")
    items = stage(items, "benchmark-items")
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = max(1, math.ceil(total / block_bytes))
    for number in range(count):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number)
        yield sorted(map(tuple, part.collect()), key=repr)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    seed_words: int = SEED_WORDS,
    coverage: float = COVERAGE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Pairs of documents and items of which the document contains at least ``coverage``.

    Columns ``doc_id``, ``item_id``, ``n_tiles``, ``tiled_words``, ``item_words``,
    ``coverage``. Every document is read whole, once for each block of the
    benchmark; nothing of the documents is shuffled. The size of the benchmark
    is summed up first: what exceeds ``block_bytes`` goes to further blocks, so
    what tasks hold is bounded. Items of fewer than ``seed_words`` words are too
    short to tell a leak from chance and match nothing. NULL and empty texts match nothing; a repeated document or item is
    reported as often as it occurs.
    """
    spark = docs.sparkSession
    ship_package(spark)
    source = docs.select(F.col("doc_id").cast("bigint"), "text")
    result = None
    for block in _blocks(benchmark, block_bytes):
        shipped = spark.sparkContext.broadcast(Benchmark(block, seed_words))

        def run(
            batches: Iterator[pa.RecordBatch], shipped=shipped
        ) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out: list[list] = [[] for _ in _OUT]
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for row in shipped.value.matches(text.as_py()):
                        if row[2] >= coverage * row[3]:
                            for column, value in zip(out, (doc_id, *row)):
                                column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(out, _OUT)], schema=_OUT
                )

        found = source.mapInArrow(
            run,
            "doc_id bigint, item_id bigint, n_tiles bigint, tiled_words bigint, item_words bigint",
        )
        result = found if result is None else result.union(found)
    return result.withColumn("coverage", F.col("tiled_words") / F.col("item_words"))


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without contaminated documents, all columns kept.

    Rows are told apart by a hash of their text beside the id, so rows without
    an id are judged on their own text and rows that share an id as well.
    """
    mark = F.xxhash64("doc_id", "text")
    marked = contamination(
        docs.select(mark.alias("doc_id"), "text"), benchmark, **options
    )
    own = fresh(docs.columns, "bad")
    bad = stage(marked.select(F.col("doc_id").alias(own)).distinct(), "contaminated")
    return docs.join(bad, mark == F.col(own), "left_anti")
