"""Packing of tokenized documents into sequences by bounded-space online best fit.

Each task takes its pieces one by one, the longest first, and holds a fixed
number of open bins.
A bitset has one bit for each amount of free space that an open bin has, so the
tightest bin that still takes a piece is the lowest set bit at or above the
piece's length. When a new bin is needed and all are open, the fullest closes.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import SEPARATOR_ID, pieces_of
from tidemark.session import ship_package, stage

SEQUENCE_TOKENS = 2048
OPEN_BINS = 1 << 14
PIECES_PER_TASK = 50_000
_TASK_BITS = 40

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)
_PLACED = _PIECES.append(pa.field("sequence_id", pa.int64())).append(
    pa.field("offset", pa.int64())
)


class OpenBins:
    """At most ``most`` open bins of ``size`` units; bins are numbered as they are opened."""

    def __init__(self, size: int, most: int) -> None:
        self.size, self.most = size, most
        self.opened = self.open = 0
        self.spaces = 0  # bit s is set while an open bin has s units left
        self.bins: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, space: int) -> int:
        number = self.bins[space].pop()
        if not self.bins[space]:
            self.spaces &= ~(1 << space)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset of a piece of 1 to ``size`` units."""
        fitting = self.spaces >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            number = self._take(space)
        else:
            space, number = self.size, self.opened
            self.opened += 1
            if length < space and self.open == self.most:
                self._take((self.spaces & -self.spaces).bit_length() - 1)
        if rest := space - length:
            self.bins[rest].append(number)
            self.spaces |= 1 << rest
            self.open += 1
        return number, self.size - space


def cut(total: int, size: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces: all full but the first."""
    if total <= size:
        return [(0, total)]
    first = total % size or size
    return [(0, first)] + [(at, size) for at in range(first, total, size)]


def token_pieces(
    docs: DataFrame, tokenizer: str, size: int = SEQUENCE_TOKENS, ranks: str | None = None
) -> DataFrame:
    """One row per piece of every document: its place and the CRC-32 of its ids.

    A document is its ids and one separator; NULL text counts as empty, so it
    still is one separator. Equal rows give equal pieces. ``ranks`` may name the
    same vocabulary as ranks, which is read faster.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = pieces_of(tokenizer, ranks=ranks)
        separator = np.array([SEPARATOR_ID], "<u4").tobytes()
        for batch in batches:
            out: list[list] = [[] for _ in _PIECES]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = memoryview(bpe.encode(text.as_py() or "") + separator)
                for number, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    for column, value in zip(out, (doc_id, number, start, length, crc)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(out, _PIECES)], schema=_PIECES
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def pack(
    pieces: DataFrame,
    size: int = SEQUENCE_TOKENS,
    open_bins: int = OPEN_BINS,
    pieces_per_task: int = PIECES_PER_TASK,
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset``; the places of a sequence have no gaps.

    Pieces are dealt out evenly, whatever their ids, to tasks of about
    ``pieces_per_task``; each task fills sequences of its own. Memory is bounded
    by the open bins. An empty input gives an empty result.
    """
    stored = stage(pieces, "pieces")
    tasks = max(2, math.ceil(stored.count() / pieces_per_task))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(size, open_bins)
        base = TaskContext.get().partitionId() << _TASK_BITS
        for batch in batches:
            placed = [bins.place(length) for length in batch.column("length").to_pylist()]
            sequence = pa.array([base + number for number, _ in placed], pa.int64())
            offset = pa.array([at for _, at in placed], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, sequence, offset], schema=_PLACED)

    dealt = stored.repartition(tasks)
    return dealt.sortWithinPartitions(F.desc("length"), "doc_id", "piece").mapInArrow(
        run,
        "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint,"
        " sequence_id bigint, offset bigint",
    )
