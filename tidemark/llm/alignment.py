"""Alignment of the tokens that two tokenizers make of the same texts.

Token ids are lists in Arrow arrays. Flattened lists with their parents'
numbers and cumulative byte lengths give the end of every token. A hash join on
(document, end) finds the ends that both sides share; the full outer form of
the same join lists every stretch between two neighbouring ends, which is one
overlap of an A token with a B token. How many documents hold an id pair is
counted in parts, one per chunk of texts, which Spark adds up; each chunk gets
the sums of its own pairs back, so no table of all pairs goes to every task.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import _PLAIN, rank_encoding
from tidemark.session import ship_package, stage

BLOCK_BYTES = 1 << 20  # of text, aligned as one table
CHUNK_BYTES = 8 << 20  # of text, counted as one part
_DOC_SHIFT = 40
#: Runs from this length on go to the reference tokenizer, whose time stays in proportion.
_LONG_RUN = re.compile(r"\S{400}|\s{400}")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Side A: a byte-level vocabulary; special tokens' strings are plain text.

    ``ranks`` may name the same vocabulary as ranks, which is read faster. It
    serves for texts whose cutting is known to be the same.
    """

    def __init__(self, path: str, ranks: str | None = None) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        letters = _byte_letters()
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=False)
        self.tokens = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            self.tokens[k] = bytes(letters[c] for c in token)
        self._fast = None
        if ranks:
            self._fast = rank_encoding(ranks)

    def encode(self, text: str) -> np.ndarray:
        if self._fast and _PLAIN.fullmatch(text) and not _LONG_RUN.search(text):
            return self._fast.encode_to_numpy(text, disallowed_special=()).astype(np.int32)
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, np.int32)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        return [self.encode(" " + text) for text in texts]


class Pieces:
    """Side B: a piece vocabulary with byte fallback, which adds the leading space itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        model = self._model
        self.tokens = [
            bytes([int(piece[3:5], 16)]) if model.is_byte(k) else piece.replace("▁", " ").encode()
            for k, piece in ((k, model.id_to_piece(k)) for k in range(model.get_piece_size()))
        ]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int32) for ids in self._model.encode(texts, num_threads=1)]


def _cells(count: int, marks: str) -> tuple[np.ndarray, np.ndarray]:
    """Decimal ids followed by each mark, as rows of bytes, and which bytes of them count.

    Row ``len(marks) * id + k`` has the mark number k.
    """
    width = len(str(count - 1)) + 1
    names = [f"{k}{mark}".encode() for k in range(count) for mark in marks]
    cells = np.array(names, f"S{width}").view(np.uint8).reshape(-1, width)
    return cells, cells != 0


class Aligner:
    def __init__(self, a_path: str, b_path: str, a_ranks: str | None = None) -> None:
        self.a, self.b = ByteLevel(a_path, a_ranks), Pieces(b_path)
        self._lengths = [pa.array([len(t) for t in s.tokens], pa.int64()) for s in (self.a, self.b)]
        width = max(len(str(len(s.tokens) - 1)) for s in (self.a, self.b)) + 1
        self._text = []
        for side, marks in ((self.a, ",|"), (self.b, ",;")):
            cells, held = _cells(len(side.tokens), marks)
            pad = ((0, 0), (0, width - cells.shape[1]))
            self._text.append((np.pad(cells, pad), np.pad(held, pad)))

    def tokens(self, texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both sides; none where the joined bytes are not those of the text."""
        sides = [self.a.encode_all(texts), self.b.encode_all(texts)]
        none = np.empty(0, np.int32)
        for k, text in enumerate(texts):
            wanted = b" " + text.encode()
            for side, ids in zip((self.a, self.b), sides):
                if not text or b"".join(map(side.tokens.__getitem__, ids[k].tolist())) != wanted:
                    sides[0][k] = sides[1][k] = none
                    break
        return sides[0], sides[1]

    def _ends(self, ids: list[np.ndarray], lengths: pa.Array, name: str) -> tuple[pa.Table, pa.Array]:
        """One row per token: its key, made of document number and end, and its place."""
        offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
        flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
        sums = pc.cumulative_sum(lengths.take(flat)).to_numpy()
        before = np.concatenate([[0], sums])[offsets[:-1]]
        parents = parent.to_numpy()
        keys = (parents.astype(np.int64) << _DOC_SHIFT) + sums - before[parents]
        places = np.arange(len(keys))
        return pa.table({"key": keys, name: places}), flat

    def align(self, texts: list[str]) -> tuple[list[tuple], pa.Table]:
        """(n_a, n_b, n_groups, n_links, groups_sha256) of every text, and the pairs that each holds.

        The table has the number of the text, the pair (A id times the number of
        B ids, plus B id) and how often it is linked there.
        """
        ids_a, ids_b = self.tokens(texts)
        table_a, flat_a = self._ends(ids_a, self._lengths[0], "a")
        table_b, flat_b = self._ends(ids_b, self._lengths[1], "b")
        joined = table_a.join(table_b, "key", join_type="full outer", use_threads=False)
        joined = joined.sort_by("key").combine_chunks()
        both = pc.and_(joined["a"].is_valid(), joined["b"].is_valid()).to_numpy()
        key = joined["key"].to_numpy()
        doc = key >> _DOC_SHIFT
        # The last end of a text is shared, so nothing is filled from the next text.
        a = pc.fill_null_backward(joined["a"]).to_numpy()
        b = pc.fill_null_backward(joined["b"]).to_numpy()
        flat_a, flat_b = flat_a.to_numpy(), flat_b.to_numpy()
        pairs = flat_a[a].astype(np.int64) * len(self.b.tokens) + flat_b[b]
        held = pa.table({"doc": doc, "pair": pairs}).group_by(["doc", "pair"], use_threads=False)
        held = held.aggregate([([], "count_all")]).rename_columns(["doc", "pair", "times"])

        n = len(texts)
        n_links = np.bincount(doc, minlength=n)
        n_groups = np.bincount(doc[both], minlength=n)
        digests = self._digests(
            flat_a, flat_b, table_a["key"].to_numpy(), table_b["key"].to_numpy(),
            key[both], a[both], b[both], n,
        )
        return [
            (len(ids_a[k]), len(ids_b[k]), int(n_groups[k]), int(n_links[k]), digests[k])
            for k in range(n)
        ], held

    def _digests(self, flat_a, flat_b, key_a, key_b, shared, last_a, last_b, n: int) -> list[str]:
        """SHA-256 of the groups' text for each of ``n`` texts; '' without tokens."""
        if not len(shared):
            return [""] * n
        group_a, group_b = np.searchsorted(shared, key_a), np.searchsorted(shared, key_b)
        # A group is its A tokens, then its B tokens.
        b_before = np.concatenate([[0], last_b[:-1] + 1])
        at_a = np.arange(len(flat_a)) + b_before[group_a]
        at_b = np.arange(len(flat_b)) + last_a[group_b] + 1
        size = len(flat_a) + len(flat_b)
        cells = np.empty((size, self._text[0][0].shape[1]), np.uint8)
        held = np.empty(cells.shape, bool)
        for at, flat, key, (text, used) in (
            (at_a, flat_a, key_a, self._text[0]),
            (at_b, flat_b, key_b, self._text[1]),
        ):
            group = group_a if flat is flat_a else group_b
            row = 2 * flat.astype(np.int64) + (shared[group] == key)
            cells[at], held[at] = text[row], used[row]
        doc = np.empty(size, np.int64)
        doc[at_a], doc[at_b] = key_a >> _DOC_SHIFT, key_b >> _DOC_SHIFT
        ends = np.cumsum(np.bincount(doc, held.sum(axis=1), minlength=n)).astype(np.int64)
        raw = memoryview(cells[held].tobytes())
        begins = np.concatenate([[0], ends[:-1]])
        return [
            hashlib.sha256(raw[begin : end - 1]).hexdigest() if end > begin else ""
            for begin, end in zip(begins.tolist(), ends.tolist())
        ]


@lru_cache(maxsize=1)
def aligner_of(a_path: str, b_path: str, a_ranks: str | None) -> Aligner:
    return Aligner(a_path, b_path, a_ranks)


_PARTS = pa.schema(
    [
        ("chunk", pa.int64()),
        ("doc_id", pa.int64()),
        ("n_a", pa.int64()),
        ("n_b", pa.int64()),
        ("n_groups", pa.int64()),
        ("n_links", pa.int64()),
        ("groups_sha256", pa.string()),
        ("steps", pa.list_(pa.int32())),
        ("times", pa.list_(pa.int32())),
        ("pairs", pa.list_(pa.int64())),
        ("holders", pa.list_(pa.int32())),
    ]
)
_PARTS_SQL = (
    "chunk bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,"
    " groups_sha256 string, steps array<int>, times array<int>, pairs array<bigint>,"
    " holders array<int>"
)


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _chunk(number: int, ids: list, counts: list[tuple], held: pa.Table) -> Iterator[pa.RecordBatch]:
    """Rows of the documents of a chunk, and one row with its pairs.

    A document's pairs are places in the chunk's list of pairs, as steps from one to the next.
    """
    parts = held.group_by("pair", use_threads=False).aggregate([([], "count_all")]).sort_by("pair")
    pairs = parts["pair"].combine_chunks()
    place = pc.index_in(held["pair"], value_set=pairs).to_numpy().astype(np.int64)
    doc = held["doc"].to_numpy()
    order = np.lexsort([place, doc])
    doc, place = doc[order], place[order]
    steps = np.diff(place, prepend=0)
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    steps[first] = place[first]
    per_doc = np.bincount(doc, minlength=len(ids))
    columns = [pa.array([number] * len(ids), pa.int64()), pa.array(ids, pa.int64())]
    columns += [pa.array(x) for x in zip(*counts)]
    columns += [_lists(steps, per_doc), _lists(held["times"].to_numpy()[order], per_doc)]
    columns += [pa.nulls(len(ids), _PARTS.field(k).type) for k in ("pairs", "holders")]
    yield pa.RecordBatch.from_arrays(
        [c.cast(f.type) for c, f in zip(columns, _PARTS)], schema=_PARTS
    )
    row = [pa.nulls(1, f.type) for f in _PARTS]
    row[0] = pa.array([number], pa.int64())
    row[-2] = pa.array([pairs.to_pylist()], pa.list_(pa.int64()))
    row[-1] = pa.array([parts["count_all"].to_pylist()], pa.list_(pa.int32()))
    yield pa.RecordBatch.from_arrays(row, schema=_PARTS)


def aligned_parts(docs: DataFrame, a_path: str, b_path: str, a_ranks: str | None) -> DataFrame:
    """Rows of documents with the pairs they hold, and rows of chunks with their pairs' partial counts."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(a_path, b_path, a_ranks)
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        counts: list[tuple] = []
        held: list[pa.Table] = []
        block: list[str] = []
        in_block = in_chunk = 0

        def close_block() -> None:
            nonlocal block, in_block
            if block:
                rows, pairs = aligner.align(block)
                moved = pc.add(pairs["doc"], len(counts))
                held.append(pairs.set_column(0, "doc", moved))
                counts.extend(rows)
                block, in_block = [], 0

        def close_chunk() -> Iterator[pa.RecordBatch]:
            nonlocal ids, counts, held, in_chunk, number
            close_block()
            if ids:
                yield from _chunk(number, ids, counts, pa.concat_tables(held).combine_chunks())
                number += 1
            ids, counts, held, in_chunk = [], [], [], 0

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py() or ""
                ids.append(doc_id)
                block.append(text)
                in_block += len(text)
                in_chunk += len(text)
                if in_chunk >= CHUNK_BYTES or len(ids) >= 1 << 16:
                    yield from close_chunk()
                elif in_block >= BLOCK_BYTES:
                    close_block()
        yield from close_chunk()

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, _PARTS_SQL
    )


def pair_counts(parts: DataFrame, b_size: int) -> DataFrame:
    """How many documents hold each pair (``n``), and the most that any pair of its A id has (``most``)."""
    partial = parts.where(F.col("pairs").isNotNull()).select(
        F.inline(F.arrays_zip(F.col("pairs").alias("pair"), F.col("holders").alias("n")))
    )
    counts = partial.groupBy("pair").agg(F.sum("n").alias("n"))
    counts = stage(counts.withColumn("a", F.expr(f"pair div {b_size}")), "pair_counts")
    # One row per A id at most, so its size is bounded by the vocabulary.
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(most), "a").select("pair", "n", "most")


def _summed(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _finish(docs: pa.Table, entries: pa.Table) -> pa.Table:
    """n_best and count_sum of a chunk's documents, from the counts of its pairs."""
    docs = docs.combine_chunks()
    at = entries["place"].to_numpy()
    n, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    n[at], best[at] = entries["n"].to_numpy(), entries["best"].to_numpy(zero_copy_only=False)
    lists = docs["steps"].combine_chunks()
    offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy())])
    steps = pc.list_flatten(lists).to_numpy().astype(np.int64)
    times = pc.list_flatten(docs["times"].combine_chunks()).to_numpy().astype(np.int64)
    sums = np.cumsum(steps)
    before = np.concatenate([[0], sums])[offsets[:-1]]
    place = sums - np.repeat(before, np.diff(offsets))
    out = docs.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    out = out.append_column("n_best", pa.array(_summed(best[place] * times, offsets)))
    return out.append_column("count_sum", pa.array(_summed(n[place] * times, offsets)))


def aligned(docs: DataFrame, a_path: str, b_path: str, a_ranks: str | None = None) -> DataFrame:
    """One row per document: tokens, groups and links of both tokenizers, and how common its links are.

    NULL and empty texts, and texts that either side does not give back byte by
    byte, have no tokens: all numbers are 0 and the digest is ''. Every row,
    repeated ones too, has a row in the result and counts as a document of its
    own; ids may be NULL. A task holds one chunk of texts, or one text if that
    is longer. Other columns are not looked at.
    """
    parts = stage(aligned_parts(docs, a_path, b_path, a_ranks), "aligned")
    counts = pair_counts(parts, len(Pieces(b_path).tokens))
    places = parts.where(F.col("pairs").isNotNull()).select(
        "chunk", F.posexplode("pairs").alias("place", "pair")
    )
    entries = places.join(counts, "pair").select(
        F.col("chunk").alias("part"), "place", "n", (F.col("n") == F.col("most")).alias("best")
    )
    rows = parts.where(F.col("pairs").isNull()).drop("pairs", "holders")
    return (
        rows.groupBy("chunk")
        .cogroup(entries.groupBy("part"))
        .applyInArrow(
            _finish,
            "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,"
            " groups_sha256 string, n_best bigint, count_sum bigint",
        )
    )
