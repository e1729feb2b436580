"""Token counts that follow edits.

A document's state is its text and its pre-tokens, each with its length in code
points and its number of tokens. Over blocks of pre-tokens stands a segment tree
of both sums: it finds the block of a place in the text, and after an edit only
the sums above the touched blocks are added up again.

BPE never crosses pre-tokens, and where a pre-token ends depends on at most one
code point beyond it. So an edit can only change pre-tokens from the one before
the edit on, and behind the edit everything is as before from the first border
that old and new pre-tokens share. Only the text between is encoded again.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Pieces, pieces_of
from tidemark.session import new_path, ship_package

BLOCK = 64  # pre-tokens in a block of the tree when it is built
_WINDOW = 64  # code points behind an edit that are encoded first
_UNSETTLED = 2  # last pre-tokens of a window that the text behind it may change


class TokenTree:
    """Pre-token lengths and token counts of one text, in blocks under a segment tree."""

    def __init__(self, lengths: list[int], counts: list[int]) -> None:
        starts = range(0, max(1, len(lengths)), BLOCK)
        self._build([(lengths[s : s + BLOCK], counts[s : s + BLOCK]) for s in starts])

    def _build(self, blocks: list[tuple[list[int], list[int]]]) -> None:
        self.blocks = blocks
        self._width = 1 << (len(blocks) - 1).bit_length()
        self.chars = [0] * (2 * self._width)
        self.tokens = [0] * (2 * self._width)
        for place, (lengths, counts) in enumerate(blocks, self._width):
            self.chars[place], self.tokens[place] = sum(lengths), sum(counts)
        for node in range(self._width - 1, 0, -1):
            self._add_up(node)

    def _add_up(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    @property
    def total(self) -> int:
        return self.tokens[1]

    def leaves(self) -> tuple[list[int], list[int]]:
        return [x for b in self.blocks for x in b[0]], [x for b in self.blocks for x in b[1]]

    def find(self, place: int) -> tuple[int, int]:
        """The block that holds the code point at ``place``, or the last one, and its start."""
        node, start = 1, 0
        while node < self._width:
            node *= 2
            if place >= start + self.chars[node] and self.chars[node + 1]:
                start += self.chars[node]
                node += 1
        return node - self._width, start

    def borders_before(self, place: int, count: int) -> tuple[int, int, int]:
        """The ``count``-th last pre-token that starts before ``place``: block, index, start.

        The start of the text if there are fewer.
        """
        block, start = self.find(max(0, place - 1))
        while True:
            begins = list(accumulate(self.blocks[block][0], initial=start))[:-1]
            before = [k for k, at in enumerate(begins) if at < place]
            if len(before) >= count:
                return block, before[-count], begins[before[-count]]
            if block == 0:
                return 0, 0, 0
            count -= len(before)
            block -= 1
            start -= sum(self.blocks[block][0])
            place = start + sum(self.blocks[block][0])

    def borders_from(self, place: int) -> Iterator[tuple[int, int, int]]:
        """Starts of pre-tokens at or after ``place``, in order, then the end: start, block, index."""
        block, start = self.find(place)
        while block < len(self.blocks):
            for index, length in enumerate(self.blocks[block][0]):
                if start >= place:
                    yield start, block, index
                start += length
            block += 1
        last = len(self.blocks) - 1
        yield start, last, len(self.blocks[last][0])

    def replace(
        self, first: tuple[int, int], last: tuple[int, int], lengths: list[int], counts: list[int]
    ) -> None:
        """Puts new pre-tokens where those from ``first`` up to ``last`` (block, index) were."""
        (a, i), (b, j) = first, last
        head, tail = self.blocks[a], self.blocks[b]
        merged = (head[0][:i] + lengths + tail[0][j:], head[1][:i] + counts + tail[1][j:])
        if len(merged[0]) > 4 * BLOCK:
            parts = range(0, len(merged[0]), BLOCK)
            cut = [(merged[0][s : s + BLOCK], merged[1][s : s + BLOCK]) for s in parts]
            self._build(self.blocks[:a] + cut + self.blocks[b + 1 :])
            return
        self.blocks[a] = merged
        for block in range(a + 1, b + 1):
            self.blocks[block] = ([], [])
        nodes = set()
        for block in range(a, b + 1):
            node = block + self._width
            self.chars[node] = sum(self.blocks[block][0])
            self.tokens[node] = sum(self.blocks[block][1])
            nodes.add(node // 2)
        while nodes and 0 not in nodes:
            for node in nodes:
                self._add_up(node)
            nodes = {node // 2 for node in nodes}


def _counts(bpe: Pieces, parts: list[str]) -> list[int]:
    return [len(ids) // 4 for ids in bpe.look_up(parts)]


def leaves_of(bpe: Pieces, text: str) -> tuple[list[int], list[int]]:
    parts = bpe.cut(text)
    return [len(part) for part in parts], _counts(bpe, parts)


def apply_edit(
    bpe: Pieces, tree: TokenTree, text: str, start: int, end: int, replacement: str
) -> tuple[str, int]:
    """Replaces ``text[start:end]``; the new text, and how many code points were encoded again."""
    new = text[:start] + replacement + text[end:]
    shift = len(new) - len(text)
    block, index, left = tree.borders_before(start, _UNSETTLED)
    window = _WINDOW
    while True:
        right = min(len(new), end + shift + window)
        parts = bpe.cut(new[left:right])
        settled = len(parts) if right == len(new) else max(0, len(parts) - _UNSETTLED)
        old = tree.borders_from(end)
        place, last, at = next(old)
        border = left
        for count in range(settled + 1):
            if border - shift >= end:
                while place < border - shift:
                    place, last, at = next(old)
                if place == border - shift:
                    parts = parts[:count]
                    tree.replace(
                        (block, index), (last, at), [len(p) for p in parts], _counts(bpe, parts)
                    )
                    return new, border - left
            if count < settled:
                border += len(parts[count])
        window *= 4


# --------------------------------------------------------------- on DataFrames

STATE = "doc_id bigint, text string, n_tokens bigint, tree binary"
EDIT = "array<struct<start:bigint,end:bigint,replacement:string>>"


def _packed(lengths: list[int], counts: list[int]) -> bytes:
    """Both rows in the narrowest of one, two or four bytes a number, behind a byte that says which."""
    width = next(w for w in (1, 2, 4) if max(lengths, default=0) < 1 << 8 * w)
    width = max(width, next(w for w in (1, 2, 4) if max(counts, default=0) < 1 << 8 * w))
    return bytes([width]) + np.array([lengths, counts], f"<u{width}").tobytes()


def _unpacked(tree: bytes) -> TokenTree:
    numbers = np.frombuffer(tree, f"<u{tree[0]}", offset=1)
    lengths, counts = numbers.reshape(2, -1).tolist()
    return TokenTree(lengths, counts)


def _small(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def build_trees(docs: DataFrame, tokenizer: str, *also: str) -> DataFrame:
    """State of every document: text (NULL: empty), ``n_tokens`` and the leaves of its tree.

    Whole texts are encoded once. The columns ``also`` are passed on. Strings of
    special tokens count as ordinary text. Every row has a row in the result.
    """
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = pieces_of(tokenizer, True)
        for batch in _small(batches):
            totals, trees = [], []
            for text in batch.column(1):
                lengths, counts = leaves_of(bpe, text.as_py())
                totals.append(sum(counts))
                trees.append(_packed(lengths, counts))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:2],
                    pa.array(totals, pa.int64()),
                    pa.array(trees, pa.binary()),
                    *batch.columns[2:],
                ],
                [*batch.schema.names[:2], "n_tokens", "tree", *batch.schema.names[2:]],
            )

    text = F.coalesce("text", F.lit("")).alias("text")
    source = docs.select(F.col("doc_id").cast("bigint"), text, *also)
    passed = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[2:])
    return source.mapInArrow(run, STATE + passed)


def stored_trees(docs: DataFrame, tokenizer: str, *also: str) -> DataFrame:
    """``build_trees`` written to a new table in the shared folder, and read back from there.

    What reads the result starts from the kept state: a lost executor costs a
    re-read of files, and texts are not encoded again.
    """
    spark = docs.sparkSession
    trees, path = build_trees(docs, tokenizer, *also), new_path(spark, "token-trees")
    trees.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(trees.schema).parquet(path)


_COUNTS = ("n_tokens_before", "n_chars", "n_edits", "reencoded")
_FLUSH_BYTES = 8 << 20  # of new state that is handed on at once


def apply_edits(
    state: DataFrame, tokenizer: str, edits: str = "edits", with_state: bool = True
) -> DataFrame:
    """New state after the edits in the array column ``edits``, in their order.

    ``state`` comes from ``build_trees``; without a column ``tree`` the trees are
    built in the same pass, so no state has to be kept for documents that are
    only counted. An edit replaces the code points from ``start`` up to ``end``
    of the text as the edits before have left it. Places beyond the text are
    moved into it, a NULL place or NULL edit is passed over, a NULL replacement
    deletes. Adds ``n_tokens_before``, ``n_chars``, ``n_edits`` (those applied)
    and ``reencoded``, the code points encoded again, which follow the edits and
    not the length of the text. ``with_state=False`` leaves out text and tree.
    """
    ship_package(state.sparkSession)
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64())]
    fields += [(name, pa.int64()) for name in _COUNTS]
    if with_state:
        fields += [("text", pa.string()), ("tree", pa.binary())]
    schema = pa.schema(fields)

    def flushed(out: list[list]) -> pa.RecordBatch:
        columns = [pa.array(x, f.type) for x, f in zip(out, schema)]
        for column in out:
            column.clear()
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = pieces_of(tokenizer, True)
        out: list[list] = [[] for _ in schema]
        size = 0
        for batch in batches:
            for row in zip(*batch.columns):
                doc_id, text, todo, *packed = (x.as_py() for x in row)
                tree = _unpacked(packed[0]) if packed else TokenTree(*leaves_of(bpe, text))
                before, applied, again = tree.total, 0, 0
                for edit in todo or ():
                    if not edit or edit["start"] is None or edit["end"] is None:
                        continue
                    start = min(max(0, edit["start"]), len(text))
                    end = min(max(start, edit["end"]), len(text))
                    text, encoded = apply_edit(
                        bpe, tree, text, start, end, edit["replacement"] or ""
                    )
                    applied, again = applied + 1, again + encoded
                values = [doc_id, tree.total, before, len(text), applied, again]
                if with_state:
                    values += [text, _packed(*tree.leaves())]
                    size += len(text) + len(values[-1])
                for column, value in zip(out, values):
                    column.append(value)
                if size > _FLUSH_BYTES:
                    yield flushed(out)
                    size = 0
            yield flushed(out)

    text = F.coalesce("text", F.lit("")).alias("text")
    columns = [F.col("doc_id").cast("bigint"), text, F.col(edits).cast(EDIT)]
    columns += [F.col("tree")] if "tree" in state.columns else []
    kinds = ["doc_id bigint", "n_tokens bigint", *(f"{name} bigint" for name in _COUNTS)]
    kinds += ["text string", "tree binary"] if with_state else []
    return state.select(*columns).mapInArrow(run, ", ".join(kinds))
