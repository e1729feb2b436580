"""Alignment of two tokenizers against a token-by-token form."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_helpers import docs_of, texts  # noqa: F401 (fixtures)

from tidemark.llm import alignment, bpe
from tidemark.llm.plans import PACKING_RANKS, PIECE_TOKENIZER, QUERIES, tokenizer_path
from tidemark.sources.tables import table

PATHS = [tokenizer_path(), tokenizer_path(PIECE_TOKENIZER), tokenizer_path(PACKING_RANKS)]


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def letters():
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = {}, 256
    for b in range(256):
        if b in keep:
            out[chr(b)] = b
        else:
            out[chr(extra)] = b
            extra += 1
    return out


LETTERS = letters()


def plain_text(libraries, text):
    """(A ids, B ids, spans of A, spans of B), or None."""
    a, b = libraries
    if not text:
        return None
    found = a.encode(" " + text, add_special_tokens=False)
    parts_a = [bytes(LETTERS[c] for c in t) for t in found.tokens]
    ids_b = b.encode(text)
    parts_b = []
    for k in ids_b:
        piece = b.id_to_piece(k)
        if b.is_byte(k):
            parts_b.append(bytes([int(piece[1:-1], 16)]))
        else:
            parts_b.append(piece.replace("▁", " ").encode())
    if not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
        return None

    def spans(parts):
        at, out = 0, []
        for part in parts:
            out.append((at, at + len(part)))
            at += len(part)
        return out

    return found.ids, ids_b, spans(parts_a), spans(parts_b)


def plain(libraries, docs):
    found = [plain_text(libraries, text) for _, text in docs]
    counts, links = Counter(), []
    for f in found:
        mine = []
        if f:
            j = 0
            for a, (begin, end) in zip(f[0], f[2]):
                while j and f[3][j][1] > begin:
                    j -= 1
                while j < len(f[3]) and f[3][j][0] < end:
                    if f[3][j][1] > begin:
                        mine.append((a, f[1][j]))
                    j += 1
                j = max(0, j - 1)
        links.append(mine)
        counts.update(set(mine))
    most = Counter()
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    rows = []
    for (doc_id, _), f, mine in zip(docs, found, links):
        groups = ""
        n_groups = 0
        if f:
            shared = sorted({e for _, e in f[2]} & {e for _, e in f[3]})
            n_groups = len(shared)
            parts, begin = [], 0
            for end in shared:
                side = [
                    ",".join(str(k) for k, s in zip(ids, spans) if begin <= s[0] and s[1] <= end)
                    for ids, spans in ((f[0], f[2]), (f[1], f[3]))
                ]
                parts.append("|".join(side))
                begin = end
            groups = hashlib.sha256(";".join(parts).encode()).hexdigest()
        rows.append(
            (
                doc_id, len(f[0]) if f else 0, len(f[1]) if f else 0, n_groups, len(mine), groups,
                sum(counts[x] == most[x[0]] for x in mine), sum(counts[x] for x in mine),
            )
        )
    return sorted(rows, key=repr)


def result(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


ODD = [
    "", None, " ", "  two  spaces ", "\n\nline\r\n\ttab", "a<|endoftext|>b", "<s>x</s><unk><0x41>",
    "▁ marks ▁▁", "数字と漢字 😀 👩‍👩‍👧", "nul\x00in", "é ﬁ ½ Ａ", "﻿bom", "ß" * 900, " " * 900,
    "x" * 3000 + " y", " nbsp em", "don't we'LL it's", "𝒳𝓎 \U0010ffff", "ę" * 3,
]


def test_odd_rows_equal_the_plain_form(spark, libraries, docs_of, texts):
    short = [t for t in texts if len(t) < 3000][:40]
    docs = [(k, t) for k, t in enumerate(ODD + short)]
    docs += [(None, "the of and"), (None, None), (2, short[1]), (2, short[1])]
    held = docs_of(docs).withColumns({n: F.lit(n) for n in ("chunk", "pair", "n", "a", "times")})
    assert result(alignment.aligned(held, *PATHS)) == plain(libraries, docs)


def test_chunks_and_blocks_do_not_matter(spark, libraries, docs_of, texts):
    from functools import partial

    docs = [(k, t) for k, t in enumerate(ODD + texts[:50]) if not t or len(t) < 3000]
    whole = docs_of(docs).coalesce(1)

    def cut(docs, block, chunk):
        def small(batches, run):
            alignment.BLOCK_BYTES, alignment.CHUNK_BYTES = block, chunk
            try:
                yield from run(batches)
            finally:
                alignment.BLOCK_BYTES, alignment.CHUNK_BYTES = 1 << 20, 8 << 20

        class Small:
            def __init__(self, df):
                self.df = df

            def mapInArrow(self, run, schema):
                return self.df.mapInArrow(partial(small, run=run), schema)

        return Small(docs)

    class Docs:
        sparkSession = spark

        def __init__(self, block, chunk):
            self.sizes = (block, chunk)

        def select(self, *columns):
            return cut(whole.select(*columns), *self.sizes)

    expected = plain(libraries, docs)
    for sizes in ((1, 1), (50, 400), (1 << 20, 500)):
        assert result(alignment.aligned(Docs(*sizes), *PATHS)) == expected


def test_a_table_equals_the_plain_form(spark, libraries):
    folder = "/root/testdata/sf0.001"
    rows = table(spark, folder, "documents").select("doc_id", "text").collect()
    docs = [tuple(r) for r in rows]
    df = QUERIES["op12_alignment"](spark, folder)
    assert result(df) == plain(libraries, docs)


def test_no_rows(spark, docs_of):
    assert alignment.aligned(docs_of([]), *PATHS).collect() == []
    assert result(alignment.aligned(docs_of([(1, ""), (2, None)]), *PATHS)) == [
        (k, 0, 0, 0, 0, "", 0, 0) for k in (1, 2)
    ]


def test_ranks_give_the_same_ids_on_every_plain_character(libraries):
    side = alignment.ByteLevel(PATHS[0], PATHS[2])
    for code in range(0x3000):
        c = chr(code)
        if bpe._PLAIN.fullmatch(c):
            for text in (f" a{c}1{c}.{c}", f" {c} {c}{c}a'{c}s", f" {c}\n{c}  {c}"):
                assert side.encode(text).tolist() == libraries[0].encode(
                    text, add_special_tokens=False
                ).ids, hex(code)


def test_cells():
    cells, held = alignment._cells(12, ",;")
    assert [cells[k][held[k]].tobytes() for k in (0, 1, 23)] == [b"0,", b"0;", b"11;"]
    assert np.array_equal(held.sum(axis=1)[:2], [2, 2])
