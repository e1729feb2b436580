"""Packing, token trees, tiling and the quality classifier."""

from __future__ import annotations

import math
import random
import re
import sys
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tests_llm_helpers import docs_of, rows_of, texts  # noqa: F401 (fixtures)

from tidemark.llm import best_fit, bpe, quality, tiling, token_trees
from tidemark.llm.plans import PACKING_RANKS, QUERIES, three_edits, tokenizer_path

TOKENIZER = tokenizer_path()
RANKS = tokenizer_path(PACKING_RANKS)


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(TOKENIZER)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_pre_tokens_agree_on_every_plain_character(tokenizer):
    pieces = bpe.Pieces(TOKENIZER)
    for code in range(0x3000):
        c = chr(code)
        for text in (f"a{c}1{c}.{c}", f"{c} {c}{c}a'{c}s", f" {c}\n{c}  {c}"):
            if bpe._PLAIN.fullmatch(text):
                expected = [text[a:b] for _, (a, b) in
                            tokenizer.pre_tokenizer.pre_tokenize_str(text)]
                assert pieces.cut(text) == expected, hex(code)


def test_ids_are_the_tokenizers(tokenizer, texts, monkeypatch):
    monkeypatch.setattr(bpe, "MOST_KEPT", 50)
    pieces = bpe.Pieces(TOKENIZER)
    for text in [*texts, "a <|endoftext|> b", "it's we'll I'd 'tis  \n\n x", "\x85\xa0 z"]:
        assert np.frombuffer(pieces.encode(text), "<u4").tolist() == ids_of(tokenizer, text)


def test_ranks_give_the_tokenizers_ids(tokenizer, texts, monkeypatch):
    """Without a look at single pre-tokens, whose number of new ones would set the time."""
    pieces = bpe.Pieces(TOKENIZER, ranks=RANKS)
    wide = [c for c in map(chr, range(0x3000)) if bpe._PLAIN.fullmatch(c)]
    marks = [f"a{c}1{c}.{c} {c} {c}{c}a'{c}s \n{c}  {c}" for c in wide]
    runs = ["x" * 399, "a" + " \n" * 199 + "b", "it's  we'll \n\n I'd 'tis\t x \xa0 z  ", ""]
    other = ["a <|endoftext|> b", "y" * 5000, "a" + " " * 3000 + "b", "\x85 漢"]
    for text in [*texts, *marks, *runs, *other]:
        assert np.frombuffer(pieces.encode(text), "<u4").tolist() == ids_of(tokenizer, text)
    monkeypatch.setattr(bpe.Pieces, "look_up", None)
    for text in [*marks, *runs]:
        assert np.frombuffer(pieces.encode(text), "<u4").tolist() == ids_of(tokenizer, text)


def check_packing(rows, expected, size):
    pieces, bins = defaultdict(dict), defaultdict(list)
    for doc_id, piece, start, length, crc, sequence, offset in rows:
        assert 1 <= length <= size
        pieces[doc_id][piece] = (start, length, crc)
        bins[sequence].append((offset, length))
    assert set(pieces) == set(expected)
    for doc_id, ids in expected.items():
        at = 0
        for piece in range(len(pieces[doc_id])):
            start, length, crc = pieces[doc_id][piece]
            assert start == at
            assert crc == zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            assert len(ids) <= size or piece == 0 or length == size
            at += length
        assert at == len(ids)
    for places in bins.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_packing_round_trip(docs_of, texts, tokenizer):
    pairs = [*enumerate(texts), (5000, None)]
    pieces = best_fit.token_pieces(docs_of(pairs), TOKENIZER)
    expected = {i: [*ids_of(tokenizer, t), 0] for i, t in pairs}
    used = check_packing(map(tuple, best_fit.pack(pieces).collect()), expected, 2048)
    total = sum(map(len, expected.values()))
    assert used <= -(-total // 2048) + 4
    assert best_fit.pack(best_fit.token_pieces(docs_of([]), TOKENIZER)).count() == 0
    repeated = docs_of([(1, "a b"), (1, "a b"), (None, "c")])
    assert best_fit.pack(best_fit.token_pieces(repeated, TOKENIZER)).count() == 3


def test_full_first_piece_when_the_length_divides():
    assert best_fit.cut(4096, 2048) == [(0, 2048), (2048, 2048)]
    assert best_fit.cut(4097, 2048) == [(0, 1), (1, 2048), (2049, 2048)]
    assert best_fit.cut(2048, 2048) == [(0, 2048)]


class PlainBins:
    """The same rule with a list of open bins."""

    def __init__(self, size, most):
        self.size, self.most, self.free, self.opened = size, most, [], 0

    def place(self, length):
        fitting = [f for f in self.free if f >= length]
        if fitting:
            space = min(fitting)
            self.free.remove(space)
        else:
            space = self.size
            if length < space and len(self.free) == self.most:
                self.free.remove(min(self.free))
            self.opened += 1
        if space > length:
            self.free.append(space - length)
        return self.size - space


@given(st.lists(st.integers(1, 20), max_size=200), st.integers(1, 5))
@settings(max_examples=100, deadline=None)
def test_bitset_takes_the_tightest_bin(lengths, most):
    mine, plain = best_fit.OpenBins(20, most), PlainBins(20, most)
    used = defaultdict(int)
    for length in lengths:
        number, offset = mine.place(length)
        assert offset == plain.place(length) == used[number]
        used[number] += length
        assert used[number] <= 20 and mine.open <= most
    assert mine.opened == plain.opened


# ------------------------------------------------------------------ op 8

_ALPHABET = "ab Z1.'\n\t\xe9lstdvr  é漢​"


@given(st.text(_ALPHABET, max_size=400), st.data())
@settings(max_examples=150, deadline=None)
def test_edits_follow_a_full_count(text, data):
    pieces = bpe.Pieces.__new__(bpe.Pieces)
    pieces.__dict__ = _shared_pieces().__dict__
    tree = token_trees.TokenTree(*token_trees.leaves_of(pieces, text))
    for _ in range(4):
        start = data.draw(st.integers(0, len(text)))
        end = data.draw(st.integers(start, len(text)))
        new = data.draw(st.text(_ALPHABET, max_size=30))
        expected = text[:start] + new + text[end:]
        text, _ = token_trees.apply_edit(pieces, tree, text, start, end, new)
        assert text == expected
        lengths, counts = token_trees.leaves_of(pieces, text)
        assert tree.leaves() == (lengths, counts)
        assert tree.total == sum(counts) and tree.chars[1] == len(text)


_PIECES = []


def _shared_pieces():
    if not _PIECES:
        _PIECES.append(bpe.Pieces(TOKENIZER, True))
    return _PIECES[0]


def test_long_text_is_not_encoded_again(texts):
    pieces = _shared_pieces()
    text = max(texts, key=len)
    tree = token_trees.TokenTree(*token_trees.leaves_of(pieces, text))
    for place in (0, 5, len(text) // 2, len(text) - 3, len(text) // 3):
        text, again = token_trees.apply_edit(pieces, tree, text, place, place + 2, " new words")
        assert again < 200
    assert tree.total == sum(token_trees.leaves_of(pieces, text)[1])


def test_edits_on_documents(docs_of, texts, tokenizer):
    pairs = [*enumerate(texts), (5000, None), (None, "x y"), (1, texts[1])]
    docs = docs_of(pairs).withColumn("edits", three_edits())
    rows = token_trees.apply_edits(
        token_trees.build_trees(docs, TOKENIZER, "edits"), TOKENIZER
    ).collect()
    assert len(rows) == len(pairs)
    befores = sorted(len(ids_of(tokenizer, t)) for _, t in pairs)
    assert sorted(r.n_tokens_before for r in rows) == befores
    for row in rows:
        assert row.n_tokens == len(ids_of(tokenizer, row.text))
        assert row.n_chars == len(row.text)
    counted = token_trees.apply_edits(docs, TOKENIZER, with_state=False)
    assert rows_of(counted) == sorted((tuple(r)[:6] for r in rows), key=repr)
    odd = docs_of([(1, "some text")]).withColumn(
        "edits",
        F.expr("array(named_struct('start', -5L, 'end', 99L, 'replacement', 'new'), null,"
               " named_struct('start', null, 'end', 1L, 'replacement', 'x'),"
               " named_struct('start', 50L, 'end', 2L, 'replacement', null))"),
    )
    (row,) = token_trees.apply_edits(
        token_trees.build_trees(odd, TOKENIZER, "edits"), TOKENIZER).collect()
    assert (row.text, row.n_edits, row.n_tokens) == ("new", 2, 1)
    none = docs_of([(1, "a")]).withColumn("edits", F.lit(None).cast(token_trees.EDIT))
    (row,) = token_trees.apply_edits(
        token_trees.build_trees(none, TOKENIZER, "edits"), TOKENIZER).collect()
    assert (row.text, row.n_edits) == ("a", 0)


@pytest.mark.parametrize("longest, width", [(255, 1), (256, 2), (65535, 2), (70000, 4)])
def test_packed_leaves_come_back(longest, width):
    for lengths, counts in (([3, longest, 1], [1, 2, 1]), ([longest] * 130, [longest] * 130)):
        packed = token_trees._packed(lengths, counts)
        assert len(packed) == 1 + 2 * width * len(lengths)
        assert token_trees._unpacked(packed).leaves() == (lengths, counts)
    assert token_trees._unpacked(token_trees._packed([], [])).total == 0


def plain_edits(text, source):
    n = len(text)
    edits = [(n // 4, n // 4 + min(n, 20), text[:24]), (n // 2, n // 2, f" {source} "),
             (n - n // 16, n + 64, "")]
    for start, end, new in edits:
        start = min(start, len(text))
        text = text[:start] + new + text[max(start, min(end, len(text))):]
    return text


def test_query_applies_edits_to_stored_trees(spark, docs_of, texts, tokenizer, tmp_path):
    pairs = [*enumerate(texts), (5000, None), (None, "x y"), (1, texts[1]), (5001, "é" * 400)]
    docs = docs_of(pairs)
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 != 0, F.col("source")))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    edited = QUERIES["op8_token_trees"](spark, str(tmp_path))
    assert all("/token-trees-" in file for file in edited.inputFiles())
    expected = []
    for doc_id, text in pairs:
        before = text or ""
        after = plain_edits(before, "web" if doc_id is not None and doc_id % 3 else "")
        counts = len(ids_of(tokenizer, after)), len(ids_of(tokenizer, before))
        expected.append((doc_id, *counts, len(after), 3))
    got = edited.select("doc_id", "n_tokens", "n_tokens_before", "n_chars", "n_edits")
    assert rows_of(got) == sorted(expected, key=repr)


# ------------------------------------------------------------------ op 5


def plain_tiles(doc, item, least):
    """Greedy string tiling by comparing every pair of places."""
    doc, item, found = list(doc), list(item), []
    while True:
        best = (0, 0, 0)
        for j in range(len(item)):
            for i in range(len(doc)):
                k = 0
                while (i + k < len(doc) and j + k < len(item) and doc[i + k]
                       and doc[i + k] == item[j + k]):
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < least:
            return found
        found.append((i, j, k))
        doc[i : i + k] = [0] * k
        item[j : j + k] = [0] * k


@given(st.lists(st.integers(0, 4), max_size=60), st.lists(st.integers(1, 4), max_size=25),
       st.integers(1, 4))
@settings(max_examples=150, deadline=None)
def test_tiles_by_brute_force(doc, item, least):
    got = tiling.tiles(np.array(doc, np.uint64), np.array(item, np.uint64), least)
    assert got == plain_tiles(doc, item, least)


def test_window_hashes():
    words = np.array([3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5], np.uint64)
    base = int(tiling._BASE)
    for width in range(1, 12):
        plain = [sum(int(w) * base ** (width - 1 - k) for k, w in enumerate(words[s : s + width]))
                 % 2**64 for s in range(len(words) - width + 1)]
        assert tiling.window_hashes(words, width).tolist() == plain


def test_contamination(spark, docs_of, texts):
    source = random.Random(1)
    items = [" ".join(f"w{source.randrange(500)}" for _ in range(30)) for _ in range(20)]
    words = [t.split() for t in items]
    reordered = " ".join(words[2][20:] + ["x"] + words[2][8:20] + ["y"] + words[2][:8])
    docs = docs_of([
        (1, "before " + items[0] + " after"),
        (2, items[1].upper().replace(" ", ",  ")),
        (3, reordered),
        (4, " ".join(words[3][:10])),
        (5, None), (6, ""), (None, items[4]), (7, items[0] + " " + items[5]),
        (7, items[0] + " " + items[5]), (8, " ".join(texts)),
    ])
    bench = spark.createDataFrame(
        [*enumerate(items), (100, None), (101, ""), (102, "w1 w2"), (None, items[6])],
        "item_id bigint, text string",
    )
    for block_bytes in (1 << 20, 700):
        found = tiling.contamination(docs, bench, block_bytes=block_bytes)
        got = rows_of(found.select("doc_id", "item_id"))
        assert got == sorted([(1, 0), (2, 1), (3, 2), (None, 4), (7, 0), (7, 5), (7, 0), (7, 5)],
                             key=repr)
    tiles = {r.doc_id: r.n_tiles for r in found.collect()}
    assert tiles[3] == 3 and tiles[1] == 1
    kept = tiling.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [4, 5, 6, 8]
    assert tiling.contamination(docs, bench.limit(0)).count() == 0
    assert tiling.contamination(docs.limit(0), bench).count() == 0


# ------------------------------------------------------------------ op 7


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    scored = QUERIES["op7_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    for row in rows[:50]:
        assert zlib.crc32(str(row.doc_id).encode()) % 5 == 0
    right = [row.predicted == row.quality for row in rows]
    kept = [row.predicted for row in rows if row.quality == 1]
    dropped = [1 - row.predicted for row in rows if row.quality == 0]
    print(len(rows), np.mean(right), np.mean(kept), np.mean(dropped), file=sys.stderr)
    assert np.mean(right) > 0.95 and np.mean(kept) > 0.98


def test_quality_of_odd_input(spark, docs_of):
    docs = docs_of([(1, "good words"), (1, "good words"), (2, None), (None, ""), (3, "bad | |")])
    labels = "doc_id bigint, quality int, toxic int"
    nothing = spark.createDataFrame([], labels)
    odd = spark.createDataFrame([(1, 1, 0), (3, 0, 0), (3, None, 1), (None, 0, 1), (2, 5, 0)], labels)
    for given_labels in (nothing, odd):
        rows = quality.classified(docs, given_labels).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
        assert [(r.score, r.predicted) for r in rows if r.doc_id in (2, None)] == [(0.0, 0)] * 2
    untrained = quality.classified(docs, nothing).collect()
    assert [r.score for r in untrained if r.doc_id in (1, 3)] == [0.5] * 3
    assert quality.classified(docs.limit(0), nothing).count() == 0
    assert quality.accepted(docs, nothing).columns == docs.columns


def test_scores_are_a_mean_and_a_softmax():
    """By hand: the mean of the learned numbers of all features of all words, through the softmax."""
    table = quality.train(["fine words here"] * 6 + ["bad | spam |"] * 6, [1] * 6 + [0] * 6)
    for text in ("fine bad words", "spam", "unseen things | here", "fine " * 50):
        features = [f for word in quality.words_of(text) for f in quality.features_of(word)]
        mean = sum(float(table[f]) for f in features) / len(features)
        softmax = math.exp(mean) / (math.exp(mean) + math.exp(0.0))
        assert quality.Scorer(table).score(text) == pytest.approx(softmax, rel=1e-5)


def test_scorer_bound(monkeypatch):
    table = quality.train(["a b c"] * 4 + ["x | y |"] * 4, [1] * 4 + [0] * 4)
    whole = quality.Scorer(table).score("a b | zz")
    monkeypatch.setattr(quality, "_MOST_KEPT", 1)
    assert quality.Scorer(table).score("a b | zz") == whole
    assert re.fullmatch("0\\.\\d+", str(whole))
