"""SimHash near-duplicates, weighted fingerprints and licence scans against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tests_llm_helpers import docs_of, rows_of, texts  # noqa: F401 (fixtures)
from xxhash import xxh64_intdigest

from tidemark.llm import fingerprints, licenses, simhash_pivots
from tidemark.llm.components import connected_components


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(words, bits):
    """Least index reachable over links of at most ``bits`` differing bits."""
    least = list(range(len(words)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(words):
            for j, b in enumerate(words):
                if (a ^ b).bit_count() <= bits and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least


def test_shingle_hash_is_sparks(spark):
    texts = ["", "a b c", "für straße 😀"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [row[0] & (2**64 - 1) for row in df.select(F.xxhash64("t")).collect()]
    assert got == [xxh64_intdigest(t.encode(), 42) for t in texts]


def test_near_duplicates_by_brute_force(docs_of, texts):
    pairs = [(7 * k % 1009, t) for k, t in enumerate(texts)] + [(1010, None)]
    got = rows_of(simhash_pivots.near_duplicates(docs_of(pairs)).select(
        "doc_id", simhash_pivots.hex16(F.col("fp")), "component_id"))
    words = [plain_simhash(t) for _, t in sorted(pairs)]
    least = plain_components(words, 2)
    ids = sorted(i for i, _ in pairs)
    expected = [(i, f"{w:016x}", ids[k]) for i, w, k in zip(ids, words, least)]
    assert got == sorted(expected, key=repr)


@pytest.mark.parametrize("bits", [1, 2])
def test_links_connect_what_all_pairs_connect(spark, bits):
    source = random.Random(bits)
    words = {0, 2**63, 2**64 - 1}
    for _ in range(30):
        word = source.getrandbits(64)
        words.add(word)
        for _ in range(source.randint(0, 6)):
            word ^= 1 << source.randrange(64)
            word ^= 1 << source.randrange(64) if source.random() < 0.5 else 0
            words.add(word)
    crowd = source.getrandbits(64)  # far more than a cell is paired for
    words |= {crowd ^ 1 << a ^ 1 << b for a in range(20) for b in range(a, 20, 3)}
    words = sorted(words)
    signed = [w - 2**64 if w >> 63 else w for w in words]
    df = spark.createDataFrame([(w,) for w in signed], "fp bigint")
    links = simhash_pivots.links(df, bits)
    for a, b in links.collect():
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= bits
    got = dict(connected_components(links, "a", "b").collect())
    groups = defaultdict(set)
    for w in signed:
        groups[got.get(w, w)].add(w & (2**64 - 1))
    expected = defaultdict(set)
    for k, root in enumerate(plain_components(words, bits)):
        expected[root].add(words[k])
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_links_stay_in_proportion_to_a_crowd(spark):
    words = [(1 << a ^ 1 << b ^ 1 << c) for a in range(12) for b in range(12) for c in range(12)]
    df = spark.createDataFrame([(w,) for w in sorted(set(words))], "fp bigint")
    assert simhash_pivots.links(df).count() < 70 * len(set(words))


def test_pivot_distances_discard_no_near_pair():
    source = random.Random(5)
    for _ in range(50):
        a = source.getrandbits(64)
        b = a ^ 1 << source.randrange(64) ^ 1 << source.randrange(64)
        for block in simhash_pivots.blocks(2):
            for pivot in simhash_pivots.pivots(block):
                word = pivot & (2**64 - 1)
                assert abs((a ^ word).bit_count() - (b ^ word).bit_count()) <= 2


def test_components_of_a_long_chain(spark):
    chain = [(k, k + 1) for k in range(200)] + [(1000, 1001), (1001, 1000), (5, 5), (None, 3)]
    df = spark.createDataFrame(chain, "x bigint, y bigint")
    got = dict(connected_components(df, "x", "y").collect())
    assert got == {**{k: 0 for k in range(1, 201)}, 1001: 1000}


def test_nulls_repeats_and_empty(docs_of):
    same = "a b c d e f g"
    pairs = [(3, same), (3, same), (None, same), (9, ""), (4, None), (None, "x y z q"),
             (None, "x y z q")]
    got = rows_of(simhash_pivots.near_duplicates(docs_of(pairs)).select("doc_id", "component_id"))
    assert got == sorted([(3, 3), (3, 3), (None, 3), (9, 4), (4, 4), (None, None), (None, None)],
                         key=repr)
    kept = simhash_pivots.keep_one(docs_of(pairs))
    assert kept.columns == docs_of(pairs).columns
    assert rows_of(kept.select("doc_id", "text")) == sorted(
        [(3, same), (4, None), (None, "x y z q")], key=repr)
    empty = docs_of([])
    assert simhash_pivots.near_duplicates(empty).count() == 0
    assert simhash_pivots.keep_one(empty).count() == 0


# ------------------------------------------------------------------ op 4


def plain_weighted(text):
    votes = np.zeros(64)
    for word, n in Counter(text.encode().lower().split()).items():
        weight = round(16 * (1 + np.log(n)))
        h = xxh64_intdigest(word, 42)
        votes += [weight if h >> b & 1 else -weight for b in range(64)]
    return sum(1 << b for b in range(64) if votes[b] > 0)


def test_edited_fingerprints_by_brute_force(docs_of, texts):
    pairs = [(11 * k % 1013 - 300, t) for k, t in enumerate(texts)] + [(5000, None)]
    got = rows_of(fingerprints.edited_fingerprints(docs_of(pairs)))
    ordered = [(i, t or "") for i, t in sorted(pairs, reverse=True)]
    expected = []
    for k, (i, text) in enumerate(ordered):
        following = ordered[(k + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        words = [plain_weighted(t) for t in (text, edited, following)]
        signed = [w - 2**64 if w >> 63 else w for w in words]
        sha = hashlib.sha256(edited.encode()).hexdigest()
        expected.append((i, len(text), sha, *signed))
    assert got == sorted(expected, key=repr)


def test_edited_fingerprints_of_few_rows(docs_of):
    assert fingerprints.edited_fingerprints(docs_of([])).count() == 0
    (row,) = fingerprints.edited_fingerprints(docs_of([(1, "abcd")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    rows = fingerprints.edited_fingerprints(docs_of([(None, "x"), (1, "y"), (1, "y"), (0, "zz")]))
    assert sorted(r.n_chars for r in rows.collect()) == [1, 1, 1, 2]


@pytest.mark.parametrize("hot", [None, 7, -(1 << 63)])
def test_a_frequent_id_is_cut_over_tasks(spark, hot):
    """Half of all rows on one id, or without one: no task holds twice the mean, results hold."""
    pairs = [(k * 3 if k % 2 else hot, f"text {k} of many") for k in range(4000)]
    docs = spark.createDataFrame(pairs, "doc_id bigint, text string").repartition(4)
    dealt = fingerprints._dealt(docs, 16)
    sizes = [n for _, n in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 16
    assert max(sizes) < 2 * 4000 / 16
    assert dealt.where("copy").count() == 16
    rows = fingerprints.edited_fingerprints(docs).collect()
    assert len(rows) == 4000
    # Every document precedes one other: one closed chain in falling order of ids.
    assert Counter(r.next_fp for r in rows) == Counter(r.fp for r in rows)
    word = {t: plain_weighted(t) for _, t in pairs}
    signed = {t: w - 2**64 if w >> 63 else w for t, w in word.items()}
    alone = sorted((i, t) for i, t in pairs if i is not None and i != hot and i > 7)
    follows = {i: signed[t] for (_, t), (i, _) in zip(alone, alone[1:])}
    got = {r.doc_id: r.next_fp for r in rows}
    assert {i: got[i] for i in follows} == follows


def test_repeated_rows_of_one_id_keep_their_rows(docs_of):
    docs = docs_of([(5, "a b c d")] * 300 + [(6, "x y z w")] * 3)
    rows = fingerprints.edited_fingerprints(docs).collect()
    assert Counter(r.doc_id for r in rows) == {5: 300, 6: 3}
    assert Counter(r.next_fp for r in rows) == Counter(r.fp for r in rows)


@pytest.mark.parametrize("radius", [2, 3])
def test_near_counts_by_brute_force(spark, radius, monkeypatch):
    monkeypatch.setattr(fingerprints, "CHUNK", 7)
    source = random.Random(radius)
    base = [source.getrandbits(63) for _ in range(20)]
    words = [b ^ 1 << source.randrange(63) ^ 1 << source.randrange(63) ^ 1 << source.randrange(63)
             for b in base for _ in range(15)] + base * 3
    rows = spark.createDataFrame([(k, w) for k, w in enumerate(words)], "doc_id bigint, fp bigint")
    got = rows_of(fingerprints.with_near(rows, radius, step=10).select("doc_id", "n_near"))
    expected = [
        (k, sum((w ^ x).bit_count() <= radius for x in words) - 1 if k % 10 == 0 else None)
        for k, w in enumerate(words)
    ]
    assert got == sorted(expected, key=repr)


def test_near_documents_by_brute_force(spark):
    source = random.Random(5)
    base = [source.getrandbits(64) - (1 << 63) for _ in range(10)]
    words = [b ^ 1 << source.randrange(63) ^ 1 << source.randrange(63) for b in base for _ in range(9)]
    ids = [*range(100), None]
    pairs = list(zip(ids, words + base + base[:1]))
    rows = spark.createDataFrame(pairs, "doc_id bigint, fp bigint")
    expected = {
        (w, x, ((w ^ x) & (1 << 64) - 1).bit_count(), i)
        for k, w in pairs if k is not None and k % 10 == 0
        for i, x in pairs if ((w ^ x) & (1 << 64) - 1).bit_count() <= 3
    }
    got = rows_of(fingerprints.near_documents(rows, step=10))
    assert got == sorted(expected, key=repr)
    n_near = {r.fp: r.n_near for r in fingerprints.with_near(rows, step=10).collect()
              if r.n_near is not None}
    assert n_near == {w: n - 1 for w, n in Counter(row[0] for row in got).items()}


# ------------------------------------------------------------------ op 6

LICENCES = [
    "x Licensed under CC BY-NC 4.0. y",
    "Released under the MIT License.",
    "Licensed under the Apache License, Version 2.0. All rights reserved.",
    "This work is licensed under the GNU General Public License, version 3.",
    "all rights. reserved all Rights reserved all rights RESERVED",
    "cc by cc by cc-by ccby ccé by",
    "the license of the public is general; rights are all reserved",
    "",
    None,
    "all rights",
    "MIT licence " * 2000 + "all rights reserved",
]


def plain_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                       re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"),
                          ("all rights reserved", "reserved")):
        p = phrase.split()
        hits = [k for k in range(len(words)) if words[k : k + len(p)] == p]
        places += hits
        labels |= {label} if hits else set()
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(labels)))


def test_licence_base_by_brute_force(docs_of, texts):
    pairs = list(enumerate([*LICENCES, *texts]))
    got = rows_of(licenses.scan_licenses(docs_of(pairs)))
    assert [row[:6] for row in got] == sorted([(i, *plain_base(t)) for i, t in pairs], key=repr)
    labels = {row[0]: row[6] for row in got}
    assert labels[0] == "cc-by,cc-by-nc-4.0"
    assert labels[1] == "mit"
    assert labels[2] == "apache-2.0,reserved"
    assert labels[3] == "gpl,gpl-3.0"
    assert labels[6] == ""
    assert all(0 <= row[7] <= 1 for row in got)
    assert licenses.scan_licenses(docs_of([])).count() == 0


def test_licence_words_common_in_all_documents_still_count(docs_of):
    """A hot notice, and fewer than 50 documents: no word is too common to be looked up."""
    notice = "Licensed under the MIT License"
    hot = [(k, notice if k % 2 else f"plain text {k}") for k in range(200)]
    labels = {r.doc_id: r.labels for r in licenses.scan_licenses(docs_of(hot)).collect()}
    assert labels == {k: "mit" if k % 2 else "" for k in range(200)}
    few = [(0, notice), (1, "Licensed under the Apache License, Version 2.0")]
    labels = {r.doc_id: r.labels for r in licenses.scan_licenses(docs_of(few)).collect()}
    assert labels == {0: "mit", 1: "apache-2.0"}


def plain_share(index, words, number, start):
    """Weighted longest common subsequence of a template and a file, within the gap."""
    template, gap = index.words[number], licenses.GAP
    rows, columns = len(template), len(words)
    best = [[0.0] * (columns + 1) for _ in range(rows + 1)]
    for i in range(rows):
        for j in range(columns):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j])
            if template[i] == words[j] and abs(j - i - start) <= gap:
                here = best[i][j] + index.weight[template[i]]
                best[i + 1][j + 1] = max(best[i + 1][j + 1], here)
    return best[rows][columns] / sum(index.weight[w] for w in template)


def plain_labels(index, words):
    """Labels by every template at every start, without postings."""
    found = {}
    for number, keys in enumerate(index.keys):
        template = index.words[number]
        at = [next(k for k in range(len(template)) if template[k : k + len(key)] == key)
              for key in keys]
        for start in range(-len(template), len(words)):
            first = start + at[0]
            if first < 0 or tuple(words[first : first + len(keys[0])]) != keys[0]:
                continue
            near = [
                any(p >= 0 and tuple(words[p : p + len(key)]) == key
                    for p in range(start + k - licenses.GAP, start + k + licenses.GAP + 1))
                for key, k in zip(keys[1:], at[1:])
            ]
            share = plain_share(index, words, number, start) if all(near) else 0
            if share >= licenses.LEAST_SHARE:
                label = index.labels[number]
                found[label] = max(found.get(label, 0), min(1, share))
    return found


def test_every_notice_of_a_file_is_found():
    """All templates in one file, whatever the frequencies; against all starts."""
    source = random.Random(6)
    for _ in range(6):
        index = licenses.Index()
        index.weigh(1000, {word: source.randint(0, 1000) for word in sorted(index.vocabulary)})
        chosen = source.sample(licenses.TEMPLATES, source.randint(1, 12))
        words = licenses.words_of(" filler ".join(t.text for t in chosen).encode())
        _, found = index.scan(words)
        assert found.keys() >= {t.label for t in chosen}
        assert found == pytest.approx(plain_labels(index, words))
    two = licenses.TEMPLATES[3].text + " Licensed under the Apache License, Version 2.0"
    assert index.scan(licenses.words_of(two.encode()))[1].keys() == {"mit", "apache-2.0"}


def test_changed_notices_by_brute_force():
    """Words dropped, changed, put in and moved: the same labels and shares as all starts give."""
    source = random.Random(16)
    counted = 0
    for _ in range(60):
        index = licenses.Index()
        index.weigh(1000, {word: source.randint(0, 999) for word in sorted(index.vocabulary)})
        words = []
        for template in source.sample(licenses.TEMPLATES, 2):
            for word in template.text.encode().split():
                kind = source.random()
                words += [word] if kind > 0.12 else [] if kind < 0.04 else [b"other"]
                words += [word, b"more"][: source.choice([0, 0, 0, 1, 2])] if kind > 0.95 else []
            words += [b"between"] * source.randint(0, 3)
        found = index.scan(words)[1]
        assert found == pytest.approx(plain_labels(index, words))
        counted += len(found)
    assert counted > 20


@pytest.mark.parametrize("text, label", [
    ("Redistribution and use of this software in source and binary forms, with or without"
     " modification, are permitted provided that the following conditions are met:", "bsd"),
    ("Permission is hereby granted, without any fee and free of charge, to any person obtaining a"
     " copy of this software and associated documentation files", "mit"),
    ("// SPDX-License-Identifier: MIT", "mit"),
    ("# SPDX-License-Identifier: GPL-3.0-or-later", "gpl-3.0"),
    ("under the terms of the GNU Affero General Public License", "agpl"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or"
     " without fee is hereby granted, provided that the above copyright notice appear", "isc"),
])
def test_notices_with_words_put_in(docs_of, text, label):
    docs = docs_of([(1, text), (2, f"code {text} code " * 3), (3, "licensed code, no notice")])
    labels = {r.doc_id: r.labels.split(",") for r in licenses.scan_licenses(docs).collect()}
    assert label in labels[1] and label in labels[2] and labels[3] == [""]


def test_a_file_of_nothing_but_licence_words_takes_linear_time():
    index = licenses.Index()
    index.weigh(1000, {})
    for line in ("mit license ", "permission is hereby granted ", "free of charge the software "):
        words = licenses.words_of(line.encode() * 20_000)
        assert index.scan(words)[1].keys() <= {"mit"}
