"""License scans with a positional index of rare words.

Templates are word sequences: notices of public licences, some whole, and their
identifiers. Their postings say, for each word, in which template and at which
place it stands. Licence words are ranked by their inverse document frequency
over the whole corpus. A template counts if

* its key phrases stand word by word: the first wherever it does, which sets the
  start of the template, the others within ``GAP`` words of where that puts them;
* and its words found in their order, each within ``GAP`` words of its place,
  reach ``LEAST_SHARE`` of its weight. So words may be missing, changed or put in.

A file looks up the highest-ranked words of each template, as many as hold
``LOOKED_UP`` of its weight. Where a template counts, at least ``LOOKED_UP +
LEAST_SHARE - 1`` of its weight are looked-up words that agree on its start
within ``GAP``. So the postings are intersected by relative position and only
starts with that much agreement are aligned; none that counts is left out,
however many notices a file has and however frequent their words are.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_package

LEAST_SHARE = 0.6
LOOKED_UP = 0.7
GAP = 8

#: The base phrases, each with its label.
BASE = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)


class Template(NamedTuple):
    label: str
    text: str
    keys: tuple[str, ...]


#: Opening words of public licences and their notices.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license",)),
    Template("mit", "licensed under the mit license", ("mit license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files",
        ("permission is hereby granted", "free of charge"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
        ("redistribution and use", "source and binary forms"),
    ),
    Template(
        "gpl-3.0",
        "this work is licensed under the gnu general public license version 3",
        ("general public license", "version 3"),
    ),
    Template(
        "gpl",
        "you can redistribute it and or modify it under the terms of the gnu general public"
        " license as published by the free software foundation",
        ("general public license",),
    ),
    Template("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    Template("mpl-2.0", "subject to the terms of the mozilla public license v 2 0",
             ("mozilla public license",)),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template(
        "cc",
        "this work is licensed under a creative commons attribution international license",
        ("creative commons attribution",),
    ),
    Template("cc0", "creative commons zero cc0 1 0 universal public domain dedication",
             ("public domain dedication",)),
    Template("agpl", "gnu affero general public license", ("affero general public license",)),
    Template("epl", "made available under the terms of the eclipse public license",
             ("eclipse public license",)),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except"
        " in compliance with the license you may obtain a copy of the license at http www apache org"
        " licenses license 2 0 unless required by applicable law or agreed to in writing software"
        " distributed under the license is distributed on an as is basis without warranties or"
        " conditions of any kind either express or implied see the license for the specific language"
        " governing permissions and limitations under the license",
        ("unless required by applicable law", "without warranties or conditions of any kind"),
    ),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files the software to deal in the software without"
        " restriction including without limitation the rights to use copy modify merge publish"
        " distribute sublicense and or sell copies of the software and to permit persons to whom the"
        " software is furnished to do so subject to the following conditions the above copyright"
        " notice and this permission notice shall be included in all copies or substantial portions"
        " of the software",
        ("to deal in the software without restriction", "sublicense and or sell copies"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted provided that the above copyright notice and this permission"
        " notice appear in all copies",
        ("permission to use copy modify", "with or without fee"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met redistributions of source code"
        " must retain the above copyright notice this list of conditions and the following disclaimer"
        " redistributions in binary form must reproduce the above copyright notice this list of"
        " conditions and the following disclaimer in the documentation and or other materials"
        " provided with the distribution",
        ("must retain the above copyright notice", "must reproduce the above copyright notice"),
    ),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will"
        " the authors be held liable for any damages arising from the use of this software permission"
        " is granted to anyone to use this software for any purpose including commercial applications"
        " and to alter it and redistribute it freely",
        ("including commercial applications", "to alter it and redistribute it freely"),
    ),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to"
        " copy modify publish use compile sell or distribute this software",
        ("free and unencumbered software",),
    ),
)

#: Identifiers as a machine-readable licence line names them, each with its label.
IDENTIFIERS = (
    ("mit", "mit"),
    ("isc", "isc"),
    ("zlib", "zlib"),
    ("unlicense", "unlicense"),
    ("apache 2 0", "apache-2.0"),
    ("bsd 2 clause", "bsd"),
    ("bsd 3 clause", "bsd"),
    ("gpl 2 0", "gpl"),
    ("gpl 3 0", "gpl-3.0"),
    ("lgpl 2 1", "lgpl"),
    ("lgpl 3 0", "lgpl"),
    ("agpl 3 0", "agpl"),
    ("mpl 2 0", "mpl-2.0"),
    ("epl 2 0", "epl"),
    ("cc by 4 0", "cc-by-4.0"),
    ("cc by sa 4 0", "cc-by-sa-4.0"),
    ("cc by nc 4 0", "cc-by-nc-4.0"),
    ("cc0 1 0", "cc0"),
)
_LINES = ((label, "spdx license identifier " + name) for name, label in IDENTIFIERS)
TEMPLATES += tuple(Template(label, line, (line,)) for label, line in _LINES)

#: Digits and lower-case ASCII letters stay, A to Z become lower case, bytes from 128 on stay.
_FOLD = bytes(
    byte if byte >= 128 or chr(byte).isdigit() or chr(byte).islower()
    else byte + 32 if 65 <= byte <= 90
    else 32
    for byte in range(256)
)


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD).split()


class Index:
    """Postings of templates and base phrases, with the weights of their words."""

    def __init__(self, templates: tuple[Template, ...] = TEMPLATES, base=BASE) -> None:
        self.base = [tuple(text.encode().split()) for text, _ in base]
        self.base_labels = [label for _, label in base]
        self.labels = [t.label for t in templates]
        self.words = [tuple(t.text.encode().split()) for t in templates]
        self.keys = [[tuple(k.encode().split()) for k in t.keys] for t in templates]
        self.vocabulary = {w for words in (*self.words, *self.base) for w in words}
        self.key_places = [
            [(key, _find(words, key)) for key in keys]
            for words, keys in zip(self.words, self.keys)
        ]
        self.weigh(0, {})

    def weigh(self, documents: int, containing: dict[bytes, int]) -> None:
        """Inverse document frequencies from the number of documents and those with each word."""
        self.weight = {
            word: math.log((documents + 2) / (containing.get(word, 0) + 1))
            for word in self.vocabulary
        }
        self.total = [sum(self.weight[w] for w in words) for words in self.words]
        # Each base phrase is looked up by its rarest word.
        self.anchors = [
            max(range(len(p)), key=lambda k, p=p: (self.weight[p[k]], -k)) for p in self.base
        ]
        # The highest-ranked words of each template, up to the share that is looked up.
        self.looked_up: list[list[tuple[int, bytes, float]]] = []
        # Each template is filed under the rarest word of its first key phrase.
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for number, (words, keys) in enumerate(zip(self.words, self.key_places)):
            chosen, left = [], LOOKED_UP * self.total[number]
            for place in sorted(range(len(words)), key=lambda k, w=words: (-self.weight[w[k]], k)):
                if left > 0:
                    weight = self.weight[words[place]]
                    chosen.append((place, words[place], weight))
                    left -= weight
            self.looked_up.append(chosen)
            first, at = keys[0]
            rarest = max(range(len(first)), key=lambda k, w=first: (self.weight[w[k]], -k))
            self.postings[first[rarest]].append((number, at + rarest))

    def scan(self, words: list[bytes]) -> tuple[list[list[int]], dict[str, float]]:
        """Places of each base phrase, and the share of each label whose template was found."""
        places: dict[bytes, list[int]] = defaultdict(list)
        for place, word in enumerate(words):
            if word in self.vocabulary:
                places[word].append(place)
        base = []
        for phrase, anchor in zip(self.base, self.anchors):
            starts = (place - anchor for place in places.get(phrase[anchor], ()))
            base.append([s for s in starts if s >= 0 and _stands(words, s, phrase)])

        found: dict[str, float] = {}
        for word, filed in self.postings.items():
            for number, at in filed if word in places else ():
                label = self.labels[number]
                for place in places[word]:
                    if found.get(label, 0.0) >= 1.0:
                        break  # no other start can do better
                    start = place - at
                    if self._agrees(places, number, start) and self._keys(words, number, start):
                        share = self._share(places, number, start)
                        if share >= LEAST_SHARE:
                            found[label] = max(found.get(label, 0.0), share)
        return base, found

    def _agrees(self, places: dict[bytes, list[int]], number: int, start: int) -> bool:
        """Whether enough looked-up words stand near the place that ``start`` gives them."""
        chosen = self.looked_up[number]
        # What may be missing of the looked-up words is what may be missing of all.
        spare = (1 - LEAST_SHARE) * self.total[number] + 1e-9
        for at, word, weight in chosen:
            if not _near(places.get(word, ()), start + at):
                spare -= weight
                if spare < 0:
                    return False
        return True

    def _keys(self, words: list[bytes], number: int, start: int) -> bool:
        """Whether the first key phrase stands in its place and the others near theirs."""
        (first, at), *others = self.key_places[number]
        return _stands(words, start + at, first) and all(
            any(_stands(words, start + at + step, key) for step in range(-GAP, GAP + 1))
            for key, at in others
        )

    def _share(self, places: dict[bytes, list[int]], number: int, start: int) -> float:
        """Greatest share of the weight whose words stand in order, each near its place."""
        template = self.words[number]
        begin = start - GAP
        best = [0.0] * (len(template) + 2 * GAP + 1)  # best[k]: with file words before begin + k
        for at, word in enumerate(template, start):
            weight = self.weight[word]
            for place in reversed(_near(places.get(word, ()), at)):
                k = place - begin
                reached = best[k] + weight
                for later in range(k + 1, len(best)):
                    if best[later] >= reached:
                        break
                    best[later] = reached
        return min(1.0, best[-1] / self.total[number])


def _near(places: list[int], at: int) -> list[int]:
    """Those of ascending ``places`` that lie within ``GAP`` of ``at``."""
    return places[bisect_left(places, at - GAP) : bisect_right(places, at + GAP)]


def _find(words: tuple, key: tuple) -> int:
    return next(k for k in range(len(words)) if words[k : k + len(key)] == key)


def _stands(words: list[bytes], start: int, phrase: tuple[bytes, ...]) -> bool:
    return start >= 0 and tuple(words[start : start + len(phrase)]) == phrase


def _raw(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("bigint"),
        F.coalesce("text", F.lit("")).cast("binary").alias("raw"),
    )


def document_frequencies(docs: DataFrame, vocabulary: set[bytes]) -> tuple[int, dict[bytes, int]]:
    """Number of documents, and of those that contain each word of a fixed vocabulary.

    Tasks send one row per word of the vocabulary, whatever the corpus size.
    """
    ship_package(docs.sparkSession)
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = defaultdict(int)
        for batch in batches:
            for raw in batch.column(1):
                counts[b""] += 1
                for word in vocabulary.intersection(words_of(raw.as_py())):
                    counts[word] += 1
        columns = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = _raw(docs).mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n"))
    counts = {bytes(word): n for word, n in rows.collect()}
    return counts.pop(b"", 0), counts


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.string()),
        ("labels", pa.string()),
        ("score", pa.float64()),
    ]
)


def scan_licenses(docs: DataFrame, index: Index | None = None) -> DataFrame:
    """Labels of licence notices in every whole text, one row per row of ``docs``.

    ``n_base`` counts all places of base phrases, ``first_word`` and
    ``last_word`` are the least and greatest of their starts or NULL. ``score``
    is 1 with a base phrase, else the greatest share of a template found, else
    0. NULL text counts as empty. Document frequencies come from all of ``docs``
    in a pass before; they weigh words and leave base labels as they are.
    """
    ship_package(docs.sparkSession)
    index = index or Index()
    index.weigh(*document_frequencies(docs, index.vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in _OUT]
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(raw.as_py())
                base, found = index.scan(words)
                places = [place for each in base for place in each]
                base_labels = {x for x, each in zip(index.base_labels, base) if each}
                row = (
                    doc_id,
                    len(words),
                    len(places),
                    min(places, default=None),
                    max(places, default=None),
                    ",".join(sorted(base_labels)),
                    ",".join(sorted(base_labels | set(found))),
                    1.0 if base_labels else max(found.values(), default=0.0),
                )
                for column, value in zip(out, row):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(out, _OUT)], schema=_OUT
            )

    return _raw(docs).mapInArrow(
        run,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
        " base_labels string, labels string, score double",
    )
