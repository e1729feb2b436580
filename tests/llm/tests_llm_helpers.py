"""Shared by the tests of this folder."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns whose names operators use inside."""

    def make(pairs):
        rows = [(i, t, "en", "web", len(t) if t is not None else None) for i, t in pairs]
        df = spark.createDataFrame(rows, DOCS)
        for name in ("fp", "key", "score", "label", "spans", "digest", "value", "component_id"):
            df = df.selectExpr("*", f"'{name}' as {name}")
        return df

    return make


WORDS = "the of and to in is ra el ó für straße été naïve token card mail A B c".split()


@pytest.fixture(scope="session")
def texts():
    """Texts with ties, copies, near copies, odd white space, empty and very long ones."""
    source = random.Random(3)
    plain = [" ".join(source.choices(WORDS, k=source.randint(0, 60))) for _ in range(60)]
    plain += [t.upper() for t in plain[:5]] + plain[5:15]
    plain += ["", " ", "\n\t x\x0b y\x1cz ", "one", "one two", "数字 と 漢字 😀 a​b", "a" * 5000]
    plain += [" ".join(source.choices(WORDS, k=20_000))]
    long = " ".join(source.choices(WORDS, k=300)).split()
    for k in range(60):
        near = long[:]
        near[source.randrange(len(near))] = f"changed{k % 40}"
        plain.append(" ".join(near))
    return plain


def rows_of(df):
    """Rows as tuples in a fixed order."""
    return sorted((tuple(row) for row in df.collect()), key=repr)
