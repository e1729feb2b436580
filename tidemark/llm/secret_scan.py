"""Secrets: fixed patterns, and a battery of randomness tests for any other long token.

Built-in expressions only. A token's encoding is inferred from its characters,
and the battery compares it with what ordinary tokens (words, identifiers,
numbers) of the same length and encoding look like:

* uniformity: the chi-squared statistic over the alphabet, a/n * sum(c^2) - n.
  At a given length it grows with the pairs of equal characters alone, so it is
  judged by those: ordinary tokens repeat characters more often than random ones;
* runs: the number of runs of one character class (upper, lower, digit, other);
  random tokens change the class more often;
* serial correlation of neighbouring character codes: keyboard and counting
  sequences are correlated far beyond chance and are never reported.

Expectations follow the encoding, deviations the length, so short tokens need a
stronger showing; how short a tested token may be follows from the same. The first two give one p-value (Stouffer). Within a document the
p-values, weighted by length, pass the Benjamini-Hochberg step-up at ``RATE``,
which bounds the expected share of ordinary tokens among those reported.
"""

from __future__ import annotations

import math
from itertools import count
from statistics import NormalDist
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spans import bound, find_spans, fresh, listed, scan

#: The plain forms; the key words count in either case.
ASSIGN = (
    r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
    r"([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
LEAST_VALUE = 6

RATE = 0.01
MOST_CORRELATED = 3.0
_SPREAD = 1.5  # ordinary tokens scatter more than independent draws


class Encoding(NamedTuple):
    classes: tuple[int, ...]  # characters of each class in its alphabet
    pairs: float  # share of equal pairs in ordinary tokens
    changes: float  # share of class changes in ordinary tokens


#: Fixed values. Ordinary tokens of one case have their digits in one place, at the end mostly.
ENCODINGS = {
    "hex": Encoding((6, 10), 0.15, 0.2),
    "base32": Encoding((26, 6), 0.065, 0.04),
    "base36": Encoding((26, 10), 0.065, 0.08),
    "alphanumeric": Encoding((26, 26, 10), 0.065, 0.2),
    "base64": Encoding((26, 26, 10, 2), 0.065, 0.2),
}


def least_length(code: Encoding) -> int:
    """From which length a random token, showing what is expected of it, reaches ``RATE`` by itself.

    Shorter ones are ordinary for all the battery can tell; testing them would
    only make the control stricter for the others.
    """
    size = sum(code.classes)
    changing = 1 - sum((c / size) ** 2 for c in code.classes)

    def z(n: int) -> float:
        pairs, changes = n * (n - 1) / 2, n - 1
        uniform = pairs * (code.pairs - 1 / size) / math.sqrt(pairs * code.pairs)
        scatter = math.sqrt(changes * code.changes * (1 - code.changes))
        runs = changes * (changing - code.changes) / scatter
        return (uniform + runs) / _SPREAD / math.sqrt(2)

    return next(n for n in count(2) if z(n) >= NormalDist().inv_cdf(1 - RATE))


LEAST_LENGTHS = {name: least_length(code) for name, code in ENCODINGS.items()}
TOKEN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{min(LEAST_LENGTHS.values())},}}+"
#: Letters of one class never change it, and no length makes up for that.
WORD = "^(?:[A-Z]?[a-z]+|[A-Z]+)$"

KINDS = ("assign", "access", "hex")


def encoding(value: Column) -> Column:
    """Inferred encoding; NULL for plain numbers, which are no secrets."""
    return (
        F.when(value.rlike("^[0-9]+$"), F.lit(None))
        .when(value.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$"), "hex")
        .when(value.rlike("^[A-Z2-7]+=*$"), "base32")
        .when(value.rlike("^(?:[a-z]*[0-9][a-z0-9]*|[A-Z]*[0-9][A-Z0-9]*)$"), "base36")
        .when(value.rlike("^[A-Za-z0-9]+$"), "alphanumeric")
        .otherwise("base64")
    )


def _of_encoding(code: Column, values: dict[str, float]) -> Column:
    return F.coalesce(*[F.when(code == name, F.lit(v)) for name, v in values.items()])


def is_tested(value: Column) -> Column:
    """Whether the battery can tell a random token of this length and encoding."""
    least = _of_encoding(encoding(value), LEAST_LENGTHS)
    return ~value.rlike(WORD) & F.coalesce(F.length(value) >= least, F.lit(False))


#: The common polynomial for the tail of the normal distribution near its middle.
_NEAR = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
_FAR = 2.5  # from here on by continued fraction, which converges fast there
_DEPTH = 24


def _normal_tail(z: Column) -> Column:
    """Upper tail of the normal distribution, also far out true to a millionth of itself."""

    def tail(x: Column) -> Column:
        density = F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
        t = 1 / (1 + F.lit(0.2316419) * x)
        near = F.lit(0.0)
        for factor in reversed(_NEAR):
            near = (near + factor) * t
        below = x
        for k in range(_DEPTH, 0, -1):
            below = x + k / below
        return density * F.when(x < _FAR, near).otherwise(1 / below)

    return bound(
        z,
        lambda x: bound(F.abs(x), lambda far: F.when(x < 0, 1 - tail(far)).otherwise(tail(far))),
    )


def _equal_pairs(value: Column) -> Column:
    """Pairs of equal characters: the sum of c * (c - 1) / 2 over the alphabet."""
    places = F.array_sort(F.split(value, ""))
    start = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0.0).alias("pairs"))
    return F.aggregate(
        places,
        start,
        lambda done, c: F.struct(
            c.alias("last"),
            F.when(c == done["last"], done["run"] + 1).otherwise(F.lit(0)).alias("run"),
            (done["pairs"] + F.when(c == done["last"], done["run"] + 1.0).otherwise(0.0)).alias(
                "pairs"
            ),
        ),
        lambda done: done["pairs"],
    )


def _class_changes(value: Column) -> Column:
    """Neighbours of different class: the number of runs less one."""
    classes = F.regexp_replace(value, "[a-z]", "a")
    classes = F.regexp_replace(F.regexp_replace(classes, "[A-Z]", "A"), "[0-9]", "0")
    runs = F.regexp_replace(classes, r"a+|A+|0+|[+/_=-]+", "x")
    return F.length(runs) - 1


def _correlation(value: Column) -> Column:
    """Lag-1 correlation of character codes times the root of the length; 0 if all are equal."""
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c).cast("double"))
    n = F.length(value)
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, b: a + b)
    mean = total(codes) / n
    ahead = F.slice(codes, F.lit(1), n - 1)
    behind = F.slice(codes, F.lit(2), n - 1)
    both = total(F.zip_with(ahead, behind, lambda x, y: (x - mean) * (y - mean)))
    spread = total(F.transform(codes, lambda x: (x - mean) * (x - mean)))
    return F.when(spread > 0, both / spread * F.sqrt(n)).otherwise(0.0)


def ordinary_p(value: Column) -> Column:
    """How likely an ordinary token of this length and encoding looks as random as this one."""
    n = F.length(value).cast("double")
    code = encoding(value)
    share = _of_encoding(code, {name: x.pairs for name, x in ENCODINGS.items()})
    usual = _of_encoding(code, {name: x.changes for name, x in ENCODINGS.items()})
    pairs = n * (n - 1) / 2 * share
    uniform = (pairs - _equal_pairs(value)) / (F.sqrt(pairs) * _SPREAD)
    changes = (n - 1) * usual
    spread = F.sqrt(changes * (1 - usual)) * _SPREAD
    runs = (_class_changes(value) - changes) / spread
    p = _normal_tail((uniform + runs) / F.sqrt(F.lit(2.0)))
    sequence = F.abs(_correlation(value)) > MOST_CORRELATED
    return F.when(code.isNull() | sequence, 1.0).otherwise(p)


def _discoveries(spans: Column) -> Column:
    """Spans that pass the weighted step-up at ``RATE`` among all tokens of the document."""
    judged = F.transform(
        spans, lambda s: F.struct(ordinary_p(s["value"]).alias("p"), s.alias("span"))
    )
    lengths = F.aggregate(
        spans, F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"]
    )

    def weighted(items: Column) -> Column:
        return bound(
            lengths / F.size(spans),
            lambda mean: F.array_sort(
                F.transform(
                    items,
                    lambda x: F.struct(
                        (x["p"] * mean / (x["span"]["end"] - x["span"]["start"])).alias("p"),
                        x["span"].alias("span"),
                    ),
                )
            ),
        )

    def step_up(ranked: Column) -> Column:
        passing = F.filter(
            F.transform(
                ranked,
                lambda x, k: F.when(x["p"] <= RATE * (k + 1) / F.size(ranked), x["p"]),
            ),
            lambda p: p.isNotNull(),
        )
        return bound(
            F.array_max(passing),
            lambda most: F.transform(
                F.filter(ranked, lambda x: x["p"] <= most), lambda x: x["span"]
            ),
        )

    found = bound(weighted(judged), step_up)
    return F.when(F.size(spans) == 0, spans).otherwise(found)


def _apart(tokens: Column, others: Column) -> Column:
    """Tokens that overlap none of the others, by one pass in order and one against it.

    Of two spans that overlap, the later one begins before the end of the other.
    """

    def entries(spans: Column, is_token: bool) -> Column:
        return F.transform(
            spans,
            lambda s: F.struct(
                s["start"], F.lit(is_token).alias("token"), s["end"].alias("end"), s.alias("span")
            ),
        )

    def kept(ordered: Column) -> Column:
        reached = scan(
            ordered,
            F.lit(-1),
            lambda at, x: F.when(x["token"], at).otherwise(F.greatest(at, x["end"])),
        )
        next_start = F.reverse(
            scan(
                F.reverse(ordered),
                F.lit((1 << 62)),
                lambda at, x: F.when(x["token"], at).otherwise(F.least(at, x["start"])),
            )
        )
        limits = F.zip_with(
            reached,
            next_start,
            lambda low, high: F.struct(low.alias("low"), high.alias("high")),
        )
        clear = F.zip_with(
            ordered,
            limits,
            lambda x, limit: F.when(
                x["token"] & (x["start"] >= limit["low"]) & (limit["high"] >= x["end"]), x["span"]
            ),
        )
        return F.filter(clear, lambda span: span.isNotNull())

    both = bound(
        F.array_sort(F.concat(entries(tokens, True), entries(others, False))), kept
    )
    return F.when((F.size(tokens) == 0) | (F.size(others) == 0), tokens).otherwise(both)


def _by_start(spans: Column, kinds: tuple[str, ...]) -> Column:
    order = F.array(*map(F.lit, kinds))
    keyed = F.transform(
        spans,
        lambda s: F.struct(s["start"], F.array_position(order, s["kind"]).alias("k"), s.alias("s")),
    )
    return F.transform(F.array_sort(keyed), lambda x: x["s"])


def with_secrets(docs: DataFrame, name: str = "secrets") -> DataFrame:
    """Adds the struct column ``name``: spans ``assign``, ``access``, ``hex`` and ``random``.

    NULL and empty texts have empty arrays. ``random`` holds reported tokens
    that do not overlap a span of the other kinds.
    """
    text = F.coalesce("text", F.lit(""))

    def long_enough(value: Column) -> Column:
        return F.length(F.regexp_extract(value, ASSIGN, 1)) >= LEAST_VALUE

    own = fresh([*docs.columns, name], "found")
    found = docs.select(
        "*",
        F.inline(
            F.array(
                F.struct(
                    F.struct(
                        find_spans(text, ASSIGN, "assign", long_enough).alias("assign"),
                        find_spans(text, ACCESS, "access").alias("access"),
                        find_spans(text, HEX, "hex").alias("hex"),
                        find_spans(text, TOKEN, "random", is_tested).alias("token"),
                    ).alias(own)
                )
            )
        ),
    )
    kinds = [F.col(f"`{own}`.{kind}") for kind in KINDS]
    apart = bound(_apart(F.col(f"`{own}`.token"), F.concat(*kinds)), _discoveries)
    struct = F.struct(
        *(kind.alias(k) for kind, k in zip(kinds, KINDS)), apart.alias("random")
    )
    # The array keeps the expressions from being repeated where the column is used.
    found = found.select("*", F.inline(F.array(F.struct(struct.alias(name)))))
    return found.drop(own)


def secrets(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds and all spans for every row of ``docs``.

    ``base_sha256`` is over the base spans by start, then kind; ``spans`` has the
    reported random tokens in the same order.
    """
    found = with_secrets(docs.select("doc_id", "text"))
    base = F.concat(*[F.col(f"secrets.{kind}") for kind in KINDS])
    every = F.concat(base, F.col("secrets.random"))
    return found.select(
        "doc_id",
        *[F.size(f"secrets.{kind}").cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(listed(_by_start(base, KINDS)), 256).alias("base_sha256"),
        listed(_by_start(every, (*KINDS, "random"))).alias("spans"),
    )
