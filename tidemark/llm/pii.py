"""Personal data: patterns propose spans, checksums confirm them, context adjusts the score.

Built-in expressions only. Patterns are written so that the regular expression
engine never tries a run of characters from within: possessive repeats, and a
look behind that allows a start only where a run begins or the last match ended.
They match what the plain forms in the comments match.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spans import (
    EMPTY,
    between,
    bound,
    find_spans,
    fresh,
    listed,
    pieces,
    redacted,
    scan,
)

#: [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
#: [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
#: [0-9]([\x20-]?[0-9])+ of 13 to 19 digits
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])"
#: The plain form.
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: The head of an account number with enough behind it; where it ends is tested apart.
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "ssn")

#: Characters of an account number, by the registry's country codes.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_SIZES = range(15, 35)
_IBAN_REACH = 2 * max(_IBAN_SIZES)  # with a space before each character and one behind

LEAST_SCORE = 0.6  # for spans beyond the base kinds; base spans stay
NEARBY = 40  # code points on either side that count as context
CONTEXT_ADDS = 0.3
CHECKED_ADDS = 0.3
_PATTERN_ALONE = {"email": 0.6, "ip": 0.5, "card": 0.4, "phone": 0.5, "iban": 0.4, "ssn": 0.3}
_CHECKED = {"card", "iban"}
_CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|write|address)",
    "ip": r"(?i)\b(?:ip|host|server|address|login|client)",
    "card": r"(?i)\b(?:card|visa|master|credit|debit|payment|paid)",
    "phone": r"(?i)\b(?:phone|tel|call|mobile|fax|contact)",
    "iban": r"(?i)\b(?:iban|account|bank|transfer|konto)",
    "ssn": r"(?i)\b(?:ssn|social|security|taxpayer)",
}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(value: Column) -> Column:
    """Whether 13 to 19 digits pass Luhn: from the right, every second one doubled, sum % 10 = 0."""
    digits = F.split(F.reverse(_digits(value)), "")
    worth = F.transform(
        digits,
        lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise(
            (2 * d.cast("int")) % 10 + F.floor(d.cast("int") / 5).cast("int")
        ),
    )
    total = F.aggregate(worth, F.lit(0), lambda a, b: a + b)
    return F.length(_digits(value)).between(13, 19) & (total % 10 == 0)


def passes_mod97(value: Column) -> Column:
    """Whether an account number of 15 to 34 characters leaves 1 modulo 97, its head moved behind."""
    plain = F.regexp_replace(value, " ", "")
    moved = F.split(F.concat(F.substring(plain, 5, 34), F.substring(plain, 1, 4)), "")
    rest = F.aggregate(
        moved,
        F.lit(0),
        lambda r, c: F.when(c.between("0", "9"), (r * 10 + F.ascii(c) - 48) % 97).otherwise(
            (r * 100 + F.ascii(c) - 55) % 97
        ),
    )
    return F.length(plain).between(15, 34) & (rest == 1)


def _small_parts(value: Column) -> Column:
    part = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
    return value.rlike(rf"^{part}(?:\.{part}){{3}}$")


def account_numbers(text: Column) -> Column:
    """Spans of account numbers of 15 to 34 characters, single spaces between them allowed.

    Each head is followed to every place where a word ends. Of the ends that pass
    modulo 97 the one of the country's length counts, else the last. A span
    within one before it is left out.
    """
    of_country = "|".join(
        f"(?:{codes.replace(' ', '|')}).{{{size - 2}}}" for size, codes in IBAN_LENGTHS.items()
    )

    def whole(cut: Column, length: Column, head: Column) -> Column:
        ahead = between(cut, head["start"], F.least(head["start"] + _IBAN_REACH, length))
        ends = bound(
            ahead,
            lambda shown: F.array(
                *[
                    F.regexp_extract(
                        shown, rf"^[A-Z0-9](?:\x20?[A-Z0-9]){{{size - 1}}}(?![A-Za-z0-9])", 0
                    )
                    for size in _IBAN_SIZES
                ]
            ),
        )
        # One-element arrays bind a value, so it is computed once.
        passing = F.transform(
            F.array(ends),
            lambda found: F.filter(found, lambda x: (x != "") & passes_mod97(x)),
        )
        value = F.element_at(
            F.transform(
                passing,
                lambda found: F.coalesce(
                    F.get(
                        F.filter(
                            found,
                            lambda x: F.regexp_replace(x, " ", "").rlike(f"^(?:{of_country})$"),
                        ),
                        F.lit(0),
                    ),
                    F.get(F.reverse(found), F.lit(0)),
                ),
            ),
            1,
        )
        return F.element_at(
            F.transform(
                F.array(value),
                lambda v: F.struct(
                    head["kind"].alias("kind"),
                    head["start"].alias("start"),
                    (head["start"] + F.length(v)).alias("end"),
                    v.alias("value"),
                ),
            ),
            1,
        )

    def all_of(heads: Column) -> Column:
        spans = bound(
            pieces(text),
            lambda cut: bound(
                F.length(text).cast("bigint"),
                lambda length: F.transform(heads, lambda h: whole(cut, length, h)),
            ),
        )
        known = F.filter(spans, lambda span: span["value"].isNotNull())
        return bound(
            known,
            lambda found: F.transform(
                F.filter(
                    F.zip_with(
                        found,
                        scan(found, F.lit(-1), lambda at, x: F.greatest(at, x["end"])),
                        lambda span, reached: F.struct(
                            span.alias("span"), (span["end"] > reached).alias("beyond")
                        ),
                    ),
                    lambda x: x["beyond"],
                ),
                lambda x: x["span"],
            ),
        )

    return bound(
        find_spans(text, IBAN, "iban"),
        lambda heads: F.when(F.size(heads) > 0, all_of(heads)).otherwise(F.array().cast(EMPTY)),
    )


_RULES: dict[str, tuple[str, Callable[[Column], Column] | None]] = {
    "email": (EMAIL, None),
    "ip": (IP, _small_parts),
    "card": (CARD, passes_luhn),
    "phone": (PHONE, lambda value: F.length(_digits(value)).between(9, 15)),
    "iban": (IBAN, None),
    "ssn": (SSN, None),
}


def score(cut: Column, length: Column, span: Column, kind: str) -> Column:
    """What the pattern says alone, more with a passed checksum, more with a context word nearby.

    ``cut`` is the text in pieces, ``length`` its code points.
    """
    before = between(cut, F.greatest(span["start"] - NEARBY, F.lit(0)), span["start"])
    behind = between(cut, span["end"], F.least(span["end"] + NEARBY, length))
    near = F.concat(before, F.lit(" "), behind).rlike(_CONTEXT[kind])
    sure = _PATTERN_ALONE[kind] + CHECKED_ADDS * (kind in _CHECKED)
    return F.least(F.lit(1.0), F.lit(sure) + F.when(near, CONTEXT_ADDS).otherwise(0.0))


def _with_pieces(
    text: Column, spans: Column, use: Callable[[Column, Column, Column], Column], empty: Column
) -> Column:
    """``use(spans, pieces, length)``; texts without a span are not cut."""

    def with_length(found: Column, cut: Column) -> Column:
        return bound(F.length(text).cast("bigint"), lambda length: use(found, cut, length))

    return bound(
        spans,
        lambda found: F.when(
            F.size(found) > 0, bound(pieces(text), lambda cut: with_length(found, cut))
        ).otherwise(empty),
    )


def _confident(text: Column, spans: Column, kind: str) -> Column:
    return _with_pieces(
        text,
        spans,
        lambda found, cut, length: F.filter(
            found, lambda span: score(cut, length, span, kind) >= LEAST_SCORE
        ),
        F.array().cast(EMPTY),
    )


def _with_score(text: Column, spans: Column, kind: str) -> Column:
    return _with_pieces(
        text,
        spans,
        lambda found, cut, length: F.transform(
            found,
            lambda s: F.concat_ws(
                ":", F.lit(kind), s["start"], s["end"],
                F.format_number(score(cut, length, s, kind), 2),
            ),
        ),
        F.array().cast("array<string>"),
    )


def with_spans(docs: DataFrame, name: str = "pii") -> DataFrame:
    """Adds the struct column ``name`` with an array of spans for every kind.

    NULL and empty texts have empty arrays. Base spans stay whatever their
    score; spans of other kinds need ``LEAST_SCORE``.
    """
    text = F.coalesce("text", F.lit(""))
    found = []
    for kind, (pattern, keep) in _RULES.items():
        spans = (
            account_numbers(text) if kind == "iban" else find_spans(text, pattern, kind, keep)
        )
        if kind not in BASE_KINDS:
            spans = _confident(text, spans, kind)
        found.append(spans.alias(kind))
    # The array keeps the expressions from being repeated where the column is used.
    return docs.select("*", F.inline(F.array(F.struct(F.struct(*found).alias(name)))))


def scored(text: Column, spans: Column) -> Column:
    """``kind:start:end:score`` of every span in order, with two decimals."""
    each = [_with_score(text, spans[kind], kind) for kind in KINDS]
    return F.concat_ws(",", F.concat(*each))


def personal_data(docs: DataFrame) -> DataFrame:
    """Counts of the base kinds and all spans for every row of ``docs``.

    ``base_sha256`` is over the base spans by kind, then start. ``spans`` has
    those and the spans of the other kinds after them, ``scores`` their scores.
    """
    found = with_spans(docs.select("doc_id", "text"))
    base = F.concat(*[F.col(f"pii.{kind}") for kind in BASE_KINDS])
    every = F.concat(*[F.col(f"pii.{kind}") for kind in KINDS])
    return found.select(
        "doc_id",
        *[F.size(f"pii.{kind}").cast("bigint").alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(every).alias("spans"),
        scored(F.coalesce("text", F.lit("")), F.col("pii")).alias("scores"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind; ``n_chars`` follows the new text.

    All rows and columns stay; a NULL text stays NULL.
    """
    columns = docs.columns
    own = fresh(columns, "pii")
    found = with_spans(docs, own)
    every = F.concat(*[F.col(f"`{own}`.{kind}") for kind in KINDS])
    found = found.withColumn("text", redacted(F.col("text"), every))
    if "n_chars" in columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        found = found.withColumn(
            "n_chars", F.when(F.size(every) > 0, changed).otherwise(F.col("n_chars"))
        )
    return found.select(*(F.col(f"`{name}`") for name in columns))
