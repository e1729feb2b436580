"""Spans of regular expressions as arrays, in built-in expressions only.

A span is (kind, start, end, value); places are code points from 0, the end is
exclusive. Matches are the leftmost non-overlapping ones. The work grows with
the length of the text and the number of spans, not with their product: running
values are formed in blocks, and what stands at a place is cut from pieces of
fixed length, as a place in a whole text is only found by walking to it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY = "array<struct<kind:string,start:bigint,end:bigint,value:string>>"
BLOCK = 64  # items whose running values are formed by themselves
PIECE = 256  # code points


def fresh(columns: Iterable[str], name: str) -> str:
    """``name`` with as many underscores as it takes to be none of the columns."""
    taken = {column.lower() for column in columns}
    while name.lower() in taken:
        name += "_"
    return name


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def scan(
    items: Column, zero: Column, step: Callable[[Column, Column], Column], kind: str = "bigint"
) -> Column:
    """For each item what ``step`` has made of ``zero`` and the items before it.

    An array cannot grow in place, so each block of items gives a small array of
    its own, and these are joined at the end.
    """

    def state(at: Column, out: Column) -> Column:
        return F.struct(at.cast(kind).alias("at"), out.alias("out"))

    def of_block(at: Column, block: Column) -> Column:
        return F.aggregate(
            block,
            state(at, F.array().cast(f"array<{kind}>")),
            lambda done, x: state(
                step(done["at"], x), F.concat(done["out"], F.array(done["at"]))
            ),
        )

    def blocks(all_items: Column) -> Column:
        count = F.ceil(F.size(all_items) / F.lit(BLOCK)).cast("int")
        return F.transform(
            F.sequence(F.lit(0), count - 1),
            lambda k: F.slice(all_items, k * BLOCK + 1, F.lit(BLOCK)),
        )

    def whole(all_items: Column) -> Column:
        return F.aggregate(
            blocks(all_items),
            state(zero, F.array().cast(f"array<array<{kind}>>")),
            lambda done, block: bound(
                of_block(done["at"], block),
                lambda found: state(found["at"], F.concat(done["out"], F.array(found["out"]))),
            ),
            lambda done: F.flatten(done["out"]),
        )

    return bound(
        items,
        lambda x: F.when(F.size(x) > 0, whole(x)).otherwise(F.array().cast(f"array<{kind}>")),
    )


def pieces(text: Column) -> Column:
    """The text in pieces of PIECE code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def between(cut: Column, start: Column, end: Column) -> Column:
    """What stands from ``start`` to ``end`` in a text that ``pieces`` has cut; '' for nothing."""
    first = F.floor(start / PIECE).cast("int")
    count = F.floor(end / PIECE).cast("int") - first + 1
    part = F.array_join(F.slice(cut, first + 1, F.greatest(count, F.lit(1))), "")
    inside = F.substr(part, (start - first * PIECE + 1).cast("int"), (end - start).cast("int"))
    return F.when(end > start, inside).otherwise("")


def find_spans(
    text: Column, pattern: str, kind: str, keep: Callable[[Column], Column] | None = None
) -> Column:
    """Spans of all matches whose value passes ``keep``.

    What lies between matches comes from a split by the same pattern, and the
    lengths of both add up to the places. Texts without a match are not split.
    """

    def spans_of(values: Column) -> Column:
        lengths = F.zip_with(
            F.slice(F.split(text, pattern, -1), F.lit(1), F.size(values)),
            values,
            lambda gap, value: F.struct(
                F.length(gap).cast("bigint").alias("gap"),
                (F.length(gap) + F.length(value)).cast("bigint").alias("both"),
            ),
        )

        def placed(sizes: Column) -> Column:
            begins = scan(sizes, F.lit(0), lambda at, x: at + x["both"])
            starts = F.zip_with(begins, sizes, lambda at, x: at + x["gap"])
            return F.zip_with(
                starts,
                values,
                lambda start, value: F.struct(
                    F.lit(kind).alias("kind"),
                    start.alias("start"),
                    (start + F.length(value)).alias("end"),
                    value.alias("value"),
                ),
            )

        return bound(lengths, placed)

    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    spans = bound(
        values,
        lambda v: F.when(F.size(v) > 0, spans_of(v)).otherwise(F.array().cast(EMPTY)),
    )
    return spans if keep is None else F.filter(spans, lambda span: keep(span["value"]))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    return F.concat_ws(
        ",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with ``[KIND]`` in place of every span; spans that overlap give way to one mark."""
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"].alias("kind")))
    )

    def joined(sorted_spans: Column, cut: Column) -> Column:
        reached = scan(sorted_spans, F.lit(0), lambda at, s: F.greatest(at, s["end"]))
        parts = F.zip_with(
            reached,
            sorted_spans,
            # A span that begins before the reach of those before it is part of their mark.
            lambda at, s: F.when(
                s["start"] >= at,
                F.concat(between(cut, at, s["start"]), F.lit("["), F.upper(s["kind"]), F.lit("]")),
            ).otherwise(""),
        )
        last = F.array_max(F.transform(sorted_spans, lambda s: s["end"]))
        rest = between(cut, last, F.length(text).cast("bigint"))
        return F.concat(F.array_join(parts, ""), rest)

    found = bound(ordered, lambda s: bound(pieces(text), lambda cut: joined(s, cut)))
    return F.when(F.size(spans) == 0, text).otherwise(found)
