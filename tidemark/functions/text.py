"""Line, word and byte counts of a text column, and text decoding."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that end a line. The pattern counts a pair of
# \r and \n once, by passing over the \r.
PLAIN_BREAKS = "\n\r"
UNICODE_BREAKS = "\n\r\x0b\x0c\x1c\x1d\x1e\x85  "
PLAIN_BREAK = r"[\n\r](?<!\r(?=\n))"
UNICODE_BREAK = r"[\n-\r\x1c-\x1e\x85\x{2028}\x{2029}](?<!\r(?=\n))"
# Fixed value: a word is what stands between any kind of white space.
WORD = r"[^\s\p{Z}\x1c-\x1f\x85]+"
# Suffixes of the objects that count as text.
TEXT_SUFFIXES = ("txt", "csv", "log", "md", "py", "js", "html", "xml", "json")


def ends_in_break(text: Column, unicode_breaks: bool = False) -> Column:
    ends = UNICODE_BREAKS if unicode_breaks else PLAIN_BREAKS
    return reduce(or_, [text.endswith(end) for end in ends])


def inner_breaks(line: Column, unicode_breaks: bool = False) -> Column:
    """Breaks inside a line that was cut at ``\\n``; few lines have any.

    Looking for the characters is much cheaper than the pattern, so that runs
    only where one was found.
    """
    ends = UNICODE_BREAKS if unicode_breaks else PLAIN_BREAKS
    found = reduce(or_, [line.contains(end) for end in ends if end != "\n"])
    line_break = UNICODE_BREAK if unicode_breaks else PLAIN_BREAK
    return F.when(found, F.regexp_count(line, F.lit(line_break))).otherwise(0)


def line_count(text: Column, unicode_breaks: bool = False) -> Column:
    """Lines of a text: a final break adds none, an empty text has none.

    By default lines end as they do for Spark's text reader. With
    ``unicode_breaks`` form feeds, separators and the like end a line too.
    """
    line_break = UNICODE_BREAK if unicode_breaks else PLAIN_BREAK
    unfinished = (text != "") & ~ends_in_break(text, unicode_breaks)
    return (F.regexp_count(text, F.lit(line_break)) + unfinished.cast("int")).cast("bigint")


def word_count(text: Column) -> Column:
    """Words separated by any white space."""
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def byte_count(text: Column) -> Column:
    return F.octet_length(text).cast("bigint")


def decode_text(content: Column) -> Column:
    """UTF-8 where the bytes are valid, Latin-1 otherwise."""
    as_text = content.cast("string")
    return F.when(F.is_valid_utf8(as_text), as_text).otherwise(F.decode(content, "ISO-8859-1"))


def has_text_suffix(name: Column, suffixes: tuple[str, ...] = TEXT_SUFFIXES) -> Column:
    return F.regexp_extract(F.lower(name), r"\.([^.]*)$", 1).isin(*suffixes)
