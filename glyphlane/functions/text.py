"""Text helpers whose results equal Python's on any Unicode text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: every character for which Python's str.isspace() holds.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
ASCII_BLANKS = r"\t-\r\x1C-\x1F"
WIDE_SPACES = (
    r"\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WHITESPACE_CLASS = " " + ASCII_BLANKS + WIDE_SPACES
MAY_HOLD_WIDE_SPACE = r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{3000}]"  # cheap to test


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def strip_right(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITESPACE))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Array of the whitespace-separated words.

    By matching words, not by splitting: a split compiles its pattern per row.
    """
    plain = F.regexp_extract_all(text, F.lit(f"[^ {ASCII_BLANKS}]+"), F.lit(0))
    wide = F.regexp_extract_all(text, F.lit(f"[^{WHITESPACE_CLASS}]+"), F.lit(0))
    return F.when(text.rlike(MAY_HOLD_WIDE_SPACE), wide).otherwise(plain)


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words.

    Matching the full whitespace class is several times slower than the ASCII
    one, so only texts that may hold a wide space take it.
    """
    plain = F.regexp_count(text, F.lit(f"[^ {ASCII_BLANKS}]+"))
    wide = F.regexp_count(text, F.lit(f"[^{WHITESPACE_CLASS}]+"))
    return F.when(text.rlike(MAY_HOLD_WIDE_SPACE), wide).otherwise(plain).cast("bigint")


def occurrences(text: Column, needle: str) -> Column:
    """How often ``needle`` occurs without overlap."""
    removed = F.replace(text, F.lit(needle), F.lit(""))
    return ((F.length(text) - F.length(removed)) / len(needle)).cast("bigint")


def ordered_text(text: str, separator: str, order: str) -> Column:
    """Aggregate: the group's texts joined in order; arguments are column names."""
    shown = separator.replace("\\", "\\\\").replace("\n", "\\n").replace("'", "\\'")
    return F.expr(f"listagg(`{text}`, '{shown}') WITHIN GROUP (ORDER BY `{order}`)")
