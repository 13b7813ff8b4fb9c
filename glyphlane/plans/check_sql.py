"""Pieces of check SQL used by several queries."""

from __future__ import annotations

from ..functions.text import WHITESPACE

SQL_SPACES = "".join(
    f"chr({ord(c)}) || " for c in WHITESPACE).removesuffix(" || ")
RE_SPACES = (
    r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)


def strip_sql(text: str) -> str:
    return f"trim({text}, {SQL_SPACES})"


def word_count_sql(text: str) -> str:
    return f"len(regexp_extract_all({text}, '[^{RE_SPACES}]+'))"


def resize_sql(source: str, name: str, factor: int, lo: str, hi: str, at_least_factor: bool,
               height: str = "height", width: str = "width", error: str | None = None) -> str:
    """CTE ``name``: source columns plus new_height, new_width, plan_error."""
    rounded = "greatest({f}, round_even({s} / {f}.0, 0) * {f})" if at_least_factor else (
        "round_even({s} / {f}.0, 0) * {f}")
    rh = rounded.format(s=height, f=factor)
    rw = rounded.format(s=width, f=factor)
    fault = error or f"CASE WHEN greatest({height}, {width}) > 200 * least({height}, {width}) THEN 'aspect ratio' END"
    side = (
        "CASE WHEN plan_error IS NOT NULL THEN NULL"
        " WHEN rh_ * rw_ > hi_ THEN floor({s} / sqrt(area_ / hi_) / {f}) * {f}"
        " WHEN rh_ * rw_ < lo_ THEN ceil({s} * sqrt(lo_ / area_) / {f}) * {f}"
        " ELSE {r} END"
    )
    return f"""
{name}_0 AS (
  SELECT *, {rh} AS rh_, {rw} AS rw_, CAST({height} AS DOUBLE) * {width} AS area_,
         CAST({lo} AS DOUBLE) AS lo_, CAST({hi} AS DOUBLE) AS hi_, {fault} AS plan_error
  FROM {source}),
{name} AS (
  SELECT *, CAST({side.format(s=height, f=factor, r='rh_')} AS BIGINT) AS new_height,
         CAST({side.format(s=width, f=factor, r='rw_')} AS BIGINT) AS new_width
  FROM {name}_0)"""
