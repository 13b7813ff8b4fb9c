"""Fill-in-middle documents, cut through an index of fixed text blocks.

A text's UTF-8 bytes lie in blocks of ``block_bytes``. A Fenwick tree over the
blocks stores how many units and how many code points begin in each. A cut after
k units descends the tree by binary lifting, which gives the block that holds the
cut and the units and code points before it; the boundary itself is then located
in that one block. A unit is a code point, or begins at each match of a pattern,
taken from left to right (what precedes the first match belongs to it; a text
without a match is one unit).

Where to cut and which form to take are decided by a hash of the document's id,
so every run and every retried task gives the same rows. Nothing is shuffled; a
task holds a few texts at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MADE = ["n", "form", "prefix_chars", "middle_chars", "output"]


class BlockIndex:
    """Counts of units and code points per block of one text, in a Fenwick tree."""

    def __init__(self, text: bytes, units: np.ndarray | None = None, block_bytes: int = 2048):
        """``units``: the bytes at which units begin, ascending; None for every code point."""
        data = np.frombuffer(text, np.uint8)
        self.points = (data & 0xC0) != 0x80  # bytes that begin a code point
        self.size, self.block_bytes = len(data), block_bytes
        self.units = units
        edges = np.arange(0, self.size, block_bytes)
        points = np.add.reduceat(self.points, edges, dtype=np.int64) if self.size else np.zeros(0, np.int64)
        begun = points if units is None else np.diff(np.searchsorted(units, np.append(edges, self.size)))
        self.total, self.chars = int(begun.sum()), int(points.sum())
        sums = np.zeros((len(edges) + 1, 2), np.int64)
        np.cumsum(np.stack([begun, points], axis=1), axis=0, out=sums[1:])
        at = np.arange(len(sums))
        self.tree = (sums - sums[at - (at & -at)]).tolist()

    def cut(self, k: int) -> tuple[int, int]:
        """The byte and the code point at which the text is cut after ``k`` units."""
        if k <= 0:
            return 0, 0
        if k >= self.total:
            return self.size, self.chars
        block, before, chars = 0, 0, 0
        step = 1 << (len(self.tree).bit_length() - 1)
        while step:
            there = block + step
            # blocks are passed while unit k, counted from 0, begins behind them
            if there < len(self.tree) and before + self.tree[there][0] <= k:
                block, before, chars = there, before + self.tree[there][0], chars + self.tree[there][1]
            step >>= 1
        at = block * self.block_bytes
        if self.units is None:
            byte = at + int(np.flatnonzero(self.points[at : at + self.block_bytes])[k - before])
        else:
            byte = int(self.units[np.searchsorted(self.units, at) + k - before])
        return byte, chars + int(np.count_nonzero(self.points[at:byte]))


def unit_starts(text: str, pattern: re.Pattern) -> np.ndarray:
    """The bytes at which units begin; the first one begins with the text."""
    starts = [m.start() for m in pattern.finditer(text)]
    if not text:
        return np.zeros(0, np.int64)
    starts[:1] = [0]
    points = np.flatnonzero((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)
    return points[np.unique(np.array(starts, np.int64))]


def _arranged(text: bytes, a: int, b: int, form: str) -> bytes:
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    if form == "psm":
        return b"".join([p, text[:a], s, text[b:], m, text[a:b]])
    return b"".join([s, text[b:], p, text[:a], m, text[a:b]])


def draws(seed: int, id_text: Column) -> list[Column]:
    """Four numbers of 32 bits from the hash of ``seed:id``; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_text, F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. A text that holds a mark is plain, so a mark is always a border."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return (
        F.when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
        .when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1))))
        .otherwise(output)
    )


def fill_in_middle(
    docs: DataFrame, changed_percent: int = 90, spm_percent: int = 20, seed: int = 1, unit_pattern: str | None = None,
    block_bytes: int = 2048, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n (units), form, prefix_chars, middle_chars (code points), output.

    The two cuts fall after any number of units from 0 to n, each with the same
    chance. ``changed_percent`` of the texts are changed and ``spm_percent`` of
    those have the suffix first. Empty texts and texts that hold a mark are
    plain, with null counts; null text counts as empty, a null id as an empty
    one. Rows that repeat an id are cut by the same draws. An empty table gives
    no rows; other columns are not read.
    """
    pattern = re.compile(unit_pattern) if unit_pattern is not None else None
    marks = tuple(x.encode() for x in (PREFIX, SUFFIX, MIDDLE))

    def made(text: bytes, h: tuple[int, int, int, int]) -> tuple:
        units = None if pattern is None else unit_starts(text.decode(), pattern)
        index = BlockIndex(text, units, block_bytes)
        if not text or h[2] % 100 >= changed_percent or any(m in text for m in marks):
            return index.total, "plain", None, None, text
        (a, a_chars), (b, b_chars) = (index.cut(k) for k in sorted((h[0] % (index.total + 1), h[1] % (index.total + 1))))
        form = "spm" if h[3] % 100 < spm_percent else "psm"
        return index.total, form, a_chars, b_chars - a_chars, _arranged(text, a, b, form)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 500):
            drawn = zip(*(batch.column(i).to_pylist() for i in range(2, 6)))
            rows = [made(t, h) for t, h in zip(batch.column(1).cast(pa.binary()).to_pylist(), drawn)]
            n, form, prefix, middle, output = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(output, pa.binary()).cast(pa.string())],
                ["doc_id", *MADE],
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", "text", *(h.alias(f"h{i}") for i, h in enumerate(draws(seed, F.col("doc_id").cast("string")), 1)))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def with_digests(made: DataFrame) -> DataFrame:
    """The outputs and the texts rebuilt from them, as digests."""
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
