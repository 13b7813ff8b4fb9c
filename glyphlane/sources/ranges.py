"""Records of large multi-line files, read by byte ranges.

A file is read as pieces that end at a separator: lines of a table, or what ends
at a closing brace of a JSON array. Where a record begins depends on all that
lies before it in the file, but only through a small state: whether a quote is
open and how deep the brackets are. So three steps read a file of any size:

1. every range tells how it changes the state,
2. running sums over the ranges, one small row each, give the state at which
   each range begins,
3. every range joins its pieces to records. Only the pieces at its edges, which
   belong to records of its neighbours too, are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .stored import stored

#: States of so many ranges are handed to every task at most; beyond, the pieces are joined with them.
BROADCAST_RANGES = 1 << 18


@dataclass(frozen=True)
class Form:
    """How pieces become records.

    ``changes`` gives, for each piece, the parity of its quotes and the change
    of depth if it begins outside and inside of quotes. A piece ends a record if
    it leaves no quote open and the depth is ``level``.
    """

    separator: str
    level: int
    changes: Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _quotes(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    odd = pc.count_substring(pieces, '"').to_numpy(zero_copy_only=False) % 2
    return odd, np.zeros(len(odd), np.int64), np.zeros(len(odd), np.int64)


_ESCAPED = re.compile(r"\\.", re.DOTALL)


def _brackets(pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A piece ends with the brace that the reader cut off; it counts unless a quote is open there."""
    out = np.zeros((3, len(pieces)), np.int64)
    for i, piece in enumerate(pieces.to_pylist()):
        parts = _ESCAPED.sub("", piece).split('"') if "\\" in piece else piece.split('"')
        odd = (len(parts) - 1) % 2
        depth = [sum(p.count("{") + p.count("[") - p.count("}") - p.count("]") for p in parts[start::2]) for start in (0, 1)]
        out[:, i] = odd, depth[0] - (not odd), depth[1] - odd
    return out[0], out[1], out[2]


TABLE = Form("\n", 0, _quotes)  # CSV and TSV: quotes in cells are doubled, so lines within a cell have an open one
JSON_ARRAY = Form("}", 1, _brackets)


def _pieces(spark: SparkSession, path: str, form: Form) -> DataFrame:
    """The pieces in order, with file and range; a range's rows stay together, as its task reads them."""
    rows = spark.read.text(path, lineSep=form.separator)
    return rows.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                       F.monotonically_increasing_id().alias("at"))


STATES = "file string, start bigint, odd int, outside bigint, inside bigint"


def _groups(batch: pa.RecordBatch) -> list[tuple[int, int]]:
    """Runs of rows of one file and range."""
    file = batch.column("file").dictionary_encode().indices.to_numpy()
    changed = np.flatnonzero(np.diff(file) | np.diff(batch.column("start").to_numpy())) + 1
    edges = [0, *changed.tolist(), batch.num_rows]
    return list(zip(edges, edges[1:])) if batch.num_rows else []


def _parities(odd: np.ndarray, begin: int) -> np.ndarray:
    """Whether a quote is open before each piece."""
    return (begin + np.cumsum(odd) - odd) % 2


def _state_changes(form: Form):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list | None = None
        for batch in batches:
            for low, high in _groups(batch):
                odd, outside, inside = form.changes(batch.column("value").slice(low, high - low))
                key = (batch.column("file")[low].as_py(), batch.column("start")[low].as_py())
                if last is None or (last[0], last[1]) != key:
                    if last:
                        yield _state(last)
                    last = [*key, 0, 0, 0]
                # depth for either state at the beginning of the range
                for i, begin in ((3, 0), (4, 1)):
                    open_ = _parities(odd, (begin + last[2]) % 2)
                    last[i] += int(np.where(open_ == 1, inside, outside).sum())
                last[2] = int((last[2] + odd.sum()) % 2)
        if last:
            yield _state(last)

    return run


def _state(row: list) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], ["file", "start", "odd", "outside", "inside"])


RECORDS = "file string, start bigint, n bigint, edge int, value string"
WHOLE, TAIL, HEAD, MIDDLE = 0, 1, 2, 3


def _records(form: Form):
    """Whole records of a range, and its edges: the rest of the record before it, the begin of the one behind it, or a part of one that spans it."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["file", "start", "n", "edge", "value"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, odd_now, depth_now, held, begun, n = None, 0, 0, [], False, 0
        for batch in batches:
            out: list[tuple] = []

            def close() -> None:
                """What is left of the range."""
                if held:
                    out.append((*key, n, HEAD if begun else MIDDLE, form.separator.join(held) + form.separator))

            for low, high in _groups(batch):
                now = (batch.column("file")[low].as_py(), batch.column("start")[low].as_py())
                if now != key:
                    if key:
                        close()
                    key, held, n = now, [], 0
                    odd_now, depth_now = batch.column("odd_before")[low].as_py(), batch.column("depth_before")[low].as_py()
                    # a range that begins between two records has no rest of one before it
                    begun = odd_now == 0 and depth_now == form.level or now[1] == 0
                pieces = batch.column("value").slice(low, high - low)
                odd, outside, inside = form.changes(pieces)
                open_ = _parities(odd, odd_now)
                depth = depth_now + np.cumsum(np.where(open_ == 1, inside, outside))
                ends = np.flatnonzero((((open_ + odd) % 2) == 0) & (depth == form.level))
                texts, at = pieces.to_pylist(), 0
                for end in ends.tolist():
                    out.append((*key, n, WHOLE if begun else TAIL, form.separator.join([*held, *texts[at : end + 1]]) + form.separator))
                    held, at, begun, n = [], end + 1, True, n + 1
                held += texts[at:]
                odd_now, depth_now = int((odd_now + odd.sum()) % 2), int(depth[-1])
            if out:
                yield batch_of(out)
        if key and held:
            yield batch_of([(*key, n, HEAD if begun else MIDDLE, form.separator.join(held) + form.separator)])

    return run


def record_texts(spark: SparkSession, path: str, form: Form) -> DataFrame:
    """One row per record: file, start (of the range in which it begins), n (its number there), value (its text with the last separator)."""
    pieces = _pieces(spark, path, form)
    states = stored(pieces.mapInArrow(_state_changes(form), STATES), "range-states")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    parity = states.withColumn("odd_before", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).cast("int"))
    change = F.when(F.col("odd_before") == 1, F.col("inside")).otherwise(F.col("outside"))
    begun = parity.withColumn("_change", change).select(
        "file", "start", "odd_before", F.coalesce(F.sum("_change").over(before), F.lit(0)).alias("depth_before"))
    columns = ["value", "file", "start", "odd_before", "depth_before"]
    if states.count() <= BROADCAST_RANGES:
        told = pieces.join(F.broadcast(begun), ["file", "start"]).select(*columns)
    else:
        told = pieces.join(begun, ["file", "start"]).repartition("file", "start").sortWithinPartitions("file", "start", "at").select(*columns)
    found = stored(told.mapInArrow(_records(form), RECORDS), "records")
    edges = found.where(F.col("edge") != WHOLE)
    # a record that spans ranges begins at a HEAD; what follows up to the next one belongs to it
    order = Window.partitionBy("file").orderBy("start", F.when(F.col("edge") == HEAD, 1).otherwise(0))
    numbered = edges.withColumn("_n", F.sum(F.when(F.col("edge") == HEAD, 1).otherwise(0)).over(order))
    stitched = numbered.groupBy("file", "_n").agg(
        F.min("start").alias("start"), F.max(F.when(F.col("edge") == HEAD, F.col("n"))).alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(
            "start", F.when(F.col("edge") == HEAD, 1).otherwise(0).alias("late"), "value"))), lambda e: e["value"]), "").alias("value"))
    shown = ["file", "start", "n", "value"]
    return found.where(F.col("edge") == WHOLE).select(*shown).unionByName(stitched.select(*shown))


def table_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of CSV or TSV files in ``value``, blank ones left out; ``first`` tells the first of each file, which may be a header."""
    rows = record_texts(spark, path, TABLE)
    whole = rows.select("file", ((F.col("start") == 0) & (F.col("n") == 0)).alias("first"), F.regexp_replace("value", r"\r?\n$", "").alias("value"))
    return whole.where(F.col("value") != "")


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """The objects of JSON arrays, one to a row, in ``value``."""
    rows = record_texts(spark, path, JSON_ARRAY)
    return rows.select(F.regexp_replace("value", r"^[\s\[,\x{FEFF}]+", "").alias("value")).where(F.col("value").startswith("{"))
