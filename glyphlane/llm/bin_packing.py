"""Best-fit packing of token pieces under several capacities.

A sequence has three capacities: tokens, documents, and attention cost (the sum
of squared piece lengths, what attention within documents costs). Pieces go
longest first; a piece goes to the open sequence that can take it under every
capacity and fits best, by the weighted residual norm that it would leave or by
the weighted dot product of demand and residual, or else opens a new one.

Encoding turns a whole text into pieces where it lies. From there only small
piece rows travel. They are dealt by hash to blocks of about ``block_pieces``
rows, whose number follows the number of pieces; blocks are packed
independently, at the cost of about one part-filled sequence per block.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, written
from .word_ids import definition_of, encoder

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = f"{PIECES}, sequence_id bigint, offset bigint"


def pack(
    lengths: np.ndarray, capacity: int, max_docs: int, max_cost: float, weights: tuple[float, float, float], rule: str
) -> np.ndarray:
    """The bin of each piece."""
    scale = np.array([w / c for w, c in zip(np.sqrt(weights), (capacity, max_docs, max_cost))])
    if rule not in ("norm", "dot"):
        raise ValueError("rule is norm or dot")
    bins = np.empty(len(lengths), np.int64)
    room = np.empty((3, 1024))  # tokens, documents, cost left in each open bin
    names = np.empty(1024, np.int64)
    open_bins = made = 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = float(lengths[i])
        need = np.array([size, 1.0, size * size])
        if need[2] > max_cost:
            raise ValueError("a piece alone exceeds the attention cost of a sequence")
        left = room[:, :open_bins] - need[:, None]
        fits = np.flatnonzero((left >= 0).all(axis=0))
        if len(fits):
            if rule == "norm":
                best = fits[np.argmin((np.square(left[:, fits] * scale[:, None])).sum(axis=0))]
            else:
                best = fits[np.argmax(((need * scale)[:, None] * (room[:, fits] * scale[:, None])).sum(axis=0))]
        else:
            if open_bins == len(names):
                room, names = np.concatenate([room, room], axis=1), np.concatenate([names, names])
            best = open_bins
            room[:, best], names[best] = (capacity, max_docs, max_cost), made
            open_bins, made = open_bins + 1, made + 1
        bins[i] = names[best]
        room[:, best] -= need
        if (room[:, best] < 1).any():  # no piece is shorter than a token
            open_bins -= 1
            room[:, best], names[best] = room[:, open_bins], names[open_bins]
    return bins


def token_pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each whole text with its end id."""
    definition = definition_of(tokenizer_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(definition)
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), coder.encode(batch.column(1).to_pylist())):
                ids = np.append(ids, coder.dtype.type(end_id)).astype("<u4")
                for number, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    rows.append((doc_id, number, at, len(part), zlib.crc32(part.tobytes())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            ) if rows else pa.RecordBatch.from_arrays(
                [pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, PIECES)


def best_fit_packing(
    docs: DataFrame, tokenizer_path: str, end_id: int = 1, capacity: int = 4096, max_docs: int | None = None,
    max_cost: float | None = None, weights: tuple[float, float, float] = (1.0, 0.001, 0.001), rule: str = "norm",
    block_pieces: int = 32768, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text counts as empty: one piece with the end id alone. Only texts
    longer than ``capacity`` are cut. ``max_docs`` and ``max_cost`` default to
    what ``capacity`` tokens can hold at most. Rows are packed on their own:
    rows that repeat an id or have none are further documents. An empty table
    gives no rows; other columns are not read.
    """
    pieces = written(token_pieces(docs, tokenizer_path, end_id, capacity, id_col, text_col), "token-pieces")
    blocks = max(1, -(-pieces.count() // block_pieces))
    limits = (capacity, max_docs or capacity, float(max_cost or capacity**2))

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.drop_columns("block").sort_by([(c, "ascending") for c in ("doc_id", "piece", "ids_crc32")])
        lengths = rows["length"].to_numpy()
        bins = pack(lengths, *limits, weights, rule)
        order = np.argsort(bins, kind="stable")
        before = np.cumsum(lengths[order]) - lengths[order]
        offsets = np.empty(len(bins), np.int64)
        offsets[order] = before - before[np.searchsorted(bins[order], bins[order])]
        return rows.append_column("sequence_id", pa.array(bins + (key[0].as_py() << 32))).append_column("offset", pa.array(offsets))

    # dealt by place in the written table, so that repeated rows do not meet in one block
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))
    return pieces.withColumn("block", block).groupBy("block").applyInArrow(run, PACKED)
