"""Exact top-k inner products in three phases with a uniform threshold.

Vectors lie in blocks of like norms; a block's slices of dimensions are the
lists that hold partial scores.

1. Every query gathers the heads of the lists of a few blocks, and their exact
   totals. The k-th best of all gathered totals is a safe cutoff t.
2. The cutoff goes back with the query to all blocks. A row that reaches t
   reaches t / slices in one slice at least, whatever the signs, so each slice
   collects its entries from there on. A slice is not multiplied where norms
   show that no total can reach t: for queries that a whole block stays below,
   and, slice after slice, for the rows and queries that what is known of them
   leaves below.
3. Entries whose bound reaches t are scored exactly, and the best k of each
   block meet in the final ranking.

Queries are rows of the table and grow with it, so they are not broadcast:
blocks of queries and blocks of rows, each one packed row of bounded size, meet
by an equality join on block numbers. Only k entries per query and block leave
a task, and Spark ranks them with a group limit before its shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SAFE = float(2**53)
LEAST, MOST = -(2**63), 2**63 - 1
NO_CUTOFF = LEAST
#: Blocks whose list heads a query gathers for its cutoff.
HEAD_BLOCKS = 8


def _matrix(vectors: list) -> np.ndarray:
    """The vectors as rows, shorter ones filled up with 0."""
    out = np.zeros((len(vectors), max(1, max(map(len, vectors), default=0))))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _pack(block_rows: int):
    """The rows of a task as packed blocks of at most ``block_rows`` rows."""

    def block(rows: list[tuple]) -> pd.DataFrame:
        numbers, ids, vectors, cutoffs = zip(*rows)
        m = _matrix(list(vectors))
        longs = lambda values: [np.array(values, "<i8").tobytes()]
        return pd.DataFrame({"rows": longs(numbers), "ids": longs(ids), "data": [m.astype("<f8").tobytes()], "width": [m.shape[1]], "cutoffs": longs(cutoffs)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for batch in batches:
            for row in zip(batch["row"], batch["vec_id"], batch["embedding"], batch["cutoff"]):
                rows.append(row)
                if len(rows) == block_rows:
                    yield block(rows)
                    rows = []
        if rows:
            yield block(rows)

    return run


def _whole(m: np.ndarray) -> np.ndarray:
    """floor(256 * x) as integers of any size."""
    return np.array([[int(x) * 256 if abs(x) >= SAFE else int(np.floor(x * 256)) for x in row] for row in m.tolist()], object).reshape(m.shape)


def _large_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products beyond a double's exact integers; beyond 64 bits they stay at the border."""
    return np.clip(_whole(q).dot(_whole(x).T), LEAST, MOST).astype(np.int64)


def reaching(
    q: np.ndarray, x: np.ndarray, edges: list[tuple[int, int]], cutoffs: np.ndarray, counted: list[int] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of q, row of x and score of all pairs whose score reaches the cutoff of q.

    The products must be exact in doubles. ``counted`` gets the number of
    multiplied pairs of each slice.
    """
    cutoffs = np.maximum(cutoffs, -(2**60))  # below all exact products
    norms = lambda m: np.sqrt(np.stack([np.square(m[:, a:b]).sum(axis=1) for a, b in edges], axis=1))
    qn, xn = norms(q), norms(x)
    above = lambda bound: bound * (1 + 1e-9) + 1  # noqa: E731  norms are rounded
    rows = np.flatnonzero(above(qn @ xn.max(axis=0)) >= cutoffs)
    cols = np.arange(len(x))
    share = -((-cutoffs) // len(edges))  # the uniform threshold: the mean share of the cutoff, rounded up
    total = np.zeros((len(rows), len(cols)))
    listed = np.zeros(total.shape, bool)
    for s, (a, b) in enumerate(edges):
        if counted is not None:
            counted.append(total.size)
        if not total.size:
            break
        part = q[rows, a:b] @ x[cols, a:b].T
        total += part
        listed |= part >= share[rows, None]
        left = above(qn[rows, s + 1 :] @ xn[cols, s + 1 :].T) if s + 1 < len(edges) else 0
        alive = total + left >= cutoffs[rows, None]
        keep_rows, keep_cols = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        if len(keep_rows) * len(keep_cols) < total.size:
            total, listed = total[np.ix_(keep_rows, keep_cols)], listed[np.ix_(keep_rows, keep_cols)]
            rows, cols = rows[keep_rows], cols[keep_cols]
    i, j = np.nonzero(listed & (total >= cutoffs[rows, None]))
    return rows[i], cols[j], total[i, j].astype(np.int64)


def _heads(q: np.ndarray, x: np.ndarray, edges: list[tuple[int, int]], depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for the pairs at the head of a slice's list."""
    parts = [q[:, a:b] @ x[:, a:b].T for a, b in edges]
    cols = np.concatenate([np.argpartition(-p, depth - 1, axis=1)[:, :depth] for p in parts], axis=1)
    keys = np.unique(np.repeat(np.arange(len(q)), cols.shape[1]) * len(x) + cols.ravel())
    rows, cols = np.divmod(keys, len(x))
    return rows, cols, sum(p[rows, cols] for p in parts).astype(np.int64)


def _search(k: int, slices: int, final: bool, query_chunk: int = 256):
    """Per query and row block the best k: of list heads (phase 1) or of all (phases 2 and 3)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        longs = lambda data: np.frombuffer(data, "<i8")
        for batch in batches:
            for block in batch.itertuples(index=False):
                x_rows, x_ids, raw_x = longs(block.rows), longs(block.ids), np.frombuffer(block.data, "<f8").reshape(-1, block.width)
                q_rows, q_ids, raw_q = longs(block.q_rows), longs(block.q_ids), np.frombuffer(block.q_data, "<f8").reshape(-1, block.q_width)
                width = min(block.width, block.q_width)
                with np.errstate(over="ignore"):
                    x, q = np.floor(raw_x[:, :width] * 256), np.floor(raw_q[:, :width] * 256)
                borders = np.linspace(0, width, min(slices, width) + 1).astype(int).tolist()
                edges = list(zip(borders, borders[1:]))
                exact = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * width < SAFE
                found: list[tuple] = []
                for at in range(0, len(q), query_chunk):
                    some, cut = q[at : at + query_chunk], longs(block.cutoffs)[at : at + query_chunk]
                    if not exact:
                        scores = _large_scores(raw_q[at : at + query_chunk, :width], raw_x[:, :width])
                        rows, cols = np.nonzero(scores >= cut[:, None])
                        scores = scores[rows, cols]
                    elif final:
                        rows, cols, scores = reaching(some, x, edges, cut)
                    else:
                        rows, cols, scores = _heads(some, x, edges, min(k + 1, len(x)))
                    fine = q_rows[at + rows] != x_rows[cols]
                    rows, cols, scores = rows[fine], cols[fine], scores[fine]
                    order = np.lexsort((x_ids[cols], ~scores, rows))
                    rows, cols, scores = rows[order], cols[order], scores[order]
                    top = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
                    found.append((q_rows[at + rows[top]], q_ids[at + rows[top]], x_ids[cols[top]], scores[top]))
                yield pd.DataFrame(dict(zip(("query_row", "query_id", "vec_id", "score"), map(np.concatenate, zip(*found)))))

    return run


FOUND = "query_row bigint, query_id bigint, vec_id bigint, score bigint"
BLOCK = "rows binary, ids binary, data binary, width int, cutoffs binary"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def exact_topk(
    vectors: DataFrame, is_query: Column, k: int = 5, slices: int = 4, block_rows: int = 4096,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """Rows query_id, rank, vec_id, score: the ``k`` best inner products of each row chosen by ``is_query``.

    Components become floor(256 * x); scores are exact integers, at most the
    least or largest of 64 bits. Every other row is a candidate; ties go to the
    smaller id. Rows that repeat an id are queries and candidates of their own.
    Null ids, null vectors and vectors that hold null or non-finite components
    take no part; missing components of shorter vectors are 0. With fewer
    than ``k`` other rows all are returned, with none nothing. ``is_query``
    may use the id column. Other columns are not read.
    """
    usable = (
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"),
                       F.coalesce(is_query, F.lit(False)).alias("asks"))
        .filter("vec_id is not null and embedding is not null")
        .filter(F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    )
    norm = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x)
    # like norms side by side; rows of one norm, as copies are, spread by a hash
    rows = written(usable.withColumn("norm", norm).repartitionByRange(F.desc("norm"), F.xxhash64("vec_id")).sortWithinPartitions(F.desc("norm"))
                   .withColumn("row", F.monotonically_increasing_id()).withColumn("cutoff", F.lit(NO_CUTOFF).cast("long")), "topk-rows")
    blocks = written(rows.mapInPandas(_pack(block_rows), BLOCK).withColumn("spread", F.xxhash64("rows")), "topk-blocks")
    groups = max(1, blocks.count())
    blocks = blocks.drop("cutoffs").withColumn("place", F.pmod("spread", F.lit(groups))).drop("spread")

    def search(queries: DataFrame, final: bool) -> DataFrame:
        many = groups if final else min(groups, HEAD_BLOCKS)
        places = F.transform(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long")), lambda i: F.pmod(F.xxhash64("rows") + i, F.lit(groups)))
        packed = queries.mapInPandas(_pack(block_rows), BLOCK).select(
            F.col("rows").alias("q_rows"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"), F.col("width").alias("q_width"), "cutoffs",
            F.explode(places).alias("place"),
        )
        return blocks.join(packed, "place").drop("place").mapInPandas(_search(k, slices, final), FOUND)

    asking = rows.filter("asks").select("row", "vec_id", "embedding", "cutoff")
    cutoffs = (
        _ranked(search(asking, final=False), k).groupBy(F.col("query_row").alias("row"))
        .agg(F.when(F.count("score") == k, F.min("score")).alias("found"))
    )
    told = asking.join(cutoffs, "row", "left").withColumn("cutoff", F.coalesce("found", "cutoff")).drop("found")
    return _ranked(search(told, final=True), k).select("query_id", "rank", "vec_id", "score")
