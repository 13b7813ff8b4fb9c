"""Line dedup: explode normalised lines, hash, count documents per hash, drop, reassemble.

Lines travel as 16-byte hashes with their places, never as text. A hash that
many documents hold is counted over ``(hash, document)`` first, which spreads
it, and then with map-side sums; its join is one that Spark splits by size.
Places to drop meet their document once, by id.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, written

BLANKS = " \t\n\x0b\x0c\r"


def _line_keys(shortest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, ids, places = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held: dict[bytes, list[int]] = {}
                for place, line in enumerate((text or "").split("\n")):
                    line = line.strip(BLANKS)
                    if len(line) >= shortest:
                        held.setdefault(blake2b(line.encode().lower(), digest_size=16).digest(), []).append(place)
                keys += held.keys()
                places += held.values()
                ids += [doc_id] * len(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(ids, pa.int64()), pa.array(places, pa.list_(pa.int32()))],
                ["key", "doc_id", "places"],
            )

    return run


def _without_lines(text_at: int, counts: tuple[str, str] | None):
    """Of rows with places to drop as last column: all other columns, text shortened, then both counts if named."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            total, dropped, kept = [], [], []
            for text, places in zip(batch.column(text_at).to_pylist(), batch.columns[-1].to_pylist()):
                text = text or ""
                if places:
                    gone = {p for some in places for p in some}
                    lines = text.split("\n")
                    total.append(len(lines))
                    kept.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
                    dropped.append(len(gone))
                else:
                    total.append(text.count("\n") + 1)
                    kept.append(text)
                    dropped.append(0)
            columns = batch.columns[:-1]
            columns[text_at] = pa.array(kept, pa.string())
            if counts:
                columns += [pa.array(total, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], *(counts or ())])

    return run


def line_drops(docs: DataFrame, id_col: str, text_col: str, shortest: int, least_docs: int) -> DataFrame:
    """id and the places of the lines that it loses, as lists of lists."""
    lines = written(
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id is not null")
        .mapInArrow(_line_keys(shortest), "key binary, doc_id bigint, places array<int>"),
        "line-keys",
    )
    # written, so that both sides of the join below are dealt anew and Spark can split a line that many documents hold
    common = written(
        lines.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
        .groupBy("key").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last_doc"))
        .filter(F.col("docs") >= least_docs),
        "common-lines",
    )
    return (
        lines.join(common, "key").filter("doc_id <> last_doc")
        .groupBy("doc_id").agg(F.collect_list("places").alias("places"))
    )


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = 20, least_docs: int = 3,
    counts: tuple[str, str] | None = ("n_lines", "n_dropped"),
) -> DataFrame:
    """The input rows with all their columns, their text without its dropped lines, and ``counts``: all lines, dropped lines.

    A line's key is the line without blanks at its ends, A-Z in lower case.
    Keys of at least ``shortest`` code points held by at least ``least_docs``
    documents lose all lines but those of the largest id that holds them. Null
    text is one empty line, and comes back empty. Rows with a null id neither
    count nor lose lines; rows that repeat an id are one document for the
    counts, and its places to drop hold for each of them. Input columns named
    as the counts give way to them; with None there are no counts.
    """
    docs = docs.drop(*(counts or ()))
    drops = line_drops(docs, id_col, text_col, shortest, least_docs)
    own, places = (f"{x}_{len(docs.columns)}_{'_'.join(docs.columns)}" for x in ("id", "places"))  # names that no column has
    drops = drops.select(F.col("doc_id").alias(own), F.col("places").alias(places))
    joined = docs.join(drops, F.col(id_col) == F.col(own), "left").drop(own)
    schema = T.StructType([*(T.StructField(f.name, T.StringType() if f.name == text_col else f.dataType) for f in docs.schema),
                           *(T.StructField(c, T.LongType()) for c in counts or ())])
    return joined.mapInArrow(_without_lines(docs.columns.index(text_col), counts), schema)
