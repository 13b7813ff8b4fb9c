"""Bounded labelled samples, and models that one task fits on them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, slices


def remainder(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; rows with 0 are held out of learning. Null ids give null."""
    return F.crc32(id_col.cast("string").cast("binary")) % 5


def learning_prior(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> float:
    """The share of label 1 among all labels that are learned from, kept off 0 and 1; 0.5 without any."""
    prior = labels.filter(labels[label_col].isin(0, 1) & (remainder(labels[id_col]) != 0)).agg({label_col: "avg"}).collect()[0][0]
    return min(max(float(prior if prior is not None else 0.5), 1e-3), 1 - 1e-3)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """text, label of at most ``per_class`` learning rows of each class, those of the smallest id hashes.

    A document with several labels takes the largest, rows that repeat an id are
    one with their smallest text; null labels and ids do not count. The ids are chosen from the labels alone, so at most
    2 * ``per_class`` of them are broadcast to the documents.
    """
    known = (
        labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
        .filter("_id is not null and _label in (0, 1)")
        .groupBy("_id").agg(F.max("_label").alias("_label")).filter(remainder(F.col("_id")) != 0)
    )
    order = F.xxhash64("_id")
    chosen = [known.filter(F.col("_label") == c).orderBy(order, "_id").limit(per_class) for c in (0, 1)]
    wanted = F.broadcast(chosen[0].unionByName(chosen[1]))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).join(wanted, "_id")
    # one row per id, so that the chosen ids are the only bound; the limit keeps the order
    rows = rows.groupBy("_id", "_label").agg(F.min("text").alias("text"))
    return rows.orderBy(order, "_id").limit(2 * per_class).select("text", F.col("_label").alias("label"))


def fit_in_task(sample: DataFrame, fit: Callable[[pa.Table], bytes]) -> bytes:
    """What ``fit`` makes of the bounded sample, in one task; without rows it is called with none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches), pa.schema([("text", pa.string()), ("label", pa.int32())]))
        model = fit(table)
        del table
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])

    rows = sample.repartition(1).mapInArrow(run, "model binary").collect()
    return bytes(rows[0]["model"]) if rows else fit(pa.table({"text": pa.array([], pa.string()), "label": pa.array([], pa.int32())}))


def scored(docs: DataFrame, score: Callable[[pa.Array], np.ndarray], threshold: float, id_col: str, text_col: str) -> DataFrame:
    """doc_id, held_out, score, predicted for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(score(batch.column(2)), pa.float64())], ["doc_id", "held_out", "score"])

    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(remainder(F.col(id_col)) == 0, F.lit(False)).alias("held_out"), F.col(text_col).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def rows_scoring(docs: DataFrame, score: Callable[[pa.Array], np.ndarray], accept: Callable[[np.ndarray], np.ndarray], text_col: str) -> DataFrame:
    """The rows, with all their columns, whose score is accepted; nothing is shuffled.

    Only the text decides: null counts as empty, ids are not read, repeated rows
    stay or go together. An empty table gives no rows.
    """
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(accept(score(batch.column(at)))))

    return docs.mapInArrow(run, docs.schema)
