"""Exact dedup: local groups, salted merge, global merge, full content compared in each.

Only DataFrame functions run here. A group is first combined where its rows are
read, then within a salt (the reading partition modulo ``salts``), then
globally; each step groups by digest *and* whole text, so that two texts with
one digest never meet. At most one row of a text per reading task, and one per
salt, is shuffled, however many copies there are.

The rows find their group by digest. Should one digest ever belong to several
texts, which the grouped texts prove or rule out, the rows of such digests are
matched by whole text instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import folded, written


def content_classes(rows: DataFrame, salts: int) -> DataFrame:
    """One row per distinct ``(digest, norm)``: keep_id, group_size."""
    salted = (
        rows.withColumn("salt", F.spark_partition_id() % salts)
        .groupBy("digest", "salt", "norm")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    )
    return salted.groupBy("digest", "norm").agg(
        F.max("keep_id").alias("keep_id"), F.sum("n").alias("group_size")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 16) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. The largest id of a
    group stays. Null text counts as empty. A null id stays only in a group
    without other ids; rows that repeat an id and a text count in group_size
    and share their decision. An empty table gives no rows; other columns are
    not read.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), folded(F.col(text_col)).alias("norm")).select(
        "doc_id", "norm", F.unhex(F.sha2("norm", 256)).alias("digest")
    )
    classes = content_classes(rows, salts)
    by_digest = written(
        classes.groupBy("digest").agg(
            F.max("keep_id").alias("keep_id"),
            F.max("group_size").alias("group_size"),
            F.count(F.lit(1)).alias("texts"),
        ),
        "exact-dedup",
    )
    decided = rows.select("doc_id", "digest").join(by_digest.filter("texts = 1").drop("texts"), "digest")
    shared = by_digest.filter("texts > 1").select("digest")
    if not shared.isEmpty():
        by_text = classes.join(shared, "digest", "left_semi")
        decided = decided.unionByName(rows.join(by_text, ["digest", "norm"]).drop("norm"))
    return decided.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
