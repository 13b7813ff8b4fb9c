"""Shards of a uniformly shuffled table, by a shuffle in two passes over the disks.

1. Rows are scattered by a seeded hash into buckets of about ``bucket_bytes``,
   whose number follows the bytes of the texts. The hash takes the id and the
   place at which the row is read, so rows that repeat an id or a text scatter as
   evenly as others do.
2. Each bucket fits into the memory of its task, which puts it into an order of
   its own (by the hash), shuffles it by Fisher and Yates with a generator seeded
   by the bucket, and writes it.

The written buckets, one after the other, are the shuffled table. Counts of the
buckets, one small row each, give every row its rank, and equal ranges of ranks
are the shards: the law is ``rows``, counts differ by one at most. A shard is a
run of neighbouring buckets, so reading one skips the files of the others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from .common import written

ADDED = ["law", "shard", "slot"]
#: Offsets of so many buckets, 16 bytes each, are handed to every executor at most.
BROADCAST_BUCKETS = 1 << 20


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniformly drawn order of ``n`` rows."""
    order = list(range(n))
    for i, j in zip(range(n - 1, 0, -1), rng.integers(0, np.arange(n, 1, -1)).tolist() if n > 1 else []):
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def shuffled_buckets(docs: DataFrame, seed: int, bucket_bytes: int, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """The rows with ``_bucket`` and ``_place`` in it, written once, and the number of buckets."""
    size = docs.agg(F.sum(F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + 64).alias("n")).collect()[0]["n"] or 0
    buckets = max(1, -(-size // bucket_bytes))
    key = F.xxhash64(F.lit(seed), F.col(id_col), F.monotonically_increasing_id())
    rows = docs.withColumn("_key", key).withColumn("_bucket", F.pmod(F.xxhash64(F.lit(seed), "_key"), F.lit(buckets)))
    schema = StructType(list(docs.schema.fields)).add("_bucket", LongType()).add("_place", IntegerType())

    def shuffle(group: tuple, table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table["_key"].to_numpy(), kind="stable"))).drop_columns(["_key"])
        table = table.take(pa.array(fisher_yates(table.num_rows, np.random.default_rng([seed, group[0].as_py()]))))
        return table.append_column("_place", pa.array(np.arange(table.num_rows), pa.int32()))

    return written(rows.groupBy("_bucket").applyInArrow(shuffle, schema), "shuffled-buckets"), buckets


def bucket_offsets(rows: DataFrame, span: int = 1024) -> DataFrame:
    """_bucket, _before: the rows of all buckets before it; sums of ``span`` buckets are placed first, then the buckets in them."""
    counts = written(rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).withColumn("_span", F.floor(F.col("_bucket") / span)), "bucket-counts")
    spans = counts.groupBy("_span").agg(F.sum("_n").alias("_n")).select(
        "_span", (F.sum("_n").over(Window.orderBy("_span")) - F.col("_n")).alias("_ahead")
    )
    inside = F.sum("_n").over(Window.partitionBy("_span").orderBy("_bucket")) - F.col("_n")
    return counts.withColumn("_inside", inside).join(spans, "_span").select("_bucket", (F.col("_ahead") + F.col("_inside")).alias("_before"))


def place(rank: Column, n_rows: int, shards: int) -> tuple[Column, Column]:
    """The shard and the slot in it of a rank from 0; the first n_rows % shards shards have one row more."""
    least, more = divmod(n_rows, shards)
    border = more * (least + 1)
    large, small = F.lit(least + 1), F.lit(max(least, 1))
    rest = rank - border
    first = rank < border
    shard = F.when(first, F.floor(rank / large)).otherwise(more + F.floor(rest / small))
    return shard.cast("int"), F.when(first, rank % large).otherwise(rest % small).cast("long")


def sharded(
    docs: DataFrame, shards: int = 8, seed: int = 1, bucket_bytes: int = 16 << 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """All rows and columns in shuffled order, with law (``rows``), shard (from 0) and slot in the shard (from 0, gapless).

    Every order is equally likely. The same seed over a table that is read alike
    gives the same rows; the written buckets fix them for all that follows. Rows
    that repeat an id, null ids and null texts are rows as others. With fewer
    rows than shards the last shards are empty; an empty table gives no rows.
    Columns named as the three added ones, ``_key``, ``_bucket`` or ``_place`` are replaced.
    """
    docs = docs.drop(*ADDED, "_key", "_bucket", "_place")
    rows, buckets = shuffled_buckets(docs, seed, bucket_bytes, id_col, text_col)
    offsets = written(bucket_offsets(rows), "bucket-offsets")
    n_rows = rows.count()
    if buckets <= BROADCAST_BUCKETS:
        offsets = F.broadcast(offsets)
    shard, slot = place(F.col("_before") + F.col("_place"), n_rows, shards)
    return rows.join(offsets, "_bucket").select(*docs.columns, F.lit("rows").alias("law"), shard.alias("shard"), slot.alias("slot"))


def write_shards(rows: DataFrame, folder: str) -> None:
    """One subfolder for each shard; a shard's rows lie in the order of their slots within each file."""
    rows.write.partitionBy("shard").parquet(folder)


def shard_facts(rows: DataFrame) -> DataFrame:
    """Sizes and checksums of the rows of ``sharded``; no shard is added under the law ``rows``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return rows.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )
