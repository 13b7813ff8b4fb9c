"""Packs of bounded volume, batches and epoch figures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrays import prefix_sums

# Fixed values of the packing job.
BATCH_ROWS = 256
CAPACITY = 4096
IGNORED_LABEL = -100


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Pack and place in it of every length, for many batches side by side.

    A row of ``lengths`` is a batch, longest first, filled up with -1. A length
    goes into the fullest pack of its batch with room, the first of equal ones;
    lengths above the capacity get packs of their own.
    """
    batches, longest = lengths.shape
    none = np.iinfo(np.int64).max
    rooms = np.full((batches, longest), -1, np.int64)
    sizes, made = np.zeros((batches, longest), np.int64), np.zeros(batches, np.int64)
    packs, places = np.full((2, batches, longest), -1, np.int64)
    for i in range(longest):
        rows = np.flatnonzero(lengths[:, i] >= 0)
        need = lengths[rows, i]
        open_rooms = rooms[rows, : int(made.max(initial=0)) + 1]
        fitting = np.where(open_rooms >= need[:, None], open_rooms, none)
        pack = fitting.argmin(axis=1)
        new = fitting[np.arange(len(rows)), pack] == none
        pack[new] = made[rows[new]]
        rooms[rows[new], pack[new]] = np.maximum(capacity, need[new])
        made[rows[new]] += 1
        rooms[rows, pack] -= need
        packs[rows, i], places[rows, i] = pack, sizes[rows, pack]
        sizes[rows, pack] += 1
    return packs, places


def _pack_stream(capacity: int):
    """Packs batches whose rows come sorted; the last batch waits for the next rows."""

    def packed(table: pa.Table, batch: np.ndarray) -> pa.RecordBatch:
        first = np.flatnonzero(np.diff(batch, prepend=batch[0] - 1))
        row, place = np.searchsorted(first, np.arange(len(batch)), "right") - 1, np.arange(len(batch))
        place -= first[row]
        lengths = np.full((len(first), int(place.max()) + 1), -1, np.int64)
        lengths[row, place] = table["num_tokens"].to_numpy()
        packs, places = best_fit(lengths, capacity)
        shown = table.append_column("pack", pa.array(packs[row, place])).append_column("position", pa.array(places[row, place]))
        return shown.combine_chunks().to_batches()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for rows in batches:
            table = pa.Table.from_batches([rows])
            held = table if held is None else pa.concat_tables([held, table])
            batch = held["batch"].to_numpy()
            done = int(np.searchsorted(batch, batch[-1])) if len(batch) else 0
            if done:
                yield packed(held.slice(0, done), batch[:done])
                held = held.slice(done)
        if held is not None and held.num_rows:
            yield packed(held, held["batch"].to_numpy())

    return run


def pack(rows: DataFrame, ordinal: str, num_tokens: str, row_id: str, capacity: int = CAPACITY,
         batch_rows: int = BATCH_ROWS) -> DataFrame:
    """(row id, num_tokens, batch, pack, position): packs never cross a batch of
    consecutive rows, so every batch holds at most ``batch_rows`` rows."""
    batched = rows.select(
        row_id, F.col(num_tokens).cast("bigint").alias("num_tokens"), F.floor((F.col(ordinal) - 1) / batch_rows).cast("bigint").alias("batch"),
        F.col(ordinal).alias("_ordinal"))
    dealt = batched.repartition("batch").sortWithinPartitions("batch", F.desc("num_tokens"), "_ordinal").drop("_ordinal")
    schema = T.StructType([*dealt.schema.fields, T.StructField("pack", T.LongType()), T.StructField("position", T.LongType())])
    return dealt.mapInArrow(_pack_stream(capacity), schema)


def packing_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Packs, samples, tokens and mean fill of a packing."""
    packs = packed.groupBy("batch", "pack").agg(
        F.count("*").alias("_samples"), F.sum("num_tokens").alias("_tokens"))
    return packs.agg(
        F.count("*").alias("packs"), F.sum("_samples").alias("samples"), F.sum("_tokens").alias("tokens"),
        F.count_if((F.col("_tokens") > capacity) & (F.col("_samples") > 1)).alias("overfull"),
        F.round(F.sum("_tokens") / (F.count("*") * capacity), 6).alias("fill"))


def pad_batches(rows: DataFrame, batch: str, ids: str, labels: str, pad_id: int, max_length: int) -> DataFrame:
    """Right-padded, cut ids, labels, positions and mask per row of a batch."""
    longest = F.max(F.size(ids)).over(Window.partitionBy(batch))
    width = F.least(longest, F.lit(max_length))

    def fitted(values: Column, filler: int) -> Column:
        missing = F.greatest(width - F.size(values), F.lit(0))
        return F.slice(F.concat(values, F.array_repeat(F.lit(filler).cast("bigint"), missing)), F.lit(1), width)

    positions = F.when(F.size(ids) > 0, F.sequence(F.lit(0).cast("bigint"), F.size(ids).cast("bigint") - 1)).otherwise(
        F.array().cast("array<bigint>"))
    padded = rows.withColumn("padded_ids", fitted(F.col(ids), pad_id)) \
        .withColumn("padded_labels", fitted(F.col(labels), IGNORED_LABEL)) \
        .withColumn("padded_positions", fitted(positions, 1))
    return padded.withColumn("attention", F.transform("padded_ids", lambda x: (x != pad_id)))


def concatenate_packs(rows: DataFrame, pack_keys: list[str], position: str, ids: str, labels: str) -> DataFrame:
    """One row per pack: ids and labels joined in order, and the lengths."""
    joined = rows.groupBy(*pack_keys).agg(F.array_sort(F.collect_list(F.struct(
        F.col(position).alias("p"), F.col(ids).alias("ids"), F.col(labels).alias("labels")))).alias("_items"))
    pick = lambda name: F.transform("_items", lambda e: e[name])
    return joined.select(
        *pack_keys, F.flatten(pick("ids")).alias("ids"), F.flatten(pick("labels")).alias("labels"),
        F.transform("_items", lambda e: F.size(e["ids"])).alias("lengths"))


def sequence_bounds(lengths: Column) -> Column:
    """0 and the running sums of the lengths of one pack or batch."""
    return F.concat(F.array(F.lit(0).cast("bigint")), prefix_sums(lengths))


def with_substitutes(rows: DataFrame, ordinal: str, failed: Column, policy: str) -> DataFrame:
    """Applies DROP, FAIL or SUBSTITUTE_NEXT to failed rows.

    SUBSTITUTE_NEXT puts the next row in a failed row's place (the last row is
    its own successor); a failed successor stops the job. Adds ``source_ordinal``.
    """
    marked = rows.withColumn("_failed", failed).withColumn("source_ordinal", F.col(ordinal))
    good = marked.where(~F.col("_failed")).drop("_failed")
    if policy == "DROP":
        return good
    if policy == "FAIL":
        stop = F.when(F.col("_failed"), F.raise_error(F.lit("bad sample")).cast("bigint"))
        return marked.withColumn("source_ordinal", F.coalesce(stop, F.col("source_ordinal"))).drop("_failed")
    bad = marked.where(F.col("_failed")).select(F.col(ordinal).alias("_place"), (F.col(ordinal) + 1).alias(ordinal))
    following = bad.join(marked, ordinal, "left")
    usable = F.when(F.coalesce(F.col("_failed"), F.lit(True)), F.raise_error(F.concat(
        F.lit("no usable sample after "), F.col("_place").cast("string"))).cast("bigint")).otherwise(F.col("_place"))
    moved = following.select(*[
        usable.alias(ordinal) if c == ordinal else F.col(c) for c in good.columns])
    return good.unionByName(moved)


def epoch_plan(rows: DataFrame, batch_size: int, accumulation: int, world_size: int, epochs: int) -> DataFrame:
    step_rows = batch_size * accumulation * world_size
    steps = F.floor(F.count("*") / step_rows)
    return rows.agg(F.count("*").alias("samples"), steps.alias("steps_per_epoch"), (steps * epochs).alias("total_steps"))
