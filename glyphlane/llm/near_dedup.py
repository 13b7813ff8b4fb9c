"""Near-dedup by b-bit MinHash: bands give candidates, packed low bits weed them, full sets decide.

1. Each text becomes its set of 64-bit shingle hashes, 128 minima, 32 band keys
   of 4 whole minima, and the low 4 bits of each minimum packed into 8 longs.
2. Equal sets are one class from here on; its smallest id stands for it.
3. Classes that share a band key form a bucket. Each bucket is first joined to
   its smallest and largest member only. A pair goes on if its similarity,
   estimated from the bit counts of the packed signatures and corrected for
   chance agreement of low bits, is not far below the threshold; what remains
   is confirmed on the full sets of both whole texts.
4. Components of the confirmed links are found. In a bucket whose members are
   all in one component no further pair can matter. In the others the members
   outside the largest component there meet all members, in blocks of bounded
   size: packed signatures are compared within the task, pairs are confirmed
   best first, and pairs that a found link already connects are left out. Only
   links that join components leave a task.

A pair at the threshold misses all 32 bands with a chance of 5e-6, and falls
below the estimate's margin of 5.5 standard errors with one of 2e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import give_back, slices, written
from .components import components
from .hashed_words import BASE, FOLD, NOT_BLANK, SPREAD, chunks, combined, mix, run_hashes, words_of

HASHES, ROWS, BITS = 128, 4, 4
BANDS, LANES = HASHES // ROWS, 64 // BITS
LOW_BITS = 0x1111111111111111
_RANDOM = np.random.default_rng(20)
FACTORS = _RANDOM.integers(0, 1 << 32, HASHES, dtype=np.uint32) | np.uint32(1)
SHIFTS = _RANDOM.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each whole text."""
    out: list[np.ndarray] = []
    for _, _, data, offsets in chunks(texts):
        words = words_of(FOLD[data], offsets, NOT_BLANK)
        hashes, firsts = combined(run_hashes(words.data, words.begins), words.firsts, size)
        out += [np.unique(hashes[a:b]) for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist())]
    return out


def minima(found: np.ndarray) -> np.ndarray:
    """The least value of each of the 128 functions over a set."""
    values = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(values), 2048):
        block = FACTORS[:, None] * values[None, at : at + 2048]
        block += SHIFTS[:, None]
        np.minimum(out, block.min(axis=1), out)
    return out


def packed_low_bits(least: np.ndarray) -> np.ndarray:
    """Low bits of the remixed minima, 16 to a long."""
    low = (mix(least.astype(np.uint64)) & np.uint64(2**BITS - 1)).reshape(len(least), -1, LANES)
    return (low << (np.arange(LANES, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64)


def band_keys(least: np.ndarray) -> np.ndarray:
    m = least.astype(np.uint64).reshape(len(least), BANDS, ROWS)
    ahead = m[:, :, 0] | m[:, :, 1] << np.uint64(32)
    behind = m[:, :, 2] | m[:, :, 3] << np.uint64(32)
    return mix(mix(ahead + np.arange(1, BANDS + 1, dtype=np.uint64) * BASE) + behind * SPREAD)


SIGNED = "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>, low array<bigint>"


def _signatures(size: int):
    lists = lambda m, n: pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, n, dtype=np.int32)), pa.array(m.ravel().view(np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches):
            if some.num_rows:
                sets = shingle_sets(some.column(1), size)
                least = np.stack([minima(s) for s in sets])
                d1 = np.array([mix(s).sum(dtype=np.uint64) if len(s) else 0 for s in sets], np.uint64)
                d2 = np.array([np.bitwise_xor.reduce(mix(s * SPREAD)) if len(s) else 0 for s in sets], np.uint64)
                yield pa.RecordBatch.from_arrays([
                    some.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                    lists(band_keys(least), BANDS), lists(packed_low_bits(least), HASHES // LANES),
                ], ["doc_id", "n_shingles", "d1", "d2", "bands", "low"])

    return run


def estimated(a: str, b: str) -> Column:
    """Similarity from two packed signatures: agreeing lanes, less those that agree by chance."""
    differ = F.lit(0)
    for k in range(HASHES // LANES):
        x = F.col(a)[k].bitwiseXOR(F.col(b)[k])
        for shift in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(LOW_BITS)))
    chance = 1 / 2**BITS
    return (1 - differ / HASHES - chance) / (1 - chance)


def _estimates(low: np.ndarray, others: np.ndarray) -> np.ndarray:
    """The same for one packed signature against many."""
    x = others ^ low
    for shift in (1, 2):
        x |= x >> np.uint64(shift)
    differ = np.bitwise_count(x & np.uint64(LOW_BITS)).sum(axis=1)
    chance = 1 / 2**BITS
    return (1 - differ / HASHES - chance) / (1 - chance)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union."""
    if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
        return False
    both = np.concatenate([x, y])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared) and shared > 0


def _confirmed(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in slices(batches, 256):
            if some.num_rows:
                left, right = shingle_sets(some.column(2), size), shingle_sets(some.column(3), size)
                good = pa.array([linked(x, y, percent) for x, y in zip(left, right)])
                yield pa.RecordBatch.from_arrays([some.column(0).filter(good), some.column(1).filter(good)], ["a", "b"])

    return run


def _joined_in_unit(size: int, percent: int, least_estimate: float):
    """Links between components of one unit: rows of one block, or of a block (side 0) against another (side 1)."""

    def run(rows: pa.Table) -> pa.Table:
        ids, group, side = (rows[c].to_numpy() for c in ("id", "component", "side"))
        low = np.stack(rows["low"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)).view(np.uint64)
        sets = shingle_sets(rows["text"].combine_chunks(), size)
        roots = {int(g): int(g) for g in group}

        def root(g: int) -> int:
            while roots[g] != g:
                roots[g] = g = roots[roots[g]]
            return g

        inner = not side.any()
        pairs = []
        for i in np.flatnonzero(side == 0).tolist():
            others = np.arange(i + 1, len(ids)) if inner else np.flatnonzero(side == 1)
            others = others[group[others] != group[i]]
            if len(others):
                near = _estimates(low[i], low[others])
                hit = near >= least_estimate
                pairs += zip(near[hit].tolist(), [i] * int(hit.sum()), others[hit].tolist())
        found = []
        for _, i, j in sorted(pairs, reverse=True):
            x, y = root(int(group[i])), root(int(group[j]))
            if x != y and linked(sets[i], sets[j], percent):
                roots[x] = y
                found.append((ids[i], ids[j]))
        del sets, pairs
        give_back()
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return run


def minhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 75,
    margin: float = 0.22, block: int = 256,
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Words are runs of bytes other than the six ASCII blanks, A-Z in lower case;
    a text's set is its distinct runs of ``size`` words, or all its words as
    one run if there are fewer. Texts whose sets share at least ``percent`` of
    their union are linked; component_id is the smallest id reachable. Null,
    empty and blank texts have no set and are their own component, as are rows
    with a null id, which stay (component_id null). Rows that repeat an id are
    compared row by row. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    signed = written(rows.mapInArrow(_signatures(size), SIGNED), "signatures")
    classes = written(
        signed.filter("doc_id is not null and n_shingles > 0").groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep")), "classes"
    )
    reps = signed.filter("n_shingles > 0").join(classes.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    keys = reps.select(F.explode("bands").alias("key"), F.col("doc_id").alias("id"))
    shared = keys.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n")).filter("n > 1 and lo < hi")
    members = written(keys.join(shared, "key"), "band-members")
    low = signed.select(F.col("doc_id").alias("id"), "low")
    texts = written(
        rows.select(F.col("doc_id").alias("id"), "text").join(members.select("id").distinct(), "id", "left_semi"), "band-texts"
    )

    def with_sides(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
        for side in ("a", "b"):
            pairs = pairs.join(table.select(F.col("id").alias(side), F.col(column).alias(f"{column}_{side}")), side)
        return pairs

    pairs = (
        members.select(F.explode(F.array(F.struct(F.col("lo").alias("a"), F.col("id").alias("b")),
                                         F.struct(F.col("id").alias("a"), F.col("hi").alias("b")))).alias("p"))
        .select("p.a", "p.b").filter("a < b").distinct()
    )
    likely = with_sides(pairs, low, "low").filter(estimated("low_a", "low_b") >= percent / 100 - margin).select("a", "b")
    links = written(
        with_sides(likely, texts, "text").select("a", "b", "text_a", "text_b").mapInArrow(_confirmed(size, percent), "a bigint, b bigint"), "links"
    )
    found = components(links)

    # buckets of more than three members (two ends meet all others) with more than one component
    named = members.filter("n > 3").select("key", "id").join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    parts = named.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    opened = written(
        parts.groupBy("key").agg(
            F.max(F.struct("size", "component")).alias("main"), F.sum("size").alias("total"), F.count(F.lit(1)).alias("parts")
        ).filter("parts > 1").select("key", F.col("main.component").alias("main"), F.col("main.size").alias("main_size"), "total"),
        "open-buckets",
    )
    if not opened.isEmpty():
        blocks = lambda n: F.ceil(n / F.lit(block)).cast("int")
        placed = named.join(opened, "key").select(
            "key", "id", "component", (F.col("component") == F.col("main")).alias("in_main"),
            blocks(F.col("total") - F.col("main_size")).alias("outer"), blocks(F.col("main_size")).alias("inner"),
        )
        place = F.pmod(F.xxhash64("id"), F.when(F.col("in_main"), F.col("inner")).otherwise(F.col("outer"))).cast("int")
        counted = lambda n: F.sequence(F.lit(0), n - 1)
        unit = lambda kind, x, y, side: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"), side.alias("side"))
        me = F.col("place")
        units = placed.withColumn("place", place).select(
            "key", "id", "component",
            F.explode(F.when(
                F.col("in_main"), F.transform(counted(F.col("outer")), lambda k: unit(1, k, me, F.lit(1)))
            ).otherwise(F.concat(
                F.transform(counted(F.col("inner")), lambda k: unit(1, me, k, F.lit(0))),
                F.transform(counted(F.col("outer")), lambda k: unit(0, F.least(k, me), F.greatest(k, me), (me > k).cast("int"))),
            ))).alias("unit"),
        )
        more = written(
            units.select("key", "unit.*", "id", "component").join(low, "id").join(texts, "id")
            .groupBy("key", "kind", "x", "y").applyInArrow(_joined_in_unit(size, percent, percent / 100 - margin), "a bigint, b bigint"),
            "more-links",
        )
        if not more.isEmpty():
            found = components(links.unionByName(more))

    labelled = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select(
        "d1", "d2", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    # rows without a set or an id match no class, and get a key of their own not to meet in one task
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    out = signed.select("doc_id", "n_shingles", F.when(alone, F.monotonically_increasing_id()).otherwise(F.col("d1")).alias("d1"),
                        F.when(alone, F.lit(-1).cast("long")).otherwise(F.col("d2")).alias("d2"))
    return out.join(written(labelled, "class-components"), ["d1", "d2", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of each component's smallest id, and rows with a null id, with all their columns.

    Rows that repeat an id stay or go together; they go if none of them stays.
    """
    own = f"id_{'_'.join(docs.columns)}"  # a name that no column has
    found = minhash_components(docs, id_col, text_col, **options).filter("doc_id is not null")
    gone = found.groupBy("doc_id").agg(F.bool_or("kept").alias("kept")).filter("not kept").select(F.col("doc_id").alias(own))
    return docs.join(written(gone, "near-copies"), F.col(id_col) == F.col(own), "left_anti")
