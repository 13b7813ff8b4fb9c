"""Ranked lexical search over bit-sliced Bloom signatures.

Index: documents lie in blocks. A document's signature has a few bits for each of
its terms, and further bits for each level of occurrences that a term reaches. A
block keeps its signatures in slices, one bitmap over its documents for every
bit, and documents of a like number of terms share a block, so that long texts
don't fill the signatures of short ones. Ands of slices overestimate where a term
is and how often, never underestimate.

Search: the weight of a term times its highest possible share at the level found,
summed over an item's terms, is an upper bound of the score of each document.

1. The k best bounds of each item are scored exactly; the k-th best of these
   scores is a cutoff that the item's true k-th best score reaches.
2. Every document whose bound reaches the cutoff is scored exactly, and the best
   k of these are the result; all others are excluded by their bounds.

Exact scores count the terms in whole texts: occurrences are found by 64-bit
hashes and then compared byte by byte. A block keeps its texts, compressed, beside
its slices, so a task scores what its own bounds let through and no text is ever
shuffled. Document frequencies of the asked terms are counted while the index is
built. Items come in groups of bounded text, one search each; a group's terms,
and k heads for each of its items, are all that tasks are handed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, slices, written

#: Occurrences from which a further entry is set: level i means at least LEVELS[i] of them.
LEVELS = np.array([1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 64, 128, 256, 512, 1024, 4096, 1 << 14, 1 << 17])
BITS, HASHES = 16, 6
MOST_BITS = 1 << 26
SCALE = 1_000_000_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Digits, letters and all bytes of code points beyond ASCII belong to terms.
_IN_TERM = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@dataclass
class Terms:
    """The terms of some texts, one after the other: owner text, place in ``data``, length, hash."""

    data: np.ndarray
    owner: np.ndarray
    start: np.ndarray
    length: np.ndarray
    hashes: np.ndarray


def terms_of(texts: pa.Array) -> Terms:
    """All terms, A-Z lower-cased. Null texts have none."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], "<i8")[texts.offset : texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer is not None and len(texts) else np.zeros(0, np.uint8)
    data, offsets = _LOWER[data], (offsets - offsets[0] if len(offsets) else np.zeros(1, np.int64))
    inside = _IN_TERM[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True  # a text's end ends its last term
    before = np.concatenate([[False], inside[:-1]]) if len(data) else inside
    after = np.concatenate([inside[1:], [False]]) if len(data) else inside
    start = np.flatnonzero(inside & (~before | border[:-1]))
    end = np.flatnonzero(inside & (~after | border[1:])) + 1
    return Terms(data, np.searchsorted(offsets, start, "right") - 1, start, end - start, _hashes(data, start, end))


def _hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A polynomial of the bytes of each term, modulo 2^64, then mixed; the same wherever the term lies."""
    if not len(start):
        return np.zeros(0, np.uint64)
    out = np.zeros(len(start), np.uint64)
    alive = np.arange(len(start))
    at, until = start.copy(), end
    # a step for each byte of the longest term, while few terms are long: all together for the first bytes
    for _ in range(24):
        out[alive] = (out[alive] + data[at[alive]].astype(np.uint64) + np.uint64(1)) * _MULTIPLIER
        at[alive] += 1
        alive = alive[at[alive] < until[alive]]
        if not len(alive):
            return _mixed(out)
    for i in alive.tolist():
        rest = data[at[i] : until[i]].astype(np.uint64) + np.uint64(1)
        powers = np.cumprod(np.full(len(rest), _MULTIPLIER))
        with np.errstate(over="ignore"):
            out[i] = out[i] * powers[-1] + np.sum(rest * powers[::-1], dtype=np.uint64)
    return _mixed(out)


def positions(hashes: np.ndarray, level: np.ndarray, n_bits: int) -> np.ndarray:
    """The HASHES bits of each entry, a row each; ``n_bits`` is a power of two."""
    a = _mixed(hashes + level.astype(np.uint64) * _MULTIPLIER)
    step = (a >> np.uint64(32)) | np.uint64(1)
    return ((a[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(n_bits - 1)).astype(np.int64)


class Query:
    """The items of a group and their distinct terms; small enough to be handed to every task."""

    def __init__(self, rows: list[tuple[int, list[str]]]):
        """``rows``: item id and its texts."""
        self.items = np.array([i for i, _ in rows], np.int64)
        found: dict[bytes, int] = {}
        self.of_item: list[np.ndarray] = []
        for _, texts in rows:
            t = terms_of(pa.array(texts, pa.string()))
            raw = t.data.tobytes()
            mine = {found.setdefault(raw[a : a + n], len(found)) for a, n in zip(t.start.tolist(), t.length.tolist())}
            self.of_item.append(np.array(sorted(mine), np.int64))
        self.terms = list(found)
        whole = np.frombuffer(b"".join(self.terms), np.uint8)
        self.length = np.array([len(t) for t in self.terms], np.int64)
        self.end = np.cumsum(self.length)
        self.data, self.hashes = whole, _hashes(whole, self.end - self.length, self.end)
        self.order = np.argsort(self.hashes, kind="stable")
        self.sorted = self.hashes[self.order]

    def occurrences(self, t: Terms) -> tuple[np.ndarray, np.ndarray]:
        """Owner text and term number of every occurrence of an asked term; bytes are compared."""
        owners, numbers = [], []
        left = np.searchsorted(self.sorted, t.hashes, "left")
        hit = np.flatnonzero((left < len(self.sorted)) & (self.sorted[np.minimum(left, len(self.sorted) - 1)] == t.hashes)) if len(self.sorted) else left[:0]
        at = left[hit]
        while len(hit):
            number = self.order[at]
            same = self.length[number] == t.length[hit]
            mine, theirs = hit[same], number[same]
            # all bytes of these occurrences, side by side
            size = t.length[mine]
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            equal = t.data[np.repeat(t.start[mine], size) + step] == self.data[np.repeat(self.end[theirs] - size, size) + step]
            fine = np.logical_and.reduceat(equal, np.cumsum(size) - size) if len(size) else np.zeros(0, bool)
            owners.append(t.owner[mine[fine]])
            numbers.append(theirs[fine])
            # terms that share a hash lie side by side
            more = (at + 1 < len(self.sorted)) & (self.sorted[np.minimum(at + 1, len(self.sorted) - 1)] == t.hashes[hit])
            hit, at = hit[more], at[more] + 1
        return (np.concatenate(owners), np.concatenate(numbers)) if owners else (np.zeros(0, np.int64),) * 2


class _Block:
    """Signatures in the making: documents of one size class."""

    def __init__(self, n_bits: int, block_bytes: int, block_docs: int):
        self.n_bits = n_bits
        self.room = max(8, min(block_docs, block_bytes * 8 // n_bits))
        self.ids: list[int] = []
        self.sizes: list[int] = []
        self.bits: list[np.ndarray] = []
        self.texts: list[bytes] = []

    def row(self) -> tuple:
        width = -(-len(self.ids) // 8)
        flat = np.zeros(self.n_bits * width, np.uint8)
        for doc, bits in enumerate(self.bits):
            flat[bits * width + doc // 8] |= np.uint8(128 >> doc % 8)
        return self.n_bits, self.ids, self.sizes, flat.tobytes(), self.texts


INDEX = (
    "n_bits int, ids array<bigint>, sizes array<bigint>, slices binary, texts array<binary>, n_docs bigint, n_terms bigint, "
    "asked array<struct<term:int,docs:bigint>>"
)


def _index_rows(query: Query, block_bytes: int, block_docs: int):
    schema = pa.schema([
        ("n_bits", pa.int32()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("slices", pa.binary()),
        ("texts", pa.list_(pa.binary())), ("n_docs", pa.int64()), ("n_terms", pa.int64()),
        ("asked", pa.list_(pa.struct([("term", pa.int32()), ("docs", pa.int64())]))),
    ])

    def batch_of(n_bits, ids, sizes, bits, texts, n_docs=0, n_terms=0, asked=()):
        values = [n_bits, ids, sizes, bits, texts, n_docs, n_terms, [{"term": t, "docs": n} for t, n in asked]]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_blocks: dict[int, _Block] = {}
        n_docs = n_terms = 0
        df = np.zeros(len(query.terms), np.int64)
        packer = zstandard.ZstdCompressor(level=1)
        for batch in slices(batches, 500):
            t = terms_of(batch.column(1))
            owner, number = query.occurrences(t)
            df += np.bincount(np.unique(owner * max(1, len(df)) + number) % max(1, len(df)), minlength=len(df))
            sizes = np.bincount(t.owner, minlength=batch.num_rows)
            n_docs, n_terms = n_docs + int(np.count_nonzero(sizes)), n_terms + int(sizes.sum())
            borders = np.searchsorted(t.owner, np.arange(batch.num_rows + 1))
            for doc, doc_id in enumerate(batch.column(0).to_pylist()):
                if sizes[doc] == 0 or doc_id is None:
                    continue
                distinct, counts = np.unique(t.hashes[borders[doc] : borders[doc + 1]], return_counts=True)
                levels = np.searchsorted(LEVELS, counts, "right")  # the levels that a term reaches
                entries = np.repeat(distinct, levels)
                level = np.arange(len(entries)) - np.repeat(np.cumsum(levels) - levels, levels)
                n_bits = min(MOST_BITS, 1 << max(6, (BITS * len(entries) - 1).bit_length()))
                block = open_blocks.setdefault(n_bits, _Block(n_bits, block_bytes, block_docs))
                block.ids.append(doc_id)
                block.sizes.append(int(sizes[doc]))
                block.bits.append(positions(entries, level, n_bits).astype(np.int32).ravel())
                block.texts.append(packer.compress(batch.column(1)[doc].as_buffer()))
                if len(block.ids) == block.room:
                    yield batch_of(*open_blocks.pop(n_bits).row())
        for block in open_blocks.values():
            yield batch_of(*block.row())
        asked = [(int(i), int(df[i])) for i in np.flatnonzero(df)]
        yield batch_of(0, [], [], b"", [], n_docs, n_terms, asked)
        open_blocks.clear()
        give_back()

    return run


def lengths_factor(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The integer m of each document."""
    return 100 - 50 + (50 * sizes * n_docs) // n_terms


def shares(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (SCALE * tf) // (1000 * tf + 20 * m)


@dataclass
class Statistics:
    n_docs: int
    n_terms: int
    weights: np.ndarray  # of the terms of the query


def upper_bounds(query: Query, stats: Statistics, n_bits: int, sizes: np.ndarray, packed: bytes, chunk: int = 2048) -> Iterator[tuple[int, np.ndarray]]:
    """The first of some items and the bounds of a block's documents for each of them, for all items.

    Terms of several items, ``chunk`` at a time, go together; only documents
    whose slices show a term are looked at further.
    """
    bits = np.frombuffer(packed, np.uint8).reshape(n_bits, -1)
    n = len(sizes)
    m = lengths_factor(sizes, stats.n_docs, stats.n_terms)
    # a term at level i occurs less often than the next level asks for; no term occurs more often than all together
    most = np.minimum(np.append(LEVELS[1:] - 1, 1 << 40)[:, None], sizes[None, :])
    share = np.vstack([np.zeros(n, np.int64), shares(most, m[None, :])])
    first = 0
    while first < len(query.of_item):
        last, held = first + 1, len(query.of_item[first])
        while last < len(query.of_item) and held + len(query.of_item[last]) <= chunk:
            held += len(query.of_item[last])
            last += 1
        terms = np.concatenate(query.of_item[first:last])
        item = np.repeat(np.arange(last - first), [len(x) for x in query.of_item[first:last]])
        weighing = stats.weights[terms] > 0
        terms, item = terms[weighing], item[weighing]
        total = np.zeros((last - first, n), np.int64)
        for at in range(0, len(terms), chunk):
            some = terms[at : at + chunk]
            there = np.bitwise_and.reduce(bits[positions(query.hashes[some], np.zeros(len(some), np.int64), n_bits)], axis=1)
            pair, doc = np.nonzero(np.unpackbits(there, axis=1, count=n))
            level, left = np.ones(len(pair), np.int64), np.arange(len(pair))
            for step in range(1, len(LEVELS)):
                asked = np.unique(pair[left])
                if not len(asked):
                    break
                found = np.bitwise_and.reduce(bits[positions(query.hashes[some[asked]], np.full(len(asked), step), n_bits)], axis=1)
                row = np.searchsorted(asked, pair[left])
                reached = found[row, doc[left] >> 3] >> (7 - (doc[left] & 7)).astype(np.uint8) & 1
                left = left[reached == 1]
                level[left] += 1
            np.add.at(total, (item[at : at + chunk][pair], doc), share[level, doc] * stats.weights[some[pair]])
        yield first, total
        first = last


class _Best:
    """The k best (value, id) of each item so far, ties to the smaller id."""

    def __init__(self, items: int, k: int):
        self.k, self.kept = k, [(np.zeros(0, np.int64),) * 2 for _ in range(items)]

    def offer(self, item: int, ids: np.ndarray, values: np.ndarray) -> None:
        old_ids, old = self.kept[item]
        ids, values = np.append(old_ids, ids), np.append(old, values)
        top = np.lexsort((ids, -values))[: self.k]
        self.kept[item] = ids[top], values[top]

    def least(self, item: int) -> int:
        """What a value must reach to matter."""
        values = self.kept[item][1]
        return int(values[-1]) if len(values) == self.k else 1

    def batch(self, query: Query, name: str) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*[(np.full(len(d), i), d, v) for i, (d, v) in zip(query.items, self.kept)])]
        return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["item_id", "doc_id", name])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """n_bits, ids, sizes, slices and, if there, texts of each block."""
    for batch in batches:
        for row in range(batch.num_rows):
            n_bits, ids, sizes, packed, *texts = (batch.column(i)[row] for i in range(batch.num_columns))
            yield n_bits.as_py(), *(x.values.to_numpy().astype(np.int64) for x in (ids, sizes)), packed.as_buffer(), *texts
        give_back()


def _heads(query: Query, stats: Statistics, k: int):
    """The k best bounds of a task for each item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(query.items), k)
        for n_bits, ids, sizes, packed in _blocks(batches):
            for first, bounds in upper_bounds(query, stats, n_bits, sizes, packed):
                for item, row in enumerate(bounds, first):
                    hit = np.flatnonzero(row >= best.least(item))
                    if len(hit):
                        best.offer(item, ids[hit], row[hit])
        yield best.batch(query, "bound")

    return run


def _exact_scores(query: Query, stats: Statistics, docs: np.ndarray, texts: pa.ListScalar, asked: list[np.ndarray], best: _Best, ids: np.ndarray) -> None:
    """Scores some documents of a block for their items, from whole texts."""
    unpacker = zstandard.ZstdDecompressor()
    for at in range(0, len(docs), 200):
        some = docs[at : at + 200]
        t = terms_of(pa.array([unpacker.decompress(texts[int(d)].as_buffer()) for d in some], pa.large_binary()))
        sizes = np.bincount(t.owner, minlength=len(some)).astype(np.int64)
        owner, number = query.occurrences(t)
        order = np.argsort(owner, kind="stable")
        number, borders = number[order], np.searchsorted(owner[order], np.arange(len(some) + 1))
        m = lengths_factor(sizes, stats.n_docs, stats.n_terms)
        for doc, items in enumerate(asked[at : at + 200]):
            tf = np.bincount(number[borders[doc] : borders[doc + 1]], minlength=len(query.terms))
            part = np.zeros(len(tf), np.int64)
            seen = np.flatnonzero(tf)
            part[seen] = stats.weights[seen] * shares(tf[seen], m[doc])
            for item in items.tolist():
                score = int(part[query.of_item[item]].sum())
                if score >= best.least(item):
                    best.offer(item, ids[some[doc] : some[doc] + 1], np.array([score]))


def _resolved(query: Query, stats: Statistics, k: int, cutoffs: np.ndarray | None, heads: tuple[np.ndarray, np.ndarray] | None):
    """The k best exact scores of a task: of the heads (sorted ids and item numbers), or of all whose bound reaches the item's cutoff."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(query.items), k)
        for block in _blocks(batches):
            n_bits, ids, sizes, packed, texts = block
            if heads is not None:
                low, high = (np.searchsorted(heads[0], ids, side) for side in ("left", "right"))
                docs = np.flatnonzero(high > low)
                asked = [heads[1][low[d] : high[d]] for d in docs]
            else:
                hit = np.concatenate([bounds >= cutoffs[first : first + len(bounds), None] for first, bounds in upper_bounds(query, stats, n_bits, sizes, packed)])
                doc, item = np.nonzero(hit.T)
                docs, begins = np.unique(doc, return_index=True)
                asked = np.split(item, begins[1:]) if len(docs) else []
            _exact_scores(query, stats, docs, texts, asked, best, ids)
        yield best.batch(query, "score")

    return run


def _ranked(found: DataFrame, k: int, value: str = "score") -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc(value), "doc_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search(rows: DataFrame, query: Query, k: int, block_bytes: int, block_docs: int) -> DataFrame:
    spark = rows.sparkSession
    index = written(rows.mapInArrow(_index_rows(query, block_bytes, block_docs), INDEX), "bit-slices")
    n_docs, n_terms = index.agg(F.sum("n_docs"), F.sum("n_terms")).collect()[0]
    n_docs, n_terms = n_docs or 0, n_terms or 0
    df = np.zeros(len(query.terms), np.int64)
    for row in index.select(F.inline("asked")).groupBy("term").agg(F.sum("docs").alias("docs")).collect():  # the terms of the group
        df[row["term"]] = row["docs"]
    if not n_terms or not len(df):
        return spark.createDataFrame([], RESULT)
    # a term without documents adds to no score, nor to a bound
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) if d else 0 for d in df.tolist()]
    stats = Statistics(n_docs, n_terms, np.array(weights, np.int64))
    blocks = index.filter("n_bits > 0").select("n_bits", "ids", "sizes", "slices", "texts")
    scores = "item_id bigint, doc_id bigint, score bigint"
    heads = blocks.drop("texts").mapInArrow(_heads(query, stats, k), "item_id bigint, doc_id bigint, bound bigint")
    best = _ranked(heads, k, "bound").select("doc_id", "item_id").collect()  # k for each item of the group
    ids, numbers = np.array([r["doc_id"] for r in best], np.int64), np.searchsorted(query.items, np.array([r["item_id"] for r in best], np.int64))
    order = np.argsort(ids, kind="stable")
    first = _ranked(blocks.mapInArrow(_resolved(query, stats, k, None, (ids[order], numbers[order])), scores), k)
    cutoffs = np.ones(len(query.items), np.int64)
    for row in first.filter(F.col("rank") == k).select("item_id", "score").collect():  # one row for each item of the group
        cutoffs[np.searchsorted(query.items, row["item_id"])] = row["score"]
    return _ranked(blocks.mapInArrow(_resolved(query, stats, k, cutoffs, None), scores), k).select("item_id", "rank", "doc_id", "score")


RESULT = "item_id bigint, rank int, doc_id bigint, score bigint"


def lexical_search(
    docs: DataFrame, items: DataFrame, k: int = 50, group_bytes: int = 1 << 20, block_bytes: int = 4 << 20, block_docs: int = 2048,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents with a score above 0 for each item, ties to the smaller id.

    Terms are runs of ASCII letters and digits and of code points beyond ASCII,
    A-Z lower-cased. Null and empty texts have no terms. Rows that repeat a
    document id are documents of their own; those without an id count in all
    statistics but are not returned. Rows that repeat an item id are one item
    with the terms of all of them; items without an id take no part. Without
    terms, items or documents there are no rows; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).filter("item_id is not null")
    size = asked.agg(F.sum(F.octet_length(F.coalesce("text", F.lit(""))) + 64)).collect()[0][0] or 0
    groups = max(1, -(-size // group_bytes))
    found = None
    for group in range(groups):
        some = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(groups)) == group)
        some = some.groupBy("item_id").agg(F.collect_set("text").alias("texts")).orderBy("item_id").collect()  # about group_bytes of text
        if some:
            part = _search(rows, Query([(r["item_id"], r["texts"]) for r in some]), k, block_bytes, block_docs)
            found = part if found is None else found.unionByName(part)
    return found if found is not None else docs.sparkSession.createDataFrame([], RESULT)
