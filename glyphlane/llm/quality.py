"""Quality by nearest-neighbour voting over latent-semantic vectors.

A text becomes counts of hashed terms: its words (ASCII case folded), the shape
of each blank-separated token (upper case, other letters, digits, each other
sign; runs of one kind count once), and whether a word, a run of three words or
a line repeats an earlier one next to it or in the text. Log counts, weighted
by the rarity of the term in the bounded labelled sample, are projected to the
sample's leading singular directions and scaled to length 1.

The vectors of the sample are the labelled neighbours. Their number is bounded
by a parameter, so they are broadcast with the model. Every text meets all of
them in blocks of exact cosine products; the nearest vote with their
similarity. A class that the sample holds more or less often than all labels do
votes with accordingly less or more weight.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .hashed_words import FOLD, NOT_BLANK, WORD, chunks, combined, mix, run_hashes, words_of
from .labelled import fit_in_task, labelled_sample, learning_prior, rows_scoring, scored

#: Buckets of word terms, and after them of shape and repetition terms.
WORD_BUCKETS = 1 << 14
SHAPE_BUCKETS = 1 << 10
BUCKETS = WORD_BUCKETS + SHAPE_BUCKETS
LINES = np.ones(256, bool)
LINES[0x0A] = False

#: The kind of each byte: upper case, other letters, digits, each other sign itself.
KINDS = np.arange(256, dtype=np.uint8)
KINDS[65:91], KINDS[97:123], KINDS[48:58], KINDS[128:] = 65, 97, 48, 97


def _repeats(owner: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which items equal an earlier item of their text."""
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))
    again = np.zeros(len(hashes), bool)
    same = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    again[order[1:][same]] = True
    return again


def term_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, bucket and count of the terms of some texts."""
    low = FOLD[data]
    words = words_of(low, offsets, WORD)
    hashes, texts = run_hashes(words.data, words.begins), words.texts
    owners = [texts]
    buckets = [(hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)]
    tokens = words_of(data, offsets, NOT_BLANK)
    kinds = KINDS[tokens.data]
    change = np.ones(len(kinds), bool)
    change[1:] = kinds[1:] != kinds[:-1]
    change[tokens.begins] = True
    shape = run_hashes(kinds[change], np.cumsum(change)[tokens.begins] - 1)
    owners.append(tokens.texts)
    buckets.append(WORD_BUCKETS + 4 + (shape % np.uint64(SHAPE_BUCKETS - 4)).astype(np.int64))
    beside = np.zeros(len(hashes), bool)
    beside[1:] = (hashes[1:] == hashes[:-1]) & (texts[1:] == texts[:-1])
    triples, firsts = combined(hashes, words.firsts, 3)
    triple_texts = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    lines = words_of(data, offsets, LINES)
    line_hashes = run_hashes(lines.data, lines.begins)
    for k, (owner, hit) in enumerate((
        (texts, beside), (triple_texts, _repeats(triple_texts, triples)), (lines.texts, _repeats(lines.texts, line_hashes)),
    )):
        owners.append(owner[hit])
        buckets.append(np.full(int(hit.sum()), WORD_BUCKETS + k))
    keys, counts = np.unique(np.concatenate(owners).astype(np.int64) * BUCKETS + np.concatenate(buckets), return_counts=True)
    return keys // BUCKETS, keys % BUCKETS, counts


def _summed(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Rows of ``values`` summed by their sorted owner."""
    out = np.zeros((n, values.shape[1]), values.dtype)
    if len(owner):
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        out[owner[first]] = np.add.reduceat(values, first, axis=0)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt(np.square(rows).sum(axis=1, keepdims=True)), 1e-12)


def _weights(owner: np.ndarray, bucket: np.ndarray, count: np.ndarray, rarity: np.ndarray, shape_share: float, n: int) -> np.ndarray:
    """Weighted log counts; words and shapes are scaled to their shares of a text of length 1."""
    value = np.log1p(count) * rarity[bucket]
    out = np.zeros(len(value))
    for part, share in ((bucket < WORD_BUCKETS, 1 - shape_share), (bucket >= WORD_BUCKETS, shape_share)):
        length = np.sqrt(np.bincount(owner[part], np.square(value[part]), n))
        out[part] = value[part] * np.sqrt(share) / np.maximum(length[owner[part]], 1e-12)
    return out


class Neighbours:
    """Term weights, projection, labelled unit vectors, labels and class weights."""

    FIELDS = ("rarity", "projection", "vectors", "label", "numbers")

    def __init__(self, rarity, projection, vectors, label, numbers):
        self.rarity, self.projection, self.vectors, self.label, self.numbers = rarity, projection, vectors, label, numbers

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Neighbours:
        with np.load(io.BytesIO(data)) as f:
            return cls(*(f[k] for k in cls.FIELDS))

    def latent(self, texts: pa.Array) -> np.ndarray:
        out = np.zeros((len(texts), self.projection.shape[1]), np.float32)
        for first, last, data, offsets in chunks(texts):
            owner, bucket, count = term_counts(data, offsets)
            value = _weights(owner, bucket, count, self.rarity, self.numbers[1], last - first)
            seen = value != 0
            owner, bucket, value = owner[seen], bucket[seen], value[seen].astype(np.float32)
            for part in np.array_split(np.arange(last - first), max(1, len(owner) // 100_000)):
                if len(part):
                    a, b = np.searchsorted(owner, [part[0], part[-1] + 1])
                    rows = value[a:b, None] * self.projection[bucket[a:b]]
                    out[first + part[0] : first + part[-1] + 1] = _summed(rows, owner[a:b] - part[0], len(part))
        return _unit(out)

    def scores(self, texts: pa.Array, block: int = 512) -> np.ndarray:
        prior, _, nearest, power, *weigh = self.numbers
        if not len(self.vectors):
            return np.full(len(texts), prior)
        latent, out = self.latent(texts), np.full(len(texts), prior)
        nearest = min(int(nearest), len(self.vectors))
        for at in range(0, len(latent), block):
            products = latent[at : at + block] @ self.vectors.T
            top = np.argpartition(-products, nearest - 1, axis=1)[:, :nearest]
            vote = np.maximum(np.take_along_axis(products, top, axis=1), 0).astype(float) ** power
            vote *= np.where(self.label[top] == 1, weigh[1], weigh[0])
            total = vote.sum(axis=1)
            some = total > 1e-9  # a text without known terms is near nothing and scores as the prior
            out[at : at + block][some] = ((vote * self.label[top]).sum(axis=1)[some]) / total[some]
        return out


def fit_neighbours(
    texts: pa.Array, label: np.ndarray, rank: int = 64, nearest: int = 15, power: float = 4.0, shape_share: float = 0.6, seed: int = 5,
    prior: float | None = None,
) -> Neighbours:
    """Term rarity, a randomised singular value decomposition and the sample's vectors.

    Votes count as if the sample had the share ``prior`` of label 1; without it they count as they are.
    """
    parts = []
    for first, _, data, offsets in chunks(texts):
        owner, bucket, count = term_counts(data, offsets)
        parts.append((owner + first, bucket, count))
    share = float(label.mean()) if len(label) else 0.5
    if prior is None or share in (0, 1) or not len(label):
        prior = share
    weigh = [(1 - prior) / (1 - share), prior / share] if 0 < share < 1 else [1, 1]
    numbers = np.array([prior, shape_share, nearest, power, *weigh])
    if not parts:
        return Neighbours(np.zeros(BUCKETS), np.zeros((BUCKETS, 1), np.float32), np.zeros((0, 1), np.float32), label, numbers)
    owner, bucket, count = (np.concatenate(c) for c in zip(*parts))
    n = len(label)
    held = np.bincount(bucket, minlength=BUCKETS)
    rarity = np.where(held > 0, np.log((1 + n) / (1 + held)) + 0.1, 0.0)
    value = _weights(owner, bucket, count, rarity, shape_share, n).astype(np.float32)
    turned = np.lexsort((owner, bucket))

    def times(m: np.ndarray) -> np.ndarray:
        out = np.zeros((n, m.shape[1]), np.float32)
        for part in np.array_split(np.arange(n), max(1, len(owner) // 100_000)):
            a, b = np.searchsorted(owner, [part[0], part[-1] + 1]) if len(part) else (0, 0)
            if b > a:
                out[part[0] : part[-1] + 1] = _summed(value[a:b, None] * m[bucket[a:b]], owner[a:b] - part[0], len(part))
        return out

    def turned_times(m: np.ndarray) -> np.ndarray:
        out = np.zeros((BUCKETS, m.shape[1]), np.float32)
        for some in np.array_split(turned, max(1, len(turned) // 100_000)):
            if len(some):
                low = bucket[some[0]]
                out[low : bucket[some[-1]] + 1] += _summed(value[some, None] * m[owner[some]], bucket[some] - low, bucket[some[-1]] + 1 - low)
        return out

    sketch = np.random.default_rng(seed).normal(size=(BUCKETS, min(rank + 8, BUCKETS))).astype(np.float32)
    for _ in range(3):
        base, _ = np.linalg.qr(times(sketch))
        sketch = turned_times(base)
    _, size, right = np.linalg.svd(sketch.T, full_matrices=False)
    projection = np.ascontiguousarray(right[: min(rank, int((size > 1e-6).sum()) or 1)].T.astype(np.float32))
    model = Neighbours(rarity, projection, np.zeros((0, 1), np.float32), label.astype(float), numbers)
    model.vectors = model.latent(texts)
    return model


def fit_quality(
    docs: DataFrame, labels: DataFrame, per_class: int = 2500, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> Neighbours:
    """Neighbours from at most ``per_class`` learning rows of each class, prepared in one task."""
    prior = learning_prior(labels, label_col, id_col)

    def fit(table: pa.Table) -> bytes:
        return fit_neighbours(table["text"].combine_chunks(), table["label"].to_numpy().astype(float), prior=prior).to_bytes()

    return Neighbours.from_bytes(fit_in_task(labelled_sample(docs, labels, label_col, per_class, id_col, text_col), fit))


def scorer(docs: DataFrame, model: Neighbours):
    """A function for tasks; at most 2 * ``per_class`` vectors and the projection are broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model.to_bytes())
    kept: list[Neighbours] = []

    def score(texts: pa.Array) -> np.ndarray:
        if not kept:
            kept.append(Neighbours.from_bytes(shared.value))
        return kept[0].scores(texts)

    return score


def quality(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, per_class: int = 2500, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Whole texts are scored; null counts as empty. A text without known terms,
    as an empty one, scores as the share of label 1 in all learning labels. Rows whose
    crc32 of the id is 0 modulo 5 (held_out) are not learned from; rows with a
    null id are scored. Without usable labels every score is 0.5. Repeated rows
    score alike, neighbours of one similarity vote alike; an empty table gives
    no rows; other columns are not read.
    """
    score = scorer(docs, fit_quality(docs, labels, per_class, id_col, text_col))
    return scored(docs, score, threshold, id_col, text_col)


def of_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, per_class: int = 2500, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows that score ``threshold`` or more, with all their columns.

    Null ids and texts, repeated rows and empty tables are as in ``quality``.
    """
    score = scorer(docs, fit_quality(docs, labels, per_class, id_col, text_col))
    return rows_scoring(docs, score, lambda scores: scores >= threshold, text_col)
