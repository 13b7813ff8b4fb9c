"""Toxicity by a factorization machine over hashed terms.

Terms are the distinct words of a text (ASCII case folded) and the first 5, 6
and 7 bytes of longer words, as 64-bit hashes. The machine scores a text by

    bias + sum of w[i] + sum over pairs of <v[i], v[j]>

over its known terms, so that a pair such as an insult with a group mention can
weigh more than both alone. Known terms are those whose presence goes with the
label in the bounded sample beyond chance, alone or together with another term;
all others have no weight, so long texts are not judged by the sum of their noise.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .hashed_words import FOLD, WORD, chunks, mix, run_hashes, words_of
from .labelled import fit_in_task, labelled_sample, learning_prior, rows_scoring, scored

PREFIXES = (5, 6, 7)
RANK = 8


def terms(data: np.ndarray, offsets: np.ndarray, known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each distinct term of some texts; with ``known``, the place in it instead of the hash."""
    words = words_of(FOLD[data], offsets, WORD)
    sizes, texts = words.sizes, words.texts
    hashes, owners = [run_hashes(words.data, words.begins)], [texts]
    padded = np.concatenate([words.data, np.zeros(8, np.uint8)]).astype(np.uint64)
    for size in PREFIXES:
        longer = np.flatnonzero(sizes > size)
        packed = np.full(len(longer), size, np.uint64)
        for k in range(size):
            packed = packed << np.uint64(8) | padded[words.begins[longer] + k]
        hashes.append(mix(packed))
        owners.append(texts[longer])
    found, owner = np.concatenate(hashes), np.concatenate(owners)
    if known is not None:
        marked = np.zeros(1 << 16, bool)
        marked[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
        maybe = marked[(found & np.uint64(0xFFFF)).astype(np.int64)]
        found, owner = found[maybe], owner[maybe]
        place = np.searchsorted(known, found)
        right = np.append(known, 0)[place] == found if len(known) else np.zeros(len(found), bool)
        pairs = np.unique(owner[right].astype(np.int64) << 32 | place[right])
        return pairs >> 32, pairs & 0xFFFFFFFF
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    first = np.ones(len(found), bool)
    first[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return owner[first], found[first]


class Machine:
    """Known terms (sorted hashes), bias, weights and factors."""

    def __init__(self, known: np.ndarray, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.known, self.bias, self.weights, self.factors = known, bias, weights, factors

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, known=self.known, bias=self.bias, weights=self.weights, factors=self.factors)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Machine:
        with np.load(io.BytesIO(data)) as f:
            return cls(f["known"], float(f["bias"]), f["weights"], f["factors"])

    def scores(self, texts: pa.Array) -> np.ndarray:
        out = np.empty(len(texts))
        for first, last, data, offsets in chunks(texts):
            owner, place = terms(data, offsets, self.known)
            n = last - first
            linear = np.bincount(owner, self.weights[place], n)
            sums = np.stack([np.bincount(owner, self.factors[place, f], n) for f in range(self.factors.shape[1])], axis=1)
            squares = np.bincount(owner, np.square(self.factors)[place].sum(axis=1), n)
            margin = self.bias + linear + (np.square(sums).sum(axis=1) - squares) / 2
            out[first:last] = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
        return out


def known_terms(owner: np.ndarray, found: np.ndarray, label: np.ndarray, least_z: float) -> np.ndarray:
    """The terms whose share of texts differs between the classes by ``least_z`` standard errors."""
    pos, neg = max(1, int(label.sum())), max(1, int((1 - label).sum()))
    each, count = np.unique(found, return_counts=True)
    hit, hit_count = np.unique(found[(label == 1)[owner]], return_counts=True)
    hits = np.zeros(len(each))
    hits[np.searchsorted(each, hit)] = hit_count
    share = count / (pos + neg)
    z = (hits / pos - (count - hits) / neg) / np.sqrt(np.maximum(share * (1 - share), 1e-9) * (1 / pos + 1 / neg))
    return each[(np.abs(z) >= least_z) & (count >= 2)]


def paired_terms(
    owner: np.ndarray, found: np.ndarray, label: np.ndarray, alone: np.ndarray, most: int, least_z: float, block: int = 512
) -> np.ndarray:
    """The terms of pairs whose joint presence goes with the label beyond what both do apart.

    Texts with both terms, with either one and with none have each a share of
    label 1; the sum of the first and last less the others is 0 if effects add
    up. Its chance to differ by ``least_z`` times its largest standard error,
    half the root of the summed reciprocal counts, is below 2 * exp(-least_z ** 2 / 2)
    at any counts and shares (Hoeffding). Terms in, or missing from, fewer than
    ``least_z ** 2 / 4`` texts cannot reach that. The ``most`` frequent others
    meet in blocks; pairs of two terms of ``alone`` have nothing to add.
    """
    each, count = np.unique(found, return_counts=True)
    n, floor = len(label), least_z**2 / 4
    picked = np.flatnonzero((count >= floor) & (n - count >= floor))
    picked = np.sort(picked[np.argsort(-count[picked], kind="stable")[:most]])
    each, count = each[picked], count[picked].astype(float)
    if len(each) < 2:
        return each[:0]
    place = np.searchsorted(each, found)
    right = np.append(each, 0)[place] == found
    place, owner = place[right], owner[right]
    by_label = np.argsort(-label, kind="stable")
    column = np.empty(n, np.int64)
    column[by_label] = np.arange(n)
    pos = int(label.sum())
    order = np.argsort(place, kind="stable")
    place, column = place[order], column[owner[order]]
    hits = np.bincount(place[column < pos], minlength=len(each)).astype(float)
    known, useful = np.isin(each, alone), np.zeros(len(each), bool)

    def presence(at: int) -> np.ndarray:
        a, b = np.searchsorted(place, [at, at + block])
        out = np.zeros((min(block, len(each) - at), n), np.float32)
        out[place[a:b] - at, column[a:b]] = 1
        return out

    for i in range(0, len(each), block):
        left, a = presence(i), slice(i, i + block)
        for j in range(i, len(each), block):
            other, b = presence(j), slice(j, j + block)
            both_hits = (left[:, :pos] @ other[:, :pos].T).astype(float)
            both = both_hits + left[:, pos:] @ other[:, pos:].T
            apart, spread = np.zeros_like(both), np.zeros_like(both)
            with np.errstate(divide="ignore", invalid="ignore"):
                for sign, of, size in (
                    (1, both_hits, both), (-1, hits[a, None] - both_hits, count[a, None] - both), (-1, hits[b] - both_hits, count[b] - both),
                    (1, pos - hits[a, None] - hits[b] + both_hits, n - count[a, None] - count[b] + both),
                ):
                    apart += sign * of / size
                    spread += 1 / size
                found_pairs = 4 * np.square(apart) >= least_z**2 * spread  # never where a count is 0
            found_pairs &= ~(known[a, None] & known[b])
            useful[a] |= found_pairs.any(axis=1)
            useful[b] |= found_pairs.any(axis=0)
    return each[useful]


def fit_machine(
    texts: pa.Array, label: np.ndarray, prior: float, least_z: float = 4.0, rank: int = RANK,
    epochs: int = 30, rate: float = 0.05, decay: float = 1e-4, seed: int = 7, most_paired: int = 1 << 14, least_pair_z: float = 7.0,
) -> Machine:
    """Logistic loss by stochastic steps; classes weigh as ``prior``, the share of label 1 among all labels."""
    owners, hashes = [], []
    for first, _, data, offsets in chunks(texts):
        owner, found = terms(data, offsets)
        owners.append(owner + first)
        hashes.append(found)
    if not owners or label.min() == label.max():
        share = float(label.mean()) if len(label) else 0.0
        bias = float(np.log((share + 1e-3) / (1 - share + 1e-3)))
        return Machine(np.zeros(0, np.uint64), bias, np.zeros(0), np.zeros((0, rank)))
    owner, found = np.concatenate(owners), np.concatenate(hashes)
    known = known_terms(owner, found, label, least_z)
    known = np.union1d(known, paired_terms(owner, found, label, known, most_paired, least_pair_z))
    place = np.searchsorted(known, found)
    right = np.append(known, 0)[place] == found
    owner, place = owner[right], place[right]
    begins = np.searchsorted(owner, np.arange(len(label) + 1))
    random = np.random.default_rng(seed)
    weights, factors = np.zeros(len(known)), random.normal(0, 0.01, (len(known), rank))
    weigh = np.where(label == 1, prior / label.mean(), (1 - prior) / (1 - label.mean()))
    bias = float(np.log(prior / (1 - prior)))
    for epoch in range(epochs):
        step = rate / (1 + epoch / 10)
        for i in random.permutation(len(label)).tolist():
            idx = place[begins[i] : begins[i + 1]]
            own = factors[idx]
            total = own.sum(axis=0)
            margin = bias + weights[idx].sum() + (total @ total - np.square(own).sum()) / 2
            slope = weigh[i] * (1 / (1 + np.exp(-min(max(margin, -30), 30))) - label[i])
            bias -= step * slope
            if len(idx):
                # a text moves the margin by a bounded step however many terms it has
                pace = step / np.sqrt(len(idx))
                weights[idx] -= pace * (slope + decay * weights[idx])
                factors[idx] = own - pace * (np.clip(slope * (total - own), -1, 1) + decay * own)
    return Machine(known, bias, weights, factors)


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, per_class: int = 4096, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Machine:
    """A machine fitted in one task on at most ``per_class`` learning rows of each class."""
    prior = learning_prior(labels, label_col, id_col)

    def fit(table: pa.Table) -> bytes:
        return fit_machine(table["text"].combine_chunks(), table["label"].to_numpy().astype(float), prior).to_bytes()

    return Machine.from_bytes(fit_in_task(labelled_sample(docs, labels, label_col, per_class, id_col, text_col), fit))


def scorer(machine: Machine):
    """A function for tasks; the machine, bounded by its number of terms, goes along as bytes."""
    model = machine.to_bytes()
    kept: list[Machine] = []

    def score(texts: pa.Array) -> np.ndarray:
        if not kept:
            kept.append(Machine.from_bytes(model))
        return kept[0].scores(texts)

    return score


def toxicity(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, per_class: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    Whole texts are scored; null counts as empty, which scores by the bias.
    Rows whose crc32 of the id is 0 modulo 5 (held_out) are not learned from;
    rows with a null id are scored. Without usable labels, or with one class
    only, every score is the same. Repeated rows score alike; an empty table
    gives no rows; other columns are not read.
    """
    return scored(docs, scorer(fit_toxicity(docs, labels, per_class, id_col, text_col)), threshold, id_col, text_col)


def without_toxic(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.5, per_class: int = 4096, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows that score below ``threshold``, with all their columns.

    Null ids and texts, repeated rows and empty tables are as in ``toxicity``.
    """
    score = scorer(fit_toxicity(docs, labels, per_class, id_col, text_col))
    return rows_scoring(docs, score, lambda scores: scores < threshold, text_col)
