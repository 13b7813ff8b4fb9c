"""Words of whole texts as 64-bit hashes, computed in numpy over chunks of texts.

A chunk is some texts as one byte array. Words are runs of the bytes that a
table names; no text is cut at a chunk's end, and no word crosses texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15)
SPREAD = np.uint64(0xD6E8FEB86659FD93)

#: Lower case for A-Z, other bytes as they are.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: Everything but the six ASCII blanks.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
#: ASCII letters and digits, and all bytes of other scripts.
WORD = np.zeros(256, bool)
for a, b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    WORD[a:b] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that makes every bit depend on every bit."""
    h = (h ^ (h >> np.uint64(32))) * SPREAD
    h = (h ^ (h >> np.uint64(32))) * SPREAD
    return h ^ (h >> np.uint64(32))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


LOW = _powers(BASE, 1 << 16)
HIGH = _powers((LOW[-1:] * BASE)[0], 1 << 12)


def run_hashes(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """One hash per run of bytes; run i lies from begins[i] to the next begin."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    sizes = np.diff(np.append(begins, len(data)))
    place = np.arange(len(data)) - np.repeat(begins, sizes)
    values = (data.astype(np.uint64) + np.uint64(1)) * LOW[place & 0xFFFF]
    if sizes.max() > 1 << 16:
        values *= HIGH[(place >> 16) & 0xFFF]
    return mix(np.add.reduceat(values, begins) + sizes.astype(np.uint64))


@dataclass
class Words:
    """The words of some texts: their bytes, where each begins in them, and each text's first word."""

    data: np.ndarray
    begins: np.ndarray
    firsts: np.ndarray

    @property
    def sizes(self) -> np.ndarray:
        return np.diff(np.append(self.begins, len(self.data)))

    @property
    def texts(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.firsts) - 1), np.diff(self.firsts))


def words_of(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> Words:
    inside = table[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    bounds = offsets[:-1][offsets[:-1] < len(data)]
    starts[bounds] = inside[bounds]
    places = np.flatnonzero(starts)
    begins = np.cumsum(inside)[places] - 1 if len(places) else np.zeros(0, np.int64)
    return Words(data[inside], begins, np.searchsorted(places, offsets))


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First and last row, bytes and offsets of some texts at a time; null counts as empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def combined(words: np.ndarray, firsts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within texts, and each text's first run.

    A text of fewer words is one run of its own kind; a text without words has none.
    """
    counts = np.diff(firsts)
    factors = mix(np.arange(1, size + 1, dtype=np.uint64) * BASE) | np.uint64(1)
    n = len(words)
    if n >= size:
        sums = sum(words[j : n - size + 1 + j] * factors[j] for j in range(size))
    else:
        sums = np.zeros(0, np.uint64)
    runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    out_firsts = np.concatenate([[0], np.cumsum(runs)])
    source = np.repeat(firsts[:-1] - out_firsts[:-1], runs) + np.arange(out_firsts[-1])
    short = np.flatnonzero((counts > 0) & (counts < size))
    out = np.zeros(out_firsts[-1], np.uint64)
    whole = np.ones(len(out), bool)
    whole[out_firsts[short]] = False
    out[whole] = mix(sums[source[whole]])
    for t in short.tolist():
        some = words[firsts[t] : firsts[t + 1]]
        out[out_firsts[t]] = mix((some * factors[: len(some)]).sum(keepdims=True) + LOW[len(some)])[0]
    return out, out_firsts
