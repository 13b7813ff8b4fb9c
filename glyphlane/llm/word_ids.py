"""Whole texts to token ids with the tokenizers library, one library call per new word.

For vocabularies that lower-case, split into letters, single numerals and runs
of other signs, and end each word with a marked token, a word's ids depend on
the word alone. A batch is split into words in numpy, its distinct words are
found by Arrow, and only words that this worker has not met go to the library.
Texts whose words could depend on each other (special token strings, letters
that compose only after lower-casing) go to the library whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex

SPACE, LETTER, NUMERAL, OTHER = range(4)
#: Words that a worker remembers: two generations of half as many, of which the older goes when the younger is full.
MEMORY = 300_000
#: Bytes of text that are split at a time, single longer texts apart.
CHUNK = 4 << 20
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")
END_MARK = "</w>"


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """The class of each code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for kind, pattern in ((SPACE, r"\p{White_Space}+"), (LETTER, r"\p{L}+"), (NUMERAL, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            for ch in m[0]:
                out[ord(ch)] = kind
    return out


def split_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of lower-case texts, and the place of each text's first word."""
    buf = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    kinds, classes = _classes(), None
    classes = kinds[:256][buf]
    lead = np.flatnonzero(buf >= 0xC0)
    if len(lead):
        first = buf[lead].astype(np.uint32)
        nxt = lambda k: buf[np.minimum(lead + k, len(buf) - 1)].astype(np.uint32) & 0x3F
        two = (first & 0x1F) << 6 | nxt(1)
        three = (first & 0x0F) << 12 | nxt(1) << 6 | nxt(2)
        four = (first & 0x07) << 18 | nxt(1) << 12 | nxt(2) << 6 | nxt(3)
        found = kinds[np.where(first < 0xE0, two, np.where(first < 0xF0, three, four))]
        classes[lead] = found
        classes[lead + 1] = found
        for k, least in ((2, 0xE0), (3, 0xF0)):
            longer = first >= least
            classes[lead[longer] + k] = found[longer]
    starts = classes != SPACE
    starts[1:] &= (classes[1:] != classes[:-1]) | (classes[1:] == NUMERAL)
    starts &= (buf & 0xC0) != 0x80
    quotes = np.flatnonzero((buf == 0x27) & starts)
    for at in quotes[classes[quotes + 1] == LETTER].tolist():
        for tail in CONTRACTIONS:
            if buf[at + 1 : at + 1 + len(tail)].tobytes() == tail:
                starts[at + 1] = False
                after = at + 1 + len(tail)
                if classes[after] == LETTER:
                    starts[after] = True
                break
    kept = classes != SPACE
    places = np.flatnonzero(starts)
    offsets = np.append((np.cumsum(kept, dtype=np.int32) - 1)[places], int(kept.sum())).astype(np.int32)
    words = pa.Array.from_buffers(
        pa.string(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(buf[kept]))]
    )
    text_starts = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
    return words, np.searchsorted(places, text_starts)


class WordIds:
    """Ids of whole texts; remembers the ids of words."""

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(definition)
        self.library.no_padding()
        self.library.no_truncation()
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype(np.uint16 if max(vocabulary.values()) < 1 << 16 else np.uint32)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith(END_MARK)]] = True
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype)

    def _learn(self, words: list[str]) -> None:
        for at in range(0, len(words), 2000):
            some = words[at : at + 2000]
            ids = np.array(self.library.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, self.dtype)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(some):
                for word, a, b in zip(some, [0, *ends[:-1].tolist()], ends.tolist()):
                    self.known[word] = ids[a:b].tobytes()
            else:
                for word in some:
                    self.known[word] = self._whole(word).tobytes()

    def _plain(self, text: str) -> bytes | None:
        """The normalised text, or None where only the library can tell."""
        if any(s in text for s in self.special):
            return None
        if text.isascii():
            return text.lower().encode()
        low = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return low.encode() if unicodedata.is_normalized("NFC", low) else None

    def _chunk(self, texts: list[bytes]) -> list[np.ndarray]:
        words, firsts = split_words(texts)
        coded = words.dictionary_encode()
        distinct, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        if len(self.known) > MEMORY // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = []
        for word in distinct:
            if word not in known:
                ids = older.get(word)
                if ids is None:
                    new.append(word)
                else:
                    known[word] = ids
        self._learn(new)
        pieces = [known[w] for w in distinct]
        flat = np.frombuffer(b"".join(pieces), self.dtype)
        sizes = np.array([len(p) for p in pieces], np.int64) // self.dtype.itemsize
        begins = np.cumsum(sizes) - sizes
        each = sizes[codes]
        until = np.concatenate([[0], np.cumsum(each)])
        ids = flat[np.repeat(begins[codes] - until[:-1], each) + np.arange(until[-1])]
        cuts = until[np.append(firsts, len(codes))]
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Ids of each text in turn."""
        waiting: list[bytes] = []
        size = 0
        order: list[np.ndarray | None] = []

        def flush() -> Iterator[np.ndarray]:
            done = iter(self._chunk(waiting) if waiting else ())
            for whole in order:
                yield next(done) if whole is None else whole

        for text in texts:
            plain = self._plain(text or "")
            if plain is None:
                order.append(self._whole(text))
            else:
                order.append(None)
                waiting.append(plain)
                size += len(plain)
            if size >= CHUNK or len(order) >= 10_000:
                yield from flush()
                waiting, order, size = [], [], 0
        yield from flush()


@lru_cache(maxsize=2)
def encoder(definition: str) -> WordIds:
    """The worker's encoder for a tokenizer file's content."""
    return WordIds(definition)


def definition_of(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()
