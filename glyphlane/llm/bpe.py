"""BPE by a tokenization automaton: merges compiled to arcs, words encoded by transitions.

The automaton reads tokens and accepts exactly the token sequences that the
merges give. It starts as one state with an arc for each byte; the merges are
applied in their order, each by a gadget: after a path over u and then v, a new
arc labelled uv leads where v led, and u from then on leads to a copy of its
state without the arc v. All arcs of one label lead to one state, so a state is
known by the last token and the number of gadgets it has seen, and a copy is
kept as what it lacks: its removed arcs and the step of each removal. An arc
made later than a removal exists in the copy only if its first part does.

Every prefix of a word has one accepted token sequence, so a place in a word has
one state at most. Encoding follows the arcs from the start, the longest entry
first; a place without a way to the end is never entered again, which keeps the
work in proportion to the word. Entries and transitions come from tables, the
second of which fills as pairs are met. Decoding emits the labels of the arcs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed value: how the byte-level vocabulary splits text into words before merging.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Words that a worker remembers, in two generations of which the older goes when the younger is full; and transitions.
MEMORY = 300_000
NEVER = 1 << 60


def byte_signs() -> dict[str, int]:
    """The printable sign that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class MergeAutomaton:
    """The automaton of a merge list over byte tokens."""

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        size = max(vocabulary.values()) + 1
        self.ids = vocabulary
        self.labels: list[bytes] = [b""] * size
        for label, i in vocabulary.items():
            self.labels[i] = label
        self.longest = max(map(len, vocabulary))
        self.born = [0] * size
        self.first: list[int] = [-1] * size
        self.step = [0] * size  # the last removal that the state after a token has seen
        self.below: list[tuple[int, int] | None] = [None] * size  # the state that it was copied from
        self.removed: list[dict[int, int]] = [{} for _ in range(size)]
        self.table: dict[int, bool] = {}
        for step, (left, right) in enumerate(merges, 1):
            u, v, made = vocabulary[left], vocabulary[right], vocabulary[left + right]
            if self.born[made]:
                raise ValueError("two merges make one token")
            if NEVER in (self.born[u], self.born[v]) or not self.arc(u, self.step[u], v):  # no path to rewrite
                self.born[made], self.first[made] = NEVER, u
                continue
            self.born[made], self.first[made] = step, u
            self.below[made] = (v, self.step[v])
            self.removed[u][v] = step
            self.step[u] = step
        self.move: dict[int, int] = {}
        self.entry: dict[int, int] = {}
        nodes = 0
        for label, i in vocabulary.items():
            if self.born[i] == NEVER:
                continue
            node = 0
            for byte in label:
                key = node << 8 | byte
                node = self.move.get(key, 0)
                if not node:
                    nodes += 1
                    node = self.move[key] = nodes
            self.entry[node] = i

    def arc(self, state: int, step: int, token: int) -> bool:
        """Whether the state after token ``state``, as of ``step``, has an arc ``token``."""
        at: tuple[int, int] | None = (state, step)
        while at is not None:
            gone = self.removed[at[0]]
            if gone:
                part, limit = token, NEVER
                while part >= 0:
                    when = gone.get(part)
                    if when is not None and when <= at[1] and when <= limit:
                        return False
                    limit, part = self.born[part], self.first[part]
            at = self.below[at[0]]
        return True

    def follows(self, state: int, token: int) -> bool:
        """The transition table; -1 is the start."""
        if state < 0:
            return True
        key = state * len(self.labels) + token
        known = self.table.get(key)
        if known is None:
            if len(self.table) > MEMORY:
                self.table.clear()
            known = self.table[key] = self.arc(state, self.step[state], token)
        return known

    def _entries(self, word: bytes, at: int) -> list[int]:
        """Vocabulary entries that begin at a place, the longest last."""
        node, found, move, entry = 0, [], self.move, self.entry
        for byte in word[at : at + self.longest]:
            node = move.get(node << 8 | byte, 0)
            if not node:
                break
            token = entry.get(node)
            if token is not None:
                found.append(token)
        return found

    def encode(self, word: bytes) -> list[int]:
        whole = self.ids.get(word)
        if whole is not None and self.born[whole] != NEVER:
            return [whole]
        end, labels, follows = len(word), self.labels, self.follows
        path: list[int] = []
        at, last, ways, dead = 0, -1, [self._entries(word, 0)], set()
        while at < end:
            open_ways = ways[-1]
            while open_ways:
                token = open_ways.pop()
                to = at + len(labels[token])
                if to not in dead and follows(last, token):
                    path.append(token)
                    at, last = to, token
                    if at < end:
                        ways.append(self._entries(word, at))
                    break
            else:  # the one state at this place has no way to the end
                if not path:
                    raise ValueError(f"no path over {word!r}")
                dead.add(at)
                ways.pop()
                at -= len(labels[path.pop()])
                last = path[-1] if path else -1
        return path


class ByteBpe:
    """Whole texts to ids and back, with the special tokens of the vocabulary file."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        signs = byte_signs()
        raw = lambda token: bytes(map(signs.__getitem__, token))
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.automaton = MergeAutomaton(
            {raw(t): i for t, i in spec["model"]["vocab"].items()}, [(raw(a), raw(b)) for a, b in pairs]
        )
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.words = regex.compile(WORDS)
        self.labels = dict(enumerate(self.automaton.labels)) | {i: t.encode() for t, i in self.special.items()}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            ids = self.older.get(word)
            if ids is None:
                ids = np.array(self.automaton.encode(word.encode()), "<u4").tobytes()
            if len(self.known) > MEMORY // 2:
                self.known, self.older = {}, self.known
            self.known[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        parts = self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]
        out = []
        for part in parts:
            if part in self.special:
                out.append(np.array([self.special[part]], "<u4").tobytes())
            else:
                words = self.words.findall(part)
                try:
                    out.append(b"".join(map(self.known.__getitem__, words)))
                except KeyError:
                    out.append(b"".join(map(self._word, words)))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.labels.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _coder(definition: str) -> ByteBpe:
    return ByteBpe(definition)


def bpe_round_trip(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, ids (bytes of little-endian 32-bit ids), decoded.

    Special token strings in a text become their ids. Null text counts as
    empty and has no ids. The tokenizer file is read once, by the driver.
    Rows are independent: repeated rows and ids, extra columns and empty tables
    change nothing; very long words cost in proportion to their length.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(definition)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                ids = [coder.encode(t or "") for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(ids, pa.binary()), pa.array([coder.decode(x) for x in ids], pa.string())],
                    ["doc_id", "ids", "decoded"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id bigint, ids binary, decoded string"
    )


def with_digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
