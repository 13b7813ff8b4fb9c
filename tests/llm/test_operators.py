"""Each operator against a plain restatement, on odd rows: nulls, blanks, repeats, ties, long texts, clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from glyphlane.llm import (
    bin_packing, bpe, components, exact_dedup, labelled, license_scan, license_texts, line_dedup, near_dedup, quality, token_files, topk, toxicity,
)
from tests.conftest import spark  # noqa: F401

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
CLASH = {"key": "a", "places": "b", "kept": "c", "score": "d", "digest": "e", "norm": "f", "n_lines": "g", "u": "h", "id": "i", "rep": "j"}


def fold(text):
    return (text or "").translate(UPPER)


def odd_texts():
    rng = random.Random(4)
    line = "This line is in many documents, surely."
    texts = [None, "", " \t\n ", "Same text", "sAME TEXT", "Same text", "É same", "é same", "one", "one two three four", "'s I'LL x'd ''s"]
    texts += [f"{line}\n{w}\n  {line.upper()} \n" for w in ("alpha", "beta", "gamma")]
    texts += [line, "short line\nshort line", "a<|endoftext|>b", "<|startoftext|>", "\r\n\x0b\x0c\n\n"]
    texts.append(" ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "Ärger", "123", "!?"]) for _ in range(40_000)))
    return texts


def frame(spark, texts, ids=None, **extra):  # noqa: F811
    ids = list(range(len(texts))) if ids is None else ids
    schema = ", ".join(["doc_id bigint", "text string", *(f"`{c}` string" for c in extra)])
    return spark.createDataFrame([(i, t, *extra.values()) for i, t in zip(ids, texts)], schema)


@pytest.fixture(scope="module")
def odd(spark):  # noqa: F811
    return frame(spark, odd_texts(), **CLASH).repartition(3)


@pytest.fixture(scope="module")
def none(spark):  # noqa: F811
    return frame(spark, [], **CLASH)


def test_exact_dedup(spark, odd, none):  # noqa: F811
    groups = defaultdict(list)
    for i, t in enumerate(odd_texts()):
        groups[fold(t)].append(i)
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(odd).collect()}
    assert len(got) == len(odd_texts())
    for text, ids in groups.items():
        for i in ids:
            assert (got[i].keep_id, got[i].group_size, got[i].kept) == (max(ids), len(ids), i == max(ids))
            assert got[i].text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert exact_dedup.exact_dedup(none).count() == 0
    rows = exact_dedup.exact_dedup(frame(spark, ["x", "X", "y", None, "z", "z"], [None, 3, None, 5, 7, 7])).collect()
    assert sorted((r.text_sha256[:4], str(r.doc_id), str(r.keep_id), r.kept) for r in rows) == sorted(
        (hashlib.sha256(t.encode()).hexdigest()[:4], i, k, b)
        for t, i, k, b in [("x", "None", "3", False), ("x", "3", "3", True), ("y", "None", "None", True), ("", "5", "5", True),
                           ("z", "7", "7", True), ("z", "7", "7", True)]
    )


def test_texts_with_one_digest_stay_apart(spark, monkeypatch):  # noqa: F811
    import types

    fake = types.SimpleNamespace(**{n: getattr(F, n) for n in dir(F) if not n.startswith("__")})
    fake.sha2 = lambda col, bits: F.expr(f"sha2(substring({col}, 1, 1), {bits})")
    monkeypatch.setattr(exact_dedup, "F", fake)
    rows = exact_dedup.exact_dedup(frame(spark, ["ab", "AB", "ac", "b", "ac", "ad"])).collect()
    assert {r.doc_id: (r.keep_id, r.group_size) for r in rows} == {0: (1, 2), 1: (1, 2), 2: (4, 2), 3: (3, 1), 4: (4, 2), 5: (5, 1)}


def brute_components(texts, ids, size=5, percent=75):
    sets = {}
    for i, t in zip(ids, texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", fold(t))
        sets[i] = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_near_dedup_in_large_groups(spark, odd, none):  # noqa: F811
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(3000)]
    texts = odd_texts()
    for size, copies, worst in ((150, 160, 14), (60, 40, 6), (400, 30, 40)):
        base = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(copies):
            some = list(base)
            for _ in range(rng.randint(0, worst)):
                some[rng.randrange(size)] = rng.choice(vocabulary)
            texts.append(" ".join(some))
    ids = [i * 3 + 1 for i in range(len(texts))]
    rng.shuffle(ids)
    got = near_dedup.minhash_components(frame(spark, texts, ids, **CLASH).repartition(4), block=32).collect()
    want = brute_components(texts, ids)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert near_dedup.minhash_components(none).count() == 0
    some = frame(spark, ["a b c d e f", "A b c d e f", None, "", "a b c d e f"], [4, 2, None, 3, None], **CLASH)
    rows = sorted(((str(r.doc_id), str(r.component_id), r.kept) for r in near_dedup.minhash_components(some).collect()))
    assert rows == [("2", "2", True), ("3", "3", True), ("4", "2", False), ("None", "None", True), ("None", "None", True)]
    kept = near_dedup.near_dedup(some)
    assert kept.columns == some.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["2", "3", "None", "None"]


def test_bit_counts_estimate_the_similarity(spark):  # noqa: F811
    rng = np.random.default_rng(3)
    errors = []
    for share in (0.2, 0.5, 0.75, 0.9):
        n = 2000
        common = int(n * 2 * share / (1 + share))
        pool = rng.integers(0, 2**64, 2 * n - common, dtype=np.uint64)
        a, b = np.sort(pool[:n]), np.sort(pool[n - common :])
        low = near_dedup.packed_low_bits(np.stack([near_dedup.minima(a), near_dedup.minima(b)]))
        here = near_dedup._estimates(low[0], low[1:])[0]
        row = spark.createDataFrame([(low[0].view(np.int64).tolist(), low[1].view(np.int64).tolist())], "a array<bigint>, b array<bigint>")
        assert abs(row.select(near_dedup.estimated("a", "b")).first()[0] - here) < 1e-9
        errors.append(abs(here - len(np.intersect1d(a, b)) / len(np.union1d(a, b))))
    assert max(errors) < 0.15


def test_components(spark):  # noqa: F811
    chain = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 100), (7, 7), (300, 150), (150, 90)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 200: 100, 300: 90, 150: 90}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("slices", [1, 4])
def test_topk(spark, slices):  # noqa: F811
    rng = np.random.default_rng(5)
    vectors = {i: rng.normal(0, 0.3, 6).tolist() for i in range(120)}
    vectors.update({200: vectors[5], 201: vectors[5], 202: None, 203: [0.1, None], 204: [float("nan")] * 6, 205: [float("inf")] * 6, 206: [0.5, -0.5], 207: []})
    rows = [(i, v, "x") for i, v in vectors.items()] + [(5, vectors[5], "y"), (None, vectors[5], "z")]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, score string").repartition(3)
    got = topk.exact_topk(table, F.col("vec_id") % 5 == 0, k=4, slices=slices, block_rows=16).collect()
    whole = [(i, np.floor(256 * np.array(v + [0.0] * (6 - len(v))))) for i, v, _ in rows
             if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = Counter()
    for n, (q, v) in enumerate(whole):  # the rows of a repeated id are queries and candidates of their own
        if q % 5 == 0:
            scores = sorted((-int(v @ w), x) for m, (x, w) in enumerate(whole) if m != n)[:4]
            want.update((q, k, x, -s) for k, (s, x) in enumerate(scores, 1))
    assert Counter(tuple(r) for r in got) == want
    assert topk.exact_topk(table.filter("vec_id = 10"), F.lit(True)).count() == 0
    assert topk.exact_topk(table.limit(0), F.lit(True)).count() == 0
    few = topk.exact_topk(table.filter("vec_id in (10, 11, 12)"), F.lit(True)).collect()
    assert Counter(r.query_id for r in few) == {10: 2, 11: 2, 12: 2}


def test_topk_beyond_doubles(spark):  # noqa: F811
    rows = [(1, [3e6, 1.0]), (2, [2e6 + 1 / 256, 5.0]), (3, [2e6, 9.0])]
    got = topk.exact_topk(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), F.col("vec_id") == 1, k=2).collect()
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    scores = sorted(((-sum(a * b for a, b in zip(whole[1], whole[x])), x) for x in (2, 3)))
    assert [(r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(x, -s) for s, x in scores]


def test_topk_stays_exact_up_to_64_bits(spark):  # noqa: F811
    rows = [(1, [5e6]), (2, [1.28e9 / 256]), (3, [-5e6]), (4, [1e300]), (5, [4.0])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in topk.exact_topk(table, F.col("vec_id") <= 2, k=9).collect()}
    assert got[1, 2] == 1_280_000_000 * 1_280_000_000 == 1638400000000000000 and got[1, 3] == -1638400000000000000
    assert got[2, 4] == 2**63 - 1 and got[2, 5] == 1_280_000_000 * 1024
    assert len(got) == 8


def test_topk_multiplies_less_than_all():
    """Norms and what the first slices tell leave most pairs unmultiplied, and lose none that reaches the cutoff."""
    rng = np.random.default_rng(3)
    q = np.floor(rng.normal(0, 100, (40, 64)))
    x = np.floor(rng.normal(0, 100, (900, 64)) * np.linspace(2, 0.05, 900)[:, None])
    edges = [(0, 16), (16, 32), (32, 48), (48, 64)]
    scores = (q @ x.T).astype(np.int64)
    cutoffs = np.sort(scores, axis=1)[:, -5]
    counted = []
    rows, cols, found = topk.reaching(q, x, edges, cutoffs, counted)
    assert sorted(zip(rows.tolist(), cols.tolist(), found.tolist())) == [
        (i, j, scores[i, j]) for i in range(40) for j in range(900) if scores[i, j] >= cutoffs[i]]
    assert counted[0] == q.shape[0] * x.shape[0] and sum(counted) < 0.8 * 4 * counted[0] and counted == sorted(counted, reverse=True)
    counted = []
    assert len(topk.reaching(q, x[800:], edges, cutoffs, counted)[0]) == 0 and sum(counted) == 0
    none = np.full(40, topk.NO_CUTOFF)
    assert len(topk.reaching(q, x, edges, none)[0]) == scores.size


def test_line_dedup(odd, none):
    texts = odd_texts()
    blank = " \t\n\x0b\x0c\r"
    held = defaultdict(set)
    for i, t in enumerate(texts):
        for line in (t or "").split("\n"):
            key = line.strip(blank).translate(UPPER)
            if len(key) >= 20:
                held[key].add(i)
    got = line_dedup.line_dedup(odd)
    assert got.columns == [*(c for c in odd.columns if c != "n_lines"), "n_lines", "n_dropped"]
    for r in got.collect():
        lines = (texts[r.doc_id] or "").split("\n")
        keys = [x.strip(blank).translate(UPPER) for x in lines]
        kept = [x for x, k in zip(lines, keys) if len(held[k]) < 3 or r.doc_id == max(held[k])]
        assert (r.text, r.n_lines, r.n_dropped) == ("\n".join(kept), len(lines), len(lines) - len(kept))
    assert line_dedup.line_dedup(none).count() == 0


def test_line_dedup_without_ids(spark):  # noqa: F811
    line = "a line of more than twenty signs"
    rows = line_dedup.line_dedup(frame(spark, [line] * 5, [None, None, 1, 2, 2])).collect()
    assert sorted(r.n_dropped for r in rows) == [0] * 5
    rows = line_dedup.line_dedup(frame(spark, [line] * 5, [None, 3, 1, 2, 2])).collect()
    assert sorted((str(r.doc_id), r.n_dropped) for r in rows) == [("1", 1), ("2", 1), ("2", 1), ("3", 0), ("None", 0)]


def test_license_scan(spark, none):  # noqa: F811
    mit = dict((i, b) for i, _, b in license_texts.TEXTS)["MIT"]
    texts = [
        f"MIT License\n\nCopyright (c) 2022 Somebody\nCopyright 2019-2020 Others\n\n{mit}", mit.upper().replace(", ", " ,\n"),
        "prose\nReleased  under the MIT Licence!\nmore\nLicensed under CC BY-NC 4.0.", f"{mit} and more", None, "", "prose", "(c) 2020 x",
        "SPDX-License-Identifier: ISC",
    ]
    got = {r.doc_id: (r.license_id, r.notice_ids, r.n_notices) for r in license_scan.license_scan(frame(spark, texts, **CLASH)).collect()}
    assert got == {
        0: ("MIT", "", 0), 1: ("MIT", "", 0), 2: (None, "CC-BY-NC-4.0,MIT", 2), 3: (None, "", 0), 4: (None, "", 0), 5: (None, "", 0),
        6: (None, "", 0), 7: (None, "", 0), 8: ("ISC", "ISC", 1),
    }
    assert license_scan.license_scan(none).count() == 0
    assert license_scan.license_scan(frame(spark, ["x"]), known=[]).first().license_id is None
    # repeated and null ids are one document each; a very long text is read to its end
    long = "word " * 300_000 + "\nLicensed under the MIT License."
    rows = license_scan.license_scan(frame(spark, [mit, "SPDX-License-Identifier: Zlib", None, "all rights reserved", long], [1, 1, None, None, 2])).collect()
    assert {r.doc_id: (r.license_id, r.notice_ids, r.n_notices) for r in rows if r.doc_id != 1} == {
        None: ("LicenseRef-all-rights-reserved", "LicenseRef-all-rights-reserved", 1), 2: (None, "MIT", 1)}
    one = next(r for r in rows if r.doc_id == 1)
    assert one.license_id == "MIT" and "Zlib" in one.notice_ids


def test_whole_licences_are_known(spark):  # noqa: F811
    """Each file, re-wrapped, in other case and punctuation and with copyright lines, is its licence."""
    ids = sorted(p.stem for p in license_texts.FOLDER.glob("*.txt"))
    assert {"Apache-2.0", "GPL-2.0-only", "GPL-3.0-only", "LGPL-2.1-only", "LGPL-3.0-only", "MPL-2.0", "CC0-1.0"} <= set(ids)
    texts = []
    for i in ids:
        text = (license_texts.FOLDER / f"{i}.txt").read_text()
        kept = [x for x in text.split("\n") if "opyright" not in x and "(c)" not in x.lower() and "©" not in x]
        texts += [text, "Copyright 2020 Someone\n" + text.upper().replace(" ", "  "), text.replace('"', "“").replace("-", "—")]
        assert kept
    got = {r.doc_id: r.license_id for r in license_scan.license_scan(frame(spark, texts)).collect()}
    assert got == {n: ids[n // 3] for n in range(len(texts))}


def test_units_equal_each_canonical_form(spark):  # noqa: F811
    rng = random.Random(9)
    pieces = ["a", "Sub", "License", "licenc", "\n", "\n\n", " ", "-", "Copyright (c) 2020 x", "(c) 1999", "© y", "per", "cent", "https:", "\t", "é", "'"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randrange(0, 14))) for _ in range(400)]
    rows = frame(spark, texts).select("doc_id", license_scan._units(F.col("text")).alias("u"), license_scan.canonical(F.col("text")).alias("w"),
                                      F.transform(F.split("text", "\n"), license_scan.canonical).alias("l")).collect()
    for r in rows:
        assert r.u[0] == r.w and Counter(x for x in r.u[1:] if x) == Counter(x for x in r.l if x), texts[r.doc_id]


def test_bpe_automaton_equals_the_library(odd, none, spark):  # noqa: F811
    library = Tokenizer.from_file(BYTE_BPE)
    rng = random.Random(8)
    texts = odd_texts() + ["a" * k for k in range(30)] + ["".join(rng.choice("aehinorst ,'1é\n中 ") for _ in range(50)) for _ in range(300)]
    got = {r.doc_id: r for r in bpe.bpe_round_trip(frame(spark, texts, **CLASH), BYTE_BPE).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i].ids, "<u4").tolist() == ids
        assert got[i].decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.with_digests(bpe.bpe_round_trip(none, BYTE_BPE)).count() == 0


def test_merge_gadgets_accept_one_path_for_each_word():
    letters = [bytes([c]) for c in b"abc"]
    rng = random.Random(2)
    for _ in range(40):
        vocabulary, merges = {x: i for i, x in enumerate(letters)}, []
        while len(merges) < 12:
            a, b = rng.choice(list(vocabulary)), rng.choice(list(vocabulary))
            if a + b not in vocabulary and len(a + b) < 7:
                vocabulary[a + b] = len(vocabulary)
                merges.append((a, b))
        automaton = bpe.MergeAutomaton(vocabulary, merges)
        for _ in range(200):
            word = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 12)))
            parts = [bytes([c]) for c in word]
            for a, b in merges:  # the definition: merge after merge, each from left to right
                i = 0
                while i < len(parts) - 1:
                    if parts[i] == a and parts[i + 1] == b:
                        parts[i : i + 2] = [a + b]
                    i += 1
            assert [automaton.labels[i] for i in automaton.encode(word)] == parts


def library_ids(texts, end):
    encoded = Tokenizer.from_file(WORD_BPE).encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [[*e.ids, end] for e in encoded]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, odd, none, tmp_path):  # noqa: F811
    want, start = {}, 0
    for i, ids in enumerate(library_ids(odd_texts(), 2)):
        want[i] = (start, len(ids), crc(ids))
        start += len(ids)
    manifest = token_files.write_token_files(odd, f"file://{tmp_path}/a", WORD_BPE, seq_len=16, batch_rows=4, file_tokens=1000)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_documents(manifest).collect()}
    assert got == want
    flat = [x for ids in library_ids(odd_texts(), 2) for x in ids]
    for r in manifest.collect():
        for row in {0, (r.n_tokens - 1) // 16}:
            ids, mask = token_files.sequence(r.path, row)
            mapped = token_files._open(r.path).get_batch(row // 4).column(1).values
            assert not ids.flags.owndata and mask.buffers()[1].size == mapped.buffers()[1].size  # a view of the whole batch's bits
            mask = np.array(mask)
            here = flat[r.first_token + row * 16 : min(r.first_token + r.n_tokens, r.first_token + row * 16 + 16)]
            assert ids[mask].tolist() == here and len(ids) == 16
    empty = token_files.write_token_files(none, f"file://{tmp_path}/b", WORD_BPE)
    assert token_files.read_documents(empty).count() == 0
    twice = token_files.write_token_files(frame(spark, ["b", "a", None, "a"], [1, 1, None, 1]), f"file://{tmp_path}/c", WORD_BPE)
    rows = token_files.read_documents(twice).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, 1, 1, 1] and [r.n_tokens for r in rows] == [1, 2, 2, 2]


def test_best_fit_packing(spark, odd, none):  # noqa: F811
    ids = library_ids(odd_texts(), 1)
    rows = bin_packing.best_fit_packing(odd, WORD_BPE, capacity=512, block_pieces=64).collect()
    bins = defaultdict(list)
    for r in rows:
        part = ids[r.doc_id][r.piece * 512 : r.piece * 512 + 512]
        assert (r.start, r.length, r.ids_crc32) == (r.piece * 512, len(part), crc(part))
        bins[r.sequence_id].append((r.offset, r.length))
    assert Counter(r.doc_id for r in rows) == {i: -(-len(x) // 512) for i, x in enumerate(ids)}
    for held in bins.values():
        held.sort()
        assert [a for a, _ in held] == np.cumsum([0, *(n for _, n in held)])[:-1].tolist() and sum(n for _, n in held) <= 512
    assert bin_packing.best_fit_packing(none, WORD_BPE).count() == 0
    big = bin_packing.best_fit_packing(frame(spark, ["x y", "x y", None], [None, 2**60 + 1, None]), WORD_BPE).collect()
    assert sorted(str(r.doc_id) for r in big) == [str(2**60 + 1), "None", "None"]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_keeps_every_capacity(rule):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 400, 600)
    bins = bin_packing.pack(lengths, 1024, 5, 300_000.0, (1.0, 0.5, 0.5), rule)
    for b in np.unique(bins):
        some = lengths[bins == b]
        assert some.sum() <= 1024 and len(some) <= 5 and (some**2).sum() <= 300_000
    tight = bin_packing.pack(lengths, 1024, 1024, 1024.0**2, (1.0, 0.001, 0.001), "norm")
    assert len(np.unique(tight)) <= -(-lengths.sum() // 1024) + 2
    with pytest.raises(ValueError):
        bin_packing.pack(np.array([600]), 1024, 5, 300_000.0, (1.0, 1.0, 1.0), rule)


@pytest.mark.parametrize("classify, label, good, least", [
    (toxicity.toxicity, "toxic", 0.97, 0.85), (quality.quality, "quality", 0.97, 0.97),
])
def test_classifiers_on_held_out_rows(spark, classify, label, good, least):  # noqa: F811
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = classify(docs, labels).join(labels, "doc_id").filter("held_out").select(F.col(label).alias("y"), "predicted").collect()
    assert np.mean([r.y == r.predicted for r in rows]) >= good
    assert np.mean([r.predicted for r in rows if r.y]) >= least  # recall of label 1
    assert np.mean([r.predicted == 0 for r in rows if not r.y]) >= 0.9


@pytest.mark.parametrize("classify, label, threshold", [(toxicity.toxicity, "toxic", 0.5), (quality.quality, "quality", 0.3)])
def test_classifiers_on_odd_rows(spark, odd, none, classify, label, threshold):  # noqa: F811
    texts = odd_texts()
    known = spark.createDataFrame([(i, i % 2, "x") for i in range(len(texts))] + [(None, 1, "x"), (3, None, "x"), (3, 1, "x"), (999, 0, "x")],
                                  f"doc_id bigint, {label} int, text string")
    rows = classify(odd, known).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= threshold) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert classify(none, known).count() == 0
    assert len({r.score for r in classify(odd, known.limit(0)).collect()}) == 1
    only = classify(frame(spark, ["x", None], [None, None]), known).collect()
    assert [r.held_out for r in only] == [False, False]


def test_factors_learn_a_pair_that_weights_miss():
    import pyarrow as pa

    rng = random.Random(6)
    texts, labels = [], []
    for _ in range(1200):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        texts.append(" ".join([rng.choice(["blue", "green", "stone", "river"]) for _ in range(6)] + ["nasty"] * insult + ["folk"] * group))
        labels.append(float(insult == group))  # neither word alone says anything
    model = toxicity.fit_machine(pa.array(texts), np.array(labels), 0.5, least_z=0.0, epochs=40)
    assert np.mean((model.scores(pa.array(texts)) >= 0.5) == np.array(labels)) > 0.95


def test_production_terms_keep_a_pair_that_neither_word_shows():
    import pyarrow as pa

    rng = random.Random(6)
    texts, labels, pairs = [], [], []
    for _ in range(3000):
        toxic, u = rng.random() < 0.5, rng.random()
        insult = u < 0.05
        group = insult if toxic else 0.05 <= u < 0.1  # each word as common in clean texts as in toxic ones
        words = [f"w{rng.randrange(300)}" for _ in range(20)] + ["nasty"] * insult + ["folk"] * group
        texts.append(" ".join(rng.sample(words, len(words))))
        labels.append(float(toxic))
        pairs.append(insult + group)
    texts, labels, pairs = pa.array(texts), np.array(labels), np.array(pairs)
    owner, found = toxicity.terms(*next(toxicity.chunks(texts))[2:])
    assert len(toxicity.known_terms(owner, found, labels, 4.0)) == 0
    model = toxicity.fit_machine(texts, labels, 0.5)
    assert len(model.known) == 2
    scores = model.scores(texts)
    assert np.all(scores[pairs == 2] >= 0.5) and np.all(scores[pairs == 1] < 0.5)
    blocks = toxicity.paired_terms(owner, found, labels, model.known[:0], 1 << 14, 7.0, block=7)
    assert np.array_equal(blocks, model.known)
    assert len(toxicity.paired_terms(owner, found, labels, model.known, 1 << 14, 7.0)) == 0


def test_quality_votes_do_not_follow_the_cap(spark):  # noqa: F811
    rng = random.Random(3)
    # the texts say nothing about the labels
    rows = [(i, " ".join(f"w{rng.randrange(60)}" for _ in range(30)), int(rng.random() < 0.85)) for i in range(2000)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(5000, ""), (5001, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, quality int")
    learned = [y for i, _, y in rows if zlib.crc32(str(i).encode()) % 5]
    small, large = ({r.doc_id: r.score for r in quality.quality(docs, labels, per_class=n).collect()} for n in (100, 2500))
    assert small[5000] == small[5001] == large[5000] and abs(small[5000] - np.mean(learned)) < 1e-9
    held = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert abs(np.mean([small[i] for i in held]) - np.mean([large[i] for i in held])) < 0.1


def test_repeated_ids_do_not_crowd_the_sample(spark):  # noqa: F811
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    docs = frame(spark, [f"text {i}" for i in ids for _ in range(30)] + [None, "zz"], [i for i in ids for _ in range(30)] + [ids[0]] * 2)
    known = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id bigint, toxic int")
    rows = labelled.labelled_sample(docs, known, "toxic", 10).collect()
    assert Counter(r.label for r in rows) == {0: 10, 1: 10} and len({r.text for r in rows}) == 20
    rows = labelled.labelled_sample(docs, known, "toxic", 100).collect()
    assert sorted((r.text, r.label) for r in rows) == sorted((f"text {i}", i % 2) for i in ids)


def test_machine_scores_by_a_double_loop_over_pairs(spark):  # noqa: F811
    """The margin, restated: bias, weights of the known terms, and the product of factors of every pair."""
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(40)]
    texts = ["", "unknown words", " ".join(words), *(" ".join(rng.choice(words, 9)) for _ in range(30)), "w1 " * 5000, None]
    raw = pa.array([w for w in words if w != "w7"], pa.string())
    known = np.unique(np.concatenate([toxicity.terms(data, offsets)[1] for _, _, data, offsets in toxicity.chunks(raw)]))
    machine = toxicity.Machine(known, -0.3, rng.normal(0, 0.5, len(known)), rng.normal(0, 0.5, (len(known), 3)))
    got = machine.scores(pa.array(texts, pa.string()))
    for n, text in enumerate(texts):
        one = pa.array([text], pa.string())
        mine = sorted({int(np.searchsorted(known, h)) for _, _, data, offsets in toxicity.chunks(one) for h in toxicity.terms(data, offsets)[1] if h in known})
        margin = machine.bias + sum(machine.weights[i] for i in mine)
        for a in range(len(mine)):
            for b in range(a + 1, len(mine)):
                margin += float(machine.factors[mine[a]] @ machine.factors[mine[b]])
        assert got[n] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9)


def test_votes_by_a_plain_loop_over_all_neighbours():
    """Cosines with every labelled vector, the nearest 15 and their votes, one text at a time."""
    rng = random.Random(6)
    texts = [" ".join(f"{'good' if i % 3 else 'bad'}{rng.randrange(30)}" for _ in range(rng.randrange(3, 40))) for i in range(200)]
    label = np.array([float(i % 3 > 0) for i in range(200)])
    model = quality.fit_neighbours(pa.array(texts), label, prior=0.9)
    asked = [*texts[:20], "good1 bad2 good3", "nothing of these", "", None, "good4 " * 3000]
    got = model.scores(pa.array(asked, pa.string()), block=7)
    prior, _, nearest, power, w0, w1 = model.numbers
    for n, text in enumerate(asked):
        mine = model.latent(pa.array([text], pa.string()))[0].astype(float)
        near = sorted(((float(mine @ v), i) for i, v in enumerate(model.vectors.astype(float))), reverse=True)
        votes = [(max(c, 0) ** power * (w1 if label[i] else w0), label[i]) for c, i in near[: int(nearest)]]
        total = sum(v for v, _ in votes)
        # neighbours at the border may be as near as others
        border = near[int(nearest)][0]
        ties = sum(abs(c - near[int(nearest) - 1][0]) < 1e-5 for c, _ in near)
        if ties == 1 or abs(border - near[int(nearest) - 1][0]) > 1e-5:
            assert got[n] == pytest.approx(sum(v * y for v, y in votes) / total if total > 1e-9 else prior, abs=1e-4)


@pytest.mark.parametrize("decide", [lambda d, x: toxicity.without_toxic(d, x), lambda d, x: quality.of_quality(d, x)])
def test_filters_take_any_rows(spark, decide):  # noqa: F811
    """Null ids and texts, repeated rows, very long texts and clashing names stay or go by their text alone; empty tables give none."""
    texts = [f"fine words number {i}" for i in range(60)] + [None, "", "long " * 200_000, "fine words number 3", "fine words number 3"]
    ids = [*range(60), None, 7, 8, 3, 3]
    docs = frame(spark, texts, ids, **CLASH)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)] + [(None, 1, 1), (5, None, None)], "doc_id bigint, toxic int, quality int")
    kept = decide(docs, labels)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert {r.text for r in rows} <= set(texts) and len([r for r in rows if r.text == "fine words number 3"]) in (0, 3)
    assert decide(docs.limit(0), labels).collect() == []
    # without usable labels every row scores the same
    assert decide(docs, labels.limit(0)).count() in (0, len(texts))
