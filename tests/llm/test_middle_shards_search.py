"""Fill-in-middle, sharding and lexical search against plain restatements, on odd rows."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphlane.llm import fill_in_middle as fim
from glyphlane.llm import lexical_search as search
from glyphlane.llm import sharding
from tests.conftest import spark  # noqa: F401
from tests.llm.test_operators import UPPER, frame, odd_texts

EXTRA = {"n": "a", "form": "b", "output": "c", "shard": "d", "slot": "e", "law": "f", "_key": "g", "_bucket": "h", "items": "i", "score": "j", "h1": "k"}


def middle_texts():
    return [*odd_texts(), "a<P>b", "a<S>b", "<M>", "<P", "P>", "<", "S><", "é𝄞" * 3000, "x" * 100_000, "<<P", "M>M>"] + [f"t{i} <S é" for i in range(60)]


def plain_middle(doc_id, text, unit=None):
    """The contract, word for word; units are code points or begin at matches."""
    text = text or ""
    starts = list(range(len(text))) if unit is None else [m.start() for m in re.finditer(unit, text)]
    if unit is not None and text:
        starts = sorted({0, *starts[1:]})
    n = len(starts)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    place = lambda k: 0 if k == 0 else len(text) if k >= n else starts[k]
    a, b = (place(k) for k in sorted((h[0] % (n + 1), h[1] % (n + 1))))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("unit", [None, r"\S+"])
def test_fill_in_middle(spark, unit):  # noqa: F811
    texts = middle_texts()
    ids = [*range(len(texts) - 2), None, 3]
    docs = frame(spark, texts, ids, **EXTRA).repartition(3)
    made = fim.fill_in_middle(docs, unit_pattern=unit, block_bytes=64)
    got = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    want = Counter((i, *plain_middle(i, t, unit)) for i, t in zip(ids, texts))
    assert Counter(tuple(r)[:6] for r in got) == want
    assert Counter(r.back for r in got) == Counter(t or "" for t in texts)
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.with_digests(fim.fill_in_middle(frame(spark, [], **EXTRA))).collect() == []
    one = fim.with_digests(fim.fill_in_middle(frame(spark, ["abc é"], [11]))).collect()[0]
    assert one.output_sha256 == hashlib.sha256(plain_middle(11, "abc é")[4].encode()).hexdigest()
    assert one.restored_sha256 == hashlib.sha256("abc é".encode()).hexdigest()


def test_a_cut_reads_one_block():
    text = ("aé€𝄞" * 5000).encode()
    index = fim.BlockIndex(text, None, 32)

    class Watched(np.ndarray):
        read = 0

        def __getitem__(self, key):
            out = super().__getitem__(key)
            Watched.read += np.size(out)
            return out

    index.points = index.points.view(Watched)
    whole = text.decode()
    for k in (1, 777, 19_999):
        Watched.read = 0
        assert index.cut(k) == (len(whole[:k].encode()), k)
        assert Watched.read <= 64


def test_sharding(spark):  # noqa: F811
    texts = [*odd_texts(), *(f"text {i}" * (i % 9) for i in range(200)), *["same"] * 150]
    ids = [*range(len(texts) - 150), *[7] * 75, *[None] * 75]
    docs = frame(spark, texts, ids, **EXTRA).repartition(5)
    out = sharding.sharded(docs, bucket_bytes=1 << 14).persist()
    rows = out.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter(zip(ids, texts))
    assert out.columns == ["doc_id", "text", *(c for c in EXTRA if c not in ("shard", "slot", "law", "_key", "_bucket")), *sharding.ADDED]
    sizes = Counter(r.shard for r in rows)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sizes[s]))
    # copies lie in all shards, and another seed gives another order
    assert len({r.shard for r in rows if r.text == "same"}) == 8
    other = {(r.doc_id, r.shard, r.slot) for r in sharding.sharded(docs, seed=2, bucket_bytes=1 << 14).collect()}
    assert len(other & {(r.doc_id, r.shard, r.slot) for r in rows}) < 100
    facts = {(r.doc_id, r.shard, r.slot): r for r in sharding.shard_facts(out).collect()}
    import zlib

    for r in rows:
        f = facts[r.doc_id, r.shard, r.slot]
        raw = (r.text or "").encode()
        assert (f.size, f.text_crc32, f.law, f.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "rows", None)


def test_buckets_follow_the_bytes_and_hold_no_hot_row(spark):  # noqa: F811
    docs = frame(spark, ["copy " * 40] * 3000, [5] * 3000).repartition(4)
    rows, buckets = sharding.shuffled_buckets(docs, 1, 1 << 14, "doc_id", "text")
    sizes = Counter(r._bucket for r in rows.select("_bucket").collect())
    assert buckets == -(-3000 * 264 // (1 << 14)) and len(sizes) == buckets
    assert max(sizes.values()) < 2 * 3000 / buckets
    offsets = {r._bucket: r._before for r in sharding.bucket_offsets(rows, span=4).collect()}
    assert offsets == {b: sum(n for o, n in sizes.items() if o < b) for b in sizes}


@pytest.mark.parametrize("n", [0, 1, 3, 8, 9])
def test_few_rows_in_shards(spark, n):  # noqa: F811
    rows = sharding.sharded(frame(spark, [f"t{i}" for i in range(n)])).collect()
    assert sorted((r.shard, r.slot) for r in rows) == sorted((i % 8, i // 8) for i in range(n))


def test_shards_as_folders(spark, tmp_path):  # noqa: F811
    out = sharding.sharded(frame(spark, [f"t{i}" for i in range(100)]), bucket_bytes=1 << 10)
    sharding.write_shards(out, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted((r.shard, r.slot, r.text) for r in back.collect()) == sorted((r.shard, r.slot, r.text) for r in out.collect())


def test_every_order_is_equally_likely():
    seen = Counter(tuple(sharding.fisher_yates(4, np.random.default_rng([1, s])).tolist()) for s in range(24_000))
    assert len(seen) == 24 and max(abs(n - 1000) for n in seen.values()) < 160


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def plain_search(docs, items, k):
    """All documents scored for all items. docs: (id, text); items: id to texts."""
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs = sum(bool(c) for _, c in counts)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, texts in items.items():
        if item is None:
            continue
        asked, scores = {t for x in texts for t in terms(x)}, []
        for doc_id, c in counts:
            if not c or doc_id is None:
                continue
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in asked if t in c
            )
            if score > 0:
                scores.append((-score, doc_id))
        out += [(item, rank, doc_id, -score) for rank, (score, doc_id) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def search_rows():
    rng = random.Random(8)
    word = lambda: f"w{min(int(rng.expovariate(0.03)), 300)}"
    texts = [" ".join(word() for _ in range(rng.choice([1, 5, 40, 400]))) for _ in range(500)]
    texts += ["É é ñ-ñ W1_w1\x00W1", "a" * 5000 + " w1", "w2 " * 20_000, "tie w7 w8", "tie w7 w8", "TIE W8 W7", None, "", " ,;! "]
    texts += ["same text w9"] * 60
    ids = [*range(len(texts) - 60), *[3] * 30, *[None] * 30]
    items = [(1, "w1 W1 w2"), (2, "tie w7"), (3, None), (4, " , "), (5, texts[7] or "w5"), (5, "é w9"), (None, "w1"), (6, "absent"), (7, "É a" + "a" * 4999)]
    items += [(100 + i, " ".join(word() for _ in range(30))) for i in range(12)]
    return texts, ids, items


@pytest.mark.parametrize("options", [{}, {"group_bytes": 300, "block_docs": 16}])
def test_lexical_search(spark, options):  # noqa: F811
    texts, ids, items = search_rows()
    docs = frame(spark, texts, ids, **EXTRA).repartition(4)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    by_item = {}
    for i, t in items:
        by_item.setdefault(i, []).append(t)
    got = sorted(map(tuple, search.lexical_search(docs, asked, k=10, **options).collect()))
    assert got == plain_search(list(zip(ids, texts)), by_item, 10)


def test_search_without_rows(spark):  # noqa: F811
    docs, items = frame(spark, ["a b"]), spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert search.lexical_search(docs.limit(0), items).collect() == []
    assert search.lexical_search(docs, items.limit(0)).collect() == []
    assert search.lexical_search(frame(spark, [None, ""]), items).collect() == []
    assert search.lexical_search(docs, items).columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_hold_and_exclude(spark):  # noqa: F811
    texts, ids, items = search_rows()
    rows = [(i, t) for i, t in zip(ids, texts) if i is not None]
    by_item = {i: [t for x, t in items if x == i] for i in sorted({i for i, _ in items if i})}
    query = search.Query(list(by_item.items()))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(2)
    index = docs.mapInArrow(search._index_rows(query, 4 << 20, 64), search.INDEX).collect()
    n_docs, n_terms = sum(r.n_docs for r in index), sum(r.n_terms for r in index)
    counts = [(i, Counter(terms(t))) for i, t in rows]
    df = Counter(t for _, c in counts for t in c)
    assert (n_docs, n_terms) == (sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts))
    found = Counter()
    for r in index:
        for a in r.asked:
            found[query.terms[a.term].decode()] += a.docs
    assert found == Counter({t.decode(): df[t.decode()] for t in query.terms if df[t.decode()]})
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t.decode()] + 1))) for t in query.terms], np.int64)
    stats = search.Statistics(n_docs, n_terms, weights)
    full = plain_search(rows, by_item, 10**6)
    exact = {}
    for item, _, doc_id, score in full:
        exact.setdefault((item, doc_id), []).append(score)
    tight = seen = 0
    for r in index:
        if not r.n_bits:
            continue
        for first, some in search.upper_bounds(query, stats, r.n_bits, np.array(r.sizes), bytes(r.slices), chunk=40):
            for item, bounds in enumerate(some.tolist(), first):
                for doc_id, bound in zip(r.ids, bounds):
                    scores = exact.get((int(query.items[item]), doc_id), [0])
                    if doc_id != 3:  # its rows repeat
                        assert bound >= scores[0]
                        tight, seen = tight + (bound <= 1.5 * scores[0]), seen + 1
    assert tight > 0.8 * seen


def test_terms_with_one_hash_stay_apart(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(search, "_hashes", lambda data, start, end: np.asarray(end - start, np.uint64) % np.uint64(2))
    query = search.Query([(1, ["ab cd efg ab"]), (2, ["x yz"])])
    t = search.terms_of(pa.array(["cd AB q efg ef", None, "yz x xx ab"]))
    owner, number = query.occurrences(t)
    assert Counter((o, query.terms[n].decode()) for o, n in zip(owner.tolist(), number.tolist())) == Counter(
        [(0, "cd"), (0, "ab"), (0, "efg"), (2, "yz"), (2, "x"), (2, "ab")])
