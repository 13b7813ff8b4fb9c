import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from glyphlane.functions import answers as A
from glyphlane.functions.arrays import prefix_sums
from glyphlane.operators import features as X
from glyphlane.operators import mixing as M
from glyphlane.operators import ordinal
from glyphlane.operators import packing as P
from glyphlane.operators import validate as V
from glyphlane.operators.ordinal import with_global_ordinal, with_ordinal

from .conftest import first


def test_sampling_rates_and_unknown_names(spark):
    requests = spark.createDataFrame([("a%50",), ("b",), ("c%150",)], "request string")
    registry = spark.createDataFrame([("a", "/a"), ("b", "/b"), ("c", "/c")], "dataset string, data_path string")
    assert {r.dataset: r.rate for r in M.resolve_requests(requests, registry).collect()} == {"a": 0.5, "b": 1.0, "c": 1.5}
    fewer = registry.where("dataset <> 'b'")
    assert [r.dataset for r in M.unknown_requests(requests, fewer).collect()] == ["b"]
    with pytest.raises(Exception, match="do not find b"):
        M.resolve_requests(requests, fewer).collect()


def test_exact_sample_of_a_hot_dataset(spark):
    rows = spark.range(9000).select(F.col("id"), F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("dataset"))
    rates = spark.createDataFrame([("hot", 0.37), ("cold", 1.5)], "dataset string, rate double")
    kept = M.sample_exact(rows, rates, "id", 1)
    assert {r.dataset: r["count"] for r in kept.groupBy("dataset").count().collect()} == {"hot": 2220, "cold": 3000}
    assert kept.select("id").distinct().count() == 5220
    none = M.sample_exact(rows, spark.createDataFrame([("hot", 0.0), ("cold", 0.0001)], "dataset string, rate double"), "id")
    assert none.count() == 0


def test_shuffle_order_is_dense(spark):
    got = M.shuffled(spark.range(5000), "id", 3)
    assert first(got.agg(F.min("ordinal"), F.max("ordinal"), F.countDistinct("ordinal"))) == (1, 5000, 5000)
    assert first(got.agg(F.corr("ordinal", "id")))[0] < 0.1


def test_ordinal_with_one_hot_bucket(spark):
    df = spark.range(1000).select((999 - F.col("id")).alias("k"))
    got = with_ordinal(df, [F.col("k")], F.floor(F.col("k") / 990))
    assert got.where(F.col("ordinal") != F.col("k") + 1).count() == 0


def test_global_order_is_cut_by_rows(spark):
    """Skewed and sparse keys: ranges follow the rows, and none holds much more than its share."""
    keys = [7] * 600 + [10**15 + i * 10**9 for i in range(200)] + list(range(200))
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long").repartition(5)
    got = with_global_ordinal(df, [F.col("k"), F.col("i")], range_rows=50).collect()
    assert [(r.k, r.i) for r in sorted(got, key=lambda r: r.ordinal)] == sorted((k, i) for i, k in enumerate(keys))
    assert sorted(r.ordinal for r in got) == list(range(1, 1001))
    held = []
    original = ordinal.stored
    try:
        ordinal.stored = lambda rows, name: held.append(original(rows, name)) or held[-1]
        with_global_ordinal(df, [F.col("k"), F.col("i")], range_rows=50)
    finally:
        ordinal.stored = original
    sizes = held[0].groupBy(F.shiftright("_row", 33)).count().collect()
    assert len(sizes) >= 15 and max(r["count"] for r in sizes) <= 150
    assert with_global_ordinal(df.limit(0), [F.col("k")]).collect() == []


def test_running_sums_of_long_arrays(spark):
    rows = spark.createDataFrame([([1, 2, 3],), ([],), ([5],), (list(range(100_000)),)], "a array<int>")
    for r in rows.select("a", prefix_sums(F.col("a")).alias("s"), P.sequence_bounds(F.col("a")).alias("b")).collect():
        assert r.s == list(accumulate(r.a)) and r.b == [0, *r.s]
    ids = [77091, 5, 6, 151645] * 25_000
    masks = first(spark.createDataFrame([(ids,)], "ids array<bigint>").select(X.label_mask(F.col("ids")).alias("l")))
    assert masks.l == plain_labels(ids)
    html = first(spark.createDataFrame([("\n".join(["a", "```py", "x<y", "```"] * 25_000),)], "t string").select(A.to_html(F.col("t")).alias("h")))
    assert html.h.count('<pre><code class="language-py">') == 25_000 and html.h.count("x&lt;y") == 25_000


def test_empty_ids_have_no_positions(spark):
    rows = spark.createDataFrame([(1, [], []), (1, [5], [5])], "b int, ids array<bigint>, labels array<bigint>")
    got = P.pad_batches(rows, "b", "ids", "labels", 9, 4).collect()
    assert {tuple(r.padded_ids): r.padded_positions for r in got} == {(9,): [1], (5,): [0]}


def plain_best_fit(lengths, capacity):
    packs = []
    for n in sorted(lengths, reverse=True):
        fitting = [p for p in packs if sum(p) + n <= capacity]
        if fitting:
            max(fitting, key=sum).append(n)
        else:
            packs.append([n])
    return sorted(sum(p) for p in packs)


def test_packing(spark):
    rnd = random.Random(4)
    rows = [(i + 1, rnd.choice([rnd.randint(1, 900), rnd.randint(1, 5000)])) for i in range(700)]
    packed = P.pack(spark.createDataFrame(rows, "ordinal long, n long"), "ordinal", "n", "ordinal").collect()
    assert sorted(r.ordinal for r in packed) == list(range(1, 701))
    packs = {}
    for r in packed:
        assert r.batch == (r.ordinal - 1) // 256
        packs.setdefault((r.batch, r.pack), []).append(r.num_tokens)
    assert all(sum(p) <= P.CAPACITY or len(p) == 1 for p in packs.values())
    for b in range(3):
        want = plain_best_fit([n for i, n in rows if (i - 1) // 256 == b], P.CAPACITY)
        assert sorted(sum(p) for (batch, _), p in packs.items() if batch == b) == want


def plain_labels(ids):
    labels, i = [-100] * len(ids), 0
    while i < len(ids):
        if ids[i] == X.ANSWER_MARK and X.TURN_END in ids[i + 2:]:
            end = ids.index(X.TURN_END, i + 2)
            labels[i + 2:end + 2] = ids[i + 2:end + 2]
            i = end
        i += 1
    return labels


def test_label_masks(spark):
    rnd = random.Random(6)
    rows = [([rnd.choice([1, 2, 3, 4, X.ANSWER_MARK, X.TURN_END]) for _ in range(rnd.randint(1, 40))],) for _ in range(400)]
    for ids, labels in spark.createDataFrame(rows, "ids array<bigint>").select("ids", X.label_mask(F.col("ids"))).collect():
        assert labels == plain_labels(ids), ids


def test_position_worked_examples(spark):
    schema = "s int, turn int, n long, t int, h int, w int"
    segs = spark.createDataFrame([(1, 0, None, 3, 2, 2), (1, 1, 5, None, None, None)], schema)
    rows = X.position_rows(segs, "s", ["turn"]).orderBy("turn", "token").collect()
    assert [r.pos_t for r in rows] == [0] * 4 + [1] * 4 + [2] * 4 + [3, 4, 5, 6, 7]
    timed = X.position_rows(segs, "s", ["turn"], F.lit(25.0)).orderBy("turn", "token").collect()
    assert [r.pos_t for r in timed] == [0] * 4 + [50] * 4 + [100] * 4 + [101, 102, 103, 104, 105]
    assert first(X.position_deltas(segs, "s")).delta == 8 - 17
    single = X.position_rows(X.split_video_grids(segs), "s", ["turn", "frame"]).orderBy("turn", "frame", "token").collect()
    assert [r.pos_t for r in single] == [0] * 4 + [2] * 4 + [4] * 4 + [6, 7, 8, 9, 10]


def test_substitutes(spark):
    rows = spark.createDataFrame([(1, False), (2, True), (3, False), (4, True)], "ordinal long, bad boolean")
    assert [r.ordinal for r in P.with_substitutes(rows, "ordinal", F.col("bad"), "DROP").orderBy("ordinal").collect()] == [1, 3]
    three = rows.where("ordinal < 4")
    got = P.with_substitutes(three, "ordinal", F.col("bad"), "SUBSTITUTE_NEXT").orderBy("ordinal").collect()
    assert [(r.ordinal, r.source_ordinal) for r in got] == [(1, 1), (2, 3), (3, 3)]
    for policy in ("FAIL", "SUBSTITUTE_NEXT"):
        with pytest.raises(Exception, match="sample"):
            P.with_substitutes(rows, "ordinal", F.col("bad"), policy).collect()


def samples(spark, turns, images, videos=()):
    schema = "id int, conversations array<struct<from:string,value:string>>, images array<string>, videos array<string>"
    return spark.createDataFrame([(1, turns, list(images), list(videos))], schema)


def test_validation_example(spark):
    s = samples(spark, [("human", "<image> what"), ("gpt", "a")], ["a.jpg", "b.jpg"])
    listing = spark.createDataFrame([("media/a.jpg",), ("media/b.jpg",)], "path string")
    problem = first(V.validate(s, listing, "id")).validation_problems
    assert [(p.type, p.media_type, p.expected, p.actual) for p in problem] == [("token_mismatch", "image", 2, 1)]
    gone = first(V.validate(s, listing.where("path like '%a.jpg'"), "id")).validation_problems
    assert [p.type for p in gone] == ["missing_files", "token_mismatch"]


def test_message_building(spark):
    turns = [("human", "a <image>b<video>"), ("gpt", " <image> "), ("human", "<image>")]
    good = first(V.build_messages(samples(spark, turns, ["x", "y"], ["v"]), "/d", "FAIL"))
    assert [(i.turn, i.type, i.text or i.uri) for i in good["items"]] == [
        (0, "text", "a"), (0, "image", "/d/x"), (0, "text", "b"), (0, "video", "/d/v"), (1, "text", " <image> "), (2, "image", "/d/y")]
    short = V.build_messages(samples(spark, turns, ["x"], ["v"]), "/d")
    assert first(short).fault == "more <image> placeholders than images"
    assert first(V.build_messages(samples(spark, turns, ["x", "y", "z"], ["v"]), "/d")).fault == "unused media"
    with pytest.raises(Exception, match="placeholders"):
        V.build_messages(samples(spark, turns, ["x"], ["v"]), "/d", "FAIL").collect()


def test_buckets_follow_rows_and_not_ids(spark):
    ids = [0, 1, 2, 3, 2**62, -(2**61), *(10**15 + 7**k for k in range(20)), *range(5_000_000, 5_000_400)]
    rows = spark.createDataFrame([(i,) for i in ids], "id bigint")
    cut = ordinal.in_buckets(rows, F.col("id"), "b", buckets=16)
    sizes = [r["count"] for r in cut.groupBy("b").count().collect()]
    assert len(sizes) <= 16 and max(sizes) <= 3 * len(ids) / 16
    got = {r.id: r.ordinal for r in ordinal.with_ordinal(cut, [F.col("id")], F.col("b")).collect()}
    assert got == {v: i for i, v in enumerate(sorted(ids), 1)}
    assert ordinal.with_ordinal(ordinal.in_buckets(rows.limit(0), F.col("id"), "b"), [F.col("id")], F.col("b")).count() == 0
