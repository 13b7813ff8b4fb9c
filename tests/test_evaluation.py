import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from glyphlane.functions import actions as X
from glyphlane.functions import answers as A
from glyphlane.functions import choices as C
from glyphlane.functions import literals as L
from glyphlane.operators import codejudge as J
from glyphlane.operators import detection as D
from glyphlane.operators import frames as R
from glyphlane.operators import qa as Q

from .conftest import first


def plain_letter(answer, options):
    if C.API_FAILURE in answer:
        return None
    if any(p in answer for p in C.REFUSALS):
        return "Z"
    tokens = answer.translate(str.maketrans({c: " " for c in C.SEPARATORS})).split()
    named = [k for k in options if k in tokens]
    if len(named) == 1:
        return None if "A" in tokens and len(tokens) > 3 else named[0]
    return "Z" if not named and "Z" in tokens else None


def plain_text(answer, options):
    held = [k for k, v in options.items() if v.lower() in answer.lower()]
    return held[0] if len(held) == 1 else None


def test_option_rules(spark):
    rnd = random.Random(8)
    bits = ["A", "B", "C", "Z", "(B).", "red", "Blue", "or", "it", "is", "Cannot determine the answer", C.API_FAILURE, "A,", " C"]
    rows = [(" ".join(rnd.choice(bits) for _ in range(rnd.randint(0, 6))), {"A": "red", "B": "blue", "C": rnd.choice(["", "is", "x"])}) for _ in range(800)]
    df = spark.createDataFrame(rows, "a string, o map<string,string>")
    for a, o, got in df.select("a", "o", C.infer_option(F.col("a"), F.col("o"))).collect():
        assert got == (plain_letter(a, o) or plain_text(a, o)), (a, o)


def test_option_worked_examples(spark):
    o = {"A": "red", "B": "blue"}
    cases = {"(B).": "B", "It is A red thing": "A", "blue": "B", "Cannot determine the answer": "Z", "A or B": None}
    df = spark.createDataFrame([(a, o) for a in cases], "a string, o map<string,string>")
    assert {r[0]: r[1] for r in df.select("a", C.infer_option(F.col("a"), F.col("o"))).collect()} == cases


def test_answer_equality(spark):
    cases = [("1/2", "0.5", True), ("12", "12.0", True), ("x", "y", False), (" X ", "x", True), ("\\frac{1}{4}", "0.25", True),
             ("2**3", "8", True), ("__import__('os')", "1", False), ("007", "7", False), ("--3", "3", True), ("1e3", "1000", True),
             ("3.0000001", "3", True), ("nan", "nan ", True), ("\\sqrt{9}", "3", True), ("", "0", False)]
    df = spark.createDataFrame(cases, "a string, b string, want boolean")
    for r in C.with_equality(df, F.col("a"), F.col("b"), "got").collect():
        assert r.got == r.want, r


def test_empty_judge_leaves_the_stand_in(spark):
    q = spark.createDataFrame([("1", "unclear", {"A": "red", "B": "blue"})], "index string, prediction string, options map<string,string>")
    judge = spark.createDataFrame([], "index string, attempt int, text string")
    r = first(Q.extract_options(q, judge, "index"))
    assert r.extraction_method == "random" and r.extracted_answer in "ABZ" and not r.extraction_success


def test_image_references(spark):
    rows = spark.createDataFrame([("1", "x" * 80), ("2", "1"), ("3", "1")], "index string, image string")
    assert {r.image for r in Q.resolve_images(rows).collect()} == {"x" * 80}
    with pytest.raises(Exception, match="image reference"):
        Q.resolve_images(rows.unionByName(spark.createDataFrame([("4", "9")], "index string, image string"))).collect()


def test_box_answers(spark):
    cases = {
        '[{"bbox_2d":[1,2,3],"label":"a"},{"bbox_2d":[1,2,3,4],"label":"b"}]': ["b"], '[{"bbox_2d":[1,2,3,4]}]': [],
        "```json\n[{'bbox_2d': (1, 2, 3, 4), 'label': 'c'}]\n```": ["c"], '[{"bbox_2d":[1,2,3,4],"label":null}]': [],
        '[{"label":"x"},{"bbox_2d":[1.5,2,3,4],"label":"d"}]': ["d"], "nothing": [], "[5]": [], "[]": [],
        '[{"bbox_2d":[1,2,3,4],"label":"e"}] tail': []}
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    assert {r.t: [b.label for b in r.boxes] for r in D.parse_answers(df, "t").collect()} == cases


def plain_iou(d, g):
    iw = min(d["x"] + d["w"], g["x"] + g["w"]) - max(d["x"], g["x"])
    ih = min(d["y"] + d["h"], g["y"] + g["h"]) - max(d["y"], g["y"])
    inter = max(iw, 0) * max(ih, 0)
    return inter / (d["w"] * d["h"] if g["iscrowd"] else d["w"] * d["h"] + g["w"] * g["h"] - inter)


def plain_ap(dets, truth, low, high, threshold, limit):
    """Greedy matching and 101-point precision of one class, written plainly."""
    outside = lambda a: a < low or a > high
    images = sorted({g["image_id"] for g in truth} | {d["image_id"] for d in dets})
    flags = []
    for image in images:
        gts = [dict(g, ignore=bool(g["iscrowd"]) or outside(g["area"]), used=False) for g in truth if g["image_id"] == image]
        gts.sort(key=lambda g: (g["ignore"], g["gt_id"]))
        mine = sorted((d for d in dets if d["image_id"] == image), key=lambda d: d["det_ord"])[:limit]
        for d in mine:
            best, at = threshold, None
            for g in gts:
                if g["used"] and not g["iscrowd"]:
                    continue
                if at is not None and not at["ignore"] and g["ignore"]:
                    break
                value = plain_iou(d, g)
                if value >= best:
                    best, at = value, g
            if at is not None:
                at["used"] = True
                flags.append((True, at["ignore"]))
            else:
                flags.append((False, outside(d["w"] * d["h"])))
    total = sum(1 for g in truth if not g["iscrowd"] and not outside(g["area"]))
    if total == 0:
        return None
    counted = [hit for hit, ignore in flags if not ignore]
    tp = np.cumsum(counted) if counted else np.array([])
    precision, recall = tp / np.arange(1, len(tp) + 1), tp / total
    return float(np.mean([max(precision[recall >= r * 0.01], default=0.0) for r in range(101)]))


@pytest.mark.parametrize("per_image", [6, 120])
def test_detection_against_plain_matching(spark, per_image):
    rnd = random.Random(per_image)
    truth, dets = [], []
    for image in range(6):
        for n in range(per_image):
            w, h = rnd.choice([8, 30, 32, 100, 120]) + rnd.randint(0, 3), rnd.choice([8, 32, 100]) + rnd.randint(0, 3)
            x, y = rnd.randint(0, 150), rnd.randint(0, 150)
            box = {"dataset": "d", "image_id": image, "category_id": 1}
            truth.append({**box, "gt_id": n, "x": float(x), "y": float(y), "w": float(w), "h": float(h), "area": float(w * h),
                          "iscrowd": int(rnd.random() < 0.1)})
            for c in range(rnd.choice([0, 1, 1, 2])):
                dets.append({**box, "det_ord": n * 10 + c, "x": float(x + rnd.randint(-5, 5)), "y": float(y + rnd.randint(-5, 5)),
                             "w": float(w + rnd.randint(-3, 6)), "h": float(h + rnd.randint(-3, 6)), "score": 1.0})
    schema = "dataset string, image_id long, category_id long, {} long, x double, y double, w double, h double, {}"
    tf = spark.createDataFrame(truth, schema.format("gt_id", "area double, iscrowd int"))
    df = spark.createDataFrame(dets, schema.format("det_ord", "score double"))
    ranked = D.ranked_detections(df)
    got_pairs = D.candidate_pairs(ranked, tf).count()
    want_pairs = sum(1 for d in dets for g in truth if d["image_id"] == g["image_id"] and plain_iou(d, g) >= 0.5)
    assert got_pairs == want_pairs
    got = {r.curve: r.ap for r in D.average_precision(D.match(ranked, tf), tf).collect()}
    want = {}
    for k in range(50):
        low, high = list(D.AREAS.values())[(k % 40) // 10]
        ap = plain_ap(dets, truth, low, high, D.THRESHOLDS[k % 10], 100 if k >= 40 else 1000)
        if ap is not None:
            want[k] = ap
    assert got == pytest.approx(want)


def plain_greedy(rows):
    """rows: (rank, gt, iou, crowd, reached, hidden) of one class in one image, all thresholds one by one."""
    out, taken = {}, {}
    for rank in sorted({r[0] for r in rows}):
        mine = sorted((r for r in rows if r[0] == rank), key=lambda r: (r[2], r[1]), reverse=True)
        matched = ignored = 0
        for bit in range(D.COMBINATIONS):
            for counting in (True, False):
                for _, gt, _, crowd, reached, hidden in mine:
                    usable = reached >> bit & 1 and (hidden >> bit & 1) != counting and (crowd or not taken.get((gt, bit)))
                    if usable and not matched >> bit & 1:
                        matched |= 1 << bit
                        ignored |= 0 if counting else 1 << bit
                        taken[gt, bit] = True
        out[rank] = (matched, ignored)
    return out


def test_greedy_matching_of_many_groups():
    rnd = random.Random(2)
    groups = {g: [] for g in range(60)}
    for g, rows in groups.items():
        hidden = {gt: rnd.getrandbits(D.COMBINATIONS) for gt in range(5)}
        crowd = {gt: rnd.random() < 0.2 for gt in range(5)}
        for rank in range(rnd.choice([1, 2, 7])):
            rows += [(rank, gt, rnd.choice([0.5, 0.7, 0.9]), crowd[gt], rnd.getrandbits(D.COMBINATIONS), hidden[gt])
                     for gt in rnd.sample(range(5), rnd.randint(1, 5))]
    flat = [(g, *r) for g, rows in groups.items() for r in rows]
    rnd.shuffle(flat)
    g, rank, gt, iou, crowd, reached, hidden = (np.array(c) for c in zip(*flat))
    first_rows, matched, ignored = D.greedy(g, rank, gt, iou, crowd, reached, hidden)
    got = {}
    for row, m, i in zip(first_rows, matched.tolist(), ignored.tolist()):
        got.setdefault(int(g[row]), {})[int(rank[row])] = (m, i)
    assert got == {k: plain_greedy(rows) for k, rows in groups.items()}


BOX = "dataset string, image_id long, category_id long, {} long, x double, y double, w double, h double, {}"


def test_crowd_over_many_detections(spark):
    """A crowd finds its detections by cells; a far region of the same class costs it nothing."""
    inside = [("d", 1, 1, i, float(i % 100), float(i // 100), 20.0, 20.0, 1.0) for i in range(11_000)]
    far = [("d", 1, 1, 20_000 + i, 5000.0 + i, 9000.0, 20.0, 20.0, 1.0) for i in range(500)]
    dets = spark.createDataFrame(inside + far, BOX.format("det_ord", "score double")).repartition(8)
    truth = spark.createDataFrame([("d", 1, 1, 1, -5.0, -5.0, 300.0, 90.0, 27000.0, 1), ("d", 1, 1, 2, 4990.0, 8990.0, 45.0, 60.0, 2700.0, 1),
                                   ("d", 1, 1, 3, -1e6, 0.0, 0.0, 0.0, 0.0, 1)], BOX.format("gt_id", "area double, iscrowd int"))
    ranked = D.ranked_detections(dets, 20_000)
    got = {(r.rank, r.gt_id) for r in D.candidate_pairs(ranked, truth).collect()}
    want = set()
    for n, d in enumerate(inside + far):
        for gt, x, y, w, h in ((1, -5.0, -5.0, 300.0, 90.0), (2, 4990.0, 8990.0, 45.0, 60.0)):
            iw, ih = min(d[4] + 20, x + w) - max(d[4], x), min(d[5] + 20, y + h) - max(d[5], y)
            if iw > 0 and ih > 0 and iw * ih / 400 >= 0.5:
                want.add((n, gt))
    assert got == want and len(want) > 7000


def test_limit_of_the_ranking_reaches_the_matching(spark):
    """1020 detections at one place and as many boxes: all are matched only if no pair is cut at 1000."""
    n = 1020
    dets = spark.createDataFrame([("d", 1, 1, i, 0.0, 0.0, 50.0, 50.0, 1.0) for i in range(n)], BOX.format("det_ord", "score double"))
    truth = spark.createDataFrame([("d", 1, 1, i, 0.0, 0.0, 50.0, 50.0, 2500.0, 0) for i in range(n)], BOX.format("gt_id", "area double, iscrowd int"))
    assert D.match(D.ranked_detections(dets, n), truth, n).where(F.col("matched") > 0).count() == n


def test_parts_of_curves_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(D, "PART_ROWS", 64)
    rows = spark.range(3000).select(
        F.when(F.col("id") < 2900, "a").otherwise("b").alias("dataset"), F.lit(1).cast("long").alias("category_id"), F.col("id").alias("image_id"),
        F.lit(0).alias("rank"), F.lit(1.0).alias("score"), (F.col("id") % 3).alias("matched"), (F.col("id") % 2).alias("ignored"))
    parts = D.curve_parts(rows).collect()
    assert max(len(p.few) for p in parts) <= 64 and sum(len(p.few) for p in parts) == 3000
    whole = b"".join(p.matched for p in sorted(parts, key=lambda p: p.first_row) if p.dataset == "a")
    assert np.frombuffer(whole, "<i8").tolist() == [i % 3 for i in range(2900)]


def test_dataset_without_predictions_counts(spark):
    truth = spark.createDataFrame([("a", 1, 1, 1, 0.0, 0.0, 200.0, 200.0, 40000.0, 0)],
                                  "dataset string, image_id long, category_id long, gt_id long, x double, y double, w double, h double, area double, iscrowd int")
    dets = spark.createDataFrame([], "dataset string, image_id long, category_id long, det_ord long, x double, y double, w double, h double, score double")
    rows = D.evaluate(dets, truth).collect()
    assert [r.dataset for r in rows] == ["a", "Average"] and rows[0].mAP == 0.0 and rows[0].mAP_s == -1.0


def test_frame_times(spark):
    frames = spark.createDataFrame([(1, 0, "<1.0 seconds>"), (1, 1, "<11.0 seconds>"), (1, 2, "<3.5 seconds>")], "g int, f int, t string")
    answers = spark.createDataFrame([(1, "1.0", 0), (1, "11.0", 1), (1, "5 s", 2), (2, "1", 3)], "g int, time string, o int")
    got = R.match_times(frames, answers, ["g"], "f", "t", "time", "o").collect()
    assert {r.f: r.answer_order for r in got} == {0: 0, 1: 1, 2: 2}


def test_actions_cover_both_tools(spark):
    df = spark.createDataFrame([("computer_use", "left_click", []), ("computer_use", "scroll", []), ("mobile_use", "scroll", ["pixels"])],
                               "t string, a string, n array<string>")
    assert [r[0] for r in df.select(X.action_fault(F.col("t"), F.col("a"), F.col("n"))).collect()] == [
        None, "missing pixels", "Unknown action: scroll"]


def test_numbers_without_end_match_only_themselves(spark):
    cases = [(["5"], "inf", False), (["5"], "nan", False), (["nan"], "NaN ", False), (["-7", "2"], "inf\n2", False), (["Infinity"], "inf", True),
             (["-inf"], "inf", False), (["1e400"], "inf", True), (["nan", "1"], "nan\n1.0", False), (["0.5"], "0.500000001", True)]
    rows = spark.createDataFrame([(i, o, e) for i, (o, e, _) in enumerate(cases)], "i int, o array<string>, e string")
    got = {r.i: r.m for r in rows.select("i", J.output_matches(F.col("o"), F.col("e")).alias("m")).collect()}
    assert got == {i: want for i, (_, _, want) in enumerate(cases)}


def test_tally_and_parsers(spark):
    codes = spark.createDataFrame([("p", c) for c in (1, 1, 0, -1, -2)], "p string, code int")
    r = first(J.tally(codes, "p"))
    assert (r.passed_tests, r.failed_tests, r.error_tests, r.timeout_tests, r.accuracy) == (2, 1, 1, 1, 0.4)
    one = first(spark.range(1).select(A.strip_reasoning(F.lit("<think>x</think>\n B ")).alias("a"),
                                      A.last_code_block(F.lit("none")).alias("c"),
                                      A.without_box_tags(F.lit("a<box>1\n2</box>b<box>3")).alias("b")))
    assert one.a == "B" and one.c is None and one.b == "a<box>1\n2</box>b"


def test_repeated_arithmetic_is_read_once_a_batch(monkeypatch):
    """Sums that repeat in a batch are parsed once, blanks not at all."""
    import pyarrow as pa
    read = []
    plain = L._value
    monkeypatch.setattr(L, "_value", lambda tree: read.append(tree) or plain(tree))
    left = pa.array(["1+1", None, "2+2", "1+1", "x+1", None] * 50, pa.string())
    right = pa.array(["2", "2", "2", "2", "2", None] * 50, pa.string())
    assert L.same_value.func(left, right).to_pylist() == [True, None, False, True, None, None] * 50
    assert len(read) == 4  # 1+1, 2+2, x+1 and 2


def test_value_comparison_is_compiled(spark):
    """Numbers are compared by projections, which Spark compiles, not by functions on arrays."""
    df = spark.range(3).select(F.col("id").cast("string").alias("a"), F.lit("1.0").alias("b"))
    plan = C.with_equality(df, F.col("a"), F.col("b"), "got")._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan


def test_listed_options_read_like_mapped_ones(spark):
    """Letters by position, also beyond Z and beyond the signs at hand."""
    cases = [("B", ["x", "y"]), ("C", ["x", "y"]), ("it is y", ["x", "y"]), ("it is x y", ["x", "y"]), ("", ["x"]), (None, ["x"]),
             ("(A) or so", ["x", "y"]), ("Cannot determine the answer", ["x"]), ("Z", ["x"]), ("Z", [str(i) for i in range(30)]),
             ("Á", [f"<{i}>" for i in range(300)]), ("is <299>", [f"<{i}>" for i in range(300)]), ("say u", ["u", None]), ("x", [])]
    rows = spark.createDataFrame(cases, "answer string, choices array<string>").select(
        C.infer_listed(F.col("answer"), F.col("choices")).alias("listed"),
        F.when(F.size("choices") < 100, C.infer_option(F.col("answer"), F.map_from_arrays(F.transform("choices", lambda c, i: F.chr(i + 65)), "choices"))).alias("mapped"),
        F.array_join(C.list_letters(F.col("choices")), "").alias("letters"), F.size("choices").alias("n")).collect()
    for r in rows:
        assert r.letters == "".join(chr(65 + i) for i in range(r.n))
        if r.n < 100:  # chr() of Spark knows 256 signs
            assert r.listed == r.mapped
    assert [r.listed for r in rows] == ["B", None, "B", None, None, None, "A", "Z", "Z", "Z", "Á", chr(65 + 299), "A", None]


@pytest.mark.parametrize("few", [0, 3, 64])
def test_frame_times_against_plain_search(spark, few):
    """Groups of few and of many time texts, frames without answers, blank texts."""
    rnd = random.Random(few)
    frames = [(g, f, rnd.choice([None, "", f"<{rnd.randint(0, 40)}.0 seconds>"])) for g in range(6) for f in range(30)]
    answers = [(g, rnd.choice([None, "", str(rnd.randint(0, 40)), f"{rnd.randint(0, 9)}.0", "s>"]), rnd.randint(0, 99))
               for g in range(1, 6) for _ in range(2 ** g)]
    got = R.match_times(spark.createDataFrame(frames, "g int, f int, t string"), spark.createDataFrame(answers, "g int, time string, o int"),
                        ["g"], "f", "t", "time", "o", few).collect()
    want = {(g, f): max([o for h, a, o in answers if h == g and a and t is not None and a in t], default=None) for g, f, t in frames}
    assert len(got) == len(frames) and {(r.g, r.f): r.answer_order for r in got} == want


def test_overlap_is_evaluated_once(spark):
    """The sides of the common area occur once in the expression, so that a join's condition stays small."""
    sides = [F.col(f"{s}{c}") for s in "dg" for c in "xywh"]
    rows = spark.createDataFrame([(0.0, 0.0, 2.0, 2.0, 1.0, 0.0, 2.0, 2.0)], ", ".join(f"{s}{c} double" for s in "dg" for c in "xywh"))
    shown = rows.select(D.overlap(*sides, F.lit(False)).alias("iou"))
    assert first(shown).iou == 2.0 / 6.0
    assert rows.select(D.overlap(*sides, F.col("dx") > 1).alias("iou"))._jdf.queryExecution().optimizedPlan().toString().count("least(") <= 4
    assert D.BY_GROUP[0] == "image_id" and sorted(D.BY_GROUP) == sorted(D.GROUP)
