import math
import random

import pytest
from pyspark.sql import functions as F

from glyphlane.functions import geometry as G

from .conftest import first


def plain_resize(h, w, f, lo, hi, at_least):
    if max(h, w) / min(h, w) > 200:
        return None
    rh, rw = round(h / f) * f, round(w / f) * f
    if at_least:
        rh, rw = max(f, rh), max(f, rw)
    if rh * rw > hi:
        b = math.sqrt(h * w / hi)
        rh, rw = math.floor(h / b / f) * f, math.floor(w / b / f) * f
    elif rh * rw < lo:
        b = math.sqrt(lo / (h * w))
        rh, rw = math.ceil(h * b / f) * f, math.ceil(w * b / f) * f
    return rh, rw


def test_resize_matches_plain_formula(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(1, 6000), rnd.randint(1, 6000)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "h int, w int")
    for f, lo, hi in ((28, 4 * 784, 16384 * 784), (32, 256 * 1024, 1280 * 1024)):
        for h, w, p in df.select("h", "w", G.resize_plan("h", "w", f, lo, hi)).collect():
            want = plain_resize(h, w, f, lo, hi, True)
            assert (p["error"] is not None) == (want is None)
            if want:
                assert (p["height"], p["width"]) == want, (h, w)


@pytest.mark.parametrize("h,w,f,lo,hi,want", [
    (1080, 1920, 32, 4, 16384, (1088, 1920)), (1080, 1920, 28, 16, 576, (504, 896)),
    (10, 15, 28, 4, 16384, (56, 84)), (70, 70, 28, 4, 16384, (56, 56)), (5000, 4000, 28, 4, 1280, (1120, 896))])
def test_resize_worked_examples(spark, h, w, f, lo, hi, want):
    p = first(spark.range(1).select(G.resize_plan(F.lit(h), F.lit(w), f, lo * f * f, hi * f * f).alias("p"))).p
    assert (p["height"], p["width"]) == want


def test_resize_errors(spark):
    p = first(spark.range(1).select(
        G.resize_plan(F.lit(201), F.lit(1), 28).alias("ratio"),
        G.resize_plan_training(F.lit(20), F.lit(400)).alias("small"),
        G.resize_plan_detection(F.lit(1), F.lit(40)).alias("tiny")))
    assert p.ratio["error"] and p.small["error"] and p.tiny["error"]


def test_frame_counts(spark):
    cases = [(300, 30.0, None, 20), (30, 30.0, None, 4), (100000, 25.0, None, 768), (7, 30.0, None, 4),
             (100, 30.0, 3, 4), (100, 30.0, 5, 4), (100, 30.0, 7, 8), (100, 30.0, 9, 8)]
    df = spark.createDataFrame(cases, "t int, fps double, n int, want int")
    for r in df.select("want", G.frame_count(F.col("t"), F.col("fps"), nframes=F.col("n")).alias("c")).collect():
        assert r.c["nframes"] == r.want


def test_frame_ranges_and_indices(spark):
    r = first(spark.range(1).select(
        G.frame_range(F.lit(300), F.lit(30.0), F.lit(2.5), F.lit(7.0)).alias("a"),
        G.frame_range(F.lit(300), F.lit(30.0), None, F.lit(99.0)).alias("b"),
        G.frame_range(F.lit(300), F.lit(30.0), F.lit(9.0), F.lit(3.0)).alias("c"),
        G.frame_indices_rounded(F.lit(0), F.lit(299), F.lit(8)).alias("r"),
        G.frame_indices_truncated(F.lit(0), F.lit(299), F.lit(8)).alias("t")))
    assert tuple(r.a)[:3] == (75, 210, 136) and tuple(r.b)[:3] == (0, 299, 300) and r.c["error"]
    assert r.r == [0, 43, 85, 128, 171, 214, 256, 299]
    assert r.t == [0, 42, 85, 128, 170, 213, 256, 299]


def test_boxes_points_camera(spark):
    box = [146, 137, 615, 415]
    sizes = [640, 428, 640, 428]
    plan = G.resize_plan_training(F.lit(428), F.lit(640))
    r = first(spark.range(1).select(
        F.array(*[G.to_relative(F.lit(b), F.lit(s)) for b, s in zip(box, sizes)]).alias("rel"),
        F.array(*[G.to_resized(F.lit(b), F.lit(s), plan["width"] if s == 640 else plan["height"])
                  for b, s in zip(box, sizes)]).alias("px"),
        F.array(G.click_position(F.lit(500), F.lit(1080)), G.click_position(F.lit(250), F.lit(2400))).alias("click"),
        G.pseudo_camera(F.lit(1280), F.lit(720)).alias("cam")))
    assert r.rel == [228, 320, 961, 970] and r.px == [147, 134, 619, 407] and r.click == [541, 601]
    assert tuple(r.cam) == (1108.51, 623.54, 640.0, 360.0)


def test_box_projection(spark):
    rnd = random.Random(5)
    rows = [([rnd.uniform(-2, 2), rnd.uniform(-2, 2), rnd.uniform(0.2, 5)] + [rnd.uniform(0.1, 2) for _ in range(3)]
             + [rnd.uniform(-180, 180) for _ in range(3)],) for _ in range(50)]
    cam = G.pseudo_camera(F.lit(640), F.lit(480), fx=F.lit(500.0), fy=F.lit(510.0))
    for r in spark.createDataFrame(rows, "b array<double>").select("b", G.project_box3d(F.col("b"), cam).alias("p")).collect():
        x, y, z, sx, sy, sz, a, b, c = r.b
        a, b, c = map(math.radians, (a, b, c))
        want = []
        for i in range(8):
            p = [s / 2 * (1 if not i >> n & 1 else -1) for s, n in ((sx, 2), (sy, 1), (sz, 0))]
            p = [p[0], p[1] * math.cos(a) - p[2] * math.sin(a), p[1] * math.sin(a) + p[2] * math.cos(a)]
            p = [p[0] * math.cos(b) + p[2] * math.sin(b), p[1], -p[0] * math.sin(b) + p[2] * math.cos(b)]
            p = [p[0] * math.cos(c) - p[1] * math.sin(c) + x, p[0] * math.sin(c) + p[1] * math.cos(c) + y, p[2] + z]
            if p[2] > 0:
                want += [500 * p[0] / p[2] + 320, 510 * p[1] / p[2] + 240]
        assert [v for q in r.p for v in q] == pytest.approx(want)


def test_projection_turns_a_box_once(spark):
    """The sines of a box's angles are taken once, not for each of its corners."""
    cam = G.pseudo_camera(F.lit(640), F.lit(480))
    rows = spark.createDataFrame([([0.0, 0.0, 5.0, 1.0, 1.0, 1.0, 10.0, 20.0, 30.0],)], "b array<double>")
    plan = rows.select(G.project_box3d(F.col("b"), cam).alias("p"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.upper().count("SIN(") <= 3 and plan.upper().count("COS(") <= 3
