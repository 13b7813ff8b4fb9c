"""Object detection: questions, answers, matching and average precision.

Tables: truth(dataset, image_id, category_id, gt_id, x, y, w, h, area, iscrowd),
detections(dataset, image_id, category_id, det_ord, x, y, w, h, score),
classes(dataset, class_index, name, category_id).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import literals as L
from ..functions.json import kind, strict_json
from ..functions.text import let
from ..sources.stored import stored
from .ordinal import with_global_ordinal

# --- Fixed values of the evaluation -------------------------------------------------

PIXELS_PER_TOKEN = 32 * 32
QUESTION_MIN_PIXELS = 768 * PIXELS_PER_TOKEN
QUESTION_MAX_PIXELS = 12800 * PIXELS_PER_TOKEN
QUESTION_MAX_SIDE = 50000
THRESHOLDS = [float(v) for v in np.linspace(0.5, 0.95, 10)]
SMALL, LARGE = 32.0 ** 2, 96.0 ** 2
AREAS = {"all": (0.0, 1e10), "small": (0.0, SMALL), "medium": (SMALL, LARGE), "large": (LARGE, 1e10)}
MAX_DETECTIONS = 1000
MEAN_DETECTIONS = 100  # the mean over all thresholds looks at these only
RECALL_STEPS = 100

# ---------------------------------------------------------------------------------------

IMAGE = ["dataset", "image_id"]
GROUP = ["dataset", "image_id", "category_id"]
# The same keys where rows are sorted: comparing starts with the key that tells most rows apart.
BY_GROUP = ["image_id", "category_id", "dataset"]
COMBINATIONS = len(AREAS) * len(THRESHOLDS)  # bit a * 10 + t of the masks below


def questions(images: DataFrame, classes: DataFrame) -> DataFrame:
    """One prompt per dataset and image, numbered from 0 in that order."""
    named = classes.groupBy("dataset").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("class_index", "name"))), lambda c: c["name"]), ", ").alias("_names"))
    plan = G.resize_plan_detection(F.col("height"), F.col("width"), 32, QUESTION_MIN_PIXELS,
                                   QUESTION_MAX_PIXELS, QUESTION_MAX_SIDE)
    prompt = F.concat(F.lit("Locate every instance that belongs to the following categories: '"), "_names",
                      F.lit("'. Report bbox coordinates in JSON format."))
    placed = with_global_ordinal(images, [F.col("dataset"), F.col("image_id")], "_place")
    return placed.join(named, "dataset").select(
        (F.col("_place") - 1).alias("question_id"), "dataset", "image_id", "height", "width",
        plan["height"].alias("resized_height"), plan["width"].alias("resized_width"), prompt.alias("prompt"))


def parse_answers(answers: DataFrame, text: str, out: str = "boxes") -> DataFrame:
    """Adds the labelled boxes of each answer.

    Answers that are JSON as well as a Python literal are read natively; all
    others, with their faults, by the Arrow helper.
    """
    bare = F.replace(F.replace(F.col(text), F.lit("```json"), F.lit("")), F.lit("```"), F.lit(""))

    def native(items: Column) -> Column:
        box = lambda e: F.try_variant_get(e, "$.bbox_2d", "variant")
        label = lambda e: F.try_variant_get(e, "$.label", "variant")
        numbers = lambda e: F.try_variant_get(e, "$.bbox_2d", "array<double>")
        plain = F.forall(items, lambda e: (kind(e) == "OBJECT") & (kind(box(e)) == "ARRAY")
                         & (F.schema_of_variant(label(e)) == "STRING") & F.schema_of_variant(box(e)).rlike(
                             r"^ARRAY<(BIGINT|DOUBLE|DECIMAL\(\d+,\d+\)|VOID)>$"))
        read = F.transform(items, lambda e: F.struct(
            numbers(e).alias("bbox"), F.try_variant_get(e, "$.label", "string").alias("label")))
        return F.when(plain, F.filter(read, lambda e: F.size(e["bbox"]) == 4))

    items = F.when(~bare.contains("\\"), F.try_variant_get(strict_json(bare), "$", "array<variant>"))
    first = answers.withColumn("_native", let(items, native))
    rest = F.when(F.col("_native").isNull(), F.btrim(bare, F.lit(" \t")))
    return first.withColumn("_literal", L.boxes_from_literal(rest)).withColumn(
        out, F.coalesce("_native", "_literal")).drop("_native", "_literal")


def detections(parsed: DataFrame, classes: DataFrame, relative: bool = False) -> DataFrame:
    """Detection rows of parsed answers in image pixels, unknown labels dropped.

    Columns needed: dataset, image_id, boxes, resized_height/width,
    height/width. The order is by first appearance of the raw label, then by
    place in the answer.
    """
    labelled = let(F.col("boxes"), lambda boxes: let(F.transform(boxes, lambda b: b["label"]), lambda names: F.transform(
        boxes, lambda b, i: F.struct(
            F.array_position(names, b["label"]).cast("int").alias("first"), i.alias("place"),
            b["label"].alias("label"), b["bbox"].alias("bbox")))))
    rows = parsed.select(*IMAGE, "height", "width", "resized_height", "resized_width",
                         F.explode(labelled).alias("d"))
    known = classes.groupBy("dataset", F.lower("name").alias("_key")).agg(
        F.min_by("category_id", "class_index").alias("category_id"), F.min("class_index").alias("class_index"))
    joined = rows.withColumn("_key", F.lower("d.label")).join(known, ["dataset", "_key"])

    def pixels(i: int, size: str) -> Column:
        value = F.col("d.bbox")[i]
        if relative:
            return G.from_relative(value, F.col(size))
        return value / F.col(f"resized_{size}") * F.col(size)

    x1, y1, x2, y2 = pixels(0, "width"), pixels(1, "height"), pixels(2, "width"), pixels(3, "height")
    return joined.select(
        *IMAGE, "category_id", "class_index", (F.col("d.first").cast("bigint") * 2**31 + F.col("d.place")).alias("det_ord"),
        x1.alias("x"), y1.alias("y"), (x2 - x1).alias("w"), (y2 - y1).alias("h"), F.lit(1.0).alias("score"))


def ranked_detections(dets: DataFrame, limit: int = MAX_DETECTIONS) -> DataFrame:
    """The best ``limit`` detections per image and class with their rank from 0."""
    order = Window.partitionBy(*BY_GROUP).orderBy(F.col("score").desc(), F.col("det_ord"))
    return dets.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= limit).withColumn(
        "rank", F.col("rank") - 1)


def overlap(ax: Column, ay: Column, aw: Column, ah: Column, bx: Column, by: Column, bw: Column, bh: Column,
            crowd: Column) -> Column:
    """Intersection over union; for crowd truth over the detection's own area.

    Its parts are evaluated once. Repeated in a join's condition they make a
    method too large for the JVM to compile, and the whole join with it.
    """
    iw = F.least(ax + aw, bx + bw) - F.greatest(ax, bx)
    ih = F.least(ay + ah, by + bh) - F.greatest(ay, by)
    inter = F.when((iw > 0) & (ih > 0), iw * ih).otherwise(0.0)
    own = aw * ah
    union = lambda i: F.when(crowd, own).otherwise(own + bw * bh - i)
    return let(inter, lambda i: let(union(i), lambda u: F.when(u > 0, i / u).otherwise(0.0)))


def _level(width: Column) -> Column:
    """The power of four of a width."""
    return F.floor(F.log2(width) / 2 + 1e-9).cast("int")


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level)).cast("bigint")


def _crowd_pairs(det: DataFrame, crowds: DataFrame) -> DataFrame:
    """Detections and the crowd regions that may cover half of them.

    Half covered along both sides, a detection has its centre in the region. A
    region is covered by at most four cells whose sides are the next powers of
    two; a detection looks up its own cell in each of the sizes in use.
    """
    up = lambda side: F.greatest(F.ceil(F.log2(F.greatest(side, F.lit(1e-9))) - 1e-9), F.lit(-30)).cast("int")
    sized = crowds.withColumns({"_lx": up(F.col("gw")), "_ly": up(F.col("gh"))})
    spans = [F.sequence(_cell(F.col(f"g{c}") - 1e-9, F.col(f"_l{c}")), _cell(F.col(f"g{c}") + F.col(f"g{d}") + 1e-9, F.col(f"_l{c}")))
             for c, d in (("x", "w"), ("y", "h"))]
    cover = sized.withColumn("_cx", F.explode(spans[0])).withColumn("_cy", F.explode(spans[1]))
    sizes = sized.select(*GROUP, "_lx", "_ly").distinct()
    looked = det.join(sizes, BY_GROUP).withColumns({
        "_cx": _cell(F.col("dx") + F.col("dw") / 2, F.col("_lx")), "_cy": _cell(F.col("dy") + F.col("dh") / 2, F.col("_ly"))})
    return looked.join(cover, [*BY_GROUP, "_lx", "_ly", "_cx", "_cy"]).select(*det.columns, *crowds.columns[len(GROUP):])


def candidate_pairs(ranked: DataFrame, truth: DataFrame) -> DataFrame:
    """Detection and truth pairs of one image and class that overlap by half.

    Half overlap bounds both the ratio of the widths (2) and the shift (half the
    wider one), so truth is keyed by the power of four of its width and a cell
    16 times that size, and a detection looks into the few cells it can reach.
    Crowd regions know no such bound and have cells of their own.
    """
    det = ranked.where((F.col("w") > 0) & (F.col("h") > 0)).select(*GROUP, "rank", *[F.col(c).alias(f"d{c}") for c in "xywh"])
    gt = truth.select(*GROUP, "gt_id", "area", F.col("iscrowd").cast("boolean").alias("crowd"),
                      *[F.col(c).alias(f"g{c}") for c in "xywh"])
    half = overlap(*[F.col(f"d{c}") for c in "xywh"], *[F.col(f"g{c}") for c in "xywh"], F.col("crowd"))
    size = lambda level: F.pow(F.lit(4.0), level + 2)

    # shifted by half a cell, so that boxes at an image's edge are not at a cell's
    cell = lambda x, level: F.floor(x / size(level) + 0.5).cast("bigint")

    # Levels, then cells: each a plain sequence, which Spark compiles.
    levelled = det.withColumn("level", F.explode(F.sequence(_level(F.col("dw") * 0.49), _level(F.col("dw") * 2.05))))
    shift = F.greatest(size(F.col("level")) / 4, F.col("dw")) * 0.51
    keyed_det = levelled.withColumn("_shift", shift).withColumn("cell", F.explode(F.sequence(
        cell(F.col("dx") - F.col("_shift"), F.col("level")), cell(F.col("dx") + F.col("_shift"), F.col("level"))))).drop("_shift")
    keyed_gt = gt.where(~F.col("crowd") & (F.col("gw") > 0) & (F.col("gh") > 0)).withColumn("level", _level(F.col("gw"))).withColumn(
        "cell", cell(F.col("gx"), F.col("level")))
    # neither side is small; estimates of exploded rows are too low to be left to decide
    plain = keyed_det.hint("merge").join(keyed_gt, [*BY_GROUP, "level", "cell"])
    shown = [*GROUP, "rank", "gt_id", "area", "crowd", half.alias("iou")]
    return plain.select(*shown).unionByName(_crowd_pairs(det, gt.where("crowd")).select(*shown)).where(F.col("iou") >= THRESHOLDS[0])


def bounded_pairs(pairs: DataFrame, limit: int = MAX_DETECTIONS) -> DataFrame:
    """Pairs a greedy matching can use, at most ``limit`` per detection and size band.

    ``limit`` detections are ranked, so at most ``limit`` - 1 others can take
    truth from one; a truth box that ``limit`` better ones of its own size band
    precede is never reached. Of crowds, which are never used up, the best alone counts.
    """
    band = (F.when(F.col("crowd"), 5).when(F.col("area") < SMALL, 0).when(F.col("area") == SMALL, 1).when(F.col("area") < LARGE, 2)
            .when(F.col("area") == LARGE, 3).otherwise(4))
    order = Window.partitionBy(*BY_GROUP, "rank", "_band").orderBy(F.col("iou").desc(), F.col("gt_id").desc())
    return pairs.withColumn("_band", band).withColumn("_n", F.row_number().over(order)).where(
        F.col("_n") <= F.when(F.col("crowd"), 1).otherwise(limit)).drop("_n", "_band")


def _bits(n: int) -> int:
    return (1 << n) - 1


IN_RANGE = list(AREAS.values())
STEP = len(THRESHOLDS)


def _area_bits(inside: Callable[[float, float], Column]) -> Column:
    """All thresholds of the area ranges for which ``inside(low, high)`` does not hold."""
    out = F.lit(0).cast("bigint")
    for a, (low, high) in enumerate(IN_RANGE):
        out = out.bitwiseOR(F.when(inside(low, high), 0).otherwise(_bits(STEP) << (a * STEP)).cast("bigint"))
    return out


def with_bits(pairs: DataFrame) -> DataFrame:
    """Adds ``reached`` (thresholds that the overlap reaches, for every area range) and ``hidden`` (ranges in which the truth does not count)."""
    steps = F.lit(0)
    for t in THRESHOLDS:
        steps = steps + (F.col("iou") >= t).cast("int")
    ones = F.get(F.array(*[F.lit(sum(_bits(n) << (a * STEP) for a in range(len(IN_RANGE)))).cast("bigint") for n in range(STEP + 1)]), steps)
    hidden = _area_bits(lambda low, high: ~F.col("crowd") & F.col("area").between(low, high))
    return pairs.withColumn("reached", ones).withColumn("hidden", hidden)


def greedy(group: np.ndarray, rank: np.ndarray, gt: np.ndarray, iou: np.ndarray, crowd: np.ndarray, reached: np.ndarray,
           hidden: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First row, matched bits and ignored bits of each detection of many groups.

    Detections go in rank order; each takes the free counting box with the
    largest overlap (the later one on a tie), or else an ignored one. Crowds are
    never used up. All groups go side by side: a step handles one choice of the
    n-th detection of every group that has one, as arrays.
    """
    order = np.lexsort((-gt, -iou, rank, group))
    group, rank = group[order], rank[order]
    new_det = np.ones(len(order), bool)
    new_det[1:] = (group[1:] != group[:-1]) | (rank[1:] != rank[:-1])
    first = np.flatnonzero(new_det)
    det = np.cumsum(new_det) - 1
    choice = np.arange(len(order)) - first[det]
    new_group = np.ones(len(first), bool)
    new_group[1:] = group[first[1:]] != group[first[:-1]]
    turn = np.arange(len(first)) - np.flatnonzero(new_group)[np.cumsum(new_group) - 1]
    box = np.unique(np.stack([group, gt[order]]), axis=1, return_inverse=True)[1].ravel()
    crowd, reached, hidden = crowd[order], reached[order], hidden[order]
    taken = np.zeros(len(order), np.int64)
    matched, ignored = np.zeros((2, len(first)), np.int64)
    # rows by turn, then choice; a step is a run of equal turn and choice
    steps = np.lexsort((choice, turn[det]))
    key = turn[det[steps]] * (int(choice.max(initial=0)) + 1) + choice[steps]
    bounds = np.append(np.flatnonzero(np.diff(key, prepend=-1)), len(key)).tolist()
    turns = turn[det[steps]]
    at = 0
    while at < len(bounds) - 1:
        until = at
        while until < len(bounds) - 1 and turns[bounds[until]] == turns[bounds[at]]:
            until += 1
        for counting in (True, False):
            for low, high in zip(bounds[at:until], bounds[at + 1 : until + 1]):
                rows = steps[low:high]
                who, what = det[rows], box[rows]
                usable = reached[rows] & (~hidden[rows] if counting else hidden[rows]) & ~matched[who]
                plain = ~crowd[rows]
                usable[plain] &= ~taken[what[plain]]
                taken[what[plain]] |= usable[plain]
                matched[who] |= usable
                if not counting:
                    ignored[who] |= usable
        at = until
    return order[first], matched, ignored


MATCHES = "dataset string, image_id bigint, category_id bigint, rank int, matched bigint, ignored bigint"
CONTEST = [*GROUP, "rank", "gt_id", "iou", "crowd", "reached", "hidden"]


def _match_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Matches rows sorted by group; the last group of a batch waits for the next one."""

    def numbered(table: pa.Table) -> np.ndarray:
        changed = np.zeros(table.num_rows, bool)
        for name in GROUP:
            values = table[name].combine_chunks()
            codes = values.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
            changed[1:] |= codes[1:] != codes[:-1]
        return np.cumsum(changed)

    def matches(table: pa.Table, group: np.ndarray) -> pa.RecordBatch:
        values = [table[c].to_numpy() for c in CONTEST[len(GROUP):]]
        rows, matched, ignored = greedy(group, *values)
        shown = table.select([*GROUP, "rank"]).take(pa.array(rows))
        shown = shown.append_column("matched", pa.array(matched)).append_column("ignored", pa.array(ignored))
        return shown.combine_chunks().to_batches()[0]

    def key(table: pa.Table, row: int) -> list:
        return [table[name][row].as_py() for name in GROUP]

    held: list[pa.Table] = []  # rows of one group, of which more may come
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        group = numbered(table)
        if held and group[-1] == 0 and key(held[-1], -1) == key(table, 0):
            held.append(table)
            continue
        whole = pa.concat_tables([*held, table])
        group = numbered(whole)
        done = int(np.searchsorted(group, group[-1]))
        if done:
            yield matches(whole.slice(0, done), group[:done])
        held = [whole.slice(done)]
    if held:
        whole = pa.concat_tables(held)
        yield matches(whole, numbered(whole))


def match(ranked: DataFrame, truth: DataFrame, limit: int = MAX_DETECTIONS) -> DataFrame:
    """Detections with the bit masks ``matched`` and ``ignored``; ``limit`` is that of the ranking.

    Detections without a match are ignored where their own size is out of range.
    """
    pairs = with_bits(bounded_pairs(candidate_pairs(ranked, truth), limit))
    found = pairs.select(*CONTEST).repartition(*BY_GROUP).sortWithinPartitions(*BY_GROUP).mapInArrow(_match_stream, MATCHES)
    area = F.col("w") * F.col("h")
    outside = _area_bits(lambda low, high: area.between(low, high))
    none = F.lit(0).cast("bigint")
    joined = ranked.join(found, [*BY_GROUP, "rank"], "left").withColumn("matched", F.coalesce("matched", none))
    return joined.withColumn("ignored", F.coalesce("ignored", none).bitwiseOR(
        outside.bitwiseAND(F.bitwise_not("matched"))))


def counted_truth(truth: DataFrame) -> DataFrame:
    """Counting truth boxes per dataset and class, one column per area range."""
    plain = ~F.col("iscrowd").cast("boolean")
    return truth.groupBy("dataset", "category_id").agg(*[
        F.count_if(plain & F.col("area").between(low, high)).alias(f"n_{name}")
        for name, (low, high) in AREAS.items()])


def curve_totals(truth: DataFrame) -> DataFrame:
    """(dataset, category_id, curve, total) for every curve that has truth."""
    names = list(AREAS)
    per_curve = F.array(*[
        F.struct(F.lit(k).alias("curve"), F.col(f"n_{names[(k % COMBINATIONS) // STEP]}").alias("total"))
        for k in range(COMBINATIONS + STEP)])
    return counted_truth(truth).select("dataset", "category_id", F.inline(per_curve)).where(F.col("total") > 0)


CURVES = COMBINATIONS + STEP
PART_ROWS = 8192
PARTS = ("dataset string, category_id bigint, first_row bigint, matched binary, ignored binary, few binary, "
         "tp array<bigint>, seen array<bigint>")
PART_SCHEMA = pa.schema([
    ("dataset", pa.string()), ("category_id", pa.int64()), ("first_row", pa.int64()), ("matched", pa.binary()), ("ignored", pa.binary()),
    ("few", pa.binary()), ("tp", pa.list_(pa.int64())), ("seen", pa.list_(pa.int64()))])


def _curve_bits(matched: bytes, ignored: bytes, few: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hits and counted entries, a row per detection and a column per curve."""
    spread = lambda raw: np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1, bitorder="little")[:, :COMBINATIONS]
    counted, hit = 1 - spread(ignored), spread(matched)
    best = np.frombuffer(few, np.uint8)[:, None]
    counted = np.concatenate([counted, counted[:, :STEP] & best], axis=1)
    return counted & np.concatenate([hit, hit[:, :STEP]], axis=1), counted


def _curve_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of the curves as parts of at most PART_ROWS of one class, with the sums of each curve."""
    for batch in batches:
        names = [batch.column(i).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) for i in (0, 1)]
        rank, matched, ignored, row = (batch.column(c).to_numpy() for c in ("rank", "matched", "ignored", "row"))
        changed = np.flatnonzero(np.diff(names[0]) | np.diff(names[1])) + 1
        edges = np.unique(np.concatenate([np.arange(0, len(row), PART_ROWS), changed, [len(row)]])).astype(int)
        out = []
        for low, high in zip(edges, edges[1:]):
            packed = (matched[low:high].astype("<i8").tobytes(), ignored[low:high].astype("<i8").tobytes(),
                      (rank[low:high] < MEAN_DETECTIONS).astype(np.uint8).tobytes())
            hit, counted = _curve_bits(*packed)
            out.append((batch.column(0)[low].as_py(), batch.column(1)[low].as_py(), int(row[low]), *packed,
                        hit.sum(axis=0, dtype=np.int64), counted.sum(axis=0, dtype=np.int64)))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), PART_SCHEMA)], schema=PART_SCHEMA)


def _best_steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Best precision of each recall step among the hits of each part, for all curves."""
    for batch in batches:
        found: list[list] = [[], [], [], [], []]
        for part in batch.to_pylist():
            hit, counted = _curve_bits(part["matched"], part["ignored"], part["few"])
            before = [np.array([b[c] for b in part["before"]], np.int64) for c in ("tp", "seen")]
            total = np.array(part["totals"], np.int64)
            rows, curves = np.nonzero(hit & (total > 0))
            taken = (before[0] + np.cumsum(hit, axis=0, dtype=np.int64))[rows, curves]
            seen = (before[1] + np.cumsum(counted, axis=0, dtype=np.int64))[rows, curves]
            recall = taken / total[curves]
            near = np.floor(recall * RECALL_STEPS)
            step = np.where((near + 1) * 0.01 <= recall, near + 1, np.where(near * 0.01 > recall, near - 1, near)).astype(int)
            best = np.zeros((CURVES, RECALL_STEPS + 1))
            np.maximum.at(best, (curves, step), taken / seen)
            c, s = np.nonzero(best)
            for column, values in zip(found, ([part["dataset"]] * len(c), [part["category_id"]] * len(c), c.tolist(), s.tolist(), best[c, s].tolist())):
                column += values
        types = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, types)], ["dataset", "category_id", "curve", "step", "p"])


def curve_parts(matched: DataFrame) -> DataFrame:
    """All detections in the order of the curves, cut into parts of bounded size that are written once.

    The order is by class, falling score, image and rank; ranges of it go to
    sorted tasks, which pack the rows they pass. ``first_row`` grows along the order.
    """
    order = [F.col("dataset"), F.col("category_id"), F.col("score").desc(), F.col("image_id"), F.col("rank")]
    narrow = matched.select("dataset", "category_id", "image_id", "rank", "score", "matched", "ignored")
    placed = narrow.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("row", F.monotonically_increasing_id())
    return stored(placed.select("dataset", "category_id", "rank", "matched", "ignored", "row").mapInArrow(_curve_parts, PARTS), "curve-parts")


def average_precision(matched: DataFrame, truth: DataFrame) -> DataFrame:
    """(dataset, category_id, curve, ap) for every class and curve with truth.

    Curves 0-39 are area * 10 + threshold; 40-49 repeat the first ten over the
    best 100 detections per image. Sums of the parts, running along each curve,
    place the parts; then each part gives the best precision of each recall step
    it reaches. Misses only lower the precision, so hits alone become points.
    """
    keys, part = ["dataset", "category_id", "curve"], ["dataset", "category_id", "first_row"]
    parts = curve_parts(matched)
    before = Window.partitionBy(*keys).orderBy("first_row").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.select(*part, F.posexplode(F.arrays_zip("tp", "seen")).alias("curve", "sums")).select(*part, "curve", *[
        F.coalesce(F.sum(f"sums.{n}").over(before), F.lit(0)).alias(n) for n in ("tp", "seen")])
    placed = sums.groupBy(*part).agg(F.transform(
        F.array_sort(F.collect_list(F.struct("curve", "tp", "seen"))), lambda b: F.struct(b["tp"].alias("tp"), b["seen"].alias("seen"))).alias("before"))
    counts = counted_truth(truth).select("dataset", "category_id", F.array(*[
        F.col(f"n_{list(AREAS)[(k % COMBINATIONS) // STEP]}") for k in range(CURVES)]).alias("totals"))
    joined = parts.drop("tp", "seen").join(placed, part).join(counts, ["dataset", "category_id"])
    best = joined.mapInArrow(_best_steps, "dataset string, category_id bigint, curve int, step int, p double").groupBy(
        *keys, "step").agg(F.max("p").alias("p"))
    curve = Window.partitionBy(*keys)
    covered = F.col("step") - F.coalesce(F.lag("step").over(curve.orderBy("step")), F.lit(-1))
    weighted = best.select(*keys, (F.max("p").over(curve.orderBy(F.col("step").desc())) * covered).alias("part"))
    ap = weighted.groupBy(*keys).agg((F.sum("part") / (RECALL_STEPS + 1)).alias("ap"))
    return curve_totals(truth).join(ap, keys, "left").select(*keys, F.coalesce("ap", F.lit(0.0)).alias("ap"))


METRICS = ("mAP", "mAP_50", "mAP_75", "mAP_s", "mAP_m", "mAP_l")


def metrics(ap: DataFrame) -> DataFrame:
    """Six figures per dataset, rounded to three places; -1 without any truth."""
    k = F.col("curve")
    chosen = {
        "mAP": k >= COMBINATIONS, "mAP_50": k == 0, "mAP_75": k == 5,
        "mAP_s": k.between(10, 19), "mAP_m": k.between(20, 29), "mAP_l": k.between(30, 39)}
    rounded = lambda v: F.rint(v * 1000) / 1000
    return ap.groupBy("dataset").agg(*[
        F.coalesce(rounded(F.avg(F.when(where, F.col("ap")))), F.lit(-1.0)).alias(name) for name, where in chosen.items()])


def metric_table(per_dataset: DataFrame) -> DataFrame:
    """Datasets by name, then ``Average``: the mean of the rounded figures."""
    average = per_dataset.agg(*[F.avg(m).alias(m) for m in METRICS]).select(F.lit("Average").alias("dataset"), *METRICS)
    both = per_dataset.select(F.lit(0).alias("_last"), "dataset", *METRICS).unionByName(
        average.select(F.lit(1).alias("_last"), "dataset", *METRICS))
    return both.orderBy("_last", "dataset").drop("_last")


def evaluate(dets: DataFrame, truth: DataFrame, limit: int = MAX_DETECTIONS) -> DataFrame:
    """Metric table of raw detections."""
    matched = match(ranked_detections(dets, limit), truth, limit)
    return metric_table(metrics(average_precision(matched, truth)))
