"""Detection questions and answers over parts, matching over line items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import detection as D
from .check_sql import resize_sql
from .registry import Tables, query
from .views import MEDIA_SQL, media

NAMES = ("cat", "Dog", "bird", "DOG")


def classes(t: Tables) -> DataFrame:
    """Every dataset (0 to 2) knows the names above; the last repeats one."""
    name = F.posexplode(F.array(*[F.lit(n) for n in NAMES])).alias("class_index", "name")
    sets = t.part.select(F.concat(F.lit("d"), (F.col("p_partkey") % 3).cast("string")).alias("dataset")).distinct()
    return sets.select("dataset", name).withColumn("category_id", (F.col("class_index") * 10 + 1).cast("bigint"))


def images(t: Tables) -> DataFrame:
    k = F.col("media_id")
    return media(t).select(F.concat(F.lit("d"), (k % 3).cast("string")).alias("dataset"), k.alias("image_id"), "height", "width")


@query("detection_questions", "I1 F4", f"""
WITH {MEDIA_SQL}, {resize_sql('media', 'r', 32, '768*1024', '12800*1024', False)}
SELECT row_number() OVER (ORDER BY media_id % 3, media_id) - 1 AS question_id, 'd' || media_id % 3 AS dataset, media_id AS image_id, height, width,
  new_height AS resized_height, new_width AS resized_width,
  'Locate every instance that belongs to the following categories: ''cat, Dog, bird, DOG''. Report bbox coordinates in JSON format.' AS prompt
FROM r""")
def detection_questions(t: Tables) -> DataFrame:
    return D.questions(images(t), classes(t))


def _answers(t: Tables) -> DataFrame:
    """Zero to five boxes per image, fenced or bare, JSON or Python text, some broken."""
    k = F.col("image_id")

    def box(i):
        coords = F.concat_ws(", ", *[((k * a + i * b) % 900 + c).cast("string") for a, b, c in
                                     ((3, 11, 1), (5, 7, 2), (3, 11, 60), (5, 7, 80))])
        label = F.element_at(F.array(*[F.lit(n) for n in ("cat", "dog", "CAT", "wolf", "Bird")]), ((k + i) % 5 + 1).cast("int"))
        short = (k % 11 == 0) & (i == 1)
        return F.concat(F.lit('{"bbox_2d": ['), F.when(short, "1, 2, 3").otherwise(coords), F.lit('], "label": "'), label, F.lit('"}'))

    count = F.when(k == 7, 2500).otherwise(k % 6).cast("int")  # one answer of very many boxes
    items = F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), box)).otherwise(F.array().cast("array<string>"))
    listed = F.concat(F.lit("["), F.array_join(items, ",\n"), F.when(k % 13 == 0, ', {"bbox_2d": [1, 2, 3, 4]}').otherwise(""), F.lit("]"))
    text = F.when(k % 4 == 0, F.concat(F.lit("```json\n"), listed, F.lit("\n```"))).when(
        k % 4 == 1, F.replace(listed, F.lit('"'), F.lit("'"))).when(k % 4 == 2, listed).otherwise(
        F.concat(listed, F.when(k % 3 == 0, " oops").otherwise("")))
    return D.questions(images(t), classes(t)).drop("prompt", "question_id").withColumn("answer", text)


ANSWER_SQL = f"""
q AS (SELECT media_id AS k, height, width, new_height AS rh, new_width AS rw FROM r),
b AS (SELECT q.*, i.i, (k * 3 + i * 11) % 900 + 1 AS x1, (k * 5 + i * 7) % 900 + 2 AS y1, (k * 3 + i * 11) % 900 + 60 AS x2, (k * 5 + i * 7) % 900 + 80 AS y2,
    ['cat', 'dog', 'CAT', 'wolf', 'Bird'][(k + i) % 5 + 1] AS label
  FROM q, LATERAL (SELECT unnest(range(CASE WHEN k = 7 THEN 2500 ELSE k % 6 END)) AS i) i
  WHERE NOT (k % 11 = 0 AND i = 1) AND NOT (k % 13 = 0) AND NOT (k % 4 = 3 AND k % 3 = 0)),
p AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY i) - 1 AS place FROM b),
f AS (SELECT *, min(place) OVER (PARTITION BY k, label) + 1 AS first FROM p),
boxes AS (SELECT 'd' || k % 3 AS dataset, k AS image_id, CASE lower(label) WHEN 'cat' THEN 1 WHEN 'dog' THEN 11 WHEN 'bird' THEN 21 END AS category_id,
   first * 2147483648 + place AS det_ord, x1 / rw * width AS x, y1 / rh * height AS y, x2 / rw * width - x1 / rw * width AS w, y2 / rh * height - y1 / rh * height AS h
   FROM f WHERE label <> 'wolf')"""


@query("detection_answers", "G5 I2 I3 I4 I5 F20", f"""
WITH {MEDIA_SQL}, {resize_sql('media', 'r', 32, '768*1024', '12800*1024', False)}, {ANSWER_SQL}
SELECT dataset, image_id, CAST(category_id AS BIGINT) AS category_id, det_ord, round(x, 9) AS x, round(y, 9) AS y, round(w, 9) AS w, round(h, 9) AS h FROM boxes""")
def detection_answers(t: Tables) -> DataFrame:
    found = D.detections(D.parse_answers(_answers(t), "answer"), classes(t))
    return found.select("dataset", "image_id", "category_id", "det_ord", *[F.round(c, 9).alias(c) for c in "xywh"])


def truth(t: Tables) -> DataFrame:
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    w, h = (10 + (p * 3) % 150).cast("double"), (10 + (s * 5) % 120).cast("double")
    return t.lineitem.select(
        F.concat(F.lit("d"), (F.col("l_orderkey") % 3).cast("string")).alias("dataset"), F.col("l_orderkey").alias("image_id"),
        (F.col("l_linenumber") % 2).cast("bigint").alias("category_id"), (p * 100000 + s * 10 + F.col("l_linenumber")).alias("gt_id"),
        ((p * 7) % 60).cast("double").alias("x"), ((s * 13) % 50).cast("double").alias("y"), w.alias("w"), h.alias("h"),
        (w * h).alias("area"), F.when(p % 41 == 0, 1).otherwise(0).alias("iscrowd"))


def predictions(t: Tables) -> DataFrame:
    gt, k = truth(t), F.col("gt_id")
    shift = lambda m, d: (F.floor(k / 10) % m).cast("double") - d
    copies = F.when(F.floor(k / 10) % 10 == 0, F.array().cast("array<int>")).when(
        F.floor(k / 10) % 13 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return gt.select("*", F.explode(copies).alias("copy")).select(
        *D.GROUP, (k * 2 + F.col("copy")).alias("det_ord"), (F.col("x") + shift(17, 8) + F.col("copy")).alias("x"),
        (F.col("y") + shift(11, 5)).alias("y"), (F.col("w") + shift(5, 2)).alias("w"), F.col("h").alias("h"), F.lit(1.0).alias("score"))


BOXES_SQL = """
gt AS (SELECT 'd' || l_orderkey % 3 AS dataset, l_orderkey AS image_id, CAST(l_linenumber % 2 AS BIGINT) AS category_id,
    l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS gt_id, CAST((l_partkey * 7) % 60 AS DOUBLE) AS x, CAST((l_suppkey * 13) % 50 AS DOUBLE) AS y,
    CAST(10 + (l_partkey * 3) % 150 AS DOUBLE) AS w, CAST(10 + (l_suppkey * 5) % 120 AS DOUBLE) AS h, l_partkey % 41 = 0 AS crowd FROM lineitem),
dt AS (SELECT dataset, image_id, category_id, gt_id * 2 + c.c AS det_ord, x + (gt_id // 10) % 17 - 8 + c.c AS x, y + (gt_id // 10) % 11 - 5 AS y, w + (gt_id // 10) % 5 - 2 AS w, h
  FROM gt, LATERAL (SELECT unnest(CASE WHEN (gt_id // 10) % 10 = 0 THEN [] WHEN (gt_id // 10) % 13 = 0 THEN [0, 1] ELSE [0] END) AS c) c),
rk AS (SELECT *, row_number() OVER (PARTITION BY dataset, image_id, category_id ORDER BY det_ord) - 1 AS rank FROM dt),
pr AS (SELECT d.image_id, d.category_id, d.rank, d.det_ord, g.gt_id, g.crowd, g.w * g.h AS area, d.w * d.h AS own, g.w * g.h AS other,
   greatest(least(d.x + d.w, g.x + g.w) - greatest(d.x, g.x), 0) * greatest(least(d.y + d.h, g.y + g.h) - greatest(d.y, g.y), 0) AS inter
  FROM rk d JOIN gt g USING (dataset, image_id, category_id)),
ov AS (SELECT *, inter / CASE WHEN crowd THEN own ELSE own + other - inter END AS iou FROM pr
  WHERE inter / CASE WHEN crowd THEN own ELSE own + other - inter END >= 0.5)"""

#: The matching of one class in one image at one threshold and area range, a detection a step.
GREEDY_SQL = f"""
{BOXES_SQL},
ranges(a, low, high) AS (VALUES (0, 0, 1e10), (1, 0, 1024), (2, 1024, 9216), (3, 9216, 1e10)),
steps AS (SELECT t, 0.5 + t * 0.05 AS bar FROM range(10) r(t)),
op AS (SELECT DISTINCT image_id, category_id, max(rank) OVER (PARTITION BY image_id, category_id) AS last FROM ov),
run AS (
  SELECT image_id, category_id, a, t, -1::BIGINT AS rank, last, []::BIGINT[] AS taken, NULL::BIGINT AS gt, false AS aside
  FROM op, ranges, steps
  UNION ALL
  SELECT image_id, category_id, a, t, rank + 1, last,
    CASE WHEN best IS NULL OR best.crowd THEN taken ELSE list_append(taken, best.gt) END, best.gt, coalesce(NOT best.counts, false)
  FROM (
    SELECT r.image_id, r.category_id, r.a, r.t, r.rank, any_value(r.last) AS last, any_value(r.taken) AS taken,
      max(CASE WHEN o.gt_id IS NULL THEN NULL ELSE {{'counts': NOT o.crowd AND o.area BETWEEN low AND high, 'iou': o.iou, 'gt': o.gt_id, 'crowd': o.crowd}} END) AS best
    FROM run r JOIN ranges USING (a) JOIN steps USING (t)
      LEFT JOIN ov o ON o.image_id = r.image_id AND o.category_id = r.category_id AND o.rank = r.rank + 1 AND o.iou >= bar
        AND (o.crowd OR NOT list_contains(r.taken, o.gt_id))
    WHERE r.rank < r.last
    GROUP BY r.image_id, r.category_id, r.a, r.t, r.rank)),
mt AS (
  SELECT d.dataset, d.image_id, d.category_id, d.rank, d.det_ord, a, t, r.gt IS NOT NULL AS matched,
    CASE WHEN r.gt IS NOT NULL THEN r.aside ELSE NOT d.w * d.h BETWEEN low AND high END AS ignored
  FROM rk d CROSS JOIN ranges CROSS JOIN steps LEFT JOIN run r USING (image_id, category_id, a, t, rank))"""


@query("detection_matches", "I6 I7", f"""
WITH RECURSIVE {GREEDY_SQL}
SELECT image_id, category_id, det_ord, CAST(sum(CASE WHEN matched THEN 1::BIGINT << (a * 10 + t) ELSE 0 END) AS BIGINT) AS matched,
  CAST(sum(CASE WHEN ignored THEN 1::BIGINT << (a * 10 + t) ELSE 0 END) AS BIGINT) AS ignored
FROM mt GROUP BY image_id, category_id, det_ord""")
def detection_matches(t: Tables) -> DataFrame:
    return D.match(D.ranked_detections(predictions(t)), truth(t)).select("image_id", "category_id", "det_ord", "matched", "ignored")


@query("detection_metrics", "I6 I7 I8 I9 I10", f"""
WITH RECURSIVE {GREEDY_SQL},
total AS (SELECT dataset, category_id, a, count(*) FILTER (NOT crowd AND w * h BETWEEN low AND high) AS total FROM gt, ranges GROUP BY ALL),
ct AS (SELECT dataset, category_id, CASE WHEN few THEN 4 ELSE a END AS curve, a, t, matched,
    count(*) FILTER (matched) OVER w AS tp, count(*) OVER w AS seen
  FROM (SELECT mt.*, few FROM mt, (VALUES (false), (true)) f(few) WHERE NOT ignored AND (NOT few OR (rank < 100 AND a = 0)))
  WINDOW w AS (PARTITION BY dataset, category_id, a, t, few ORDER BY image_id, rank ROWS UNBOUNDED PRECEDING)),
pt AS (SELECT *, tp / total AS recall, tp / seen AS p FROM ct JOIN total USING (dataset, category_id, a) WHERE matched AND total > 0),
best AS (SELECT dataset, category_id, curve, t, s, max(p) AS p FROM (
    SELECT *, unnest(range(0, 1 + least(100, CAST(floor(recall * 100 + 1e-9) AS BIGINT)))) AS s FROM (
      SELECT dataset, category_id, curve, t, recall, max(p) AS p FROM pt GROUP BY ALL)) WHERE s * 0.01::DOUBLE <= recall GROUP BY ALL),
curves AS (SELECT dataset, category_id, a AS curve, a, t, total FROM total, steps UNION ALL
  SELECT dataset, category_id, 4, 0, t, total FROM total, steps WHERE a = 0),
ap AS (SELECT c.dataset, c.category_id, c.curve, c.t, coalesce(sum(p), 0) / 101 AS ap
  FROM curves c LEFT JOIN best USING (dataset, category_id, curve, t) WHERE total > 0 GROUP BY ALL),
figures AS (SELECT dataset,
    round_even(avg(ap) FILTER (curve = 4), 3) AS mAP, round_even(avg(ap) FILTER (curve = 0 AND t = 0), 3) AS mAP_50,
    round_even(avg(ap) FILTER (curve = 0 AND t = 5), 3) AS mAP_75, round_even(avg(ap) FILTER (curve = 1), 3) AS mAP_s,
    round_even(avg(ap) FILTER (curve = 2), 3) AS mAP_m, round_even(avg(ap) FILTER (curve = 3), 3) AS mAP_l FROM ap GROUP BY dataset),
filled AS (SELECT dataset, coalesce(mAP, -1) AS mAP, coalesce(mAP_50, -1) AS mAP_50, coalesce(mAP_75, -1) AS mAP_75,
    coalesce(mAP_s, -1) AS mAP_s, coalesce(mAP_m, -1) AS mAP_m, coalesce(mAP_l, -1) AS mAP_l FROM figures)
SELECT dataset, mAP, mAP_50, mAP_75, mAP_s, mAP_m, mAP_l FROM filled UNION ALL
SELECT 'Average', round(avg(mAP), 9), round(avg(mAP_50), 9), round(avg(mAP_75), 9), round(avg(mAP_s), 9), round(avg(mAP_m), 9), round(avg(mAP_l), 9) FROM filled""")
def detection_metrics(t: Tables) -> DataFrame:
    table = D.evaluate(predictions(t), truth(t))
    return table.select("dataset", *[F.round(m, 9).alias(m) for m in D.METRICS])


@query("detection_overlaps", "I6", f"""
WITH {BOXES_SQL}
SELECT image_id, category_id, det_ord, gt_id, round(iou, 6) AS iou FROM ov""")
def detection_overlaps(t: Tables) -> DataFrame:
    ranked = D.ranked_detections(predictions(t))
    names = ranked.select(*D.GROUP, "rank", "det_ord")
    return D.candidate_pairs(ranked, truth(t)).join(names, [*D.BY_GROUP, "rank"]).select(
        "image_id", "category_id", "det_ord", "gt_id", F.round("iou", 6).alias("iou"))
