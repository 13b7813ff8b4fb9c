"""Image, video, coordinate, camera and layout plans over derived media facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import uris as U
from .check_sql import resize_sql
from .registry import Tables, query
from .views import MEDIA_SQL, media



def _text(numbers):
    return F.array_join(numbers.cast("array<string>"), ",")


@query("resize_plan", "F1 F2 F5 E4", f"""
WITH {MEDIA_SQL}, {resize_sql('media', 'a', 28, '4*28*28', '16384*28*28', True)},
{resize_sql('media', 'b', 28, '16*28*28', '576*28*28', True)}
SELECT a.media_id, a.new_height AS full_height, a.new_width AS full_width,
       b.new_height AS small_height, b.new_width AS small_width,
       CAST(floor(b.new_height * b.new_width / 784.0) AS BIGINT) AS small_tokens,
       a.plan_error AS error
FROM a JOIN b USING (media_id)""")
def resize_plan(t: Tables) -> DataFrame:
    return media(t).select(
        "media_id",
        G.resize_plan(F.col("height"), F.col("width"), 28).alias("full"),
        G.resize_plan(F.col("height"), F.col("width"), 28, 16 * 784, 576 * 784).alias("small"),
    ).select(
        "media_id",
        F.col("full.height").alias("full_height"), F.col("full.width").alias("full_width"),
        F.col("small.height").alias("small_height"), F.col("small.width").alias("small_width"),
        G.image_tokens(F.col("small"), 28).alias("small_tokens"),
        F.col("full.error").alias("error"),
    )


@query("image_item_plan", "F5", f"""
WITH {MEDIA_SQL},
items AS (SELECT *, CASE WHEN media_id % 4 = 0 THEN 100 + media_id % 900 END AS ask_h,
                 CASE WHEN media_id % 4 = 0 THEN 80 + media_id % 700 END AS ask_w,
                 CASE WHEN media_id % 3 = 0 THEN 50176 ELSE 4 * 1024 END AS lo_px,
                 CASE WHEN media_id % 3 = 1 THEN 501760 ELSE 16384 * 1024 END AS hi_px
          FROM media),
{resize_sql('items', 'own', 32, 'lo_px', 'hi_px', True)},
{resize_sql('items', 'ask', 32, '4*1024', '16384*1024', True, 'ask_h', 'ask_w')}
SELECT own.media_id,
       CASE WHEN own.ask_h IS NOT NULL THEN ask.new_height ELSE own.new_height END AS plan_height,
       CASE WHEN own.ask_h IS NOT NULL THEN ask.new_width ELSE own.new_width END AS plan_width
FROM own JOIN ask USING (media_id)""")
def image_item_plan(t: Tables) -> DataFrame:
    k = F.col("media_id")
    plan = G.image_plan(
        F.col("height"), F.col("width"), 16,
        resized_height=F.when(k % 4 == 0, 100 + k % 900),
        resized_width=F.when(k % 4 == 0, 80 + k % 700),
        min_pixels=F.when(k % 3 == 0, F.lit(50176)),
        max_pixels=F.when(k % 3 == 1, F.lit(501760)),
    )
    return media(t).select("media_id", plan.alias("plan")).select(
        "media_id", F.col("plan.height").alias("plan_height"), F.col("plan.width").alias("plan_width"))


BOX_SQL = """
boxes AS (SELECT *, (media_id * 7) % width AS x1, (media_id * 11) % height AS y1,
                 least(width, (media_id * 7) % width + 5 + media_id % 300) AS x2,
                 least(height, (media_id * 11) % height + 5 + media_id % 200) AS y2
          FROM media)"""


@query("box_coordinates", "F3 F16 F17 F18 F19 F20", f"""
WITH {MEDIA_SQL}, {BOX_SQL},
{resize_sql('boxes', 'r', 28, '56*56', '14*14*4*1280', False,
            error="CASE WHEN least(height, width) < 28 THEN 'side below factor' WHEN greatest(height, width) > 200 * least(height, width) THEN 'aspect ratio' END")}
SELECT media_id, plan_error AS error,
  CAST(greatest(0, least(1000, round_even(x1 / width * 1000, 0))) AS BIGINT) AS rel_x1,
  CAST(greatest(0, least(1000, round_even(y2 / height * 1000, 0))) AS BIGINT) AS rel_y2,
  CAST(CASE WHEN plan_error IS NULL THEN greatest(0, least(new_width - 1, round_even(x2 * (new_width / width), 0))) END AS BIGINT) AS px_x2,
  CAST(CASE WHEN plan_error IS NULL THEN greatest(0, least(new_height - 1, round_even(y1 * (new_height / height), 0))) END AS BIGINT) AS px_y1,
  round((media_id % 1001) / 1000 * width, 6) AS back_x,
  round(floor((media_id % 1001) / 2.0) / 1000 * height, 6) AS back_point_y,
  CAST(round_even((media_id % 1000) / 999 * width, 0) AS BIGINT) AS click_x,
  x1 || ',' || y1 || ',' || (x2 - x1) || ',' || (y2 - y1) AS xywh
FROM r""")
def box_coordinates(t: Tables) -> DataFrame:
    k = F.col("media_id")
    x1, y1 = (k * 7) % F.col("width"), (k * 11) % F.col("height")
    boxes = media(t).select(
        k, F.col("height"), F.col("width"), x1.alias("x1"), y1.alias("y1"),
        F.least(F.col("width"), x1 + 5 + k % 300).alias("x2"), F.least(F.col("height"), y1 + 5 + k % 200).alias("y2"),
        G.resize_plan_training(F.col("height"), F.col("width")).alias("plan"))
    return boxes.select(
        "media_id", F.col("plan.error").alias("error"),
        G.to_relative(F.col("x1"), F.col("width")).alias("rel_x1"),
        G.to_relative(F.col("y2"), F.col("height")).alias("rel_y2"),
        F.when(F.col("plan.error").isNull(), G.to_resized(F.col("x2"), F.col("width"), F.col("plan.width"))).alias("px_x2"),
        F.when(F.col("plan.error").isNull(), G.to_resized(F.col("y1"), F.col("height"), F.col("plan.height"))).alias("px_y1"),
        F.round(G.from_relative(k % 1001, F.col("width")), 6).alias("back_x"),
        F.round(G.from_relative((k % 1001) / 2, F.col("height"), truncate=True), 6).alias("back_point_y"),
        G.click_position(k % 1000, F.col("width")).alias("click_x"),
        _text(G.box_to_xywh(F.array("x1", "y1", "x2", "y2"))).alias("xywh"),
    )


@query("detection_resize_plan", "F4", f"""
WITH {MEDIA_SQL},
cut AS (SELECT media_id, height AS h0, width AS w0,
   CASE WHEN greatest(height, width) > 2000 THEN floor(height / (greatest(height, width) / 2000)) ELSE height END AS height,
   CASE WHEN greatest(height, width) > 2000 THEN floor(width / (greatest(height, width) / 2000)) ELSE width END AS width
   FROM media),
{resize_sql('cut', 'r', 32, '768*1024', '2000*1024', False,
            error="CASE WHEN least(h0, w0) < 2 THEN 'side below 2' WHEN greatest(h0, w0) > 200 * least(h0, w0) THEN 'aspect ratio' END")}
SELECT media_id, new_height, new_width, plan_error AS error FROM r""")
def detection_resize_plan(t: Tables) -> DataFrame:
    plan = G.resize_plan_detection(F.col("height"), F.col("width"), 32, 768 * 1024, 2000 * 1024, 2000)
    return media(t).select("media_id", plan.alias("p")).select(
        "media_id", F.col("p.height").alias("new_height"), F.col("p.width").alias("new_width"),
        F.col("p.error").alias("error"))


CLIP_SQL = """
clips AS (
  SELECT *, total_frames / fps AS dur,
         CASE WHEN media_id % 4 IN (1, 3) THEN CAST(media_id % 9 AS DOUBLE) / 2 END AS v_start,
         CASE WHEN media_id % 4 IN (2, 3) THEN CAST(media_id % 61 AS DOUBLE) END AS v_end,
         CASE WHEN media_id % 6 = 0 THEN media_id % 40 END AS ask_n,
         CASE WHEN media_id % 6 = 1 THEN 1.5 WHEN media_id % 12 = 6 THEN 3.0 END AS ask_fps
  FROM media),
ranged0 AS (
  SELECT *, CASE WHEN v_start IS NULL THEN 0 ELSE ceil(greatest(0, least(v_start, dur)) * fps) END AS s_,
         CASE WHEN v_end IS NULL THEN total_frames - 1
              ELSE least(floor(greatest(0, least(v_end, dur)) * fps), total_frames - 1) END AS e_
  FROM clips),
ranged AS (
  SELECT *, CASE WHEN (v_start IS NOT NULL OR v_end IS NOT NULL) AND s_ >= e_ THEN 'empty time range' END AS range_error
  FROM ranged0),
counted0 AS (
  SELECT *, CASE WHEN range_error IS NULL THEN e_ - s_ + 1 END AS t_ FROM ranged),
counted1 AS (
  SELECT *, CASE WHEN ask_n IS NOT NULL THEN round_even(ask_n / 2.0, 0) * 2
    ELSE floor(least(greatest(t_ / fps * coalesce(ask_fps, 2.0), 4), floor(least(768, t_) / 2) * 2, t_) / 2) * 2 END AS n_
  FROM counted0),
counted AS (
  SELECT *, CASE WHEN t_ IS NULL THEN NULL
     WHEN ask_n IS NOT NULL AND ask_fps IS NOT NULL THEN 'fps and nframes'
     WHEN n_ < 2 OR n_ > t_ THEN 'frame count out of range' END AS count_error FROM counted1)"""


def clips(t: Tables) -> DataFrame:
    k = F.col("media_id")
    return media(t).select(
        "*",
        F.when((k % 4).isin(1, 3), (k % 9).cast("double") / 2).alias("v_start"),
        F.when((k % 4).isin(2, 3), (k % 61).cast("double")).alias("v_end"),
        F.when(k % 6 == 0, k % 40).alias("ask_n"),
        F.when(k % 6 == 1, 1.5).when(k % 12 == 6, 3.0).alias("ask_fps"),
    ).withColumn(
        "range", G.frame_range(F.col("total_frames"), F.col("fps"), F.col("v_start"), F.col("v_end"))
    ).withColumn(
        "chosen", G.frame_count(F.col("range.count"), F.col("fps"), F.col("ask_fps"), F.col("ask_n")))


@query("frame_plan", "F6 F7 F10", f"""
WITH {MEDIA_SQL}, {CLIP_SQL}
SELECT media_id, CAST(CASE WHEN range_error IS NULL THEN s_ END AS BIGINT) AS start_frame,
  CAST(CASE WHEN range_error IS NULL THEN e_ END AS BIGINT) AS end_frame, CAST(t_ AS BIGINT) AS frames,
  range_error, CAST(CASE WHEN count_error IS NULL THEN n_ END AS BIGINT) AS nframes, count_error,
  round(CASE WHEN count_error IS NULL THEN n_ END / greatest(t_, 1e-6) * fps, 6) AS sample_fps
FROM counted""")
def frame_plan(t: Tables) -> DataFrame:
    return clips(t).select(
        "media_id", F.col("range.start").alias("start_frame"), F.col("range.end").alias("end_frame"),
        F.col("range.count").alias("frames"), F.col("range.error").alias("range_error"),
        F.col("chosen.nframes").alias("nframes"), F.col("chosen.error").alias("count_error"),
        F.round(G.sample_fps(F.col("chosen.nframes"), F.col("range.count"), F.col("fps")), 6).alias("sample_fps"))


@query("frame_indices", "F8 F9", f"""
WITH {MEDIA_SQL}, {CLIP_SQL},
p AS (SELECT media_id, s_, e_, CAST(n_ AS BIGINT) AS n, (e_ - s_) / greatest(n_ - 1, 1) AS step_, total_frames
      FROM counted WHERE range_error IS NULL AND count_error IS NULL)
SELECT media_id,
  list_aggregate(list_transform(range(n), lambda i: CAST(round_even(CASE WHEN i = n - 1 THEN e_ ELSE i * step_ + s_ END, 0) AS BIGINT)), 'string_agg', ',') AS rounded,
  list_aggregate(list_transform(range(8), lambda i: CAST(floor(CASE WHEN i = 7 THEN total_frames - 1 ELSE i * ((total_frames - 1) / 7) END) AS BIGINT)), 'string_agg', ',') AS truncated,
  CAST(len(list_distinct(list_transform(range(64), lambda i: CAST(floor(CASE WHEN i = 63 THEN least(total_frames, 40) - 1 ELSE i * ((least(total_frames, 40) - 1) / 63) END) AS BIGINT)))) AS BIGINT) AS unique_frames
FROM p""")
def frame_indices(t: Tables) -> DataFrame:
    ok = clips(t).where(F.col("range.error").isNull() & F.col("chosen.error").isNull())
    total = F.col("total_frames")
    return ok.select(
        "media_id",
        _text(G.frame_indices_rounded(F.col("range.start"), F.col("range.end"), F.col("chosen.nframes"))).alias("rounded"),
        _text(G.frame_indices_truncated(0, total - 1, 8)).alias("truncated"),
        F.size(G.frame_indices_truncated(0, F.least(total, F.lit(40)) - 1, 64, unique=True)).cast("bigint").alias("unique_frames"))


@query("frame_list_plan", "F11 F28", f"""
WITH {MEDIA_SQL},
f AS (SELECT media_id, CASE WHEN media_id % 2 = 0 THEN 0.25 ELSE 0.5 END AS rate, 1 + media_id % 60 AS end_s, fps FROM media),
g AS (SELECT *, list_transform(range(0, end_s, CAST(floor(1 / rate) AS BIGINT)), lambda i: 'v' || media_id || '/' || i || '.000.jpg') AS frames FROM f),
h AS (SELECT *, CASE WHEN len(frames) % 2 = 1 THEN list_append(frames, frames[-1]) ELSE frames END AS padded FROM g)
SELECT media_id, list_aggregate(padded, 'string_agg', ',') AS frames, CAST(len(padded) AS BIGINT) AS nframes,
       round(len(padded) / rate * fps, 6) AS total_num_frames FROM h""")
def frame_list_plan(t: Tables) -> DataFrame:
    k = F.col("media_id")
    rate = F.when(k % 2 == 0, 0.25).otherwise(0.5)
    padded = G.pad_frame_list(F.col("frames"))
    return media(t).select(
        k, "fps", rate.alias("rate"),
        G.frame_uris(F.concat(F.lit("v"), k.cast("string")), 1 + k % 60, rate).alias("frames"),
    ).select("media_id", "fps", "rate", padded.alias("padded")).select(
        "media_id", F.array_join("padded", ",").alias("frames"),
        F.size("padded").cast("bigint").alias("nframes"),
        F.round(G.frame_list_metadata(F.size("padded"), F.col("rate"), F.col("fps"))["total_num_frames"], 6)
        .alias("total_num_frames"))


@query("video_frame_plan", "F12 F27", f"""
WITH {MEDIA_SQL},
b AS (SELECT media_id, height, width, 4 + 2 * (media_id % 300) AS n,
        CASE WHEN media_id % 5 = 0 THEN 24.0 * 1024 * 1024 ELSE 128000 * 1024 * 0.9 END AS total,
        CASE WHEN media_id % 7 = 0 THEN 200000.0 END AS ask_max FROM media),
c AS (SELECT *, greatest(least(768.0 * 1024, total / n * 2), floor(128 * 1024 * 1.05)) AS limit_ FROM b),
d AS (SELECT *, least(coalesce(ask_max, limit_), limit_) AS max_px FROM c),
{resize_sql('d', 'r', 32, '128*1024', 'max_px', True)}
SELECT media_id, round(max_px, 3) AS max_pixels, new_height, new_width,
  CAST(n AS DOUBLE) * height * width BETWEEN 4096 AND 234881024 AS within,
  CAST(floor(CAST(n AS DOUBLE) * height * width / 2048) AS BIGINT) AS clip_tokens
FROM r""")
def video_frame_plan(t: Tables) -> DataFrame:
    k = F.col("media_id")
    frames = media(t).select(
        k, F.col("height"), F.col("width"), (4 + 2 * (k % 300)).alias("n"),
        F.when(k % 5 == 0, 24.0 * 1024 * 1024).alias("total"),
        F.when(k % 7 == 0, 200000.0).alias("ask_max"))
    n, total, ask = F.col("n"), F.col("total"), F.col("ask_max")
    return frames.select(
        "media_id", G.video_max_pixels(n, 32, None, total, ask).alias("max_pixels"),
        G.video_frame_plan(F.col("height"), F.col("width"), n, 16, None, total, ask).alias("plan"),
        G.clip_budget(n, F.col("height"), F.col("width"), 4096, 234881024).alias("clip"),
    ).select(
        "media_id", F.round("max_pixels", 3).alias("max_pixels"),
        F.col("plan.height").alias("new_height"), F.col("plan.width").alias("new_width"),
        F.col("clip.within").alias("within"), F.col("clip.tokens").alias("clip_tokens"))


@query("media_uris", "F15 F29 A19", f"""
WITH {MEDIA_SQL}
SELECT media_id,
  CASE WHEN starts_with(uri, 'http://') OR starts_with(uri, 'https://') THEN 'http'
       WHEN starts_with(uri, 'file://') THEN 'file' WHEN starts_with(uri, 'data:image') THEN 'data' ELSE 'local' END AS kind,
  CASE WHEN starts_with(uri, 'file://') THEN substr(uri, 8)
       WHEN starts_with(uri, 'store/') THEN uri END AS path,
  CASE WHEN starts_with(uri, 'data:image') THEN p_name END AS payload,
  'data:image/' || CASE WHEN media_id % 3 = 0 THEN 'jpeg' ELSE 'png' END || ';base64,' || base64(encode(p_name)) AS inline_uri,
  md5(uri) || '_' || total_frames || '_' || height AS cache_key
FROM media JOIN part ON media_id = p_partkey""")
def media_uris(t: Tables) -> DataFrame:
    names = t.part.select(F.col("p_partkey").alias("media_id"), "p_name")
    uri = F.col("uri")
    return media(t).join(names, "media_id").select(
        "media_id", U.uri_kind(uri).alias("kind"), U.uri_path(uri).alias("path"),
        U.data_payload(uri).cast("string").alias("payload"),
        U.data_uri(F.col("file_name"), F.col("p_name").cast("binary")).alias("inline_uri"),
        U.cache_key(uri, F.col("total_frames"), F.col("height")).alias("cache_key"))


@query("camera_projection", "F21 F22", f"""
WITH {MEDIA_SQL},
b AS (SELECT media_id, width, height,
   ((media_id * 13) % 200 - 100) / 50 AS x, ((media_id * 17) % 100 - 50) / 50 AS y, ((media_id * 19) % 600) / 100 - 0.5 AS z,
   0.2 + (media_id % 20) / 10 AS sx, 0.3 + (media_id % 10) / 10 AS sy, 0.1 + (media_id % 30) / 10 AS sz,
   radians((media_id % 90) / 180 * 180) AS pi_, radians((media_id % 60) / 90 * 180) AS ya, radians((media_id % 45) / 60 * 180) AS ro,
   round_even(width / (tan(radians(60) / 2) * 2) * 100, 0) / 100 AS fx, round_even(height / (tan(radians(60) / 2) * 2) * 100, 0) / 100 AS fy
   FROM media),
c AS (SELECT b.*, s.n, sx / 2 * (CASE WHEN n < 4 THEN 1 ELSE -1 END) AS x0, sy / 2 * (CASE WHEN n % 4 < 2 THEN 1 ELSE -1 END) AS y0,
      sz / 2 * (CASE WHEN n % 2 = 0 THEN 1 ELSE -1 END) AS z0 FROM b, (SELECT unnest(range(8)) AS n) s),
d AS (SELECT *, y0 * cos(pi_) - z0 * sin(pi_) AS y1, y0 * sin(pi_) + z0 * cos(pi_) AS z1 FROM c),
e AS (SELECT *, x0 * cos(ya) + z1 * sin(ya) AS x2, z1 * cos(ya) - x0 * sin(ya) AS z2 FROM d),
g AS (SELECT *, x2 * cos(ro) - y1 * sin(ro) + x AS xx, x2 * sin(ro) + y1 * cos(ro) + y AS yy, z2 + z AS zz FROM e)
SELECT media_id, fx, fy, CAST(count(*) FILTER (zz > 0) AS BIGINT) AS corners, count(*) FILTER (zz > 0) = 8 AS drawable,
  round(min(fx * (xx / zz) + width / 2) FILTER (zz > 0), 3) AS left_x,
  round(max(fy * (yy / zz) + height / 2) FILTER (zz > 0), 3) AS bottom_y
FROM g GROUP BY media_id, fx, fy""")
def camera_projection(t: Tables) -> DataFrame:
    k = F.col("media_id")
    box = F.array(
        ((k * 13) % 200 - 100) / 50, ((k * 17) % 100 - 50) / 50, ((k * 19) % 600) / 100 - 0.5,
        0.2 + (k % 20) / 10, 0.3 + (k % 10) / 10, 0.1 + (k % 30) / 10,
        (k % 90) / 180, (k % 60) / 90, (k % 45) / 60)
    placed = media(t).select("media_id", box.alias("box"), G.pseudo_camera(F.col("width"), F.col("height")).alias("cam"))
    return placed.select(
        "media_id", "cam", G.project_box3d(F.col("box"), F.col("cam"), angle_scale=180.0).alias("corners"),
    ).select(
        "media_id", F.col("cam.fx").alias("fx"), F.col("cam.fy").alias("fy"),
        F.size("corners").cast("bigint").alias("corners"), (F.size("corners") == 8).alias("drawable"),
        F.round(F.array_min(F.transform("corners", lambda p: p[0])), 3).alias("left_x"),
        F.round(F.array_max(F.transform("corners", lambda p: p[1])), 3).alias("bottom_y"))


@query("sheet_layout", "F23 F24 F25", f"""
WITH {MEDIA_SQL}
SELECT media_id,
  CAST(CASE WHEN greatest(width, height) > 1500 THEN width * 1500 // greatest(width, height) ELSE width END AS BIGINT) AS page_width,
  CAST(CASE WHEN greatest(width, height) > 1500 THEN height * 1500 // greatest(width, height) ELSE height END AS BIGINT) AS page_height,
  media_id // 8 AS sheet_row, media_id % 8 AS sheet_col, media_id % 8 * width AS sheet_x, media_id // 8 * height AS sheet_y,
  CAST(ceil(total_frames / 8) AS BIGINT) * height AS sheet_height,
  CAST(CASE WHEN width > height THEN 512 ELSE floor(width * 512 / height) END AS BIGINT) AS thumb_width,
  CAST(CASE WHEN width > height THEN floor(height * 512 / width) ELSE 512 END AS BIGINT) AS thumb_height
FROM media""")
def sheet_layout(t: Tables) -> DataFrame:
    page, cell, thumb = F.col("page"), F.col("cell"), F.col("thumb")
    return media(t).select(
        "media_id", G.page_plan(F.col("width"), F.col("height")).alias("page"), G.sheet_cell(F.col("media_id"), 8, F.col("width"), F.col("height")).alias("cell"),
        G.sheet_size(F.col("total_frames"), 8, F.col("width"), F.col("height"))["height"].alias("sheet_height"),
        G.thumbnail_plan(F.col("width"), F.col("height"), 512).alias("thumb"),
    ).select(
        "media_id", page["width"].alias("page_width"), page["height"].alias("page_height"),
        cell["row"].alias("sheet_row"), cell["col"].alias("sheet_col"), cell["x"].alias("sheet_x"),
        cell["y"].alias("sheet_y"), "sheet_height", thumb["width"].alias("thumb_width"),
        thumb["height"].alias("thumb_height"))
