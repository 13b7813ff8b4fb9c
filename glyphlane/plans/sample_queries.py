"""Validation, message building and token costs of samples made from documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json import strict_json
from ..operators import lengths as N
from ..operators import validate as V
from .check_sql import strip_sql, word_count_sql
from .registry import Tables, query


def samples(t: Tables) -> DataFrame:
    """One record per document: raw media fields and two to four turns."""
    k = F.col("doc_id")
    ks = k.cast("string")
    name = lambda i: F.concat(F.lit('"i'), ks, F.lit(f'_{i}.jpg"'))
    image = F.when(k % 29 == 0, '{"a":1}').when(k % 3 == 1, name(0)).when(
        k % 3 == 2, F.concat(F.lit("["), name(0), F.lit(","), name(1), F.lit("]")))
    key = F.when(k % 8 == 0, '"images":').otherwise('"image":')
    raw = F.concat(
        F.lit("{"), F.concat_ws(
            ",", F.concat(key, image), F.when(k % 10 == 7, F.concat(F.lit('"video":"v'), ks, F.lit('.mp4"')))), F.lit("}"))
    tags = (k % 3 - F.when(k % 6 == 5, 1).otherwise(0) + F.when(k % 14 == 0, 1).otherwise(0)).cast("int")
    turn = lambda who, text: F.struct(F.lit(who).alias("from"), text.alias("value"))
    turns = F.array(
        turn("human", F.concat(F.repeat(F.lit("<image>\n"), tags), F.when(k % 10 == 7, "<video>").otherwise(""), F.col("text"))),
        turn("gpt", F.when(k % 31 == 0, "a <image> b").otherwise(F.concat(F.lit("See "), "lang"))),
        F.when(k % 6 == 5, turn("human", F.lit("And <image> please"))),
        F.when(k % 6 == 5, turn("gpt", F.lit(" Sure "))))
    record = t.spread("documents", "doc_id", "text", "lang").select(k, raw.alias("raw"), F.array_compact(turns).alias("conversations"))
    parsed = record.withColumn("_v", strict_json(F.col("raw")))
    return parsed.select(
        "doc_id", "conversations", V.media_field(F.col("_v"), "image", "images").alias("images"),
        V.media_field(F.col("_v"), "video", "videos").alias("videos"))


def listing(t: Tables) -> DataFrame:
    k = F.col("doc_id").cast("string")
    return t.labels.select(F.explode(F.array_compact(F.array(
        F.concat(F.lit("media/i"), k, F.lit("_0.jpg")),
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("media/i"), k, F.lit("_1.jpg"))),
        F.concat(F.lit("media/v"), k, F.lit(".mp4"))))).alias("path"))


SAMPLES_SQL = """
s0 AS (SELECT doc_id AS k, text, lang,
   CASE WHEN doc_id % 29 = 0 THEN 0 ELSE doc_id % 3 END AS n_img, CASE WHEN doc_id % 10 = 7 THEN 1 ELSE 0 END AS n_vid,
   doc_id % 3 - (CASE WHEN doc_id % 6 = 5 THEN 1 ELSE 0 END) + (CASE WHEN doc_id % 14 = 0 THEN 1 ELSE 0 END) AS t1, doc_id % 6 = 5 AS more FROM documents),
s1 AS (SELECT *, repeat('<image>' || chr(10), t1) || CASE WHEN n_vid = 1 THEN '<video>' ELSE '' END || text AS h1,
   CASE WHEN k % 31 = 0 THEN 'a <image> b' ELSE 'See ' || lang END AS a1 FROM s0),
files AS (SELECT 'media/i' || doc_id || '_0.jpg' AS path FROM labels UNION SELECT 'media/i' || doc_id || '_1.jpg' FROM labels WHERE doc_id % 2 = 0
   UNION SELECT 'media/v' || doc_id || '.mp4' FROM labels),
want AS (SELECT k, 'media/i' || k || '_0.jpg' AS path FROM s1 WHERE n_img > 0 UNION ALL SELECT k, 'media/i' || k || '_1.jpg' FROM s1 WHERE n_img > 1
   UNION ALL SELECT k, 'media/v' || k || '.mp4' FROM s1 WHERE n_vid = 1),
absent AS (SELECT k, string_agg(path, ', ' ORDER BY path) AS gone FROM want WHERE path NOT IN (SELECT path FROM files) GROUP BY k),
s2 AS (SELECT s1.*, gone, (length(h1) - length(replace(h1, '<image>', ''))) // 7 + CASE WHEN more THEN 1 ELSE 0 END AS a_img,
   (length(h1) - length(replace(h1, '<video>', ''))) // 7 AS a_vid FROM s1 LEFT JOIN absent USING (k)),
checked AS (SELECT *, CASE WHEN n_img > 0 AND n_vid > 0 THEN 'mixed' WHEN n_img > 0 THEN 'image' WHEN n_vid > 0 THEN 'video' ELSE 'none' END AS modality,
   CASE WHEN gone IS NOT NULL THEN 'Missing media files: ' || gone END AS p1,
   CASE WHEN n_img <> a_img THEN 'Expected ' || n_img || ' <image> tokens, found ' || a_img
        WHEN n_vid <> a_vid THEN 'Expected ' || n_vid || ' <video> tokens, found ' || a_vid END AS p2,
   CASE WHEN contains(a1, '<image>') OR contains(a1, '<video>') THEN 'GPT response contains media token (<image> or <video>)' END AS p3 FROM s2)"""


def _checked(t: Tables) -> DataFrame:
    return V.validate(samples(t), listing(t), "doc_id")


@query("sample_validation", "C1 C2 C3 C4 C5 C6", f"""
WITH {SAMPLES_SQL} SELECT k AS doc_id, modality, concat_ws('; ', p1, p2, p3) AS problems FROM checked""")
def sample_validation(t: Tables) -> DataFrame:
    return _checked(t).select("doc_id", "modality", F.array_join(
        F.transform("validation_problems", lambda p: p["message"]), "; ").alias("problems"))


@query("validation_summary", "C7", f"""
WITH {SAMPLES_SQL}
SELECT count(*) AS total, count_if(p1 IS NULL AND p2 IS NULL AND p3 IS NULL) AS valid,
  round(count_if(p1 IS NULL AND p2 IS NULL AND p3 IS NULL) / count(*) * 100, 6) AS valid_percent,
  count_if(modality = 'image') AS image_only, count_if(modality = 'video') AS video_only, count_if(modality = 'mixed') AS mixed,
  count(p1) AS missing_media, count(p2) AS token_mismatches, count(p3) AS gpt_media_tokens FROM checked""")
def validation_summary(t: Tables) -> DataFrame:
    return V.validation_summary(_checked(t))


@query("first_missing_files", "C3 C7", f"""
WITH {SAMPLES_SQL}
SELECT k AS doc_id, path FROM want WHERE path NOT IN (SELECT path FROM files) ORDER BY k, path LIMIT 5""")
def first_missing_files(t: Tables) -> DataFrame:
    return V.missing_files(samples(t), listing(t), "doc_id", "media").orderBy("doc_id", "path").limit(5).select("doc_id", "path")


FAULT_SQL = """
faulty AS (SELECT *, CASE WHEN a_img > n_img THEN 'more <image> placeholders than images' WHEN a_vid > n_vid THEN 'more <video> placeholders than videos'
   WHEN a_img < n_img OR a_vid < n_vid THEN 'unused media' END AS fault FROM checked)"""


@query("message_items", "D24 C8", f"""
WITH {SAMPLES_SQL}, {FAULT_SQL}
SELECT k AS doc_id, fault, CASE WHEN fault IS NULL THEN concat_ws('|',
  CASE WHEN t1 > 0 THEN 'user:image:/data/i' || k || '_0.jpg' END, CASE WHEN t1 > 1 THEN 'user:image:/data/i' || k || '_1.jpg' END,
  CASE WHEN n_vid > 0 THEN 'user:video:/data/v' || k || '.mp4' END,
  CASE WHEN {strip_sql('text')} <> '' THEN 'user:text:' || {strip_sql('text')} END, 'assistant:text:' || a1,
  CASE WHEN more THEN 'user:text:And|user:image:/data/i' || k || '_' || t1 || '.jpg|user:text:please|assistant:text: Sure ' END) END AS items
FROM faulty""")
def message_items(t: Tables) -> DataFrame:
    built = V.build_messages(samples(t), "/data")
    return built.select("doc_id", "fault", F.array_join(F.transform("items", lambda p: F.concat(
        p["role"], F.lit(":"), p["type"], F.lit(":"), F.coalesce(p["text"], p["uri"]))), "|").alias("items"))


@query("vision_inputs", "F13 F14", f"""
WITH {SAMPLES_SQL}, {FAULT_SQL}
SELECT k AS doc_id, n_img + n_vid AS media,
  CASE WHEN n_img > 0 THEN concat_ws(',', '/data/i' || k || '_0.jpg', CASE WHEN n_img > 1 THEN '/data/i' || k || '_1.jpg' END) END AS images,
  CASE WHEN n_vid > 0 THEN '/data/v' || k || '.mp4' END AS videos
FROM faulty WHERE fault IS NULL""")
def vision_inputs(t: Tables) -> DataFrame:
    built = V.build_messages(samples(t), "/data", on_fault="DROP")
    return built.select("doc_id", V.vision_items(F.col("items")).alias("v")).select(
        "doc_id", F.size("v").cast("bigint").alias("media"), V.route_vision(F.col("v")).alias("r")).select(
        "doc_id", "media", F.array_join("r.images", ",").alias("images"), F.array_join("r.videos", ",").alias("videos"))


@query("vision_requests", "F14", f"""
WITH {SAMPLES_SQL}, {FAULT_SQL}
SELECT k AS doc_id, CASE WHEN n_img > 0 THEN n_img END AS images, CASE WHEN n_vid > 0 THEN n_vid END AS videos, false AS do_sample_frames,
  CASE WHEN n_vid > 0 THEN CAST(k % 5 + 0.5 AS VARCHAR) ELSE '' END AS fps, NOT (n_img + n_vid > 0) AS plain
FROM faulty WHERE fault IS NULL""")
def vision_requests(t: Tables) -> DataFrame:
    built = V.build_messages(samples(t), "/data", on_fault="DROP")
    rates = F.transform(F.filter("v", lambda p: p["type"] == "video"), lambda p: (F.col("doc_id") % 5 + 0.5).cast("double"))
    routed = built.select("doc_id", V.vision_items(F.col("items")).alias("v")).select("doc_id", V.vision_requests(F.col("v"), rates).alias("r"))
    count = lambda kind: F.when(F.col(kind).isNotNull(), F.size(kind)).cast("bigint")
    return routed.select(
        "doc_id", count("r.images").alias("images"), count("r.videos").alias("videos"), "r.do_sample_frames",
        F.array_join(F.col("r.fps").cast("array<string>"), ",").alias("fps"),
        (F.col("r.images").isNull() & F.col("r.videos").isNull()).alias("plain"))


FACTS_SQL = """
facts AS (SELECT f.path AS uri, doc_id AS d, 24 + (doc_id * 37) % 3000 AS height, 24 + (doc_id * 91) % 4000 AS width,
    8 + (doc_id * 53) % 5000 AS total_frames, 25.0 AS fps
  FROM labels, (SELECT 1) x(one), LATERAL (SELECT unnest(['i' || doc_id || '_0.jpg', 'v' || doc_id || '.mp4']) AS path) f)"""


def facts(t: Tables) -> DataFrame:
    k = F.col("doc_id")
    return t.labels.select(
        F.explode(F.array(F.concat(F.lit("i"), k.cast("string"), F.lit("_0.jpg")),
                          F.concat(F.lit("v"), k.cast("string"), F.lit(".mp4")))).alias("uri"),
        (24 + (k * 37) % 3000).alias("height"), (24 + (k * 91) % 4000).alias("width"),
        (8 + (k * 53) % 5000).alias("total_frames"), F.lit(25.0).alias("fps"))


def _cost_sql(name: str, lo: str, hi: str) -> str:
    from .check_sql import resize_sql

    return resize_sql("facts", name, 28, lo, hi, True)


def _template_words(text: str, role: str) -> str:
    return word_count_sql(f"'<|im_start|>{role}' || chr(10) || {text} || '<|im_end|>' || chr(10)")


@query("sample_costs", "E4 E5 E6", f"""
WITH {SAMPLES_SQL}, {FACTS_SQL}, {_cost_sql('ic', '32*28*28', '2048*28*28')}, {_cost_sql('vc', '144*28*28', '576*28*28')},
vf AS (SELECT uri, least(greatest(round_even(total_frames / fps / 4, 0), 4), 8) AS n, total_frames, new_height, new_width FROM vc),
vt AS (SELECT uri, CAST(floor(new_height * new_width / 784.0) AS BIGINT) * CAST(ceil(len(list_distinct(list_transform(range(CAST(n AS BIGINT)),
   lambda i: CAST(floor(CASE WHEN i = n - 1 THEN total_frames - 1 ELSE i * ((total_frames - 1) / (n - 1)) END) AS BIGINT)))) / 2) AS BIGINT) AS tokens FROM vf),
it AS (SELECT uri, CAST(floor(new_height * new_width / 784.0) AS BIGINT) AS tokens FROM ic)
SELECT k AS doc_id, CAST(21 + {_template_words('h1', 'user')} + {_template_words('a1', 'assistant')}
   + CASE WHEN more THEN {_template_words("'And <image> please'", 'user')} + {_template_words("' Sure '", 'assistant')} ELSE 0 END
   + CASE WHEN n_img > 0 THEN coalesce((SELECT tokens FROM it WHERE uri = 'i' || k || '_0.jpg'), 0)
          WHEN n_vid > 0 THEN coalesce((SELECT tokens FROM vt WHERE uri = 'v' || k || '.mp4'), 0) ELSE 0 END AS BIGINT) AS num_tokens
FROM s1""")
def sample_costs(t: Tables) -> DataFrame:
    return N.sample_costs(samples(t), facts(t), "doc_id")
