"""Conversation jobs over the conversations, events and pages tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import chat as C
from ..operators.ordinal import in_buckets, with_global_ordinal
from .check_sql import word_count_sql
from .registry import Tables, query


TURNS_SQL = """
placed AS (
  SELECT *, coalesce(sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS g,
         max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id) AS last_user,
         bool_or(role = 'system') OVER (PARTITION BY conv_id) AS has_system
  FROM conversations),
sys AS (SELECT conv_id, g, string_agg(text, chr(10) ORDER BY turn) AS s FROM placed WHERE role = 'system' GROUP BY ALL),
merged AS (SELECT p.*, CASE WHEN role = 'user' AND s IS NOT NULL THEN s || chr(10) || text ELSE text END AS v
           FROM placed p LEFT JOIN sys USING (conv_id, g) WHERE role <> 'system' AND NOT (has_system AND last_user IS NULL)),
turns AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'human' ELSE 'gpt' END AS speaker,
    CASE WHEN conv_id % 3 <> 0 AND role = 'user' AND turn = last_user AND NOT contains(v, '<image>') THEN v || chr(10) || '<image>' ELSE v END AS value FROM merged)"""


def _with_image():
    return F.col("conv_id") % 3 != 0


def _turns(t: Tables) -> DataFrame:
    return C.training_turns(t.conversations, with_image=_with_image())


@query("chat_turns", "D5 D6 D7 D8", f"""
WITH {TURNS_SQL} SELECT conv_id, turn, speaker, value FROM turns""")
def chat_turns(t: Tables) -> DataFrame:
    return _turns(t).withColumnRenamed("from", "speaker")


@query("chat_conversion", "D5 D6 D7 D8 D22 E1 D12", f"""
WITH {TURNS_SQL},
r AS (SELECT conv_id, count(*) AS turns, CAST(sum({word_count_sql('value')}) AS BIGINT) AS words,
  string_agg('<|im_start|>' || CASE speaker WHEN 'human' THEN 'user' ELSE 'assistant' END || chr(10) || value || '<|im_end|>' || chr(10), '' ORDER BY turn) AS x
  FROM turns GROUP BY conv_id)
SELECT conv_id, turns, words + CASE WHEN conv_id % 3 <> 0 THEN 128 ELSE 0 END AS num_tokens, x AS chat_text FROM r""")
def chat_conversion(t: Tables) -> DataFrame:
    role = F.when(F.col("from") == "human", "user").otherwise("assistant")
    texts = C.chat_text(_turns(t), role, F.col("value"))
    length = F.col("words") + F.when(_with_image(), C.IMAGE_LENGTH).otherwise(0)
    return texts.select("conv_id", "turns", length.alias("num_tokens"), "chat_text").orderBy("num_tokens", "conv_id")


@query("chat_lengths", "E1 E2", f"""
WITH {TURNS_SQL},
w AS (SELECT conv_id, CAST(sum({word_count_sql('value')}) AS BIGINT) AS words FROM turns GROUP BY conv_id)
SELECT conv_id, words + CASE WHEN conv_id % 3 <> 0 THEN 128 ELSE 0 END AS approx_length,
  CASE WHEN conv_id % 3 <> 0 THEN words ELSE -words END AS signed_length FROM w""")
def chat_lengths(t: Tables) -> DataFrame:
    return C.approximate_lengths(_turns(t), has_media=_with_image())


TEMPLATE_SQL = """
tpl AS (SELECT conv_id, string_agg('<|im_start|>' || role || chr(10)
    || CASE WHEN role = 'user' THEN repeat('<|vision_start|><|image_pad|><|vision_end|>', turn % 3) || CASE WHEN turn % 4 = 2 THEN 'Video 1: <|vision_start|><|video_pad|><|vision_end|>' ELSE '' END ELSE '' END
    || text || '<|im_end|>' || chr(10), '' ORDER BY turn) || '<|im_start|>assistant' || chr(10) AS x
  FROM conversations GROUP BY conv_id)"""


def _template_text():
    no = F.lit(0)
    marks = F.concat(C.media_marks((F.col("turn") % 3).cast("int"), no),
                     F.when(F.col("turn") % 4 == 2, C.media_marks(no, F.lit(1), numbered=True)).otherwise(""))
    return F.concat(F.when(F.col("role") == "user", marks).otherwise(""), F.col("text"))


def _templates(t: Tables) -> DataFrame:
    return C.chat_text(t.conversations, F.col("role"), _template_text(), open_answer=True)


@query("template_sections", "D22 D23", f"""
WITH {TEMPLATE_SQL},
p AS (SELECT *, strpos(x, '<|im_start|>user') AS u, strpos(x, '<|im_start|>assistant') AS a FROM tpl),
q AS (SELECT *, CASE WHEN u > 0 THEN strpos(substr(x, u), '<|im_start|>assistant') ELSE 0 END AS later FROM p)
SELECT conv_id, CASE WHEN contains(x, '<|im_start|>system') AND u > 1 THEN substr(x, 1, u - 1) END AS system_part,
  CASE WHEN u > 0 AND later > 0 THEN substr(x, u, later - 1) END AS user_part,
  CASE WHEN a > 0 THEN substr(x, a) END AS assistant_part
FROM q""")
def template_sections(t: Tables) -> DataFrame:
    return _templates(t).select("conv_id", C.template_sections(F.col("chat_text")).alias("s")).select(
        "conv_id", F.col("s.system").alias("system_part"), F.col("s.user").alias("user_part"),
        F.col("s.assistant").alias("assistant_part"))


@query("template_statistics", "D23", f"""
WITH {TEMPLATE_SQL}
SELECT count(*) AS samples, min(length(x)) AS min_length, max(length(x)) AS max_length, round(avg(length(x)), 6) AS mean_length FROM tpl""")
def template_statistics(t: Tables) -> DataFrame:
    lengths = C.chat_text_lengths(t.conversations, F.col("role"), _template_text(), open_answer=True)
    return C.length_statistics(lengths, F.col("chat_length"))


@query("step_history", "D26", """
WITH s AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n,
    replace(replace(text, chr(10), ''), '"', '') AS c FROM conversations WHERE role = 'assistant')
SELECT conv_id, string_agg('Step ' || n || ': ' || c || '; ', '' ORDER BY n) AS history FROM s GROUP BY conv_id""")
def step_history(t: Tables) -> DataFrame:
    return C.step_history(t.conversations.where(F.col("role") == "assistant"), "conv_id", "turn", "text")


@query("history_messages", "D28", """
WITH p AS (SELECT conv_id, turn, text AS query, 'answer ' || turn AS answer,
    CASE WHEN (conv_id + turn) % 3 = 1 THEN CASE WHEN turn % 2 = 0 THEN 'image' ELSE 'video' END END AS media FROM conversations),
g AS (SELECT *, coalesce(sum(CASE WHEN media IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS r,
   sum(CASE WHEN media IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS total FROM p)
SELECT conv_id, turn, CAST(r * 2 AS BIGINT) AS message, 'user' AS role, coalesce(media, 'text') AS type, query AS value FROM g WHERE r < total
UNION ALL
SELECT conv_id, turn, CAST(r * 2 + 1 AS BIGINT), 'assistant', 'text', answer FROM g WHERE media IS NULL AND r < total - 1""")
def history_messages(t: Tables) -> DataFrame:
    k = F.col("turn")
    pairs = t.conversations.select(
        "conv_id", "turn", F.col("text").alias("query"), F.concat(F.lit("answer "), k.cast("string")).alias("answer"),
        F.when((F.col("conv_id") + k) % 3 == 1, F.when(k % 2 == 0, "image").otherwise("video")).alias("media"))
    return C.history_messages(pairs, "conv_id", "turn")


@query("content_items", "D25", """
SELECT conv_id, turn, CASE WHEN turn % 4 = 1 THEN 'image:i' || turn || '|' ELSE '' END || CASE WHEN turn % 5 <> 3 THEN 'text:' || text || '|' ELSE '' END
  || CASE WHEN turn % 3 = 2 THEN 'video:v' || turn || '|' ELSE '' END AS items FROM conversations""")
def content_items(t: Tables) -> DataFrame:
    k = F.col("turn").cast("string")

    def item(image=None, text=None, video=None):
        none = F.lit(None).cast("string")
        return F.struct(*[(none if v is None else v).alias(n) for n, v in
                          (("image", image), ("text", text), ("video", video))])

    loose = F.array(
        F.when(F.col("turn") % 4 == 1, item(F.concat(F.lit("i"), k), F.col("text"))).otherwise(item()),
        F.when(F.col("turn") % 5 != 3, item(text=F.col("text"))).otherwise(item()),
        F.when(F.col("turn") % 3 == 2, item(video=F.concat(F.lit("v"), k))).otherwise(item()))
    return t.conversations.select(
        "conv_id", "turn", F.array_join(F.transform(
            C.normalise_items(loose), lambda e: F.concat(e["type"], F.lit(":"), e["value"], F.lit("|"))), "").alias("items"))


@query("timed_items", "D27", """
WITH f AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)
SELECT user_id, 2 * n - 1 AS position, 'text' AS type, '<' || event_id || '.0 seconds>' AS value FROM f
UNION ALL SELECT user_id, 2 * n, 'image', 'frame_' || event_id || '.jpg' FROM f""")
def timed_items(t: Tables) -> DataFrame:
    k = F.col("event_id")
    seconds = F.concat(k.cast("string"), F.lit(".0"))
    return C.timed_items(in_buckets(t.events, k, "_q"), "user_id", [k], F.col("_q"), seconds,
                         F.concat(F.lit("frame_"), k.cast("string"), F.lit(".jpg")))


@query("page_requests", "D29", """
WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, md5(html) AS digest FROM pages),
n AS (SELECT *, row_number() OVER (PARTITION BY host ORDER BY page_id) AS position FROM p)
SELECT host, position, 'image' AS type, 'page_' || page_id || '_' || digest AS value, 524288 AS min_pixels, 747520 AS max_pixels FROM n
UNION ALL SELECT host, count(*) + 1, 'text', 'Describe ' || host, NULL, NULL FROM p GROUP BY host""")
def page_requests(t: Tables) -> DataFrame:
    pages = t.pages.select("page_id", F.regexp_extract("url", "^https?://([^/?#]+)", 1).alias("host"),
                           F.md5(F.col("html").cast("binary")).alias("digest"))
    uri = F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit("_"), F.col("digest"))
    return C.page_request(in_buckets(pages, F.col("page_id"), "_q", t.pages), "host", "page_id", F.col("_q"), uri,
                          F.concat(F.lit("Describe "), F.col("host")))


@query("rows_by_ordinal", "B8", """
WITH o AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) AS ordinal FROM conversations)
SELECT * FROM o WHERE ordinal IN (1, 5, 17, 80, 100000000)""")
def rows_by_ordinal(t: Tables) -> DataFrame:
    k, rows = F.col("conv_id"), t.conversations.select("conv_id", "turn")
    return with_global_ordinal(rows, [k, F.col("turn")]).where(F.col("ordinal").isin(1, 5, 17, 80, 100000000))
