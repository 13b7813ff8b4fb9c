"""Agent logs built from whole documents: cells, image ids and token counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import agentlog as A
from .check_sql import word_count_sql
from .registry import Tables, query


def log_rows(t: Tables) -> DataFrame:
    k = F.col("doc_id")

    def message(role: str, content, when=None):
        m = F.struct(F.lit(role).alias("role"), content.alias("content"))
        return m if when is None else F.when(when, m)

    rows = t.spread("documents", "doc_id", "text", "lang", "source").select(
        "doc_id",
        F.filter(F.array(
            message("system", F.concat(F.lit("Rules for "), "source"), k % 4 != 3),
            message("system", F.lit("Second rules"), k % 5 == 0),
            message("tool", F.lit("ignored"), k % 13 == 0),
            message("user", F.lit(""), k % 11 == 0),
            message("user", F.col("text"), k % 19 != 0),
            message("assistant", F.concat(F.lit("Reply "), "lang")),
            message("user", F.when(k % 6 == 0, "See <image> now").otherwise("And now?"),
                    (k % 19 != 0) & (k % 3 == 0)),
            message("system", F.lit("late"), k % 7 == 0),
        ), lambda m: m.isNotNull()).alias("m"))
    quoted = lambda s: F.concat(
        F.lit("'"),
        F.replace(F.replace(F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")),
                            F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")),
        F.lit("'"))
    literal = F.concat(F.lit("["), F.array_join(F.transform("m", lambda m: F.concat(
        F.lit("{'role': '"), m["role"], F.lit("', 'content': "), quoted(m["content"]), F.lit("}"))), ", "), F.lit("]"))
    cell = F.when(k % 23 == 0, "[{'role': 'user'").when(k % 3 == 1, literal).otherwise(F.to_json("m"))
    return rows.select(
        "doc_id", cell.alias("messages"),
        F.when(k % 10 == 0, "  ").when(k % 17 != 0, F.concat(F.lit(" "), k.cast("string"))).alias("image_payload_id"),
        F.when(k % 4 == 0, (1000 + k * 7 % 20000).cast("string")).when(
            k % 4 == 1, F.element_at(F.array(*[F.lit(x) for x in ("n/a", "nan", "inf", "1e30", "500d", " 12. ")]), F.floor(k / 4).cast("int") % 6 + 1))
        .when(k % 4 == 2, F.concat((k % 500).cast("string"), F.lit(".0"))).alias("total_tokens"))


def image_listing(t: Tables) -> DataFrame:
    """Files of the labelled documents; every fourth exists in two formats."""
    k = F.col("doc_id").cast("string")
    return t.labels.select(F.explode(F.when(
        F.col("doc_id") % 4 == 0,
        F.array(F.concat(F.lit("store/"), k, F.lit(".PNG")), F.concat(F.lit("store/"), k, F.lit(".jpg"))),
    ).otherwise(F.array(F.concat(F.lit("store/"), k, F.lit(".jpeg"))))).alias("path"))


LOG_SQL = f"""
log AS (
  SELECT doc_id, text, lang, source, doc_id % 23 = 0 AS broken,
    doc_id % 19 <> 0 AS u1, doc_id % 19 <> 0 AND doc_id % 3 = 0 AS u2,
    CASE WHEN doc_id % 4 <> 3 THEN 'Rules for ' || source END AS s1, CASE WHEN doc_id % 5 = 0 THEN 'Second rules' END AS s2,
    CASE WHEN doc_id % 6 = 0 THEN 'See <image> now' ELSE 'And now?' END AS second_text,
    CASE WHEN doc_id % 10 = 0 OR doc_id % 17 = 0 THEN NULL ELSE doc_id END AS image_id,
    CASE doc_id % 4 WHEN 0 THEN 1000 + doc_id * 7 % 20000 WHEN 2 THEN doc_id % 500 WHEN 1 THEN CASE WHEN doc_id // 4 % 6 = 5 THEN 12 END END AS given
  FROM documents),
pics AS (SELECT DISTINCT doc_id AS image_id, doc_id || CASE WHEN doc_id % 4 = 0 THEN '.PNG' ELSE '.jpeg' END AS image FROM labels),
turned AS (
  SELECT log.*, image,
    CASE WHEN u1 THEN coalesce(s1 || chr(10), '') || coalesce(s2 || chr(10), '') || text || CASE WHEN u2 OR contains(text, '<image>') THEN '' ELSE chr(10) || '<image>' END END AS h1,
    'Reply ' || lang AS a1,
    CASE WHEN u2 THEN second_text || CASE WHEN contains(second_text, '<image>') THEN '' ELSE chr(10) || '<image>' END END AS h2,
    coalesce('<|im_start|>system' || chr(10) || s1 || '<|im_end|>' || chr(10), '')
    || coalesce('<|im_start|>system' || chr(10) || s2 || '<|im_end|>' || chr(10), '')
    || CASE WHEN u1 THEN '<|im_start|>user' || chr(10) || text || '<|im_end|>' || chr(10) ELSE '' END
    || '<|im_start|>assistant' || chr(10) || 'Reply ' || lang || '<|im_end|>' || chr(10)
    || CASE WHEN u2 THEN '<|im_start|>user' || chr(10) || second_text || '<|im_end|>' || chr(10) ELSE '' END
    || CASE WHEN doc_id % 7 = 0 THEN '<|im_start|>system' || chr(10) || 'late<|im_end|>' || chr(10) ELSE '' END
    || '<|im_start|>assistant' || chr(10) AS rendered
  FROM log LEFT JOIN pics USING (image_id)),
sized AS (SELECT *, coalesce(given, {word_count_sql('rendered')}) + 128 AS tokens FROM turned),
converted AS (
  SELECT *, CASE WHEN broken THEN 'no_messages' WHEN image_id IS NULL THEN 'no_image_id' WHEN image IS NULL THEN 'image_not_found'
    WHEN NOT u1 AND (s1 IS NOT NULL OR s2 IS NOT NULL OR doc_id % 7 = 0) THEN 'no_user'
    WHEN tokens > 20000 THEN 'too_long' ELSE 'valid' END AS status FROM sized)"""


def _converted(t: Tables) -> DataFrame:
    return A.convert_logs(log_rows(t), A.image_map(image_listing(t)), "doc_id")


@query("log_training_rows", "D1 D2 D3 D4 D5 D6 D7 D8 D9 D10 D11 D12", f"""
WITH {LOG_SQL}
SELECT doc_id, image, CAST(tokens AS BIGINT) AS num_tokens,
  concat_ws(chr(10), 'human=' || h1, 'gpt=' || a1, 'human=' || h2) AS turns
FROM converted WHERE status = 'valid'""")
def log_training_rows(t: Tables) -> DataFrame:
    return A.training_rows(_converted(t), "doc_id").select(
        "doc_id", "image", "num_tokens",
        F.array_join(F.transform("conversations", lambda c: F.concat(c["from"], F.lit("="), c["value"])), "\n")
        .alias("turns"))


@query("log_counters", "D11 D12 D13", f"""
WITH {LOG_SQL}
SELECT count(*) AS processed, count_if(status IN ('valid', 'too_long')) AS valid,
  count_if(status = 'no_image_id') AS no_image_id, count_if(status = 'image_not_found') AS image_not_found,
  count_if(status = 'too_long') AS filtered, min(tokens) FILTER (status = 'valid') AS min_tokens,
  max(tokens) FILTER (status = 'valid') AS max_tokens
FROM converted""")
def log_counters(t: Tables) -> DataFrame:
    return A.conversion_counters(_converted(t))
