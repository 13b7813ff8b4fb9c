"""Texts as the files hold them, built from whole tables, parsed and written again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.text import word_count
from ..operators import lengths as N
from ..operators import mixing as M
from ..sources import readers as R
from ..sources import writers as W
from ..sources.stored import fresh_path
from .check_sql import word_count_sql
from .registry import Tables, query


def _doc() -> Column:
    return F.col("doc_id")


def _name() -> Column:
    return F.concat(F.lit("i"), F.col("doc_id").cast("string"))


def _samples(t: Tables) -> DataFrame:
    """Samples as the files hold them; the answer starts with the document's id."""
    turn = lambda who, text: F.struct(F.lit(who).alias("from"), text.alias("value"))
    return t.documents.select(
        F.when(_doc() % 3 == 0, F.concat(_name(), F.lit(".jpg"))).alias("image"),
        F.when(_doc() % 3 == 1, F.array(F.concat(_name(), F.lit("a.jpg")), F.concat(_name(), F.lit("b.jpg")))).alias("images"),
        F.when(_doc() % 4 == 0, F.concat(_name(), F.lit(".mp4"))).alias("video"),
        F.array(turn("human", F.col("text")), turn("gpt", F.concat(_doc().cast("string"), F.lit("]} "), "lang"))).alias("conversations"),
        F.when(_doc() % 2 == 0, _doc()).alias("num_tokens"))


def _shown(samples: DataFrame, *places: str) -> DataFrame:
    said = F.split(F.col("conversations")[1]["value"], r"\]\} ")
    return samples.select(
        said[0].cast("bigint").alias("doc_id"), *places, F.array_join("images", ",").alias("images"), F.array_join("videos", ",").alias("videos"),
        F.md5(F.col("conversations")[0]["value"].cast("binary")).alias("digest"), said[1].alias("answer"), "num_tokens")


SAMPLE_SQL = """
CASE doc_id % 3 WHEN 0 THEN 'i' || doc_id || '.jpg' WHEN 1 THEN 'i' || doc_id || 'a.jpg,i' || doc_id || 'b.jpg' ELSE '' END AS images,
CASE WHEN doc_id % 4 = 0 THEN 'i' || doc_id || '.mp4' ELSE '' END AS videos, md5(text) AS digest, lang AS answer,
CASE WHEN doc_id % 2 = 0 THEN doc_id END AS num_tokens"""


@query("sample_lines", "A2", f"SELECT doc_id, {SAMPLE_SQL} FROM documents")
def sample_lines(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "samples")
    W.write_json_lines(_samples(t), path)
    return _shown(R.read_samples(t.spark, path, lines=True))


@query("sample_arrays", "A1", f"SELECT doc_id, {SAMPLE_SQL} FROM documents")
def sample_arrays(t: Tables) -> DataFrame:
    path = fresh_path(t.spark, "samples")
    W.write_json_array(_samples(t), path)
    return _shown(R.read_samples(t.spark, path, lines=False))


def _listed(t: Tables, form: str) -> DataFrame:
    pieces = form.split("%")
    rows = _samples(t).select(F.to_json(F.struct("*")).alias("value"))
    return rows.select(F.concat(*[x for i, p in enumerate(pieces) for x in ([F.lit(p)] if i == 0 else [F.col("value"), F.lit(p)])]).alias("value"))


@query("packed_lists", "A3", f"""
SELECT doc_id, pack_id, pos_in_pack, {SAMPLE_SQL} FROM documents, (VALUES (0, 0), (0, 1), (1, 0)) p(pack_id, pos_in_pack)""")
def packed_lists(t: Tables) -> DataFrame:
    return _shown(R.parse_packs(_listed(t, "[[%, %], [%]]")), "pack_id", "pos_in_pack")


@query("code_problem_lines", "A4", """
SELECT doc_id, md5(text) AS question, 'i' || doc_id AS images, CASE WHEN doc_id % 2 = 0 THEN 'def f():' ELSE '' END AS starter_code, 'p' || doc_id AS problem_id FROM documents""")
def code_problem_lines(t: Tables) -> DataFrame:
    problem = F.struct(F.col("text").alias("question"), F.array(_name()).alias("images"), F.when(_doc() % 2 == 0, "def f():").otherwise("").alias("starter_code"),
                       F.lit("{}").alias("input_output"), F.concat(F.lit("p"), _doc().cast("string")).alias("problem_id"))
    parsed = R.parse_records(t.documents.select(_doc(), F.to_json(problem).alias("value")), S.CODE_PROBLEM)
    return parsed.select("doc_id", F.md5(F.col("question").cast("binary")).alias("question"), F.array_join("images", ",").alias("images"), "starter_code", "problem_id")


@query("log_lines", "A5", """
SELECT doc_id, md5('say "' || text || '" now,' || chr(10)) AS messages, 'o,' || chr(10) || lang AS image_payload_id, CASE WHEN doc_id % 2 = 0 THEN '12' END AS total_tokens FROM documents""")
def log_lines(t: Tables) -> DataFrame:
    path, said = fresh_path(t.spark, "log"), F.concat(F.lit('say "'), F.col("text"), F.lit('" now,\n'))
    W.write_table(t.documents.select(
        said.alias("messages"), F.concat(F.lit("o,\n"), "lang").alias("image_payload_id"), F.when(_doc() % 2 == 0, "12").alias("total_tokens"),
        _doc().alias("id")), path)
    return R.read_log(t.spark, path).select(
        F.col("id").cast("bigint").alias("doc_id"), F.md5(F.col("messages").cast("binary")).alias("messages"), "image_payload_id", "total_tokens")


@query("benchmark_lines", "A6", """
SELECT doc_id, CAST(doc_id AS VARCHAR) AS index, 'which, "' || lang || '"' || chr(10) || chr(9) || '?' AS question, md5(encode(text)) AS image FROM documents""")
def benchmark_lines(t: Tables) -> DataFrame:
    path, asked = fresh_path(t.spark, "benchmark"), F.concat(F.lit('which, "'), F.col("lang"), F.lit('"\n\t?'))
    W.write_table(t.documents.select(_doc().alias("index"), asked.alias("question"), F.base64(F.col("text").cast("binary")).alias("image")), path, separator="\t")
    return R.read_benchmark(t.spark, path).select(
        F.col("index").cast("bigint").alias("doc_id"), "index", "question", F.md5(F.unbase64("image")).alias("image"))


@query("coco_annotations", "A7", """
SELECT p_partkey, p_partkey * 10 + i AS annotation, p_name AS file_name, CASE i WHEN 0 THEN 'cat' ELSE 'dog' END AS category,
  '1.0,2.0,3.0,' || CAST(p_size AS DOUBLE) AS bbox, i AS iscrowd FROM part, (VALUES (0), (1)) x(i)""")
def coco_annotations(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    def note(i: int):
        return F.struct((k * 10 + i).alias("id"), k.alias("image_id"), F.lit(7 + i).alias("category_id"),
                        F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0), F.col("p_size").cast("double")).alias("bbox"), F.lit(6.0).alias("area"), F.lit(i).alias("iscrowd"))
    file = F.struct(
        F.array(F.struct(k.alias("id"), F.col("p_name").alias("file_name"), F.lit(5).alias("height"), F.lit(6).alias("width"))).alias("images"),
        F.array(note(0), note(1)).alias("annotations"),
        F.array(*[F.struct(F.lit(7 + i).alias("id"), F.lit(n).alias("name")) for i, n in enumerate(("cat", "dog"))]).alias("categories"))
    read = R.parse_coco(t.part.select(k, F.to_json(file).alias("value")))
    named = read["categories"].select("p_partkey", F.col("id").alias("category_id"), F.col("name").alias("category"))
    images = read["images"].select("p_partkey", F.col("id").alias("image_id"), "file_name")
    return read["annotations"].join(named, ["p_partkey", "category_id"]).join(images, ["p_partkey", "image_id"]).select(
        "p_partkey", F.col("id").alias("annotation"), "file_name", "category",
        F.array_join(F.col("bbox").cast("array<string>"), ",").alias("bbox"), "iscrowd")


@query("dataset_configs", "A8", """
SELECT s_suppkey, s_name AS name, 'cat,' || s_nationkey AS classes, '/data/' || s_suppkey AS data_root, CASE WHEN s_suppkey % 2 = 0 THEN 'a.json' END AS ann_file FROM supplier""")
def dataset_configs(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    config = F.struct(F.col("s_name").alias("name"), F.array(F.lit("cat"), F.col("s_nationkey").cast("string")).alias("classes"),
                      F.concat(F.lit("/data/"), k.cast("string")).alias("data_root"), F.when(k % 2 == 0, "a.json").alias("ann_file"))
    path = fresh_path(t.spark, "configs")
    W.write_json_lines(t.supplier.select(config.alias("c")).select("c.*"), path)
    return R.read_dataset_configs(t.spark, path).select(
        F.regexp_extract("data_root", r"(\d+)$", 1).cast("bigint").alias("s_suppkey"), "name", F.array_join("classes", ",").alias("classes"), "data_root", "ann_file")


@query("media_files", "A9", """
SELECT 'store.d/' || source || '/' || doc_id || '.b' || ['.jpg', '.PNG', '.txt', '.jpeg', ''][doc_id % 5 + 1] AS path, doc_id || '.b' AS stem, n_chars AS length
FROM documents WHERE doc_id % 5 NOT IN (2, 4)""")
def media_files(t: Tables) -> DataFrame:
    ending = F.element_at(F.array(*[F.lit(e) for e in (".jpg", ".PNG", ".txt", ".jpeg", "")]), (_doc() % 5 + 1).cast("int"))
    path = F.concat(F.lit("store.d/"), F.col("source"), F.lit("/"), _doc().cast("string"), F.lit(".b"), ending)
    return R.media_listing(t.documents.select(path.alias("path"), F.col("n_chars").alias("length")))


@query("wanted_ids", "A10", """
SELECT DISTINCT unnest(['i' || doc_id, 'i' || doc_id // 2]) AS image_id FROM labels""")
def wanted_ids(t: Tables) -> DataFrame:
    half = F.concat(F.lit("i"), F.floor(_doc() / 2).cast("string"))
    return R.parse_wanted_ids(t.labels.select(F.to_json(F.array(_name(), half)).alias("value")))


@query("camera_table", "A11", """
SELECT 'i' || doc_id AS image, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN CAST(doc_id + 0.5 AS DOUBLE) END AS fx, CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN CAST(4 AS DOUBLE) END AS cy FROM documents""")
def camera_table(t: Tables) -> DataFrame:
    camera = F.struct((_doc() + 0.5).alias("fx"), F.lit(2.0).alias("fy"), F.lit(3.0).alias("cx"), F.lit(4.0).alias("cy"))
    cameras = R.parse_cameras(t.labels.select(F.to_json(F.create_map(_name(), camera)).alias("value")))
    return R.with_cameras(t.documents.select(_name().alias("image")), cameras).select("image", "fx", "cy")


@query("stale_pages", "A12", """
SELECT 'p' || page_id AS name, CASE WHEN page_id % 5 = 0 THEN 'other' ELSE md5(html) END AS md5 FROM pages WHERE page_id % 5 = 0 OR page_id % 7 = 0""")
def stale_pages(t: Tables) -> DataFrame:
    k, name = F.col("page_id"), F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("name")
    digest = F.md5(F.col("html").cast("binary"))
    found = t.pages.where(k % 7 != 0).select(name, digest.alias("md5"))
    return R.stale(found, t.pages.select(name, F.when(k % 5 == 0, "other").otherwise(digest).alias("md5")))


@query("json_text_lines", "A13", """
SELECT '{"doc_id":' || doc_id || ',"answer":"é \\"' || lang || '\\""' || CASE WHEN doc_id % 2 = 0 THEN ',"n":' || n_chars ELSE '' END || '}' AS value FROM documents""")
def json_text_lines(t: Tables) -> DataFrame:
    path, said = fresh_path(t.spark, "lines"), F.concat(F.lit('é "'), F.col("lang"), F.lit('"')).alias("answer")
    W.write_json_lines(t.documents.select(_doc(), said, F.when(_doc() % 2 == 0, F.col("n_chars")).alias("n")), path)
    return t.spark.read.text(path)


@query("table_text_lines", "A14", """
SELECT doc_id || ',"a ""' || lang || '"", b",' || CASE WHEN doc_id % 2 = 0 THEN CAST(n_chars AS VARCHAR) ELSE '' END AS value FROM documents, (VALUES (1), (2)) twice(x)
UNION ALL SELECT 'doc_id,answer,n'""")
def table_text_lines(t: Tables) -> DataFrame:
    path, said = fresh_path(t.spark, "table"), F.concat(F.lit('a "'), F.col("lang"), F.lit('", b')).alias("answer")
    rows = t.documents.select(_doc(), said, F.when(_doc() % 2 == 0, F.col("n_chars")).alias("n"))
    for _ in range(2):
        W.write_table(rows, path, mode="append")
    return t.spark.read.text(path).select("value")


@query("clean_texts", "A16", "SELECT doc_id, md5(regexp_replace(text, '[\\x00-\\x08\\x0B-\\x0C\\x0E-\\x1F]', '', 'g') || lang) AS digest, n_chars FROM documents")
def clean_texts(t: Tables) -> DataFrame:
    dirty = F.concat(F.lit("\x01"), F.col("text"), F.lit("\x0b\x1f"), F.col("lang"), F.lit("\x00")).alias("text")
    cleaned = W.without_control_characters(t.documents.select(_doc(), dirty, "n_chars"))
    return cleaned.select(_doc(), F.md5(F.col("text").cast("binary")).alias("digest"), "n_chars")


@query("image_contents", "A17", """
SELECT doc_id || '.jpg' AS path, md5(text) AS digest FROM documents
UNION ALL SELECT unnest([doc_id || '_a.png', doc_id || '_b.png']), md5(unnest([text, lang])) FROM documents WHERE doc_id % 3 = 0""")
def image_contents(t: Tables) -> DataFrame:
    cell = lambda c: F.base64(F.col(c).cast("binary"))
    name = lambda tail: F.concat(_doc().cast("string"), F.lit(tail))
    one = W.encoded_images(t.documents.select(_doc(), cell("text").alias("image")), "doc_id", "image")
    many = t.documents.where(_doc() % 3 == 0).select(_doc(), F.array(cell("text"), cell("lang")).alias("image"), F.array(name("_a.png"), name("_b.png")).alias("paths"))
    return one.unionByName(W.encoded_images(many, "doc_id", "image", "paths")).select("path", F.md5("content").alias("digest"))


@query("reused_counts", "A18", f"""
SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 1000000 ELSE {word_count_sql('text')} END AS num_tokens FROM documents""")
def reused_counts(t: Tables) -> DataFrame:
    known = t.documents.where(_doc() % 3 == 0).select(_doc(), F.lit(1000000).cast("bigint").alias("num_tokens"))
    return N.counted_once(t.documents.select(_doc(), "text"), known, "doc_id",
                          lambda fresh: fresh.select(_doc(), word_count(F.col("text")).cast("bigint").alias("num_tokens")))


@query("tagged_datasets", "B4", """
SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '/data/even' ELSE '/data/odd' END AS data_path, CASE WHEN doc_id % 2 = 1 THEN lang END AS lang FROM documents""")
def tagged_datasets(t: Tables) -> DataFrame:
    odd = t.documents.where(_doc() % 2 == 1).select(_doc(), "lang")
    return M.concatenate({"/data/even": t.documents.where(_doc() % 2 == 0).select(_doc()), "/data/odd": odd}).select(_doc(), "data_path", "lang")
