"""Mixing, packing and training features over documents and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import word_count, words
from ..operators import features as X
from ..operators import lengths as N
from ..operators import mixing as M
from ..operators import packing as P
from ..operators.ordinal import with_global_ordinal
from .check_sql import RE_SPACES, word_count_sql
from .registry import Tables, query

SEED = 7


def _mix(t: Tables, *columns) -> DataFrame:
    """Samples as narrow rows: what is needed of a text is computed before anything is shuffled."""
    rows = t.spread("documents", "doc_id", "source", "text") if columns else t.documents
    return rows.select("doc_id", F.col("source").alias("dataset"), *columns)


def _requests(t: Tables) -> DataFrame:
    n = F.regexp_extract("dataset", r"(\d+)$", 1).cast("int")
    names = _mix(t).select("dataset").distinct()
    suffix = F.when(n % 5 == 0, "").otherwise(F.concat(F.lit("%"), ((n * 7) % 150).cast("string")))
    return names.select(F.concat("dataset", suffix).alias("request"))


def _registry(t: Tables) -> DataFrame:
    return _mix(t).select("dataset").distinct().select(
        "dataset", F.concat(F.lit("/ann/"), "dataset", F.lit(".json")).alias("annotation_path"),
        F.concat(F.lit("/data/"), "dataset").alias("data_path"))


def _rates(t: Tables) -> DataFrame:
    return M.resolve_requests(_requests(t), _registry(t))


MIX_SQL = f"""
rates AS (SELECT DISTINCT source AS dataset, CASE WHEN CAST(regexp_extract(source, '(\\d+)$', 1) AS INT) % 5 = 0 THEN 1.0::DOUBLE
   ELSE ((CAST(regexp_extract(source, '(\\d+)$', 1) AS INT) * 7) % 150)::DOUBLE / 100 END AS rate FROM documents),
ranked AS (SELECT doc_id, source AS dataset, text, md5('{SEED}:' || doc_id) AS hk,
   row_number() OVER (PARTITION BY source ORDER BY md5('{SEED}:' || doc_id), doc_id) AS r, count(*) OVER (PARTITION BY source) AS n FROM documents),
mixed AS (SELECT ranked.* FROM ranked JOIN rates USING (dataset) WHERE r <= CASE WHEN rate < 1 THEN floor(n * rate) ELSE n END),
ordered AS (SELECT *, row_number() OVER (ORDER BY hk, doc_id) AS ordinal FROM mixed)"""


def _mixed(t: Tables, *columns) -> DataFrame:
    return M.sample_exact(_mix(t, *columns), _rates(t), "doc_id", SEED)


def _ordered(t: Tables, *columns) -> DataFrame:
    return M.sample_exact(_mix(t, *columns), _rates(t), "doc_id", SEED, ordinal="ordinal")


@query("dataset_requests", "B1 B2", f"""
WITH {MIX_SQL} SELECT dataset, round(rate, 6) AS rate, '/data/' || dataset AS data_path FROM rates""")
def dataset_requests(t: Tables) -> DataFrame:
    return _rates(t).select("dataset", F.round("rate", 6).alias("rate"), "data_path")


@query("mixture_sample", "B3", f"""
WITH {MIX_SQL} SELECT doc_id, dataset, '/data/' || dataset AS data_path, md5(text) AS digest FROM mixed""")
def mixture_sample(t: Tables) -> DataFrame:
    paths = _rates(t).select("dataset", "data_path")
    digest = F.md5(F.col("text").cast("binary")).alias("digest")
    return _mixed(t, digest).join(paths, "dataset").select("doc_id", "dataset", "data_path", "digest")


@query("shuffled_mixture", "B5", f"WITH {MIX_SQL} SELECT doc_id, ordinal FROM ordered")
def shuffled_mixture(t: Tables) -> DataFrame:
    return M.shuffled(_mixed(t), "doc_id", SEED).select("doc_id", "ordinal")


@query("dataset_counts", "B6", f"""
WITH {MIX_SQL} SELECT dataset, count(*) AS rows FROM mixed GROUP BY ROLLUP (dataset)""")
def dataset_counts(t: Tables) -> DataFrame:
    return M.dataset_counts(_mixed(t))


@query("first_rows", "B7", "SELECT doc_id, source FROM documents ORDER BY source, doc_id LIMIT 25")
def first_rows(t: Tables) -> DataFrame:
    return M.head(t.documents.select("doc_id", "source"), ["source", "doc_id"], 25)


def _packed(t: Tables) -> DataFrame:
    counted = _ordered(t, word_count(F.col("text")).alias("num_tokens"))
    return P.pack(counted, "ordinal", "num_tokens", "doc_id")


#: Best fit in falling order of length, an item of every batch a step; a batch's packs are the list of rooms left.
PACK_SQL = f"""
{MIX_SQL},
items AS (SELECT doc_id, n AS num_tokens, batch, row_number() OVER (PARTITION BY batch ORDER BY n DESC, ordinal) AS i FROM (
  SELECT doc_id, ordinal, (ordinal - 1) // 256 AS batch, CAST({word_count_sql('text')} AS BIGINT) AS n FROM ordered)),
run AS (
  SELECT batch, 0::BIGINT AS i, []::BIGINT[] AS rooms, -1::BIGINT AS pack FROM (SELECT DISTINCT batch FROM items)
  UNION ALL
  SELECT batch, i, CASE WHEN spot IS NULL THEN list_append(rooms, greatest(4096, n) - n)
      ELSE list_concat(rooms[1:spot - 1], [rooms[spot] - n], rooms[spot + 1:]) END,
    coalesce(spot - 1, len(rooms)) FROM (
      SELECT run.batch, items.i, rooms, items.num_tokens AS n,
        list_position(rooms, list_min([r for r in rooms if r >= items.num_tokens])) AS spot
      FROM run JOIN items ON items.batch = run.batch AND items.i = run.i + 1)),
pk AS (SELECT doc_id, num_tokens, batch, pack, row_number() OVER (PARTITION BY batch, pack ORDER BY i) - 1 AS position
  FROM run JOIN items USING (batch, i))"""


@query("packing", "E7", f"WITH RECURSIVE {PACK_SQL} SELECT doc_id, num_tokens, batch, pack, position FROM pk")
def packing(t: Tables) -> DataFrame:
    return _packed(t)


@query("packing_report", "E8", f"""
WITH RECURSIVE {PACK_SQL}, packs AS (SELECT batch, pack, count(*) AS s, sum(num_tokens) AS n FROM pk GROUP BY ALL)
SELECT count(*) AS packs, CAST(sum(s) AS BIGINT) AS samples, CAST(sum(n) AS BIGINT) AS tokens, count_if(n > 4096 AND s > 1) AS overfull,
  round(sum(n) / (count(*) * 4096), 6) AS fill FROM packs""")
def packing_report(t: Tables) -> DataFrame:
    return P.packing_report(_packed(t))


@query("packing_batches", "E7", f"""
WITH {MIX_SQL}
SELECT (ordinal - 1) // 256 AS batch, count(*) AS samples, CAST(sum({word_count_sql('text')}) AS BIGINT) AS tokens, CAST(0 AS BIGINT) AS overfull
FROM ordered GROUP BY 1""")
def packing_batches(t: Tables) -> DataFrame:
    packs = _packed(t).groupBy("batch", "pack").agg(F.count("*").alias("s"), F.sum("num_tokens").alias("n"))
    return packs.groupBy("batch").agg(
        F.sum("s").alias("samples"), F.sum("n").alias("tokens"),
        F.count_if((F.col("n") > P.CAPACITY) & (F.col("s") > 1)).alias("overfull"))


# --- token arrays: word lengths stand in for token ids ----------------------------

def _ids(text):
    return F.transform(words(text), lambda w: (F.length(w) + 100).cast("bigint"))


def _ids_sql(text: str) -> str:
    return f"list_transform(regexp_extract_all({text}, '[^{RE_SPACES}]+'), lambda w: length(w) + 100)"


def _digest(array):
    return F.md5(F.array_join(array.cast("array<string>"), ",").cast("binary"))


def _digest_sql(array: str) -> str:
    return f"md5(coalesce(list_aggregate({array}, 'string_agg', ','), ''))"


def _turn_ids(t: Tables) -> DataFrame:
    mark = lambda *v: F.array(*[F.lit(x).cast("bigint") for x in v])
    reply = F.when(F.col("doc_id") % 7 == 0, F.concat(F.lit("Reply "), "lang"))
    return t.spread("documents", "doc_id", "text", "lang", "source").select("doc_id", F.concat(
        mark(151644, 872, 198), _ids(F.col("text")), mark(151645, 198),
        mark(151644, 77091, 198), _ids(F.concat("source", F.lit(" says "), "lang")),
        F.when(F.col("doc_id") % 5 == 0, mark()).otherwise(mark(151645, 198)),
        F.when(reply.isNotNull(), F.concat(mark(151644, 77091, 198), _ids(reply), mark(151645, 198))).otherwise(mark()),
    ).alias("ids"))


IDS_SQL = f"""
parts AS (SELECT doc_id, {_ids_sql('text')} AS u, {_ids_sql("source || ' says ' || lang")} AS a,
   CASE WHEN doc_id % 7 = 0 THEN {_ids_sql("'Reply ' || lang")} END AS b, doc_id % 5 = 0 AS open FROM documents),
seq AS (SELECT doc_id,
  list_concat([151644, 872, 198], u, [151645, 198, 151644, 77091, 198], a, CASE WHEN open THEN [] ELSE [151645, 198] END,
     CASE WHEN b IS NULL THEN [] ELSE list_concat([151644, 77091, 198], b, [151645, 198]) END) AS ids,
  list_concat(list_transform(range(len(u) + 8), lambda i: -100),
     CASE WHEN open AND b IS NULL THEN list_transform(a, lambda i: -100) ELSE a END,
     CASE WHEN open THEN [] ELSE [151645, 198] END,
     CASE WHEN b IS NULL THEN [] ELSE list_concat(CASE WHEN open THEN [151644, 77091, 198] ELSE [-100, -100, -100] END, b, [151645, 198]) END) AS labels
  FROM parts)"""


def _labelled(t: Tables) -> DataFrame:
    return _turn_ids(t).withColumn("labels", X.label_mask(F.col("ids")))


@query("label_masks", "E9", f"""
WITH {IDS_SQL} SELECT doc_id, CAST(len(ids) AS BIGINT) AS tokens, {_digest_sql('ids')} AS ids_digest, {_digest_sql('labels')} AS labels_digest FROM seq""")
def label_masks(t: Tables) -> DataFrame:
    return _labelled(t).select("doc_id", F.size("ids").cast("bigint").alias("tokens"),
                               _digest(F.col("ids")).alias("ids_digest"), _digest(F.col("labels")).alias("labels_digest"))


@query("padded_batches", "E18", f"""
WITH {IDS_SQL},
b AS (SELECT *, doc_id // 8 AS batch, least(max(len(ids)) OVER (PARTITION BY doc_id // 8), 1024) AS width FROM seq),
p AS (SELECT *, greatest(width - len(ids), 0) AS gap FROM b)
SELECT doc_id, {_digest_sql('list_concat(ids, list_transform(range(gap), lambda i: 151643))[1:width]')} AS ids_digest,
  {_digest_sql('list_concat(labels, list_transform(range(gap), lambda i: -100))[1:width]')} AS labels_digest,
  {_digest_sql('list_concat(range(len(ids)), list_transform(range(gap), lambda i: 1))[1:width]')} AS positions_digest,
  CAST(least(len(ids), width) AS BIGINT) AS attended FROM p""")
def padded_batches(t: Tables) -> DataFrame:
    batched = _labelled(t).withColumn("batch", F.floor(F.col("doc_id") / 8))
    padded = P.pad_batches(batched, "batch", "ids", "labels", 151643, 1024)
    return padded.select(
        "doc_id", _digest(F.col("padded_ids")).alias("ids_digest"), _digest(F.col("padded_labels")).alias("labels_digest"),
        _digest(F.col("padded_positions")).alias("positions_digest"),
        F.size(F.filter("attention", lambda a: a)).cast("bigint").alias("attended"))


@query("packed_sequences", "E16 E17", f"""
WITH {IDS_SQL},
g AS (SELECT doc_id // 4 AS pack, flatten(list(ids ORDER BY doc_id)) AS ids, flatten(list(labels ORDER BY doc_id)) AS labels, list(len(ids) ORDER BY doc_id) AS lens FROM seq GROUP BY 1)
SELECT pack, {_digest_sql('ids')} AS ids_digest, {_digest_sql('labels')} AS labels_digest, list_aggregate(lens, 'string_agg', ',') AS lengths,
  list_aggregate(list_transform(range(len(lens) + 1), lambda i: CAST(coalesce(list_sum(lens[1:i]), 0) AS BIGINT)), 'string_agg', ',') AS bounds FROM g""")
def packed_sequences(t: Tables) -> DataFrame:
    rows = _labelled(t).withColumn("pack", F.floor(F.col("doc_id") / 4))
    joined = P.concatenate_packs(rows, ["pack"], "doc_id", "ids", "labels")
    text = lambda a: F.array_join(a.cast("array<string>"), ",")
    return joined.select(
        "pack", _digest(F.col("ids")).alias("ids_digest"), _digest(F.col("labels")).alias("labels_digest"),
        text(F.col("lengths")).alias("lengths"), text(P.sequence_bounds(F.col("lengths"))).alias("bounds"))


# --- positions ----------------------------------------------------------------------

def _segments(t: Tables) -> DataFrame:
    k = F.col("turn")
    vision = k % 3 == 1
    grid = lambda v: F.when(vision, v.cast("int"))
    return t.conversations.select(
        "conv_id", "turn", F.when(~vision, word_count(F.col("text"))).alias("n"),
        grid(1 + F.col("conv_id") % 4).alias("t"), grid(2 + k % 3).alias("h"), grid(1 + F.col("conv_id") % 5).alias("w"),
        F.when(F.col("conv_id") % 2 == 0, 0.0).otherwise(1.5).alias("spg"))


def _positions_sql(advance: str, time: str, grids: str = "segs") -> str:
    return f"""
segs AS (SELECT conv_id, turn, 1 AS frame, CASE WHEN turn % 3 <> 1 THEN {word_count_sql('text')} END AS n,
   CASE WHEN turn % 3 = 1 THEN 1 + conv_id % 4 END AS t, CASE WHEN turn % 3 = 1 THEN 2 + turn % 3 END AS h, CASE WHEN turn % 3 = 1 THEN 1 + conv_id % 5 END AS w,
   CASE WHEN conv_id % 2 = 0 THEN 0.0 ELSE 1.5 END AS spg FROM conversations),
single AS (SELECT conv_id, turn, f.frame, n, CASE WHEN t IS NOT NULL THEN 1 END AS t, h, w, spg FROM segs, LATERAL (SELECT unnest(range(1, coalesce(t, 1) + 1)) AS frame) f),
off AS (SELECT *, coalesce(sum({advance}) OVER (PARTITION BY conv_id ORDER BY turn, frame ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS o FROM {grids}),
tok AS (SELECT *, j.j AS j FROM off, LATERAL (SELECT unnest(range(coalesce(n, t * h * w))) AS j) j),
pos AS (SELECT conv_id, turn, frame, j AS token, CAST(o + CASE WHEN n IS NOT NULL THEN j ELSE {time} END AS BIGINT) AS pos_t,
   CAST(o + CASE WHEN n IS NOT NULL THEN j ELSE (j // w) % h END AS BIGINT) AS pos_h, CAST(o + CASE WHEN n IS NOT NULL THEN j ELSE j % w END AS BIGINT) AS pos_w FROM tok)"""


GRID_ADVANCE = "coalesce(n, greatest(t, h, w))"
TIMED_ADVANCE = "coalesce(n, greatest(CAST(trunc((t - 1) * spg * 2) AS BIGINT), h - 1, w - 1) + 1)"


@query("grid_positions", "E10", f"""
WITH {_positions_sql(GRID_ADVANCE, 'j // (h * w)')} SELECT conv_id, turn, token, pos_t, pos_h, pos_w FROM pos""")
def grid_positions(t: Tables) -> DataFrame:
    return X.position_rows(_segments(t), "conv_id", ["turn"])


@query("timed_positions", "E11 E15", f"""
WITH {_positions_sql(TIMED_ADVANCE, 'CAST(trunc((j // (h * w)) * spg * 2) AS BIGINT)')} SELECT conv_id, turn, token, pos_t, pos_h, pos_w FROM pos""")
def timed_positions(t: Tables) -> DataFrame:
    per_grid = X.seconds_per_grid(F.lit(2.0) / 1.5)[0]
    spg = F.when(F.col("spg") > 0, per_grid).otherwise(F.col("spg"))
    return X.position_rows(_segments(t), "conv_id", ["turn"], spg)


@query("frame_positions", "E12", f"""
WITH {_positions_sql(GRID_ADVANCE, 'j // (h * w)', 'single')} SELECT conv_id, turn, frame, token, pos_t, pos_h, pos_w FROM pos""")
def frame_positions(t: Tables) -> DataFrame:
    return X.position_rows(X.split_video_grids(_segments(t)), "conv_id", ["turn", "frame"])


@query("position_deltas", "E14", f"""
WITH {_positions_sql(GRID_ADVANCE, 'j // (h * w)')}
SELECT conv_id, max(greatest(pos_t, pos_h, pos_w)) + 1 - count(*) AS delta FROM pos GROUP BY conv_id""")
def position_deltas(t: Tables) -> DataFrame:
    return X.position_deltas(_segments(t), "conv_id")


@query("masked_positions", "E13", """
WITH m AS (SELECT user_id, event_id, CASE WHEN event_id % 7 = 0 THEN 0 ELSE 1 END AS mask FROM events)
SELECT user_id, event_id, CAST(CASE WHEN mask = 0 THEN 1 ELSE sum(mask) OVER (PARTITION BY user_id ORDER BY event_id) - 1 END AS BIGINT) AS text_position FROM m""")
def masked_positions(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", "event_id", F.when(F.col("event_id") % 7 == 0, 0).otherwise(1).alias("mask"))
    return X.masked_positions(rows, "user_id", "event_id", "mask").select("user_id", "event_id", "text_position")


# --- row policy ------------------------------------------------------------------------

@query("bad_sample_rows", "E3 E19", """
WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS ordinal, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE n_chars END AS num_tokens,
   doc_id % 29 = 3 AS failed FROM documents)
SELECT a.ordinal, b.ordinal AS source_ordinal, b.doc_id, coalesce(b.num_tokens, 1) AS length
FROM o a JOIN o b ON b.ordinal = CASE WHEN a.failed THEN a.ordinal + 1 ELSE a.ordinal END""")
def bad_sample_rows(t: Tables) -> DataFrame:
    k = F.col("doc_id")
    rows = t.documents.select(k, F.when(k % 11 != 0, F.col("n_chars")).alias("num_tokens"))
    kept = P.with_substitutes(with_global_ordinal(rows, [k]), "ordinal", k % 29 == 3, "SUBSTITUTE_NEXT")
    return kept.select("ordinal", "source_ordinal", "doc_id", N.length_or_one(F.col("num_tokens")).alias("length"))


@query("epoch_plan", "E20", f"""
WITH {MIX_SQL} SELECT count(*) AS samples, count(*) // 32 AS steps_per_epoch, count(*) // 32 * 3 AS total_steps FROM mixed""")
def epoch_plan(t: Tables) -> DataFrame:
    return P.epoch_plan(_mixed(t), 4, 4, 2, 3)
