"""Question benchmarks over customers (options) and line items (values)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import answers as A
from ..functions import choices as C
from ..functions import questions as T
from ..operators import qa as Q
from .check_sql import RE_SPACES
from .prompt_queries import sql_text
from .registry import Tables, query

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def benchmark(t: Tables) -> DataFrame:
    """Options A to E; every ninth question is open, every fourth lacks D."""
    option = {x: F.lit(s) for x, s in zip("ABCDE", SEGMENTS)}
    is_open = F.col("c_custkey") % 9 == 0
    shown = {x: F.when(~is_open & ((F.col("c_custkey") % 4 != 0) | F.lit(x != "D")), v) for x, v in option.items()}
    gold = F.element_at(F.array(*[F.lit(x) for x in "ABCDE"]), (F.col("c_custkey") % 5 + 1).cast("int"))
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("index"), F.concat(F.lit("Which segment is "), "c_name").alias("question"),
        *[v.alias(x) for x, v in shown.items()],
        F.when(is_open, F.concat(F.lit("open "), F.col("c_custkey").cast("string"))).otherwise(gold).alias("answer"),
        F.when(F.col("c_custkey") % 6 == 0, F.concat(F.lit("nation "), F.col("c_nationkey").cast("string"))).alias("hint"),
        F.when(F.col("c_nationkey") < 20, F.concat(F.lit("s"), F.col("c_nationkey").cast("string"))).alias("split"))


def records(t: Tables) -> DataFrame:
    """Nested prediction records; every 50th names no benchmark question."""
    gold = F.element_at(F.array(*[F.lit(x) for x in "ABCDE"]), (F.col("c_custkey") % 5 + 1).cast("int"))
    low = F.element_at(F.array(*[F.lit(x) for x in "ABC"]), (F.col("c_custkey") % 3 + 1).cast("int"))
    segment = F.col("c_mktsegment")
    said = (
        F.when(F.col("c_custkey") % 8 == 0, F.when(F.col("c_custkey") % 16 < 8, gold).otherwise("C"))
        .when(F.col("c_custkey") % 8 == 1, F.concat(F.lit("The answer is ("), low, F.lit(").")))
        .when(F.col("c_custkey") % 8 == 2, F.concat(F.lit("I think it is "), segment, F.lit(" surely")))
        .when(F.col("c_custkey") % 8 == 3, "Sorry, I can't help with images of people yet.")
        .when(F.col("c_custkey") % 8 == 4, "A or B")
        .when(F.col("c_custkey") % 8 == 5, "Failed to obtain answer via API: x")
        .when(F.col("c_custkey") % 8 == 6, F.concat(F.lit("A man holds "), F.lower(segment), F.lit(" today")))
        .otherwise(F.when(F.col("c_custkey") % 16 == 7, "Z").otherwise("none of these")))
    raw = F.concat(F.when(F.col("c_custkey") % 2 == 0, "<think>maybe E</think>\n ").otherwise(""), said, F.lit(" \n"))
    index = F.when(F.col("c_custkey") % 50 == 49, F.concat(F.lit("x"), F.col("c_custkey").cast("string"))).otherwise(F.col("c_custkey").cast("string"))
    return t.customer.select(
        F.struct(index.alias("index"), F.struct(A.strip_reasoning(raw).alias("gen"), raw.alias("gen_raw")).alias("result"),
                 index.alias("question_id")).alias("r")).select(
        F.col("r.question_id").alias("question_id"), F.struct(F.col("r.index").alias("index")).alias("annotation"),
        F.col("r.result").alias("result"))


def judge(t: Tables) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    answer = lambda n, text: F.struct(F.lit(n).alias("attempt"), text.alias("text"))
    return t.customer.select(k.alias("index"), F.explode(F.array(
        answer(0, F.lit("Failed to obtain answer via API, building")),
        answer(1, F.when(F.col("c_custkey") % 3 == 0, "B").otherwise("unclear")),
        answer(2, F.when(F.col("c_custkey") % 3 == 1, "Z").otherwise(F.concat(F.lit("maybe "), F.lower("c_mktsegment")))),
    )).alias("j")).select("index", "j.*")


QA_SQL = f"""
q0 AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS index, c_name, c_mktsegment AS seg, c_nationkey,
    c_custkey % 9 = 0 AS is_open, ['A','B','C','D','E'][c_custkey % 5 + 1] AS g FROM customer),
q1 AS (SELECT *, CASE WHEN is_open THEN 'open ' || k ELSE g END AS answer,
   CASE WHEN is_open THEN 'open ' || k ELSE 'AUTOMOBILE' END AS A, CASE WHEN is_open THEN 'Other Answers' ELSE 'BUILDING' END AS B,
   CASE WHEN NOT is_open THEN 'FURNITURE' END AS C, CASE WHEN NOT is_open AND k % 4 <> 0 THEN 'HOUSEHOLD' END AS D,
   CASE WHEN NOT is_open THEN 'MACHINERY' END AS E,
   CASE WHEN is_open THEN 'A' ELSE g END AS gt,
   CASE WHEN c_nationkey < 20 THEN 's' || c_nationkey END AS split,
   CASE k % 8 WHEN 0 THEN CASE WHEN k % 16 < 8 THEN g ELSE 'C' END WHEN 1 THEN 'The answer is (' || ['A','B','C'][k % 3 + 1] || ').'
     WHEN 2 THEN 'I think it is ' || seg || ' surely' WHEN 3 THEN 'Sorry, I can''t help with images of people yet.' WHEN 4 THEN 'A or B'
     WHEN 5 THEN 'Failed to obtain answer via API: x' WHEN 6 THEN 'A man holds ' || lower(seg) || ' today'
     ELSE CASE WHEN k % 16 = 7 THEN 'Z' ELSE 'none of these' END END AS prediction FROM q0),
q2 AS (SELECT *, list_filter([('A', A), ('B', B), ('C', C), ('D', D), ('E', E)], lambda o: o[2] IS NOT NULL) AS opts FROM q1)"""


def rule_sql(source: str, name: str, text: str) -> str:
    """CTE with the rule's letter for ``text`` over the list ``opts``."""
    return f"""
{name}_t AS (SELECT *, regexp_extract_all(translate({text}, '.()[],:;!*#{{}}', '            '), '[^{RE_SPACES}]+') AS toks_ FROM {source}),
{name}_n AS (SELECT *, list_filter(opts, lambda o: list_contains(toks_, o[1])) AS named_, list_filter(opts, lambda o: contains(lower({text}), lower(o[2]))) AS held_ FROM {name}_t),
{name}_l AS (SELECT *, CASE WHEN contains({text}, 'Failed to obtain answer via API') THEN NULL
   WHEN contains({text}, 'Sorry, I can''t help with images of people yet.') OR contains({text}, 'I can''t process this file.')
     OR contains({text}, 'I''m sorry, but without the image provided') OR contains({text}, 'Cannot determine the answer') THEN 'Z'
   WHEN len(named_) = 1 THEN CASE WHEN list_contains(toks_, 'A') AND len(toks_) > 3 THEN NULL ELSE named_[1][1] END
   WHEN len(named_) = 0 AND list_contains(toks_, 'Z') THEN 'Z' END AS by_letter_ FROM {name}_n),
{name} AS (SELECT * EXCLUDE (toks_, named_, held_, by_letter_), coalesce(by_letter_, CASE WHEN len(held_) = 1 THEN held_[1][1] END) AS {name}_letter,
   by_letter_ AS {name}_by_letter, CASE WHEN len(held_) = 1 THEN held_[1][1] END AS {name}_by_text FROM {name}_l)"""


def _questions(t: Tables) -> DataFrame:
    prepared = Q.open_to_choice(benchmark(t))
    options = C.options_map({x: F.col(x) for x in "ABCDE"})
    predicted = Q.load_predictions(records(t))
    return predicted.join(prepared.select("index", "split", "question", options.alias("options")), "index")


@query("option_rules", "G1 H4 H8 H11 H13 H14 H15", f"""
WITH {QA_SQL}, {rule_sql('q2', 'r', 'prediction')}
SELECT index, prediction, r_by_letter AS by_letter, r_by_text AS by_text, r_letter AS letter FROM r WHERE k % 50 <> 49""")
def option_rules(t: Tables) -> DataFrame:
    p, o = F.col("prediction"), F.col("options")
    return _questions(t).select("index", "prediction", C.option_letter(p, o).alias("by_letter"),
                                C.option_by_text(p, o).alias("by_text"), C.infer_option(p, o).alias("letter"))


SCORED_SQL = f"""
{QA_SQL}, {rule_sql('q2', 'r', 'prediction')},
j0 AS (SELECT k, opts, 1 AS attempt, CASE WHEN k % 3 = 0 THEN 'B' ELSE 'unclear' END AS txt FROM r WHERE r_letter IS NULL
  UNION ALL SELECT k, opts, 2, CASE WHEN k % 3 = 1 THEN 'Z' ELSE 'maybe ' || lower(seg) END FROM r WHERE r_letter IS NULL),
{rule_sql('j0', 'jr', 'txt')},
judged AS (SELECT k, arg_min(jr_letter, attempt) AS jl FROM jr WHERE jr_letter IS NOT NULL AND jr_letter <> 'Z' GROUP BY k),
picked AS (SELECT r.*, jl, list_concat(list_transform(opts, lambda o: o[1]), ['Z']) AS pool, ('0x' || substr(md5('0:' || index), 1, 8))::BIGINT AS h FROM r LEFT JOIN judged USING (k) WHERE k % 50 <> 49),
scored AS (SELECT *, coalesce(r_letter, jl, pool[h % len(pool) + 1]) AS extracted_answer,
  CASE WHEN r_letter IS NOT NULL THEN 'rule' WHEN jl IS NOT NULL THEN 'judge' ELSE 'random' END AS extraction_method,
  CASE WHEN r_letter IS NOT NULL THEN r_letter <> 'Z' ELSE jl IS NOT NULL END AS extraction_success FROM picked),
hits AS (SELECT *, CASE WHEN extracted_answer = gt THEN 1 ELSE 0 END AS hit FROM scored)"""


def _scored(t: Tables) -> DataFrame:
    extracted = Q.extract_options(_questions(t), judge(t), "index")
    return Q.scored(extracted, Q.gold_answers(Q.open_to_choice(benchmark(t))))


@query("question_scores", "H8 H11 H12 H17 H18 H19", f"""
WITH {SCORED_SQL} SELECT index, split, extracted_answer, extraction_method, extraction_success, gt, CAST(hit AS BIGINT) AS hit FROM hits""")
def question_scores(t: Tables) -> DataFrame:
    return _scored(t).select("index", "split", "extracted_answer", "extraction_method", "extraction_success", "gt", "hit")


@query("question_accuracy", "H20", f"""
WITH {SCORED_SQL}, f AS (SELECT coalesce(split, 'unknown') AS split, hit FROM hits)
SELECT split, count(*) AS questions, CAST(sum(hit) AS BIGINT) AS hits, round(avg(hit), 6) AS accuracy FROM f GROUP BY ROLLUP (split)""")
def question_accuracy(t: Tables) -> DataFrame:
    return Q.accuracy(_scored(t))


@query("accuracy_summary", "A15 H20", f"""
WITH {SCORED_SQL}, f AS (SELECT coalesce(split, 'unknown') AS split, hit FROM hits),
s AS (SELECT split, round(avg(hit), 6) AS a FROM f GROUP BY split)
SELECT '{{"overall_accuracy":' || (SELECT round(avg(hit), 6) FROM f) || ',"accuracy_by_split":{{' || string_agg('"' || split || '":' || a, ',' ORDER BY split) || '}}}}' AS summary FROM s""")
def accuracy_summary(t: Tables) -> DataFrame:
    return Q.summary_json(Q.accuracy(_scored(t)))


@query("foreign_predictions", "H10", """
SELECT 'x' || c_custkey AS index FROM customer WHERE c_custkey % 50 = 49""")
def foreign_predictions(t: Tables) -> DataFrame:
    return Q.foreign_predictions(Q.load_predictions(records(t)), benchmark(t)).select("index")


def _task_and_rest(prompt, begin):
    """The fixed task ahead of what a prompt asks, as the digest of its published text, and the prompt from there on."""
    task = F.split_part(prompt, begin, F.lit(1))
    return F.md5(task.cast("binary")).alias("judge_task"), F.substring(prompt, F.length(task) + 1, F.length(prompt)).alias("judge_prompt")


@query("question_prompts", "H4 H5 H6 H7 H9 H16", f"""
WITH {QA_SQL},
p AS (SELECT *, list_filter([('A', CASE WHEN is_open THEN NULL ELSE A END), ('B', CASE WHEN is_open THEN NULL ELSE B END), ('C', C), ('D', D), ('E', E)], lambda o: o[2] IS NOT NULL) AS raw_opts,
   'Which segment is ' || c_name AS question FROM q2),
l AS (SELECT *, coalesce(list_aggregate(list_transform(raw_opts, lambda o: o[1] || '. ' || o[2] || chr(10)), 'string_agg', ''), '') AS lines FROM p),
m AS (SELECT *, CASE WHEN k % 6 = 0 THEN 'Hint: nation ' || c_nationkey || chr(10) ELSE '' END || 'Question: ' || question || chr(10)
   || CASE WHEN len(raw_opts) > 0 THEN 'Options:' || chr(10) || lines || 'Please select the correct answer from the options above. ' || chr(10) ELSE '' END AS prompt FROM l)
SELECT index, prompt, 'image:file://' || index || '.jpg:1003520:4014080|text:' || rtrim(prompt, chr(10) || ' ') || ' Think.' AS items,
  '074d3989b6b489fc94f68372687fa382' AS judge_task, 'Question: ' || question || '?' || chr(10) || 'Options: There are several options: ' || chr(10) || lines || chr(10) || 'Answer: ' || seg || chr(10) || 'Your output: ' AS judge_prompt
FROM m""")
def question_prompts(t: Tables) -> DataFrame:
    renamed = Q.unify_names(benchmark(t).withColumnRenamed("hint", "Hint").withColumnRenamed("index", "Index"))
    options = C.options_map({x: F.col(x) for x in "ABCDE"})
    segment = t.customer.select(F.col("c_custkey").cast("string").alias("index"), "c_mktsegment")
    q = renamed.join(segment, "index").withColumn("options", options)
    question, hint = F.col("question"), F.col("hint")
    items = T.request_items(
        F.array(F.concat("index", F.lit(".jpg"))), T.choice_prompt(question, F.col("options"), hint),
        1280 * 28 * 28, 5120 * 28 * 28, "file://", " Think.")
    shown = F.array_join(F.transform(items, lambda e: F.concat_ws(
        ":", e["type"], e["value"], e["min_pixels"].cast("string"), e["max_pixels"].cast("string"))), "|")
    return q.select(
        "index", T.choice_prompt(question, F.col("options"), hint, strip_tail=False).alias("prompt"),
        shown.alias("items"), *_task_and_rest(T.choice_judge_prompt(question, F.col("options"), F.col("c_mktsegment")), F.concat(F.lit("Question: "), question)))


@query("benchmark_rows", "H1 H2 H3", """
SELECT CAST(c_custkey AS VARCHAR) AS index, c_custkey AS number,
  md5(repeat(CASE WHEN c_custkey % 5 = 4 THEN (SELECT n.c_name FROM customer n WHERE n.c_custkey = c.c_custkey - 1) ELSE c_name END, 5)) AS image_digest,
  CASE WHEN c_custkey % 3 = 0 THEN c_custkey || 'a.jpg,' || c_custkey || 'b.jpg' WHEN c_custkey % 3 = 1 THEN 'it''s ' || c_custkey || ',2' ELSE c_custkey || '.jpg' END AS paths
FROM customer c""")
def benchmark_rows(t: Tables) -> DataFrame:
    k = F.col("c_custkey").cast("string")
    paths = (
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit('["'), k, F.lit('a.jpg", "'), k, F.lit('b.jpg"]')))
        .when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("['it\\'s "), k, F.lit("', 2]")))
        .otherwise(F.concat(k, F.lit(".jpg"))))
    raw = t.customer.select(
        k.alias("index"), F.when(F.col("c_custkey") % 5 == 4, (F.col("c_custkey") - 1).cast("string")).otherwise(F.repeat("c_name", F.lit(5))).alias("image"),
        paths.alias("image_path"))
    resolved = Q.list_cells(Q.resolve_images(raw), "image_path")
    return resolved.select("index", Q.numeric_index(raw).alias("number"), F.md5(F.col("image").cast("binary")).alias("image_digest"),
                           F.array_join("image_path", ",").alias("paths"))


# --- value questions ---------------------------------------------------------------------

def value_questions(t: Tables) -> DataFrame:
    q = F.col("l_quantity")
    form = (F.col("l_partkey") + F.col("l_linenumber")) % 6
    whole = q.cast("bigint").cast("string")
    doubled = (q * 2).cast("bigint").cast("string")
    has_options = F.col("l_suppkey") % 3 == 0
    value = (
        F.when(form == 0, whole).when(form == 1, F.concat(q.cast("string"), F.lit(" ")))
        .when(form == 2, F.when(F.col("l_linenumber") % 3 == 0, F.concat(doubled, F.lit("/2"))).when(
            F.col("l_linenumber") % 3 == 1, F.concat(F.repeat(F.lit("0+"), F.lit(150)), whole)).otherwise(F.concat(F.lit("2**65-2**65+"), whole))).when(form == 3, (q + 1).cast("string"))
        .when(form == 4, F.concat(F.lit("\\frac{"), doubled, F.lit("}{2}"))).otherwise(F.concat(F.lit("about "), whole)))
    letter = (
        F.when(form == 0, "B").when(form == 1, "(A)").when(form == 2, F.concat(F.lit("it is "), q.cast("string")))
        .when(form == 3, "Cannot determine the answer").when(form == 4, "A or B").otherwise("Failed to obtain answer via API"))
    offered = F.sequence(F.lit(-1), F.when(F.col("l_linenumber") == 2, 28).otherwise(1))
    choices = F.when(has_options, F.transform(offered, lambda d: (q + d).cast("string"))).otherwise(
        F.array().cast("array<string>"))
    rows = t.spread("lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    return rows.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("index"), "l_linenumber",
        F.col("l_returnflag").alias("category"), choices.alias("choices"),
        F.when(has_options, "B").otherwise(q.cast("string")).alias("answer"),
        F.when(has_options, letter).otherwise(value).alias("prediction"))


def value_judge(t: Tables) -> DataFrame:
    n = F.col("l_linenumber")
    told = F.when(F.size("choices") > 0, "B").otherwise(F.col("answer"))
    failure = F.lit(C.API_FAILURE)
    return value_questions(t).select("index", F.posexplode(F.array(
        F.when((n % 2 == 1) & (n < 7), told).otherwise(failure),
        F.when(n < 7, "C").otherwise(failure))).alias("attempt", "text"))


def value_sql(x: str) -> str:
    """Number of the arithmetic forms that the answers take, NULL for other texts."""
    part = lambda pattern, i: f"CAST(regexp_extract({x}, '{pattern}', {i}) AS DOUBLE)"
    ratio, frac = r"^([0-9.]+)/([0-9.]+)$", r"^\\frac\{([0-9.]+)\}\{([0-9.]+)\}$"
    powers = r"^(\d+)\*\*(\d+)-(\d+)\*\*(\d+)\+(\d+)$"
    return f"""CASE WHEN regexp_matches({x}, '^[0-9]+(\\.[0-9]*)?$') THEN CAST({x} AS DOUBLE)
      WHEN regexp_matches({x}, '{ratio}') THEN {part(ratio, 1)} / {part(ratio, 2)}
      WHEN regexp_matches({x}, '{frac}') THEN {part(frac, 1)} / {part(frac, 2)}
      WHEN regexp_matches({x}, '{powers}') THEN pow({part(powers, 1)}, {part(powers, 2)}) - pow({part(powers, 3)}, {part(powers, 4)}) + {part(powers, 5)}
      WHEN regexp_matches({x}, '^[0-9]+(\\+[0-9]+)+$') THEN list_sum([CAST(y AS DOUBLE) for y in string_split({x}, '+')]) END"""


def same_sql(x: str, y: str) -> str:
    x, y = f"lower(trim({x}))", f"lower(trim({y}))"
    return f"coalesce({x} = {y} OR abs({value_sql(x)} - {value_sql(y)}) < 1e-6, false)"


VALUE_SQL = f"""
v00 AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS index, l_returnflag AS category, l_linenumber AS n,
   l_suppkey % 3 = 0 AS opt, (l_partkey + l_linenumber) % 6 AS form, l_quantity AS q, CAST(CAST(l_quantity AS DOUBLE) AS BIGINT) AS w FROM lineitem),
v0 AS (SELECT *, CASE WHEN opt THEN 'B' ELSE CAST(q AS VARCHAR) END AS answer,
   CASE WHEN opt THEN [(chr(CAST(66 + d AS INTEGER)), CAST(q + d AS VARCHAR)) for d in range(-1, CASE WHEN n = 2 THEN 29 ELSE 2 END)] ELSE [] END AS opts,
   CASE WHEN opt THEN CASE form WHEN 0 THEN 'B' WHEN 1 THEN '(A)' WHEN 2 THEN 'it is ' || q WHEN 3 THEN 'Cannot determine the answer' WHEN 4 THEN 'A or B'
       ELSE 'Failed to obtain answer via API' END
     ELSE CASE form WHEN 0 THEN w || '' WHEN 1 THEN q || ' '
       WHEN 2 THEN CASE n % 3 WHEN 0 THEN w * 2 || '/2' WHEN 1 THEN repeat('0+', 150) || w ELSE '2**65-2**65+' || w END
       WHEN 3 THEN CAST(q + 1 AS VARCHAR) WHEN 4 THEN '\\frac{{' || w * 2 || '}}{{2}}' ELSE 'about ' || w END END AS prediction FROM v00),
{rule_sql('v0', 'r', 'prediction')},
v1 AS (SELECT *, CASE WHEN opt THEN coalesce(CASE WHEN list_contains([o[1] for o in opts], prediction) THEN prediction END, r_letter)
     WHEN {same_sql('prediction', 'answer')} THEN prediction END AS early,
   [x for x in [CASE WHEN n % 2 = 1 AND n < 7 THEN answer ELSE 'Failed to obtain answer via API' END, CASE WHEN n < 7 THEN 'C' ELSE 'Failed to obtain answer via API' END]
     if NOT contains(x, 'Failed to obtain answer via API')] AS judged FROM r),
v2 AS (SELECT *, early IS NOT NULL AS prefetched, coalesce(early, judged[1], '') AS res, CASE WHEN early IS NOT NULL THEN 'rule' ELSE 'judge' END AS extract_model,
   CASE WHEN early IS NOT NULL THEN early <> 'Z' ELSE len(judged) > 0 END AS extract_flag FROM v1),
{rule_sql('v2', 'rr', 'res')},
v3 AS (SELECT *, {same_sql("coalesce(CASE WHEN opt THEN coalesce(CASE WHEN list_contains([o[1] for o in opts], res) THEN res END, rr_letter) ELSE res END, 'False')", 'answer')} AS hit FROM rr)"""


def _values(t: Tables) -> DataFrame:
    return Q.value_outcomes(value_questions(t), value_judge(t), "index")


@query("value_answers", "H17 H21 H22 H23", f"""
WITH {VALUE_SQL} SELECT index, res, extract_model, extract_flag, prefetched, hit FROM v3""")
def value_answers(t: Tables) -> DataFrame:
    return _values(t).select("index", "res", "extract_model", "extract_flag", "prefetched", "hit")


@query("category_scores", "H24", f"""
WITH {VALUE_SQL}
SELECT CASE WHEN grouping(category) = 1 THEN 'Overall' ELSE category END AS "Subject", count(*) AS tot, count_if(prefetched) AS prefetch, count_if(hit) AS hit,
  round(count_if(prefetched) / count(*) * 100, 6) AS prefetch_rate, round(count_if(hit) / count(*) * 100, 6) AS acc,
  CAST(CASE WHEN grouping(category) = 1 THEN count_if(extract_model = 'rule' AND extract_flag) ELSE 0 END AS BIGINT) AS rule_success,
  CAST(CASE WHEN grouping(category) = 1 THEN count_if(extract_model = 'rule') ELSE 0 END AS BIGINT) AS rule_all,
  CAST(CASE WHEN grouping(category) = 1 THEN count_if(extract_model = 'judge' AND extract_flag) ELSE 0 END AS BIGINT) AS judge_success,
  CAST(CASE WHEN grouping(category) = 1 THEN count_if(extract_model = 'judge') ELSE 0 END AS BIGINT) AS judge_all
FROM v3 GROUP BY ROLLUP (category)""")
def category_scores(t: Tables) -> DataFrame:
    return Q.category_scores(_values(t), ["rule", "judge"])


@query("value_prompts", "H6 H16", f"""
SELECT item_id, 'b91aed04fff471cfe3998af1ab6451ec' AS judge_task, text || chr(10) || 'Model response: ' || length(text) || chr(10) || 'Extracted answer: ' AS judge_prompt,
  'image:q' || item_id || '.jpg|text:' || text AS items FROM benchmark""")
def value_prompts(t: Tables) -> DataFrame:
    text = F.col("text")
    items = T.request_items(F.array(F.concat(F.lit("q"), F.col("item_id").cast("string"), F.lit(".jpg"))), text,
                            768 * 28 * 28, 5120 * 28 * 28)
    return t.benchmark.select(
        "item_id", *_task_and_rest(T.value_judge_prompt(text, F.length(text).cast("string")), text),
        F.array_join(F.transform(items, lambda e: F.concat(e["type"], F.lit(":"), e["value"])), "|").alias("items"))
