"""Answer parsing, agent actions, frame answers and code results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import actions as X
from ..functions import answers as A
from ..operators import codejudge as J
from ..operators import frames as R
from .prompt_queries import sql_text
from . import expected_texts as E
from .registry import Tables, query


@query("fenced_answers", "G2 G3 G6", """
WITH e AS (SELECT event_id, event_id % 5 AS form, replace(props, ' ', '') AS j FROM events)
SELECT event_id, form = 3 AS parse_error, CASE WHEN form <> 3 THEN j END AS value,
  CASE form WHEN 3 THEN 0 WHEN 4 THEN 2 ELSE 1 END AS listed, CASE WHEN form IN (0, 1) THEN j END AS first_code, form <> 4 AS success
FROM (SELECT event_id, form, CASE WHEN form = 4 THEN '[' || j || ',' || j || ']' ELSE j END AS j FROM e)""")
def fenced_answers(t: Tables) -> DataFrame:
    props, form = F.col("props"), F.col("event_id") % 5
    text = (
        F.when(form == 0, F.concat(F.lit("Here:\n```json\n"), props, F.lit("\n```\nDone ```json\n{}\n```")))
        .when(form == 1, F.concat(F.lit("```\n"), props, F.lit("\n```"))).when(form == 2, props)
        .when(form == 3, F.concat(props, F.lit(" trailing")))
        .otherwise(F.concat(F.lit("["), props, F.lit(", "), props, F.lit("]"))))
    listed = F.when(form == 2, F.concat(F.lit("```json"), props, F.lit(" ```"))).when(
        form == 1, F.concat(F.lit("so ["), props, F.lit("] it is"))).otherwise(text)
    rows = t.events.select(F.col("event_id"), A.fenced_json(text).alias("f"), A.list_json(listed).alias("l"), A.first_code_json(text).alias("c"),
                           A.extraction_status(F.when(form != 4, text)).alias("s"))
    return rows.select(
        "event_id", F.col("f.parse_error").alias("parse_error"), F.col("f.value").cast("string").alias("value"),
        F.size("l").alias("listed"), F.col("c").cast("string").alias("first_code"), F.col("s.success").alias("success"))


@query("document_status", "G12", """
SELECT 'f' || event_id AS file,
  CASE event_id % 5 WHEN 0 THEN 'read the bill' WHEN 1 THEN 'read the form' WHEN 2 THEN 'read the pass' ELSE 'read all' END AS prompt,
  event_id % 6 <> 0 AS success,
  CASE WHEN event_id % 6 = 0 THEN NULL WHEN event_id % 5 = 3 THEN '```json' || chr(10) || props || chr(10) || '```'
    WHEN event_id % 7 <> 0 THEN replace(props, ' ', '') END AS data,
  CASE WHEN event_id % 6 = 0 THEN 'no response' END AS error
FROM events""")
def document_status(t: Tables) -> DataFrame:
    k, file = F.col("event_id"), F.concat(F.lit("f"), F.col("event_id").cast("string")).alias("file")
    kinds = F.element_at(F.array(*[F.lit(x) for x in ("invoice", "form", "id", "general", "letter")]), (k % 5 + 1).cast("int"))
    fenced = F.concat(F.lit("```json\n"), F.col("props"), F.lit("\n```"))
    told = F.when((k % 7 == 0) & (k % 5 != 3), "no json at all").otherwise(fenced)
    requests = t.events.select(file, kinds.alias("document_type"))
    responses = t.events.where(k % 6 != 0).select(file, told.alias("text"))
    prompts = {"invoice": "read the bill", "form": "read the form", "id": "read the pass"}
    return A.document_status(requests, responses, prompts, "read all")


@query("point_answers", "G4 F18", """
WITH e AS (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'nothing' WHEN event_id % 7 = 1 THEN '[{"point_2d": [' || event_id % 900 || ', 5.5]}]'
    ELSE 'Sure ```json' || chr(10) || '[{"point_2d": [' || event_id % 900 || ', 5.5], "label": "' || event_type || '"}, {"other": 1}, {"point_2d": [1, 2]}]' || chr(10) || '```' END AS text FROM events),
b AS (SELECT event_id, regexp_extract(text, '\\[.*\\]', 0, 's') AS body FROM e),
p AS (SELECT event_id, [o for o in json_extract(CASE WHEN json_valid(body) THEN body ELSE '[]' END, '$[*]') if json_exists(o, '$.point_2d')] AS l FROM b)
SELECT event_id, coalesce(array_to_string([CAST(json_extract(l[i], '$.point_2d[0]') AS DOUBLE) || '/' || CAST(json_extract(l[i], '$.point_2d[1]') AS DOUBLE) || '/'
  || coalesce(json_extract_string(l[i], '$.label'), 'point_' || i) for i in range(1, len(l) + 1)], ','), '') AS points FROM p""")
def point_answers(t: Tables) -> DataFrame:
    x, kind = (F.col("event_id") % 900).cast("string"), F.col("event_type")
    first = F.concat(F.lit('{"point_2d": ['), x, F.lit(', 5.5]'))
    named = F.concat(first, F.lit(', "label": "'), kind, F.lit('"}, {"other": 1}, {"point_2d": [1, 2]}]\n```'))
    text = F.when(F.col("event_id") % 7 == 0, "nothing").when(F.col("event_id") % 7 == 1, F.concat(F.lit("["), first, F.lit("}]"))).otherwise(
        F.concat(F.lit("Sure ```json\n["), named))
    return t.events.select(F.col("event_id"), F.array_join(F.transform(A.points(text), lambda p: F.concat_ws(
        "/", p["x"].cast("string"), p["y"].cast("string"), p["label"])), ",").alias("points"))


MOBILE = ("key", "click", "long_press", "swipe", "dance")


@query("agent_actions", "G7 G11", """
WITH e AS (SELECT event_id, 'I will act.' || chr(10) || '<tool_call>' || chr(10) || '{"name": "mobile_use", "arguments": {"action": "'
    || ['key', 'click', 'long_press', 'swipe', 'dance'][event_id % 5 + 1] || CASE WHEN event_id % 3 = 0 THEN '"}' ELSE '", "coordinate": [3, 4]}' END
    || CASE WHEN event_id % 11 = 0 THEN '' ELSE '}' END || chr(10) || '</tool_call>' AS text FROM events),
c AS (SELECT event_id, regexp_extract(text, '<tool_call>(.*)</tool_call>', 1, 's') AS body FROM e),
j AS (SELECT event_id, CASE WHEN json_valid(body) THEN CAST(body AS JSON) END AS call FROM c),
f AS (SELECT event_id, call->>'$.arguments.action' AS action, coalesce(json_keys(call, '$.arguments'), []) AS given FROM j),
needs(name, needed) AS (VALUES ('key', ['text']), ('click', ['coordinate']), ('long_press', ['coordinate', 'time']), ('swipe', ['coordinate', 'coordinate2']),
  ('type', ['text']), ('system_button', ['button']), ('open', ['text']), ('wait', ['time']), ('terminate', ['status'])),
m AS (SELECT f.*, needed, [x for x in needed if NOT list_contains(given, x)] AS missing FROM f LEFT JOIN needs ON name = action)
SELECT event_id, action, CASE WHEN needed IS NULL THEN 'Unknown action: ' || coalesce(action, '') WHEN len(missing) > 0 THEN 'missing ' || array_to_string(missing, ', ') END AS fault,
  list_contains(given, 'coordinate') AS placed FROM m""")
def agent_actions(t: Tables) -> DataFrame:
    action = F.element_at(F.array(*[F.lit(a) for a in MOBILE]), (F.col("event_id") % 5 + 1).cast("int"))
    arguments = F.concat(F.lit('{"action": "'), action, F.when(F.col("event_id") % 3 == 0, '"}').otherwise('", "coordinate": [3, 4]}'))
    text = F.concat(F.lit("I will act.\n<tool_call>\n{\"name\": \"mobile_use\", \"arguments\": "), arguments,
                    F.when(F.col("event_id") % 11 == 0, "\n</tool_call>").otherwise("}\n</tool_call>"))
    names = F.map_keys(F.from_json(F.col("call.arguments").cast("string"), "map<string,string>"))
    return t.events.select(F.col("event_id"), A.tool_call(text).alias("call")).select(
        "event_id", F.col("call.action").alias("action"),
        X.action_fault(F.lit("mobile_use"), F.col("call.action"), F.coalesce(names, F.array().cast("array<string>"))).alias("fault"),
        F.coalesce(F.array_contains(names, "coordinate"), F.lit(False)).alias("placed"))


@query("code_blocks", "G1 G8 G9", """
SELECT doc_id, CASE WHEN doc_id % 3 > 0 THEN trim(text, chr(10) || ' ') END AS code,
  'see item at ' || lang || CASE WHEN doc_id % 4 = 2 THEN '<box>(1,2),(3,4)' || chr(10) || 'end' ELSE '' END AS untagged,
  trim(text, chr(10) || ' ') AS answer FROM documents""")
def code_blocks(t: Tables) -> DataFrame:
    k, text = F.col("doc_id"), F.col("text")
    block = F.concat(F.lit("First ```python\nold\n``` then\n```python\n"), text, F.lit("\n```\nend"))
    # An open box reaches the end of the text, never over a line break.
    tagged = F.concat(F.lit("see <ref>item</ref><box>(1,2)</box> at "), "lang")
    open_box = F.concat(F.lit("see <ref>item</ref> at "), F.col("lang"), F.lit("<box>(1,2),(3,4)"),
                        F.when(k % 4 == 2, "\nend").otherwise(""))
    return t.documents.select(
        k, A.last_code_block(F.when(k % 3 == 0, text).otherwise(block)).alias("code"),
        A.without_box_tags(F.when(k % 2 == 0, open_box).otherwise(tagged)).alias("untagged"),
        A.strip_reasoning(F.concat(F.lit("<think>a</think>b</think>\n"), text, F.lit(" \n"))).alias("answer"))


ESCAPED_SQL = "x"
for _old, _new in E.CODE_ESCAPES:
    ESCAPED_SQL = f"replace({ESCAPED_SQL}, {sql_text(_old)}, {sql_text(_new)})"


@query("html_answers", "G10", f"""
WITH d AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS ls FROM documents)
SELECT doc_id, 'Top' || coalesce(list_aggregate(list_transform(ls, lambda x: '<br>' || x), 'string_agg', ''), '') || '<pre><code class="language-py">'
  || coalesce(list_aggregate(list_transform(ls, lambda x: '<br>' || {ESCAPED_SQL}), 'string_agg', ''), '') || '<br></code></pre>' || '<br>a <b> done' AS html FROM d""")
def html_answers(t: Tables) -> DataFrame:
    text = F.concat(F.lit("Top\n"), "text", F.lit("\n\n```py\n"), "text", F.lit("\n```\na <b> done"))
    return t.documents.select("doc_id", A.to_html(text).alias("html"))


@query("frame_answers", "F26", """
WITH f AS (SELECT user_id, event_id, '<' || event_id % 130 || '.0 seconds>' AS text FROM events),
a AS (SELECT DISTINCT user_id, CAST(event_id % 13 AS VARCHAR) || CASE WHEN event_id % 2 = 0 THEN '.0' ELSE '' END AS tm, event_id % 13 * 2 + event_id % 2 AS ord FROM events WHERE event_type = 'click')
SELECT f.user_id, f.event_id, max(a.ord) AS answer_order FROM f LEFT JOIN a ON a.user_id = f.user_id AND contains(f.text, a.tm) GROUP BY ALL""")
def frame_answers(t: Tables) -> DataFrame:
    frames = t.events.select("user_id", F.col("event_id"), F.concat(F.lit("<"), (F.col("event_id") % 130).cast("string"), F.lit(".0 seconds>")).alias("text"))
    answers = t.events.where(F.col("event_type") == "click").select(
        "user_id", F.concat((F.col("event_id") % 13).cast("string"), F.when(F.col("event_id") % 2 == 0, ".0").otherwise("")).alias("time"),
        (F.col("event_id") % 13 * 2 + F.col("event_id") % 2).alias("ord"))
    return R.match_times(frames, answers, ["user_id"], "event_id", "text", "time", "ord").drop("text")


CODE_SQL = f"""
p AS (SELECT item_id, text || repeat('![image](a.png)tail ', item_id % 4) AS question, item_id % 3 = 1 AS starter,
   CASE WHEN item_id % 5 = 0 THEN '' ELSE 'go' END AS fn FROM benchmark),
q AS (SELECT *, {sql_text(J.TASK)} || chr(10) || 'QUESTION:' || chr(10) || question
   || CASE WHEN NOT starter AND fn = '' THEN {sql_text(J.STANDARD_IO)} ELSE {sql_text(J.CALL_BASED)} END
   || CASE WHEN starter THEN {sql_text(J.STARTER)} || 'def go():' || chr(10) ELSE '' END || chr(10) || 'ANSWER:' || chr(10) AS prompt FROM p)"""


def _problems(t: Tables) -> DataFrame:
    k = F.col("item_id")
    return t.benchmark.select(
        k, F.concat("text", F.repeat(F.lit("![image](a.png)tail "), (k % 4).cast("int"))).alias("question"),
        F.when(k % 3 == 1, "def go():").otherwise("").alias("starter_code"),
        F.concat(F.lit('{"fn_name": "'), F.when(k % 5 == 0, "").otherwise("go"), F.lit('", "inputs": ['),
                 F.array_join(F.transform(F.sequence(F.lit(0), (k % 3).cast("int")), lambda i: F.concat(F.lit('"in'), i.cast("string"), F.lit('"'))), ","),
                 F.lit('], "outputs": ["out'), k.cast("string"), F.lit('"]}')).alias("input_output"),
        F.transform(F.sequence(F.lit(0), (k % 3).cast("int")), lambda i: F.concat(F.lit("img"), i.cast("string"))).alias("images"))


@query("problem_prompts", "J1 J5", f"""
WITH {CODE_SQL} SELECT item_id, prompt, CAST(item_id % 3 + 1 AS BIGINT) AS tests, 'in0' AS first_input, 'out' || item_id AS first_output FROM q""")
def problem_prompts(t: Tables) -> DataFrame:
    stats = J.catalogue(F.col("input_output"))
    return _problems(t).select(
        "item_id", J.problem_prompt(F.col("question"), F.col("starter_code"), F.col("input_output")).alias("prompt"),
        stats.alias("s")).select("item_id", "prompt", F.col("s.tests").cast("bigint").alias("tests"), "s.first_input", "s.first_output")


@query("problem_items", "J2", f"""
WITH {CODE_SQL}, s AS (SELECT item_id, string_split(prompt, '![image](a.png)') AS parts FROM q),
u AS (SELECT item_id, i.i, parts[i.i + 1] AS part, len(parts) AS n FROM s, LATERAL (SELECT unnest(range(len(parts))) AS i) i)
SELECT item_id, i * 2 AS position, 'text' AS type, part AS value FROM u WHERE part <> ''
UNION ALL SELECT item_id, i * 2 + 1, 'image', 'img' || i FROM u WHERE i <= item_id % 3""")
def problem_items(t: Tables) -> DataFrame:
    prompt = J.problem_prompt(F.col("question"), F.col("starter_code"), F.col("input_output"))
    return J.interleaved(_problems(t), "item_id", prompt, F.col("images"))


@query("output_verdicts", "J3", """
WITH f AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS n, o_orderpriority AS s, o_orderkey % 15 AS form FROM orders),
t AS (SELECT k, n, form,
    CASE WHEN form IN (4, 6, 11) THEN n || '.5' || chr(10) || '2.25' WHEN form = 9 THEN '2' || chr(10) || '3' WHEN form = 10 THEN n || chr(10) || '2.25'
      WHEN form IN (12, 14) THEN 'inf' || chr(10) || '2.25' WHEN form = 13 THEN '5' || chr(10) || 'nan'
      ELSE n || ' alpha beta' || chr(10) || s || chr(10) END AS wanted,
    CASE form WHEN 0 THEN [n || ' alpha beta', s] WHEN 1 THEN [n || ' alpha beta  ', ' ' || s] WHEN 2 THEN ['', n || ' alpha beta', '', s]
      WHEN 3 THEN ['beta ' || n || ' alpha', s] WHEN 4 THEN [n || '.500000001', '2.25'] WHEN 5 THEN [s, n || ' beta alpha alpha']
      WHEN 6 THEN ['2.2501', n || '.5'] WHEN 7 THEN [n || '  alpha   beta', s] WHEN 8 THEN [n || ' alpha', s] WHEN 9 THEN ['2d', '3']
      WHEN 10 THEN [n, ' 2.25'] WHEN 12 THEN [n, '2.25'] WHEN 13 THEN ['5.0', 'NaN'] WHEN 14 THEN ['Infinity', '2.2500000001'] ELSE [n || '.51', '2.25'] END AS o,
    CASE WHEN k % 5 = 4 THEN '[{"1":' || n || '}]' WHEN k % 3 = 0 THEN '[' || n || ']' ELSE n END AS value,
    CASE WHEN k % 5 = 4 THEN '{"1":' || n || '}' WHEN k % 3 = 2 THEN '["x"]' WHEN k % 3 = 1 THEN '[' || n || ',5]' ELSE '[' || n || ']' END AS target FROM f),
l AS (SELECT *, [trim(x) for x in string_split(wanted, chr(10)) if x <> ''] AS e, [x for x in o if x <> ''] AS filled FROM t),
w AS (SELECT *, [list_sort(list_distinct([y for y in string_split(x, ' ') if y <> ''])) for x in filled] AS ow,
    [list_sort(list_distinct([y for y in string_split(x, ' ') if y <> ''])) for x in e] AS ew FROM l),
r AS (SELECT *, list_sort(list_distinct([list_sort(list_distinct([round_even(try_cast(y AS DOUBLE), 3) for y in x])) for x in ow])) AS orr,
    list_sort(list_distinct([list_sort(list_distinct([round_even(try_cast(y AS DOUBLE), 3) for y in x])) for x in ew])) AS err,
    len([1 for y in flatten(list_concat(ow, ew)) if try_cast(y AS DOUBLE) IS NULL OR isnan(try_cast(y AS DOUBLE))]) = 0 AS numbers FROM w)
SELECT k AS o_orderkey,
  coalesce(trim(array_to_string(o, chr(10)), chr(10) || ' ') = trim(wanted, chr(10) || ' ')
    OR trim(array_to_string([trim(x) for x in o], chr(10)), chr(10)) = trim(wanted, chr(10) || ' ') OR o = e OR filled = e
    OR (len(filled) = len(e) AND len([1 for i in range(1, len(e) + 1)
      if coalesce(CASE WHEN isfinite(try_cast(filled[i] AS DOUBLE)) AND isfinite(try_cast(e[i] AS DOUBLE))
          THEN abs(try_cast(filled[i] AS DOUBLE) - try_cast(e[i] AS DOUBLE)) <= 1e-8 + 1e-5 * abs(try_cast(e[i] AS DOUBLE))
          ELSE try_cast(filled[i] AS DOUBLE) = try_cast(e[i] AS DOUBLE) AND NOT isnan(try_cast(e[i] AS DOUBLE)) END, false)]) = len(e))
    OR list_sort(list_distinct(ow)) = list_sort(list_distinct(ew)) OR (numbers AND orr = err), false) AS matches,
  coalesce(json(value) = json(target) OR json(value) = (json(target)->0) OR (json_type(target) = 'OBJECT' AND json(value) = json('[' || target || ']')), false) AS value_matches
FROM r""")
def output_verdicts(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    n, status = k.cast("string"), F.col("o_orderpriority")
    expected = F.concat(n, F.lit(" alpha beta\n"), status, F.lit("\n"))
    numbers = F.concat(n, F.lit(".5\n2.25"))
    form = k % 15
    listed = J.expected_text(F.concat(F.lit('["'), n, F.lit('", "2.25"]')))
    wanted = F.when(form.isin(4, 6, 11), numbers).when(form == 9, "2\n3").when(form == 10, listed).when(
        form.isin(12, 14), "inf\n2.25").when(form == 13, "5\nnan").otherwise(expected)
    lines = (
        F.when(form == 0, F.array(F.concat(n, F.lit(" alpha beta")), status))
        .when(form == 1, F.array(F.concat(n, F.lit(" alpha beta  ")), F.concat(F.lit(" "), status)))
        .when(form == 2, F.array(F.lit(""), F.concat(n, F.lit(" alpha beta")), F.lit(""), status))
        .when(form == 3, F.array(F.concat(F.lit("beta "), n, F.lit(" alpha")), status))
        .when(form == 4, F.array(F.concat(n, F.lit(".500000001")), F.lit("2.25")))
        .when(form == 5, F.array(status, F.concat(n, F.lit(" beta alpha alpha"))))
        .when(form == 6, F.array(F.lit("2.2501"), F.concat(n, F.lit(".5"))))
        .when(form == 7, F.array(F.concat(n, F.lit("  alpha   beta")), status))
        .when(form == 8, F.array(F.concat(n, F.lit(" alpha")), status))
        .when(form == 9, F.array(F.lit("2d"), F.lit("3")))
        .when(form == 10, F.array(n, F.lit(" 2.25")))
        .when(form == 12, F.array(n, F.lit("2.25")))
        .when(form == 13, F.array(F.lit("5.0"), F.lit("NaN")))
        .when(form == 14, F.array(F.lit("Infinity"), F.lit("2.2500000001")))
        .otherwise(F.array(F.concat(n, F.lit(".51")), F.lit("2.25"))))
    one = F.concat(F.lit('{"1": '), n, F.lit("}"))
    value = F.when(k % 5 == 4, F.concat(F.lit("["), one, F.lit("]"))).when(k % 3 == 0, F.concat(F.lit("["), n, F.lit("]"))).otherwise(n)
    target = F.when(k % 5 == 4, one).when(k % 3 == 2, '["x"]').otherwise(F.concat(F.lit("["), n, F.when(k % 3 == 1, ", 5]").otherwise("]")))
    return t.orders.select(k, J.output_matches(lines, wanted).alias("matches"), J.value_matches(value, target).alias("value_matches"))


@query("code_tallies", "J4", """
WITH r AS (SELECT o_custkey, [1, 0, -1, -2][o_orderkey % 4 + 1] AS code FROM orders)
SELECT o_custkey, count(*) AS total_tests, count_if(code = 1) AS passed_tests, count_if(code = 0) AS failed_tests, count_if(code = -1) AS error_tests,
  count_if(code = -2) AS timeout_tests, round(count_if(code = 1) / count(*), 6) AS accuracy, bool_and(code = 1) AS all_passed FROM r GROUP BY o_custkey""")
def code_tallies(t: Tables) -> DataFrame:
    code = F.element_at(F.array(*[F.lit(c) for c in (1, 0, -1, -2)]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return J.tally(t.orders.select("o_custkey", code.alias("code")), "o_custkey")
