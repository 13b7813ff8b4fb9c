"""Prompt and answer rewriting over whole documents, events and parts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import prompts as P
from ..operators.logformat import convert_cells, tag_answers
from .check_sql import SQL_SPACES
from . import expected_texts as E
from .registry import Tables, query

FIELD = E.DROPPED_FIELDS[2][1]


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _system_texts(t: Tables) -> DataFrame:
    k = F.col("doc_id")
    tag = F.element_at(F.array(*[F.lit(s) for s in P.REMOVED_SECTIONS]), (k % 8 + 1).cast("int"))
    section = F.concat(F.lit("1. <"), F.when(k % 3 == 0, F.upper(tag)).otherwise(tag), F.lit(">"), F.col("text"),
                       F.lit("</"), tag, F.lit(">\n\n\n\n"))
    output = F.concat(
        F.lit("<output>\nYou must ALWAYS respond with a valid JSON here\n{\"thinking\": \"t\", "),
        F.lit(FIELD), F.lit(" \"next_goal\": \"g\"}\n"), F.lit('"action": [1, 2],\n'),
        F.when(k % 2 == 0, "</output>\n").otherwise(""))
    return t.spread("documents", "doc_id", "text", "source").select(
        k, F.concat(F.lit("Intro "), F.col("source"), F.lit("\n"), section, output,
                    F.lit("2. Keep the Action  name in JSON and the action list.\n  "),
                    F.substring_index("text", "\n", 1), F.lit(" \n")).alias("system_text"))


def _prompt_sql() -> str:
    steps = ["system_text"]
    for tag in E.REMOVED_SECTIONS:
        steps.append(f"regexp_replace({{}}, '<{tag}>.*?</{tag}>', '', 'gis')")
    steps.append("regexp_replace({}, '\\n{{3,}}', chr(10) || chr(10), 'g')")
    steps.append("regexp_replace({}, '(?m)^\\s*\\d+\\.\\s*$', '', 'g')")
    steps.append("regexp_replace({}, '\\n{{3,}}', chr(10) || chr(10), 'g')")
    for old, new in E.RENAMES:
        steps.append(f"replace({{}}, {sql_text(old)}, {sql_text(new)})")
    for _, dropped in E.DROPPED_FIELDS:
        steps.append(f"replace({{}}, {sql_text(dropped)}, '')")
    ctes, last = [], "s0"
    ctes.append("s0 AS (SELECT doc_id, system_text AS x FROM texts)")
    for i, step in enumerate(steps[1:], 1):
        ctes.append(f"s{i} AS (SELECT doc_id, {step.format('x')} AS x FROM s{i - 1})")
        last = f"s{i}"
    inner = ["{}"]
    for line in E.OUTPUT_LINES:
        inner.append(f"regexp_replace({{}}, {sql_text(line)}, '', 'gi')")
    for key in E.OUTPUT_EXAMPLE_KEYS:
        pattern = rf'\{{[^}}]*"thinking"[^}}]*"{key}"[^}}]*\}}'.replace("{", "{{").replace("}", "}}")
        inner.append(f"regexp_replace({{}}, {sql_text(pattern)}, '', 'g')")
    inner.append(f"regexp_replace({{}}, '<output>.*?</output>', {sql_text(E.NEW_OUTPUT_SECTION).replace('{', '{{').replace('}', '}}')}, 'gs')")
    ctes.append(f"o0 AS (SELECT doc_id, x, x AS y FROM {last})")
    for i, step in enumerate(inner[1:], 1):
        ctes.append(f"o{i} AS (SELECT doc_id, x, {step.format('y')} AS y FROM o{i - 1})")
    final = "CASE WHEN contains(x, '<output>') AND contains(x, '</output>') THEN y ELSE x END"
    for old, new in E.WORDING:
        final = f"replace({final}, {sql_text(old)}, {sql_text(new)})"
    final = (f"regexp_replace({final}, '\\baction\\b(\\s*(?:field|list|parameter|name))', 'tool_call\\1', 'gi')")
    ctes.append(f"done AS (SELECT doc_id, {final} AS z FROM o{len(inner) - 1})")
    return ", ".join(ctes)


TAGS_SQL = "[" + ", ".join(f"'{s}'" for s in E.REMOVED_SECTIONS) + "]"
SYSTEM_SQL = f"""
texts AS (SELECT doc_id, 'Intro ' || source || chr(10)
   || '1. <' || CASE WHEN doc_id % 3 = 0 THEN upper({TAGS_SQL}[doc_id % 8 + 1]) ELSE {TAGS_SQL}[doc_id % 8 + 1] END || '>' || text
   || '</' || {TAGS_SQL}[doc_id % 8 + 1] || '>' || repeat(chr(10), 4)
   || '<output>' || chr(10) || 'You must ALWAYS respond with a valid JSON here' || chr(10) || '{{"thinking": "t", ' || {sql_text(FIELD)}
   || ' "next_goal": "g"}}' || chr(10) || '"action": [1, 2],' || chr(10) || CASE WHEN doc_id % 2 = 0 THEN '</output>' || chr(10) ELSE '' END
   || '2. Keep the Action  name in JSON and the action list.' || chr(10) || '  ' || split_part(text, chr(10), 1) || ' ' || chr(10) AS system_text
   FROM documents)"""

CATALOG_JSON = (
    '{"tools": [{"name": "wait", "description": "Wait a little.", "params": {"seconds": '
    '{"type": "integer", "default": 3, "minimum": 0, "minLength": 1, "maximum": 30}}}, {"name": "", "params": {}}, '
    '{"name": "back", "description": "", "params": {}}]}')
CATALOG_LINES = [
    *E.CATALOG_HEADER, "- wait()", "  Description: Wait a little.", "  Parameters:",
    "    * seconds (integer): default: 3, range: [1, 30]", "", "- back()", "  Parameters: None"]


@query("system_prompts", "D15 D16 D17 D19", f"""
WITH {SYSTEM_SQL}, {_prompt_sql()}
SELECT doc_id, rtrim(z, {SQL_SPACES}) || chr(10) || chr(10) || {sql_text(chr(10).join(CATALOG_LINES))} AS prompt FROM done""")
def system_prompts(t: Tables) -> DataFrame:
    return _system_texts(t).select(
        "doc_id", P.system_prompt(F.col("system_text"), P.catalog_text(F.lit(CATALOG_JSON))).alias("prompt"))


DEFAULTS = (
    "null", '["x", 1, true, null, "it\'s", 1.5]', "1e20", '{"a": 2, "b": "c"}', '"it\'s"', "1.0", "-0.0", "1.234567895e7", "1e400",
    "123456789012345678901234567890123456789012", '[[1, 2], {"a": ["x", null]}], "minimum": 0.0, "minLength": 0.5')


@query("tool_catalogs", "D19", f"""
SELECT p_partkey, {sql_text(chr(10).join(E.CATALOG_HEADER))} || chr(10) || '- tool_' || p_partkey || '()'
  || CASE WHEN p_partkey % 3 > 0 THEN chr(10) || '  Description: ' || p_name ELSE '' END || chr(10) || '  Parameters:'
  || chr(10) || '    * size (integer): ' || CASE WHEN p_partkey % 2 = 0 THEN 'how big, ' ELSE '' END || 'default: ' || p_size
  || CASE WHEN p_size % 4 = 0 THEN ', max: 50' ELSE ', range: [' || p_size % 4 || ', 50]' END
  || chr(10) || '    * fast (boolean): default: ' || CASE WHEN p_partkey % 2 = 0 THEN 'True' ELSE 'False' END
  || chr(10) || '    * kind (unknown)' || CASE p_partkey % 11 WHEN 1 THEN ': default: [''x'', 1, True, None, "it''s", 1.5]' WHEN 2 THEN ': default: 1e+20'
       WHEN 3 THEN ': default: {{''a'': 2, ''b'': ''c''}}' WHEN 4 THEN ': default: it''s'
       WHEN 5 THEN ': default: 1.0' WHEN 6 THEN ': default: -0.0' WHEN 7 THEN ': default: 12345678.95' WHEN 8 THEN ': default: inf'
       WHEN 9 THEN ': default: 123456789012345678901234567890123456789012' WHEN 10 THEN ': default: [[1, 2], {{''a'': [''x'', None]}}], min: 0.5'
       ELSE '' END AS catalog
FROM part""")
def tool_catalogs(t: Tables) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    text = F.concat(
        F.lit('{"tools":[{"name":"tool_'), k.cast("string"), F.lit('","description":"'),
        F.when(k % 3 > 0, F.col("p_name")).otherwise(""), F.lit('","params":{"size":{"type":"integer","description":"'),
        F.when(k % 2 == 0, "how big").otherwise(""), F.lit('","default":'), size.cast("string"), F.lit(',"minimum":'),
        (size % 4).cast("string"), F.lit(',"maximum":50},"fast":{"type":"boolean","default":'),
        (k % 2 == 0).cast("string"), F.lit('},"kind":{"default":'),
        F.coalesce(F.get(F.array(*[F.lit(d) for d in DEFAULTS]), (k % 11).cast("int")), F.lit("null")), F.lit("}}}]}"))
    return t.part.select(k, P.catalog_text(text).alias("catalog"))


ANSWERS_SQL = """
a AS (SELECT event_id, event_type, props, value, event_id % 17 = 0 AND event_id % 31 > 3 AS broken,
  CASE WHEN event_id % 3 = 0 THEN '' ELSE 'saw ' || event_type END AS thinking,
  CASE event_id % 31 WHEN 0 THEN '{"thinking": 5}' WHEN 1 THEN '{"thinking": null}' WHEN 2 THEN '[]' WHEN 3 THEN '"abc"' ELSE
  '{"thinking": "' || CASE WHEN event_id % 3 = 0 THEN '' ELSE 'saw ' || event_type END || '", "memory": "é ' || user_id || '", '
  || CASE WHEN event_id % 2 = 0 THEN '"next_goal": ' || user_id || ', ' ELSE '' END
  || '"action": [' || CASE WHEN event_id % 5 = 0 THEN '' ELSE '{"' || event_type || '":' || replace(replace(props, ' ', ''), '}', ', "t":"ü"}') || '}, {"wait": 3}' END || ']'
  || CASE WHEN event_id % 17 = 0 THEN '' ELSE '}' END END AS answer, user_id FROM events)"""


def _answers(t: Tables) -> DataFrame:
    k, user = F.col("event_id"), F.col("user_id").cast("string")
    body = F.concat(
        F.lit('{"thinking": "'), F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("saw "), "event_type")),
        F.lit('", "memory": "é '), user, F.lit('", '),
        F.when(k % 2 == 0, F.concat(F.lit('"next_goal": '), user, F.lit(", "))).otherwise(""),
        F.lit('"action": ['),
        F.when(k % 5 == 0, "").otherwise(F.concat(
            F.lit('{"'), F.col("event_type"), F.lit('":'),
            F.replace(F.replace("props", F.lit(" "), F.lit("")), F.lit("}"), F.lit(', "t":"ü"}')), F.lit('}, {"wait": 3}'))),
        F.lit("]"), F.when(k % 17 == 0, "").otherwise("}"))
    body = F.when(k % 31 == 0, '{"thinking": 5}').when(k % 31 == 1, '{"thinking": null}').when(k % 31 == 2, "[]").when(
        k % 31 == 3, '"abc"').otherwise(body)
    return t.dealt("events", "event_id", "user_id", "event_type", "props").select(k, "event_type", body.alias("answer"))


TAGGED_SQL = """
parsed AS (SELECT *, json_valid(answer) AS readable, CASE WHEN json_valid(answer) THEN json_type(answer) END AS kind,
    CASE WHEN json_valid(answer) THEN CAST(answer AS JSON) END AS fields FROM a),
reasoned AS (SELECT *, coalesce(kind = 'OBJECT', false) AND coalesce(json_type(fields, '$.thinking') = 'VARCHAR', NOT json_exists(fields, '$.thinking')) AS told,
    concat(fields->>'$.thinking', chr(10) || chr(10) || 'Evaluation of Previous Goal: ' || (fields->>'$.evaluation_previous_goal'),
      chr(10) || chr(10) || 'Memory: ' || (fields->>'$.memory'), chr(10) || chr(10) || 'Next Goal: ' || (fields->>'$.next_goal')) AS reasons,
    array_to_string(flatten([[k || '(' || replace(replace(CAST(json_extract(x, '$.' || k) AS VARCHAR), '":', '": '), ',"', ', "') || ')' for k in json_keys(x)]
      for x in json_extract(fields, '$.action[*]')]), chr(10)) AS calls FROM parsed),
tagged AS (SELECT event_id, event_type, answer, CASE WHEN kind IN ('ARRAY', 'VARCHAR') THEN ''
    WHEN NOT told THEN '<thinking>' || chr(10) || answer || chr(10) || '</thinking>'
    ELSE concat_ws(chr(10) || chr(10), CASE WHEN reasons <> '' THEN '<thinking>' || chr(10) || reasons || chr(10) || '</thinking>' END,
      CASE WHEN calls <> '' THEN '<tool_call>' || chr(10) || calls || chr(10) || '</tool_call>' END) END AS tagged FROM reasoned)"""


@query("tagged_answers", "D14", f"WITH {ANSWERS_SQL}, {TAGGED_SQL} SELECT event_id, tagged FROM tagged")
def tagged_answers(t: Tables) -> DataFrame:
    return tag_answers(_answers(t), "answer", "tagged").select("event_id", "tagged")


@query("user_texts", "D18 D21", f"""
WITH {ANSWERS_SQL}
SELECT event_id, 'see ' || repeat(chr(10), 2) || ' the ' || event_type || ' and' || repeat(chr(10), 2) || '"action": list' AS cleaned,
  CASE WHEN broken THEN 'set "action": in the action list of ' || event_type ELSE 'set "tool_call": in the tool_call list of ' || event_type END AS renamed
FROM a""")
def user_texts(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    raw = F.concat(F.lit("see <Browser_State>"), F.col("answer"), F.lit("\n</browser_state>\n\n\n\n the "), kind,
                   F.lit(' and\n\n\n"action": list'))
    fields = F.concat(F.lit('set "action": in the action list of '), kind)
    return _answers(t).select("event_id", P.user_text(raw).alias("cleaned"),
                              P.user_field_names(fields, F.col("answer")).alias("renamed"))


@query("converted_cells", "D1 D14 D18 D20", f"""
WITH {ANSWERS_SQL}, {TAGGED_SQL},
c AS (SELECT *, '[{{''role'': ''user'', ''content'': ''look <browser_state>x</browser_state>at ' || event_type || '''}}, {{''role'': ''assistant'', ''content'': ''' || answer || '''}}' AS cell FROM tagged)
SELECT event_id,
  CASE WHEN event_id % 29 = 0 THEN 'oops' ELSE '[{{''role'': ''user'', ''content'': ''look at ' || event_type || '''}}, {{''role'': ''assistant'', ''content'': ''' || replace(tagged, chr(10), '\\n') || '''}}'
    || CASE event_id % 7 WHEN 0 THEN ', {{''role'': ''user'', ''content'': [{{''type'': ''image'', ''n'': 1}}], ''extra'': None}}' WHEN 1 THEN ', {{''role'': ''tool'', ''content'': ''as <browser_state>is</browser_state>''}}' ELSE '' END || ']' END AS messages,
  CASE WHEN event_id % 29 = 0 THEN 'kept' ELSE 'converted' END AS status
FROM c""")
def converted_cells(t: Tables) -> DataFrame:
    cell = F.concat(
        F.lit("[{'role': 'user', 'content': 'look <browser_state>x</browser_state>at "), F.col("event_type"),
        F.lit("'}, {'role': 'assistant', 'content': '"), F.col("answer"), F.lit("'}"),
        F.when(F.col("event_id") % 7 == 0, ", {'role': 'user', 'content': [{'type': 'image', 'n': 1}], 'extra': None}").when(
            F.col("event_id") % 7 == 1, ", {'role': 'tool', 'content': 'as <browser_state>is</browser_state>'}").otherwise(""), F.lit("]"))
    rows = _answers(t).select("event_id", F.when(F.col("event_id") % 29 == 0, "oops").otherwise(cell).alias("messages"))
    return convert_cells(rows)
