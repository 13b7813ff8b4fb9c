"""System-prompt, user-text and answer rewriting for agent logs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import literals as L
from .json import strict_json
from .text import let, strip_right

# --- Fixed values of the log rewriting -----------------------------------------

REMOVED_SECTIONS = (
    "reasoning_rules", "efficiency_guidelines", "browser_rules", "task_completion_rules",
    "action_rules", "examples", "browser_state", "browser_vision",
)

RENAMES = (
    ('"action":', '"tool_call":'),
    ("'action':", "'tool_call':"),
    ('"action"', '"tool_call"'),
    ("'action'", "'tool_call'"),
    ("action field", "tool_call field"),
    ("action list", "tool_call list"),
    ("action parameter", "tool_call parameter"),
)

USER_RENAMES = (
    ('"action":', '"tool_call":'),
    ("'action':", "'tool_call':"),
    ("action field", "tool_call field"),
    ("action list", "tool_call list"),
)

# (key that must occur, text to drop)
DROPPED_FIELDS = (
    ('"evaluation_previous_goal"',
     '"evaluation_previous_goal": "One-sentence analysis of your last action. Clearly state success, failure, or uncertain.",'),
    ('"evaluation_previous_goal"',
     'evaluation_previous_goal": "One-sentence analysis of your last action. Clearly state success, failure, or uncertain.",'),
    ('"memory"',
     '"memory": "1-3 sentences of specific memory of this step and overall progress. You should put here everything that will help you track progress in future steps. Like counting pages visited, items found, etc.",'),
    ('"next_goal"',
     '"next_goal": "State the next immediate goals and actions to achieve it, in one clear sentence."'),
)

OUTPUT_LINES = (
    r'"evaluation_previous_goal":\s*"[^"]*",?\s*\n',
    r'"memory":\s*"[^"]*",?\s*\n',
    r'"next_goal":\s*"[^"]*",?\s*\n',
    r'"action":\s*\[[^\]]*\],?\s*\n',
    r'"action":\s*"[^"]*",?\s*\n',
    r'You must ALWAYS respond with a valid JSON[^\n]*\n',
    r'Action list should NEVER be empty[^\n]*\n',
)

OUTPUT_EXAMPLE_KEYS = ("evaluation_previous_goal", "memory", "next_goal", "tool_call")

# Patterns of whole parts: an example of an answer with one of the keys, the output section, the word for a call, the browser's state.
OUTPUT_EXAMPLE = r'\{{[^}}]*"thinking"[^}}]*"{key}"[^}}]*\}}'
OUTPUT_SECTION = r"(?s)<output>.*?</output>"
ACTION_WORD = r"(?i)\baction\b(?=\s*(?:field|list|parameter|name))"
BROWSER_STATE = r"(?is)<browser_state>.*?</browser_state>"

NEW_OUTPUT_SECTION = """<output>
You must ALWAYS respond in the following format using XML-like tags:

<thinking>
Your comprehensive reasoning that includes:
- Evaluation of previous actions (success/failure/uncertainty)
- Memory of overall progress and specific details that help track progress
- Next goals and immediate actions to achieve them
- Analysis of current state and relevant context
</thinking>

<tool_call>
The tool calls you want to make, formatted as function calls, one per line.
Example: go_to_url({"url": "https://example.com", "new_tab": false})
If multiple tool calls are needed, put each on a separate line.
</tool_call>

Both sections are required. The tool_call section should NEVER be empty.
</output>"""

WORDING = (
    ("valid JSON", "the format"),
    ("JSON format", "specified format"),
    ("in JSON", "in the format"),
)

CATALOG_HEADER = (
    "Tool Description:",
    "",
    "You have access to the following tools. Use them in the <tool_call> section of your response.",
    "",
)

# -------------------------------------------------------------------------------


def _replace_all(text: Column, pairs) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _collapse_blank_lines(text: Column) -> Column:
    return F.regexp_replace(text, r"\n{3,}", "\n\n")


def drop_prompt_sections(text: Column) -> Column:
    """Removes the tagged instruction sections and the list numbers they leave."""
    for tag in REMOVED_SECTIONS:
        text = F.regexp_replace(text, f"(?is)<{tag}>.*?</{tag}>", "")
    text = F.regexp_replace(_collapse_blank_lines(text), r"(?md)^\s*\d+\.\s*$", "")
    return _collapse_blank_lines(text)


def rewrite_output_rules(text: Column) -> Column:
    """Turns the JSON answer rules of a system prompt into tag rules."""
    text = _replace_all(text, RENAMES)
    for key, dropped in DROPPED_FIELDS:
        text = F.when(text.contains(key), F.replace(text, F.lit(dropped), F.lit(""))).otherwise(text)
    section = text
    for line in OUTPUT_LINES:
        section = F.regexp_replace(section, f"(?i){line}", "")
    for key in OUTPUT_EXAMPLE_KEYS:
        section = F.regexp_replace(section, OUTPUT_EXAMPLE.format(key=key), "")
    section = F.regexp_replace(section, OUTPUT_SECTION, NEW_OUTPUT_SECTION)
    text = F.when(text.contains("<output>") & text.contains("</output>"), section).otherwise(text)
    text = _replace_all(text, WORDING)
    return F.regexp_replace(text, ACTION_WORD, "tool_call")


def system_prompt(text: Column, catalog: Column | None = None) -> Column:
    """Whole rewriting of one system message; the catalogue text goes last."""
    text = rewrite_output_rules(drop_prompt_sections(text))
    if catalog is None:
        return text
    return F.when(catalog != "", F.concat(strip_right(text), F.lit("\n\n"), catalog)).otherwise(text)


def user_text(text: Column) -> Column:
    return _collapse_blank_lines(F.regexp_replace(text, BROWSER_STATE, ""))


def user_field_names(text: Column, answer: Column) -> Column:
    """Renames answer fields in a user text whose answer is readable JSON."""
    return F.when(strict_json(answer).isNotNull(), _replace_all(text, USER_RENAMES)).otherwise(text)


PARAMETER = ("struct<type:string,description:string,default:variant,minimum:string,minLength:string,"
             "maximum:string,maxLength:string>")
CATALOG = f"struct<tools:array<struct<name:string,description:string,params:map<string,{PARAMETER}>>>>"


def _limit(first: Column, second: Column) -> Column:
    """First bound unless absent, zero or empty, then the second."""
    number = first.try_cast("double")
    return F.coalesce(F.when((first != "") & ~(F.coalesce(number, F.lit(1.0)) == 0), first), second)


# Numbers whose text is not what Python prints, by sight; lists and objects are told by their type.
OTHER_NUMBER = r"\d[.eE]|\d{18}|-0"


def _plain_default(value: Column) -> Column:
    """A default that is text, a truth value or a whole number."""
    kind = F.schema_of_variant(value)
    text = F.try_variant_get(value, "$", "string")
    return F.when(kind == "BOOLEAN", F.initcap(text)).when(kind != "VOID", text)


def _needs_python(catalog_json: Column, tools: Column) -> Column:
    listed = F.exists(tools, lambda t: F.exists(F.map_values(t["params"]), lambda p: F.schema_of_variant(p["default"]).rlike("^(ARRAY|OBJECT)")))
    return catalog_json.rlike(OTHER_NUMBER) | F.coalesce(listed, F.lit(False))


def _parameter_line(name: Column, p: Column, shown: Column) -> Column:
    """``shown`` holds default and bounds as Python prints them where the plain forms don't do."""
    default = F.when(shown.isNull(), _plain_default(p["default"])).otherwise(shown["default"])
    low = F.when(shown.isNull(), _limit(p["minimum"], p["minLength"])).otherwise(shown["low"])
    high = F.when(shown.isNull(), _limit(p["maximum"], p["maxLength"])).otherwise(shown["high"])
    bounds = (
        F.when(low.isNotNull() & high.isNotNull(), F.concat(F.lit("range: ["), low, F.lit(", "), high, F.lit("]")))
        .when(low.isNotNull(), F.concat(F.lit("min: "), low))
        .when(high.isNotNull(), F.concat(F.lit("max: "), high)))
    parts = F.array_compact(F.array(F.when(p["description"] != "", p["description"]), F.concat(F.lit("default: "), default), bounds))
    head = F.concat(F.lit("    * "), name, F.lit(" ("), F.coalesce(p["type"], F.lit("unknown")), F.lit(")"))
    return F.concat(head, F.when(F.size(parts) > 0, F.concat(F.lit(": "), F.array_join(parts, ", "))).otherwise(""))


def _tool_lines(tool: Column, shown: Column) -> Column:
    named = F.concat(F.lit("- "), tool["name"], F.lit("()"))
    described = F.when(tool["description"] != "", F.concat(F.lit("  Description: "), tool["description"]))
    params = F.map_entries(tool["params"])
    listed = F.transform(params, lambda e: _parameter_line(e["key"], e["value"], F.try_element_at(shown, e["key"])))
    block = F.when(F.size(params) > 0, F.concat(F.array(F.lit("  Parameters:")), listed)).otherwise(
        F.array(F.lit("  Parameters: None")))
    return F.concat(F.array_compact(F.array(named, described)), block, F.array(F.lit("")))


def catalog_text(catalog_json: Column) -> Column:
    """Prompt text of a tool catalogue; empty without tools or when unreadable.

    Catalogues with fractions, very large numbers, lists or objects have these
    printed by the Arrow helper; all others are settled natively.
    """
    tools = F.from_json(catalog_json, CATALOG)["tools"]
    shown = L.printed_parameters(F.when(_needs_python(catalog_json, tools), catalog_json))

    def text(p: Column) -> Column:
        numbered = F.transform(p["tools"], lambda t, i: F.struct(t.alias("tool"), F.get(p["shown"], i).alias("shown")))
        named = F.filter(numbered, lambda e: e["tool"]["name"] != "")
        lines = F.flatten(F.transform(named, lambda e: _tool_lines(e["tool"], e["shown"])))
        header = F.array(*[F.lit(h) for h in CATALOG_HEADER])
        return F.when(F.size(p["tools"]) > 0, strip_right(F.array_join(F.concat(header, lines), "\n"))).otherwise("")

    return let(F.struct(tools.alias("tools"), shown.alias("shown")), text)
