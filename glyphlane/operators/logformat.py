"""Message cells of agent logs to the tagged format, row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import literals as L
from ..functions.json import kind, strict_json
from ..functions.prompts import system_prompt, user_text
from ..functions.text import let


# JSON texts that print alike in Python: without escapes, fractions, exponents and negative zeros.
OTHER_LEXEME = r"\\|\d[.eE]|-0"
TOKEN = r'"[^"]*"|[{}\[\]:,]|[^\s{}\[\]:,"]+'


def _python_json(raw: Column) -> Column:
    """A JSON text without escapes as Python's printer spaces it."""
    tokens = F.regexp_extract_all(raw, F.lit(TOKEN), F.lit(0))
    return F.array_join(F.transform(tokens, lambda t: F.when(t.isin(":", ","), F.concat(t, F.lit(" "))).otherwise(t)), "")


def plain_answer(cell: Column) -> Column:
    """Reasoning and tool-call blocks of an answer that native functions read as Python does, NULL for any other.

    Such an answer is an object of texts and whole numbers whose actions, if any,
    are objects of named arguments.
    """
    def settle(v: Column) -> Column:
        field = lambda key, type_: F.try_variant_get(v, f"$.{key}", type_)
        sort = lambda key: F.coalesce(kind(field(key, "variant")), F.lit("ABSENT"))
        actions = field("action", "array<map<string,variant>>")
        named = F.forall(actions, lambda a: F.forall(F.map_values(a), lambda arguments: kind(arguments) == "OBJECT"))
        plain = (
            (kind(v) == "OBJECT") & ~cell.rlike(OTHER_LEXEME) & sort("thinking").isin("STRING", "ABSENT")
            & ((sort("action") == "ABSENT") | F.coalesce(named, F.lit(False))))
        for key, _ in L.ANSWER_TITLES:
            plain = plain & sort(key).isin("STRING", "BIGINT", "ABSENT")
        parts = [F.coalesce(field("thinking", "string"), F.lit(""))]
        parts += [F.coalesce(F.concat(F.lit(f"\n\n{title}: "), field(key, "string")), F.lit("")) for key, title in L.ANSWER_TITLES]
        reasons = F.concat(*parts)
        raw = F.from_json(cell, "struct<action:array<map<string,string>>>")["action"]  # keeps order and spelling
        calls = F.flatten(F.transform(raw, lambda a: F.transform(F.map_entries(a), lambda e: F.concat(
            e["key"], F.lit("("), _python_json(e["value"]), F.lit(")")))))
        blocks = F.array_compact(F.array(
            F.when(reasons != "", F.concat(F.lit("<thinking>\n"), reasons, F.lit("\n</thinking>"))),
            F.when(F.size(calls) > 0, F.concat(F.lit("<tool_call>\n"), F.array_join(calls, "\n"), F.lit("\n</tool_call>")))))
        return F.when(plain, F.array_join(blocks, "\n\n"))

    return let(strict_json(cell), settle)


def tag_answers(rows: DataFrame, cell: str, out: str) -> DataFrame:
    """Adds the tagged form of JSON answers: plain ones natively, the rest by Python's own rules."""
    native = rows.withColumn("_plain", plain_answer(F.col(cell)))
    rest = F.when(F.col("_plain").isNull(), F.col(cell))
    return native.withColumn("_rest", L.tagged_answer(rest)).withColumn(out, F.coalesce("_plain", "_rest")).drop("_plain", "_rest")


def convert_messages(parsed: Column, catalog: Column | None) -> Column:
    """Rewritten messages; answers are in the tagged format already."""
    def rewritten(m: Column) -> Column:
        content = (
            F.when(m["as_is"].isNotNull(), m["content"])
            .when(m["role"] == "system", system_prompt(m["content"], catalog))
            .when(m["role"] == "user", user_text(m["content"]))
            .otherwise(m["content"]))
        return F.struct(m["role"].alias("role"), content.alias("content"), m["as_is"].alias("as_is"))

    return F.transform(parsed, rewritten)


# A list of role and content in single quotes: its strings, and what is left of it when each string is an "S".
QUOTED = "'[^']*'"
PLAIN_LIST = r"^\[(?:\{S: ?S, ?S: ?S\}, ?)*\{S: ?S, ?S: ?S\}\]$"
# Signs that Python's printer leaves as they are, all but the quotes and line ends treated apart.
PRINTED = r"^[\n\r\t\x20-\x5B\x5D-\x7E\x{A1}-\x{AC}\x{AE}-\x{24F}\x{400}-\x{481}\x{4E00}-\x{9FA5}]*$"


def plain_messages(cell: Column) -> Column:
    """Messages of a cell that native functions read as Python does, NULL for any other.

    Such a cell is a list of dicts of role and content, all texts in single
    quotes without escapes or line ends, whose answers are plain.
    """
    strings = F.transform(F.regexp_extract_all(cell, F.lit(QUOTED), F.lit(0)), lambda t: F.substring(t, F.lit(2), F.length(t) - 2))

    def message(texts: Column, i: Column) -> Column:
        role, content = F.get(texts, i * 4 + 1), F.get(texts, i * 4 + 3)
        content = F.when(role == "assistant", plain_answer(content)).otherwise(content)
        return F.struct(role.alias("role"), content.alias("content"), F.lit(None).cast("string").alias("as_is"))

    def settle(texts: Column) -> Column:
        places = F.sequence(F.lit(0), (F.size(texts) / 4).cast("int") - 1)
        named = F.forall(places, lambda i: (F.get(texts, i * 4) == "role") & (F.get(texts, i * 4 + 2) == "content") & F.get(texts, i * 4 + 1).isin(*L.ROLES))
        read = F.transform(places, lambda i: message(texts, i))
        return F.when(named, let(read, lambda m: F.when(F.forall(m, lambda e: e["content"].isNotNull()), m)))

    structured = ~cell.rlike(r"[\\\r\n\x00]") & F.regexp_replace(cell, QUOTED, "S").rlike(PLAIN_LIST)
    return F.when(structured, let(strings, settle))


def printed_messages(messages: Column) -> Column:
    """Python text of a message list if all of it prints without escapes but for line ends, tabs and quotes, else NULL."""
    def printed(text: Column) -> Column:
        for sign, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
            text = F.replace(text, F.lit(sign), F.lit(shown))
        return let(text, quoted)

    def quoted(text: Column) -> Column:
        single, double = text.contains("'"), text.contains('"')
        within = lambda t, q: F.concat(F.lit(q), t, F.lit(q))
        return F.when(single & ~double, within(text, '"')).when(single, within(F.replace(text, F.lit("'"), F.lit("\\'")), "'")).otherwise(within(text, "'"))

    each = F.transform(messages, lambda m: F.concat(F.lit("{'role': "), printed(m["role"]), F.lit(", 'content': "), printed(m["content"]), F.lit("}")))
    simple = F.forall(messages, lambda m: m["as_is"].isNull() & m["role"].rlike(PRINTED) & m["content"].rlike(PRINTED))
    return F.when(simple, F.concat(F.lit("["), F.array_join(each, ", "), F.lit("]")))


def convert_cells(rows: DataFrame, catalog: Column | None = None, cell: str = "messages") -> DataFrame:
    """Replaces the cell by its converted literal text; unreadable cells stay.

    Plain cells are read and printed natively; only the others reach Python.
    Contents that are no text and messages of other roles pass through as they
    are. ``status`` tells converted cells from kept ones.
    """
    native = rows.withColumn("_plain", plain_messages(F.col(cell)))
    parsed = native.withColumn("_read", L.messages_as_written(F.when(F.col("_plain").isNull(), F.col(cell))))
    read = F.coalesce("_plain", "_read")
    built = parsed.withColumn("_built", F.when(read.isNotNull(), convert_messages(read, catalog)))
    shown = built.withColumn("_shown", printed_messages(F.col("_built")))
    out = shown.withColumn("_rest", L.messages_to_literal(F.when(F.col("_shown").isNull(), F.col("_built")))).withColumn(
        "_out", F.coalesce("_shown", "_rest"))
    return out.select(
        *[c for c in rows.columns if c != cell],
        F.coalesce("_out", cell, F.lit("[]")).alias(cell),
        F.when(F.col("_out").isNotNull(), "converted").otherwise("kept").alias("status"))
