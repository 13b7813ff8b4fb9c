"""Structured parts of model answers as columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import prefix_sums
from .json import kind, strict_json
from .text import let, strip

FENCE = "```"


def strip_reasoning(text: Column) -> Column:
    """What follows the last closing think tag, stripped."""
    return strip(F.substring_index(text, "</think>", -1))


def _after(text: Column, mark: str) -> Column:
    return F.substring(text, F.locate(mark, text) + len(mark), F.length(text))


def fenced_json(text: Column) -> Column:
    """Struct value, raw_text, parse_error of the first fenced block or the text."""
    block = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    body = F.when(text.rlike(r"(?s)```(?:json)?\s*(.*?)\s*```"), block).otherwise(text)
    return let(strict_json(body), lambda v: F.struct(
        v.alias("value"), F.when(v.isNull(), text).alias("raw_text"), v.isNull().alias("parse_error")))


def list_json(text: Column) -> Column:
    """Variant list of a ```json block or of the outermost brackets; a single
    object is a list of one, anything else an empty list."""
    rest = _after(text, "```json")
    fenced = strip(F.when(rest.contains(FENCE), F.substring_index(rest, FENCE, 1)).otherwise(rest))
    first, tail = F.locate("[", text), F.locate("]", F.reverse(text))
    bracketed = F.when((first > 0) & (tail > 0), F.substring(text, first, F.length(text) - tail + 2 - first))
    body = F.when(text.contains("```json"), fenced).otherwise(bracketed)
    none = F.array().cast("array<variant>")
    return let(strict_json(body), lambda v: F.coalesce(
        F.when(kind(v) == "ARRAY", F.try_variant_get(v, "$", "array<variant>"))
        .when(kind(v) == "OBJECT", F.array(v)), none))


POINT = "array<struct<x:double,y:double,label:string>>"


def points(text: Column) -> Column:
    """Points with labels; unlabelled ones count as ``point_<n>``."""
    rest = _after(text, "```json")
    body = F.when(text.contains("```json"), F.substring_index(rest, FENCE, 1)).otherwise(text)

    def read(items: Column) -> Column:
        kept = F.filter(items, lambda e: F.try_variant_get(e, "$.point_2d", "variant").isNotNull())
        pairs = F.transform(kept, lambda e, i: F.struct(
            F.try_variant_get(e, "$.point_2d", "array<double>").alias("p"),
            F.coalesce(F.try_variant_get(e, "$.label", "string"),
                       F.concat(F.lit("point_"), (i + 1).cast("string"))).alias("label")))
        whole = F.forall(pairs, lambda e: F.size(e["p"]) == 2)
        return F.when(whole, F.transform(pairs, lambda e: F.struct(
            e["p"][0].alias("x"), e["p"][1].alias("y"), e["label"].alias("label"))))

    items = F.try_variant_get(strict_json(body), "$", "array<variant>")
    return F.coalesce(let(items, read), F.array()).cast(POINT)


def first_code_json(text: Column) -> Column:
    """Variant of the first fenced code block of any language."""
    return strict_json(strip(F.nullif(F.regexp_extract(text, r"(?s)```[^\n`]*\n(.*?)```", 1), F.lit(""))))


def tool_call(text: Column) -> Column:
    """Struct name, action, arguments of the first tool-call block."""
    start, end = "<tool_call>\n", "\n</tool_call>"
    body = F.when(text.contains(start), F.substring_index(_after(text, start), end, 1))
    return let(strict_json(body), lambda v: F.struct(
        F.try_variant_get(v, "$.name", "string").alias("name"),
        F.try_variant_get(v, "$.arguments.action", "string").alias("action"),
        F.try_variant_get(v, "$.arguments", "variant").alias("arguments")))


def last_code_block(text: Column, language: str = "python") -> Column:
    """Stripped content of the last fenced block of one language."""
    blocks = F.regexp_extract_all(text, F.lit(rf"(?s)```{language}\s*(.*?)```"), F.lit(1))
    return strip(F.try_element_at(blocks, F.lit(-1)))


def without_box_tags(text: Column) -> Column:
    plain = F.replace(F.replace(text, F.lit("<ref>"), F.lit("")), F.lit("</ref>"), F.lit(""))
    return F.regexp_replace(plain, r"(?d)<box>.*?(</box>|$)", "")


# Characters escaped inside code blocks, in order.
CODE_ESCAPES = (
    ("`", "\\`"), ("<", "&lt;"), (">", "&gt;"), (" ", "&nbsp;"), ("*", "&ast;"), ("_", "&lowbar;"),
    ("-", "&#45;"), (".", "&#46;"), ("!", "&#33;"), ("(", "&#40;"), (")", "&#41;"), ("$", "&#36;"),
)


def to_html(text: Column) -> Column:
    """Lines to HTML; fences toggle a code element, code lines are escaped."""
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")

    def escaped(line: Column) -> Column:
        for old, new in CODE_ESCAPES:
            line = F.replace(line, F.lit(old), F.lit(new))
        return line

    def shown(p: Column) -> Column:
        def element(line: Column, i: Column, inside: Column) -> Column:
            opened = F.concat(F.lit('<pre><code class="language-'), F.substring_index(line, "`", -1), F.lit('">'))
            plain = F.concat(F.lit("<br>"), F.when(inside, escaped(line)).otherwise(line))
            return (F.when(line.contains(FENCE), F.when(inside, opened).otherwise("<br></code></pre>"))
                    .when(i > 0, plain).otherwise(line))

        fences = prefix_sums(F.transform(p, lambda line: line.contains(FENCE).cast("int")))
        placed = F.transform(p, lambda line, i: F.struct(line.alias("line"), i.alias("i")))
        return F.zip_with(placed, fences, lambda e, n: element(e["line"], e["i"], n % 2 == 1))

    return F.array_join(let(lines, shown), "")


def extraction_status(response: Column) -> Column:
    """Struct success, data, error of a document-extraction answer."""
    return let(fenced_json(response), lambda r: F.struct(
        response.isNotNull().alias("success"), F.when(~r["parse_error"], r["value"].cast("string")).alias("data"),
        F.when(response.isNull(), "no response").alias("error")))


GENERAL = "general"  # fixed value: the document type whose answer is plain text


def document_status(requests: DataFrame, responses: DataFrame, prompts: dict[str, str], general: str, file: str = "file") -> DataFrame:
    """One row per request: file, prompt, success, data, error.

    ``requests`` has file and document_type, ``responses`` file and text. A type
    without a prompt of its own takes the general one. Only the general type
    itself keeps its answer as text.
    """
    kind = F.coalesce(F.col("document_type"), F.lit(GENERAL))
    prompt = F.lit(general)
    for name, text in prompts.items():
        prompt = F.when(kind == name, text).otherwise(prompt)
    told = requests.join(responses.select(file, F.col("text").alias("_response")), file, "left")
    read = told.withColumn("_status", F.when(kind == GENERAL, F.struct(
        F.col("_response").isNotNull().alias("success"), F.col("_response").alias("data"),
        F.when(F.col("_response").isNull(), "no response").alias("error"))).otherwise(extraction_status(F.col("_response"))))
    return read.select(file, prompt.alias("prompt"), "_status.success", "_status.data", "_status.error")
