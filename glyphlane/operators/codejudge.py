"""Programming problems: prompts, captured outputs and tallies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import kind, strict_json
from ..functions.text import let, strip, words

# --- Fixed values: prompt texts, tolerances, result codes -------------------------------

TASK = (
    "You are required to solve a programming problem. "
    "Please enclose your code inside a ```python``` block. "
    " Do not write a main() function. If Call-Based format is used, return the result in an appropriate place instead of printing it.\n\n"
)
STANDARD_IO = "\nPlease write your code using Standard IO, i.e. input() and print()."
CALL_BASED = "\nPlease write your code using Call-Based format."
STARTER = "\nThe starter code is provided as below. Please finish the code.\n"
IMAGE_MARK = r"!\[image\]\(.*?\)"
RELATIVE, ABSOLUTE, DECIMALS = 1e-5, 1e-8, 3
NUMBER = r"(?i)^[+-]?((\d+(\.\d*)?|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)$"
PASSED, FAILED, ERROR, TIMEOUT = 1, 0, -1, -2

# -----------------------------------------------------------------------------------------


def problem_prompt(question: Column, starter_code: Column, input_output: Column, with_task: bool = True) -> Column:
    fn_name = F.nullif(F.try_variant_get(strict_json(input_output), "$.fn_name", "string"), F.lit(""))
    starter = F.nullif(starter_code, F.lit(""))
    form = F.when(fn_name.isNull() & starter.isNull(), STANDARD_IO).otherwise(CALL_BASED)
    return F.concat(
        F.lit((TASK if with_task else "") + "\nQUESTION:\n"), question, form,
        F.coalesce(F.concat(F.lit(STARTER), starter, F.lit("\n")), F.lit("")), F.lit("\nANSWER:\n"))


def interleaved(problems: DataFrame, problem_id: str, prompt: Column, images: Column) -> DataFrame:
    """Item rows of a prompt: the i-th image after the i-th text segment."""
    pieces = problems.select(problem_id, images.alias("_images"), F.posexplode(F.split(prompt, IMAGE_MARK)).alias("_i", "_text"))
    items = F.array_compact(F.array(
        F.when(F.col("_text") != "", F.struct((F.col("_i") * 2).alias("position"), F.lit("text").alias("type"), F.col("_text").alias("value"))),
        F.when(F.col("_i") < F.size("_images"), F.struct(
            (F.col("_i") * 2 + 1).alias("position"), F.lit("image").alias("type"), F.get("_images", F.col("_i")).alias("value")))))
    return pieces.select(problem_id, F.inline(items))


def catalogue(input_output: Column) -> Column:
    """Struct tests, first_input, first_output of a problem's test text."""
    def read(v: Column) -> Column:
        get = lambda path, type_: F.try_variant_get(v, path, type_)
        return F.struct(F.size(get("$.inputs", "array<variant>")).alias("tests"),
                        get("$.inputs[0]", "string").alias("first_input"), get("$.outputs[0]", "string").alias("first_output"))

    return let(strict_json(input_output), read)


def _number(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def _numbers(lines: Column) -> Column:
    return F.transform(lines, lambda x: _number(strip(x)))


def _all_close(a: Column, b: Column) -> Column:
    finite = lambda x: F.abs(x) < float("inf")
    close = lambda x, y: F.when(finite(x) & finite(y), F.abs(x - y) <= ABSOLUTE + RELATIVE * F.abs(y)).otherwise(
        (x == y) & ~F.isnan(x))
    pairs = F.zip_with(a, b, lambda x, y: F.coalesce(close(x, y), F.lit(False)))
    return (F.size(a) == F.size(b)) & F.forall(pairs, lambda ok: ok)


def _token_sets(lines: Column) -> Column:
    return F.array_sort(F.array_distinct(F.transform(lines, lambda x: F.array_sort(F.array_distinct(words(x))))))


def _rounded_sets(lines: Column) -> Column:
    values = F.transform(lines, lambda x: F.transform(words(x), lambda w: F.bround(_number(w), DECIMALS)))
    whole = F.forall(values, lambda v: F.forall(v, lambda n: n.isNotNull() & ~F.isnan(n)))
    return F.when(whole, F.array_sort(F.array_distinct(F.transform(values, lambda v: F.array_sort(F.array_distinct(v))))))


def expected_text(expected_json: Column) -> Column:
    """The expected output of a test as text; a list of lines is joined."""
    return let(strict_json(expected_json), lambda v: F.when(
        kind(v) == "ARRAY", F.array_join(F.try_variant_get(v, "$", "array<string>"), "\n")).otherwise(F.try_variant_get(v, "$", "string")))


def output_matches(output: Column, expected: Column) -> Column:
    """Whether captured lines count as the expected text.

    From strict to lenient: whole text, stripped lines, lines without blanks,
    close numbers, equal word sets per line, equal sets of rounded numbers.
    """
    wanted = F.transform(F.filter(F.split(expected, "\n"), lambda x: x != ""), strip)

    def decide(p: Column) -> Column:
        o, e = p["o"], p["e"]
        text = strip(expected)
        filled = F.filter(o, lambda x: x != "")
        spoken = F.filter(o, lambda x: F.size(words(x)) > 0)
        sets = _token_sets(spoken) == _token_sets(e)
        return F.coalesce(
            (strip(F.array_join(o, "\n")) == text) | (strip(F.array_join(F.transform(o, strip), "\n")) == text)
            | (o == e) | (filled == e)
            | _all_close(_numbers(filled), _numbers(e)) | sets
            | F.coalesce(_rounded_sets(spoken) == _rounded_sets(e), F.lit(False)), F.lit(False))

    return let(F.struct(output.alias("o"), wanted.alias("e")), decide)


def value_matches(output: Column, expected: Column) -> Column:
    """Whether a returned JSON value equals the expected one or its first element.

    An expected object stands for a list of it alone.
    """
    text = lambda v: v.cast("string")
    o, e = strict_json(output), strict_json(expected)
    first = F.when(kind(e) == "ARRAY", F.try_variant_get(e, "$[0]", "variant"))
    number = lambda v: F.when(~kind(v).isin("STRING", "BOOLEAN", "ARRAY", "OBJECT"), F.try_variant_get(v, "$", "double"))
    same = lambda a, b: F.coalesce((text(a) == text(b)) & (kind(a) == kind(b)), F.lit(False)) | F.coalesce(number(a) == number(b), F.lit(False))
    alone = (kind(e) == "OBJECT") & (text(o) == F.concat(F.lit("["), text(e), F.lit("]")))
    return same(o, e) | same(o, first) | F.coalesce(alone, F.lit(False))


def tally(results: DataFrame, problem_id: str, code: str = "code") -> DataFrame:
    """Counts per problem; -2 is counted as a time-out, as stored."""
    count = lambda value: F.count_if(F.col(code) == value)
    return results.groupBy(problem_id).agg(
        F.count("*").alias("total_tests"), count(PASSED).alias("passed_tests"), count(FAILED).alias("failed_tests"),
        count(ERROR).alias("error_tests"), count(TIMEOUT).alias("timeout_tests"),
        F.round(count(PASSED) / F.count("*"), 6).alias("accuracy"), F.bool_and(F.col(code) == PASSED).alias("all_passed"))
