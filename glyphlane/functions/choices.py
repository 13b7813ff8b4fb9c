"""Reading an option letter or a value out of a free answer."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import literals as L
from .text import let, strip, words

# --- Fixed values of the answer rules --------------------------------------------

API_FAILURE = "Failed to obtain answer via API"
REFUSALS = (
    "Sorry, I can't help with images of people yet.",
    "I can't process this file.",
    "I'm sorry, but without the image provided",
    "Cannot determine the answer",
)
REFUSED = "Z"
SEPARATORS = ".()[],:;!*#{}"
LETTERS = string.ascii_uppercase

# -----------------------------------------------------------------------------------


def options_map(columns: dict[str, Column]) -> Column:
    """Letter to option text for the given columns, absent options left out."""
    pairs = [x for letter in LETTERS if letter in columns for x in (F.lit(letter), columns[letter])]
    return F.map_filter(F.create_map(*pairs), lambda k, v: v.isNotNull())


SIGNS = [chr(ord("A") + i) for i in range(128)]


def list_letters(choices: Column) -> Column:
    """Letters by position for an option list; the signs after Z follow in code order."""
    code = lambda i: F.lpad(F.hex(i + ord("A")), 4, "0")
    return F.when(F.size(choices) <= len(SIGNS), F.slice(F.array(*[F.lit(s) for s in SIGNS]), F.lit(1), F.size(choices))).otherwise(
        F.transform(choices, lambda c, i: F.decode(F.unhex(code(i)), "UTF-16BE")))


def options_from_list(choices: Column) -> Column:
    return F.map_from_arrays(list_letters(choices), choices)


def _named_letter(answer: Column, letters: Column) -> Column:
    refused = F.lit(False)
    for phrase in REFUSALS:
        refused = refused | answer.contains(phrase)
    spaced = F.translate(answer, SEPARATORS, " " * len(SEPARATORS))

    def decide(tokens: Column) -> Column:
        return let(F.array_intersect(letters, tokens), lambda n: F.when(
            F.size(n) == 1, F.when(~(F.array_contains(tokens, "A") & (F.size(tokens) > 3)), n[0])
        ).when((F.size(n) == 0) & F.array_contains(tokens, REFUSED), F.lit(REFUSED)))

    return F.when(~answer.contains(API_FAILURE), F.when(refused, REFUSED).otherwise(let(words(spaced), decide)))


def _letter_by_text(answer: Column, letters: Column, texts: Column) -> Column:
    held = let(F.lower(answer), lambda a: F.array_compact(F.zip_with(
        letters, texts, lambda k, v: F.when(a.contains(F.lower(v)), k))))
    return let(held, lambda h: F.when(F.size(h) == 1, h[0]))


def option_letter(answer: Column, options: Column) -> Column:
    """Letter an answer names, Z for a refusal, NULL when unclear."""
    return _named_letter(answer, F.map_keys(options))


def option_by_text(answer: Column, options: Column) -> Column:
    """Letter of the only option whose text the answer holds."""
    return _letter_by_text(answer, F.map_keys(options), F.map_values(options))


def infer_option(answer: Column, options: Column) -> Column:
    """Letter by name, else by text; a bare option letter needs no further rule."""
    return F.when(F.map_contains_key(options, answer), answer).otherwise(
        F.coalesce(option_letter(answer, options), option_by_text(answer, options)))


def infer_listed(answer: Column, choices: Column) -> Column:
    """The same for an option list, without a map of it."""
    letters = list_letters(choices)
    return F.when(F.array_contains(letters, answer), answer).otherwise(
        F.coalesce(_named_letter(answer, letters), _letter_by_text(answer, letters, choices)))


def gold_letter(answer: Column) -> Column:
    return F.when(answer.rlike("^[A-Z]$"), answer).otherwise(F.lit("A"))


def stand_in(question_id: Column, options: Column, seed: int | str = 0) -> Column:
    """Repeatable random pick among the options and Z."""
    choices = F.array_union(F.map_keys(options), F.array(F.lit(REFUSED)))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), question_id.cast("string")).cast("binary"))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.element_at(choices, (number % F.size(choices) + 1).cast("int"))


# --- value answers --------------------------------------------------------------------

NUMBER = r"^[+-]*((0+|[1-9]\d*)|(\d+\.\d*|\.\d+)(e[+-]?\d+)?|\d+e[+-]?\d+)$"
UNSIGNED = r"^(?:[1-9]\d*|\d+\.\d*)$"  # the most usual numbers: read as they are
RATIO = r"^(?:\((?=.*\)$))?\(?(\d+\.?\d*)\)?/\(?(\d+\.?\d*)\)?\)?$"
ARITHMETIC = r"^[0-9eE+\-*/%.() \t]+$"


def _plain_number(text: Column) -> Column:
    sign = F.when(F.length(F.regexp_replace(F.regexp_extract(text, "^[+-]*", 0), r"\+", "")) % 2 == 1, -1.0).otherwise(1.0)
    signed = F.when(text.rlike(NUMBER), sign * F.regexp_replace(text, "^[+-]*", "").try_cast("double"))
    return F.when(text.rlike(UNSIGNED), text.try_cast("double")).otherwise(signed)


def _latex_to_arithmetic(text: Column) -> Column:
    """The small LaTeX part that is plain arithmetic: fractions, roots and pi."""
    read = F.regexp_replace(text, r"\\d?frac\{([^{}]*)\}\{([^{}]*)\}", r"(($1)/($2))")
    read = F.regexp_replace(read, r"\\sqrt\{([^{}]*)\}", r"(($1)**0.5)")
    read = F.regexp_replace(F.regexp_replace(read, r"\\pi", "(3.141592653589793)"), r"\$", "")
    return F.when(text.contains("\\") | text.contains("$"), read).otherwise(text)


def _ratio(arithmetic: Column) -> Column:
    """Quotient of two plain numbers, each in brackets or not."""
    part = lambda i: F.regexp_extract(arithmetic, RATIO, i).try_cast("double")
    return F.when(arithmetic.contains("/") & arithmetic.rlike(RATIO), F.try_divide(part(1), part(2)))


def with_equalities(df: DataFrame, compared: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Adds a column per entry: whether two answers are the same text, lower-cased and stripped, or the same number.

    Plain numbers and quotients compare natively; only other texts that look
    like arithmetic reach the Arrow evaluator, once for all columns. The steps
    are projections, which Spark compiles; numbers are read of unequal texts alone.
    """
    col = lambda name, out: F.col(f"_{name}_{out}")
    step = lambda rows, make: rows.withColumns({f"_{n}_{out}": c for out in compared for n, c in make(out).items()})
    unequal = lambda out: col("a", out) != col("b", out)
    known = lambda out: col("na", out).isNotNull() & col("nb", out).isNotNull()

    def asked(out: str) -> Column:
        return unequal(out) & ~known(out) & col("x", out).rlike(ARITHMETIC) & col("y", out).rlike(ARITHMETIC)

    rows = step(df, lambda out: {n: F.lower(strip(v)) for n, v in zip("ab", compared[out])})
    rows = step(rows, lambda out: {n: F.when(unequal(out), _latex_to_arithmetic(col(v, out))) for n, v in zip("xy", "ab")})
    rows = step(rows, lambda out: {f"n{v}": F.when(unequal(out), F.coalesce(_plain_number(col(v, out)), _ratio(col(n, out)))) for n, v in zip("xy", "ab")})
    rows = step(rows, lambda out: {
        "same": ~unequal(out) | (known(out) & (F.abs(col("na", out) - col("nb", out)) < L.VALUE_TOLERANCE)), "ask": asked(out)})
    rows = step(rows, lambda out: {n: F.when(col("ask", out), col(n, out)) for n in "xy"})
    rows = step(rows, lambda out: {"computed": L.same_value(col("x", out), col("y", out))})
    return rows.withColumns({out: F.coalesce(col("same", out), F.lit(False)) | F.coalesce(col("computed", out), F.lit(False)) for out in compared}).drop(
        *[f"_{n}_{out}" for out in compared for n in ("a", "b", "x", "y", "na", "nb", "same", "ask", "computed")])


def with_equality(df: DataFrame, given: Column, gold: Column, out: str) -> DataFrame:
    return with_equalities(df, {out: (given, gold)})
