"""Prompt texts of question benchmarks and of the judge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_right

# --- Fixed values: prompt texts ----------------------------------------------------

SELECT_OPTION = "Please select the correct answer from the options above. \n"

CHOICE_JUDGE_HEAD = (
    "You are an AI assistant who will help me to match "
    "an answer with several options of a single-choice question. "
    "You are provided with a question, several options, and an answer, "
    "and you need to find which option is most similar to the answer. "
    "If the meaning of all options are significantly different from the answer, output Z. "
    "Your should output a single uppercase character in A, B, C, D (if they are valid options), and Z. \n"
    "Example 1: \n"
    "Question: What is the main object in image?\nOptions: A. teddy bear B. rabbit C. cat D. dog\n"
    "Answer: a cute teddy bear\nYour output: A\n"
    "Example 2: \n"
    "Question: What is the main object in image?\nOptions: A. teddy bear B. rabbit C. cat D. dog\n"
    "Answer: Spider\nYour output: Z\n"
    "Example 3: \n"
)

# What stands before question, options, answer and output.
CHOICE_JUDGE_PARTS = ("Question: ", "?\nOptions: There are several options: \n", "\nAnswer: ", "\nYour output: ")
VALUE_JUDGE_PARTS = ("\nModel response: ", "\nExtracted answer: ")

VALUE_JUDGE_TASK = """
Please read the following example.
Then extract the answer from the model response and type it at the end of the prompt.\n
"""

VALUE_JUDGE_EXAMPLES = (
    """
Hint: Please answer the question and provide the final answer at the end.\n
Question: Which number is missing?\n
Model response: The number missing in the sequence is 14.\n
Extracted answer: 14
""",
    """
Hint: Please answer the question and provide the final answer at the end.\n
Question: What is the fraction of females facing the camera?\n
Model response: The fraction of females facing the camera is 0.6,
which means that six out of ten females in the group are facing the camera.\n
Extracted answer: 0.6
""",
    """
Hint: Please answer the question and provide the final answer at the end.\n
Question: How much money does Luca need to buy a sour apple candy and a butter-scotch candy? (Unit: $)\n
Model response: Luca needs $1.45 to buy a sour apple candy and a butterscotch candy.\n
Extracted answer: 1.45
""",
    """
Hint: Please answer the question and provide the final answer at the end.\n
Question: Between which two years does the line graph saw its maximum peak?\n
Model response: The line graph saw its maximum peak between 2007 and 2008.\n
Extracted answer: [2007, 2008]
""",
    """
Hint: Please answer the question and provide the correct option letter, e.g., A, B, C, D, at the end.\n
Question: What fraction of the shape is blue?\n
Choices: (A) 3/11 (B) 8/11 (C) 6/11 (D) 3/5\n
Model response: The correct answer is (B) 8/11.\n
Extracted answer: B
""",
)

# -------------------------------------------------------------------------------------


def _option_lines(options: Column) -> Column:
    return F.array_join(F.transform(
        F.map_entries(options), lambda e: F.concat(e["key"], F.lit(". "), e["value"], F.lit("\n"))), "")


def choice_prompt(question: Column, options: Column, hint: Column | None = None, strip_tail: bool = True) -> Column:
    hinted = F.lit("") if hint is None else F.coalesce(F.concat(F.lit("Hint: "), hint, F.lit("\n")), F.lit(""))
    listed = F.when(F.size(options) > 0, F.concat(
        F.lit("Options:\n"), _option_lines(options), F.lit(SELECT_OPTION))).otherwise("")
    prompt = F.concat(hinted, F.lit("Question: "), question, F.lit("\n"), listed)
    return strip_right(prompt) if strip_tail else prompt


def request_items(images: Column, prompt: Column, min_pixels: int, max_pixels: int, prefix: str = "",
                  suffix: str | None = None) -> Column:
    """Image items with their pixel bounds, then the text item."""
    kind = lambda type_, value, lo, hi: F.struct(
        F.lit(type_).alias("type"), value.alias("value"), F.lit(lo).cast("bigint").alias("min_pixels"),
        F.lit(hi).cast("bigint").alias("max_pixels"))
    pictures = F.transform(images, lambda p: kind("image", F.concat(F.lit(prefix), p), min_pixels, max_pixels))
    text = prompt if suffix is None else F.concat(prompt, F.lit(suffix))
    return F.concat(pictures, F.array(kind("text", text, None, None)))


def choice_judge_prompt(question: Column, options: Column, prediction: Column) -> Column:
    asked, offered, answered, wanted = CHOICE_JUDGE_PARTS
    return F.concat(F.lit(CHOICE_JUDGE_HEAD + asked), question, F.lit(offered), _option_lines(options), F.lit(answered), prediction, F.lit(wanted))


def value_judge_prompt(question: Column, prediction: Column) -> Column:
    head = VALUE_JUDGE_TASK + "".join(e + "\n" for e in VALUE_JUDGE_EXAMPLES)
    return F.concat(F.lit(head), question, F.lit(VALUE_JUDGE_PARTS[0]), prediction, F.lit(VALUE_JUDGE_PARTS[1]))
