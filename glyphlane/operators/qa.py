"""Question benchmarks: preparation, extraction, judge answers and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import choices as C
from ..functions import literals as L
from ..functions.json import kind, strict_json
from ..functions.text import let

# Fixed values of the benchmark files and the judge.
REFERENCE_LENGTH = 64
CHOICE_ATTEMPTS = 25
VALUE_ATTEMPTS = 5
OTHER_ANSWERS = "Other Answers"


def resolve_images(rows: DataFrame, index: str = "index", image: str = "image") -> DataFrame:
    """Replaces image cells that name another row by that row's cell.

    Only the named cells travel. A reference that leads nowhere, or to another
    reference, stops the job.
    """
    is_reference = F.length(image) <= REFERENCE_LENGTH
    references = rows.where(is_reference)
    named = references.select(F.col(image).alias("_target")).distinct()
    targets = rows.select(F.col(index).cast("string").alias("_target"), F.col(image).alias("_found")).join(
        named, "_target", "left_semi")
    found = references.withColumnRenamed(image, "_target").join(targets, "_target", "left")
    broken = F.col("_found").isNull() | (F.length("_found") <= REFERENCE_LENGTH)
    resolved = F.when(broken, F.raise_error(F.concat(F.lit("image reference "), "_target"))
                      .cast("string")).otherwise(F.col("_found"))
    return rows.where(~is_reference).unionByName(
        found.select(*[resolved.alias(image) if c == image else F.col(c) for c in rows.columns]))


def list_cells(rows: DataFrame, cell: str) -> DataFrame:
    """List-literal or plain cell to array<string>; JSON lists of texts natively."""
    is_list = F.col(cell).startswith("[") & F.col(cell).endswith("]")
    parsed = rows.withColumn("_list", F.when(is_list, let(strict_json(F.col(cell)), lambda v: F.when(
        kind(v) == "ARRAY", let(F.try_variant_get(v, "$", "array<variant>"), lambda a: F.when(
            F.forall(a, lambda e: F.schema_of_variant(e) == "STRING"),
            F.transform(a, lambda e: F.try_variant_get(e, "$", "string"))))))))
    rest = F.when(is_list & F.col("_list").isNull(), F.col(cell))
    return parsed.withColumn("_rest", L.strings_from_literal(rest)).withColumn(
        cell, F.when(is_list, F.coalesce("_list", "_rest")).otherwise(F.array(cell))).drop("_list", "_rest")


def numeric_index(rows: DataFrame, index: str = "index") -> Column:
    """The index as a number if every row's is one, else NULL."""
    every = rows.agg(F.bool_and(F.col(index).rlike("^[0-9]+$"))).scalar()
    return F.when(every, F.col(index).try_cast("bigint"))


def unify_names(df: DataFrame) -> DataFrame:
    """Lower-cases column names other than single capital letters."""
    return df.toDF(*[c if len(c) == 1 and c in C.LETTERS else c.lower() for c in df.columns])


def load_predictions(records: DataFrame) -> DataFrame:
    """Flat rows of prediction records: the annotation's fields and the answer."""
    return records.select("annotation.*", F.col("result.gen").cast("string").alias("prediction"))


def foreign_predictions(predictions: DataFrame, benchmark: DataFrame, index: str = "index") -> DataFrame:
    """Predictions whose question is not in the benchmark."""
    return predictions.join(benchmark.select(index), index, "left_anti")


def open_to_choice(rows: DataFrame) -> DataFrame:
    """Questions without option A: their answer becomes A, the rest B."""
    missing = F.col("A").isNull()
    return rows.withColumn("B", F.when(missing, OTHER_ANSWERS).otherwise(F.col("B"))).withColumn(
        "A", F.when(missing, F.col("answer")).otherwise(F.col("A")))


def gold_answers(benchmark: DataFrame, index: str = "index") -> DataFrame:
    return benchmark.select(index, C.gold_letter(F.col("answer")).alias("gt"))


def extract_options(questions: DataFrame, judge: DataFrame, question_id: str, options: str = "options",
                    attempts: int = CHOICE_ATTEMPTS, seed: int | str = 0) -> DataFrame:
    """Adds the extracted letter, its method, success and log.

    Rules first. Judge answers (question_id, attempt, text), at most ``attempts``
    per question, count where the rules leave it open: the first that names an
    option wins, and without one a repeatable random pick stands in.
    """
    told = judge.where((F.col("attempt") < attempts) & ~F.col("text").contains(C.API_FAILURE)).groupBy(question_id).agg(
        F.array_sort(F.collect_list(F.struct("attempt", "text"))).alias("_told"))
    ruled = questions.withColumn("_rule", C.infer_option(F.col("prediction"), F.col(options)))
    usable = F.filter(
        F.transform("_told", lambda e: F.struct(
            C.infer_option(e["text"], F.col(options)).alias("letter"), e["text"].alias("text"))),
        lambda e: e["letter"].isNotNull() & (e["letter"] != C.REFUSED))
    joined = ruled.join(told, question_id, "left").withColumn(
        "_judged", F.when(F.col("_rule").isNull(), F.get(usable, F.lit(0)))).drop("_told")
    method = F.when(F.col("_rule").isNotNull(), "rule").when(F.col("_judged").isNotNull(), "judge").otherwise("random")
    letter = F.coalesce("_rule", "_judged.letter", C.stand_in(F.col(question_id), F.col(options), seed))
    success = F.when(F.col("_rule").isNotNull(), F.col("_rule") != C.REFUSED).otherwise(F.col("_judged").isNotNull())
    log = (
        F.when(F.col("_rule").isNotNull(), F.concat(
            F.lit("Rule extract "), F.when(success, "success").otherwise("failed"), F.lit(" with rule result: "),
            F.col("_rule"), F.lit(" prediction: "), F.col("prediction")))
        .when(F.col("_judged").isNotNull(), F.concat(F.lit("judge extract Succeed. judge:"), F.col("_judged.text"), F.lit("\n")))
        .otherwise("judge extract failed. randomly generate one."))
    return joined.withColumn("extracted_answer", letter).withColumn("extraction_method", method).withColumn(
        "extraction_success", success).withColumn("extraction_log", log).drop("_rule", "_judged")


def scored(extracted: DataFrame, gold: DataFrame, index: str = "index") -> DataFrame:
    """Rows with a known gold answer and whether they hit it."""
    return extracted.join(gold, index).withColumn(
        "hit", F.when(F.col("extracted_answer") == F.col("gt"), 1).otherwise(0).cast("bigint"))


def accuracy(rows: DataFrame, split: str = "split") -> DataFrame:
    """Mean hit overall (split NULL) and per split, absent splits as 'unknown'."""
    filled = rows.select(F.coalesce(F.col(split), F.lit("unknown")).alias("split"), "hit")
    return filled.rollup("split").agg(
        F.count("*").alias("questions"), F.sum("hit").alias("hits"), F.round(F.avg("hit"), 6).alias("accuracy"))


def summary_json(accuracy_rows: DataFrame) -> DataFrame:
    """One JSON text with the overall accuracy and the accuracy per split."""
    per_split = F.map_from_entries(F.array_sort(F.collect_list(F.when(
        F.col("split").isNotNull(), F.struct("split", "accuracy")))))
    return accuracy_rows.agg(
        F.max(F.when(F.col("split").isNull(), F.col("accuracy"))).alias("overall_accuracy"),
        per_split.alias("accuracy_by_split")).select(F.to_json(F.struct("overall_accuracy", "accuracy_by_split")).alias("summary"))


# --- value answers -------------------------------------------------------------------------

def _read(response: Column) -> Column:
    """The option a response names, or the response itself."""
    return F.when(F.size("choices") > 0, C.infer_listed(response, F.col("choices"))).otherwise(response)


def value_outcomes(questions: DataFrame, judge: DataFrame, question_id: str, attempts: int = VALUE_ATTEMPTS) -> DataFrame:
    """Adds res, extract_model, extract_flag, prefetched and hit for value questions.

    A question with options is fetched early whenever the rules read an option,
    right or wrong; one without only when the answer is right. The others take
    the judge's first answer that is no failure. What is fetched early without
    options is right, so both comparisons are known before it is decided.
    """
    told = judge.where((F.col("attempt") < attempts) & ~F.col("text").contains(C.API_FAILURE)).groupBy(
        question_id).agg(F.min_by("text", "attempt").alias("_judged"))
    has_options = F.size("choices") > 0
    joined = questions.join(told, question_id, "left").withColumn("_read", _read(F.col("prediction")))
    later = F.when(has_options, F.coalesce(_read(F.coalesce(F.nullif("_read", F.lit("")), "_judged", F.lit(""))), F.lit("False"))).otherwise(
        F.coalesce("_judged", F.lit("")))
    compared = C.with_equalities(joined, {"_right": (F.col("_read"), F.col("answer")), "_later": (later, F.col("answer"))})
    early = F.nullif(F.when(has_options | F.col("_right"), F.col("_read")), F.lit(""))
    fetched = compared.withColumn("_early", early)
    is_early = F.col("_early").isNotNull()
    return fetched.withColumns({
        "prefetched": is_early, "res": F.coalesce("_early", "_judged", F.lit("")),
        "extract_model": F.when(is_early, "rule").otherwise("judge"),
        "extract_flag": F.when(is_early, F.col("_early") != C.REFUSED).otherwise(F.col("_judged").isNotNull()),
        "hit": F.col("_later") | (is_early & ~has_options)}).drop("_early", "_judged", "_read", "_right", "_later")


def extract_values(questions: DataFrame, judge: DataFrame, question_id: str, attempts: int = VALUE_ATTEMPTS) -> DataFrame:
    """The outcomes without ``hit``."""
    return value_outcomes(questions, judge, question_id, attempts).drop("hit")


def score_values(extracted: DataFrame) -> DataFrame:
    """Adds ``hit`` to answers that were extracted elsewhere: whether ``res`` is right."""
    return C.with_equality(extracted, F.coalesce(_read(F.col("res")), F.lit("False")), F.col("answer"), "hit")


def category_scores(rows: DataFrame, extractors: list[str], category: str = "category") -> DataFrame:
    """Totals and rates per category and ``Overall``, sorted by subject.

    Extractor columns are filled on the Overall row only.
    """
    overall = F.grouping(category) == 1
    def only_overall(value: Column) -> Column:
        return F.when(overall, value).otherwise(0).cast("bigint")

    columns = []
    for name in extractors:
        mine = F.col("extract_model") == name
        columns += [only_overall(F.count_if(mine & F.col("extract_flag"))).alias(f"{name}_success"),
                    only_overall(F.count_if(mine)).alias(f"{name}_all")]
    prefetch, hit, tot = F.count_if("prefetched"), F.count_if("hit"), F.count("*")
    return rows.rollup(category).agg(
        F.when(overall, "Overall").otherwise(F.col(category)).alias("Subject"), tot.alias("tot"),
        prefetch.alias("prefetch"), hit.alias("hit"), F.round(prefetch / tot * 100, 6).alias("prefetch_rate"),
        F.round(hit / tot * 100, 6).alias("acc"), *columns).drop(category).orderBy("Subject")
