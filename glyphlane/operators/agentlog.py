"""Agent logs: message cells and image ids to training rows.

Every step but the image lookup is an expression on the row, so a log of any
size is one scan, one join against the image map and the final length sort.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import literals as L
from ..functions import messages as M
from ..functions.json import strict_json
from ..functions.text import WHITESPACE, word_count
from ..functions.uris import base_name

# Fixed values of the log conversion.
IMAGE_TOKENS = 128
MAX_TOKENS = 20000
WHOLE_NUMBER = r"^\s*([+-]?\d+)(?:\.0*)?\s*$"
IMAGE_ENDINGS = ("jpg", "jpeg", "png", "JPG", "JPEG", "PNG")  # later ones win


def parse_messages(df: DataFrame, cell: str = "messages", out: str = "parsed") -> DataFrame:
    """Message cell to role/content pairs: JSON natively, the rest in Python."""
    native = df.withColumn("_native", M.json_messages(strict_json(F.col(cell))))
    rest = F.when(F.col("_native").isNull() & F.col(cell).isNotNull(), F.col(cell))
    return native.withColumn("_literal", L.messages_from_text(rest)).withColumn(
        out, F.coalesce("_native", "_literal", F.array().cast(L.MESSAGES))
    ).drop("_native", "_literal")


def image_map(listing: DataFrame, path: str = "path") -> DataFrame:
    """One path per file stem; among endings the last of the fixed order wins."""
    name = base_name(F.col(path))
    ending = F.element_at(F.split(name, r"\."), -1)
    rank = F.array_position(F.array(*[F.lit(e) for e in IMAGE_ENDINGS]), ending)
    files = listing.select(
        F.regexp_replace(name, r"\.[^.]*$", "").alias("image_id"),
        F.col(path).alias("image_path"), rank.alias("_rank"))
    return files.where(F.col("_rank") > 0).groupBy("image_id").agg(
        F.max_by("image_path", F.struct("_rank", "image_path")).alias("image_path"))


def default_counter(messages: Column) -> Column:
    """Word estimate of the rendered template; pass a real counter to replace it."""
    return word_count(M.render_messages(messages, open_answer=True))


def convert_logs(
    rows: DataFrame,
    images: DataFrame,
    row_id: str,
    max_tokens: int = MAX_TOKENS,
    counter: Callable[[Column], Column] = default_counter,
) -> DataFrame:
    """Every log row with its status; training columns are NULL unless used.

    ``images`` has one row per image_id. Rows without an id get a key of their
    own that matches nothing, so blanks never meet in one join partition.
    """
    trimmed = F.btrim(F.col("image_payload_id"), F.lit(WHITESPACE))
    wanted = F.when(trimmed != "", trimmed)
    # whole numbers only; anything else is counted from the messages
    written = F.regexp_extract(F.col("total_tokens"), WHOLE_NUMBER, 1)
    given = F.when(written != "", written.try_cast("bigint"))
    # Below the join, each on its own: who only asks for the status builds no turns and moves none.
    said = lambda *roles: F.exists("parsed", lambda m: m["role"].isin(*roles))
    parsed = parse_messages(rows).select(
        row_id,
        F.coalesce(wanted, F.concat(F.lit("\x00"), F.col(row_id).cast("string"))).alias("image_id"),
        wanted.isNotNull().alias("_has_id"), (F.size("parsed") > 0).alias("_any"),
        (said("user") | (said("assistant") & ~said("system"))).alias("_has_turns"),
        F.when(wanted.isNotNull(), M.training_turns(F.col("parsed"))).alias("conversations"),
        (F.when(given.isNull(), counter(F.col("parsed"))).otherwise(given) + IMAGE_TOKENS).alias("num_tokens"))
    turns = parsed.join(images, "image_id", "left")
    status = (
        F.when(~F.col("_any"), "no_messages")
        .when(~F.col("_has_id"), "no_image_id")
        .when(F.col("image_path").isNull(), "image_not_found")
        .when(~F.col("_has_turns"), "no_user")
        .when(F.col("num_tokens") > max_tokens, "too_long")
        .otherwise("valid"))
    return turns.select(
        row_id, status.alias("status"), base_name(F.col("image_path")).alias("image"),
        "conversations", "num_tokens")


def training_rows(converted: DataFrame, row_id: str) -> DataFrame:
    """Valid rows, shortest first."""
    return converted.where(F.col("status") == "valid").drop("status").orderBy("num_tokens", row_id)


def conversion_counters(converted: DataFrame) -> DataFrame:
    status = F.col("status")
    return converted.agg(
        F.count("*").alias("processed"),
        F.count_if(status.isin("valid", "too_long")).alias("valid"),
        F.count_if(status == "no_image_id").alias("no_image_id"),
        F.count_if(status == "image_not_found").alias("image_not_found"),
        F.count_if(status == "too_long").alias("filtered"),
        F.min(F.when(status == "valid", F.col("num_tokens"))).alias("min_tokens"),
        F.max(F.when(status == "valid", F.col("num_tokens"))).alias("max_tokens"),
    )
