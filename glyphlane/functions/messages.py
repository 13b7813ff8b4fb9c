"""Expressions over message arrays: one record in, one record out, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .literals import MESSAGES, ROLES
from .text import let, occurrences

IMAGE_TAG = "<image>"
VIDEO_TAG = "<video>"
TURNS = "array<struct<from:string,value:string>>"


def _turn(speaker: str, value: Column) -> Column:
    return F.array(F.struct(F.lit(speaker).alias("from"), value.alias("value")))


def json_messages(parsed: Column) -> Column:
    """Messages of a parsed JSON cell; NULL where Python rules are needed.

    Contents other than text print the Python way, so such cells are left to
    the Arrow helper.
    """
    kind = lambda e: F.schema_of_variant(e["content"])
    known = lambda e: e["role"].isin(*ROLES) & e["content"].isNotNull()

    def texts(entries: Column) -> Column:
        kept = F.filter(entries, known)
        return F.when(entries.isNotNull(), let(kept, lambda k: F.when(
            ~F.exists(k, lambda e: ~kind(e).isin("STRING", "VOID")),
            F.filter(
                F.transform(k, lambda e: F.struct(
                    e["role"].alias("role"),
                    F.try_variant_get(e["content"], "$", "string").alias("content"))),
                lambda m: m["content"] != ""))))

    entries = F.try_variant_get(parsed, "$", "array<struct<role:string,content:variant>>")
    return let(entries, texts).cast(MESSAGES)


def training_turns(messages: Column, image_tag: bool = True) -> Column:
    """Human/gpt turns of a role/content array, or NULL when there are none.

    System texts gather until the next user message and go in front of it; those
    after the last user are left out. The last human turn gets the image tag
    unless it has one. A record with system texts but no user is NULL.
    """
    start = F.struct(
        F.array().cast(TURNS).alias("out"),
        F.lit(None).cast("string").alias("pending"),
        F.lit(-1).alias("last"),
    )

    def step(acc: Column, m: Column) -> Column:
        waiting = F.when(acc["pending"].isNull(), m["content"]).otherwise(
            F.concat(acc["pending"], F.lit("\n"), m["content"]))
        is_user, is_system = m["role"] == "user", m["role"] == "system"
        return F.struct(
            F.when(is_user, F.concat(acc["out"], _turn("human", waiting)))
            .when(is_system, acc["out"])
            .otherwise(F.concat(acc["out"], _turn("gpt", m["content"]))).cast(TURNS).alias("out"),
            F.when(is_system, waiting).when(~is_user, acc["pending"]).alias("pending"),
            F.when(is_user, F.size(acc["out"])).otherwise(acc["last"]).alias("last"),
        )

    def finish(acc: Column) -> Column:
        def tagged(turn: Column, i: Column) -> Column:
            missing = (i == acc["last"]) & ~turn["value"].contains(IMAGE_TAG)
            return F.struct(turn["from"].alias("from"), F.when(
                missing, F.concat(turn["value"], F.lit("\n" + IMAGE_TAG))).otherwise(turn["value"]).alias("value"))

        turns = F.transform(acc["out"], tagged) if image_tag else acc["out"]
        stranded = (acc["last"] < 0) & acc["pending"].isNotNull()
        return F.when(~stranded & (F.size(acc["out"]) > 0), turns)

    return F.aggregate(messages, start, step, finish)


def render_messages(messages: Column, role: str = "role", text: str = "content",
                    open_answer: bool = False) -> Column:
    """Chat-template text of a message array."""
    blocks = F.transform(messages, lambda m: F.concat(
        F.lit("<|im_start|>"), m[role], F.lit("\n"), m[text], F.lit("<|im_end|>\n")))
    tail = F.lit("<|im_start|>assistant\n" if open_answer else "")
    return F.concat(F.array_join(blocks, ""), tail)


def tag_count(turns: Column, speaker: str, tag: str) -> Column:
    """Occurrences of a tag in all turns of one speaker."""
    return F.aggregate(
        F.filter(turns, lambda m: m["from"] == speaker), F.lit(0).cast("bigint"),
        lambda acc, m: acc + F.coalesce(occurrences(m["value"], tag), F.lit(0)))
