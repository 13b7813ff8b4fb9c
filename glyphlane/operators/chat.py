"""Conversations as rows: one row per turn, however long a conversation gets.

Positions inside a conversation come from bucketed running counts, so a single
conversation that holds a large share of all turns is spread over many tasks.
Only jobs whose result is one text per conversation gather it, as the last step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.messages import IMAGE_TAG
from ..functions.text import let, ordered_text, word_count
from .ordinal import running_sums, with_ordinal

TURN_BUCKET = 4096
ANSWER_HEAD = "<|im_start|>assistant\n"  # fixed value
IMAGE_LENGTH = 128  # fixed value: length added for a sample with an image


def turn_bucket(turn: str) -> Column:
    return F.floor(F.col(turn) / TURN_BUCKET)


def turn_blocks(turns: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """One row per conversation and block of turns: ``items`` (turn, role, text) in order, ``users`` (places of user turns).

    A conversation that holds a large share of all turns is many such rows.
    """
    items = F.array_sort(F.collect_list(F.struct(F.col(turn).alias("turn"), "role", "text")))
    blocks = turns.groupBy(conv, turn_bucket(turn).alias("_block")).agg(items.alias("items"))
    users = F.filter(F.transform("items", lambda m, i: F.when(m["role"] == "user", i)), lambda i: i.isNotNull())
    return blocks.withColumn("users", users)


def _joined_texts(items: Column) -> Column:
    """Texts of the system turns among ``items``, NULL without any."""
    texts = F.transform(F.filter(items, lambda m: (m["role"] == "system") & m["text"].isNotNull()), lambda m: m["text"])
    return let(texts, lambda t: F.when(F.size(t) > 0, F.array_join(t, "\n")))


def _block_states(blocks: DataFrame, conv: str) -> DataFrame:
    """What each block must know of its conversation: ``waiting`` (system texts that no user took yet), ``last_user``, ``stranded``.

    The state of a block is small: the system texts behind its last user, that
    user's turn, and whether it has system turns. States of a conversation are
    combined in order.
    """
    last = F.try_element_at("users", F.lit(-1))
    behind = F.slice("items", F.coalesce(last, F.lit(-1)) + 2, F.size("items"))
    states = blocks.select(
        conv, "_block", _joined_texts(behind).alias("_behind"), F.get("items", last)["turn"].alias("_last"),
        F.exists("items", lambda m: m["role"] == "system").alias("_system"))
    whole = Window.partitionBy(conv)
    ahead = whole.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    since = F.max(F.when(F.col("_last").isNotNull(), F.col("_block"))).over(ahead)
    told = states.select(
        conv, "_block", since.alias("_since"), F.collect_list(F.when(F.col("_behind").isNotNull(), F.struct("_block", "_behind"))).over(ahead).alias("_tails"),
        F.max("_last").over(whole).alias("last_user"), F.max("_system").over(whole).alias("_any"))
    waiting = F.transform(F.filter("_tails", lambda t: F.col("_since").isNull() | (t["_block"] >= F.col("_since"))), lambda t: t["_behind"])
    return told.select(
        conv, "_block", F.when(F.size(waiting) > 0, F.array_join(waiting, "\n")).alias("waiting"), "last_user",
        (F.col("_any") & F.col("last_user").isNull()).alias("stranded"))


def training_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                   with_image: Column | None = None) -> DataFrame:
    """Human/gpt turns of role/text rows.

    System texts join the next user turn, once; those after the last user are
    left out, and conversations with a system text but no user leave entirely.
    ``with_image`` says for which conversations the last user turn must carry an
    image tag.
    """
    blocks = turn_blocks(turns, conv, turn)
    placed = blocks.join(_block_states(blocks, conv), [conv, "_block"]).where(~F.col("stranded"))

    def spoken(m: Column, speaker: str, value: Column) -> Column:
        return F.struct(m["turn"].alias("turn"), F.lit(speaker).alias("from"), value.alias("value"))

    def answers(segment: Column) -> Column:
        kept = F.filter(segment, lambda m: m["role"] != "system")
        return F.transform(kept, lambda m: spoken(m, "gpt", m["text"]))

    def upto(place: Column, i: Column) -> Column:
        """The turns between one user and the one before, answers as they are, and the user turn with what waits for it."""
        after = F.when(i > 0, F.get("users", i - 1)).otherwise(-1)
        segment = F.slice("items", after + 2, place - after - 1)

        def closed(between: Column) -> Column:
            told = F.array_compact(F.array(F.when(i == 0, F.col("waiting")), _joined_texts(between)))
            user = F.get("items", place)
            value = F.when(F.size(told) > 0, F.concat(F.array_join(told, "\n"), F.lit("\n"), user["text"])).otherwise(user["text"])
            if with_image is not None:
                value = let(value, lambda v: F.when(
                    with_image & (user["turn"] == F.col("last_user")) & ~v.contains(IMAGE_TAG), F.concat(v, F.lit("\n" + IMAGE_TAG))).otherwise(v))
            return F.concat(answers(between), F.array(spoken(user, "human", value)))

        return let(segment, closed)

    last = F.coalesce(F.try_element_at("users", F.lit(-1)), F.lit(-1))
    rest = answers(F.slice("items", last + 2, F.size("items")))
    merged = F.concat(F.flatten(F.transform("users", upto)), rest)
    return placed.select(conv, F.inline(merged)).select(conv, F.col("turn").alias(turn), "from", "value")


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))


def chat_text(turns: DataFrame, role: Column, text: Column, conv: str = "conv_id", turn: str = "turn",
              open_answer: bool = False) -> DataFrame:
    """One template text per conversation, with turn and word counts."""
    tail = F.lit(ANSWER_HEAD if open_answer else "")
    return turns.select(conv, turn, rendered_turn(role, text).alias("_t"), word_count(text).alias("_w")) \
        .groupBy(conv).agg(
            F.count("*").alias("turns"), F.sum("_w").alias("words"),
            ordered_text("_t", "", turn).alias("_t")
        ).select(conv, "turns", "words", F.concat("_t", tail).alias("chat_text"))


def chat_text_lengths(turns: DataFrame, role: Column, text: Column, conv: str = "conv_id", open_answer: bool = False) -> DataFrame:
    """Length of each conversation's template text, summed without building it."""
    tail = len(ANSWER_HEAD) if open_answer else 0
    return turns.select(conv, F.length(rendered_turn(role, text)).alias("_n")).groupBy(conv).agg(
        (F.sum("_n") + tail).alias("chat_length"))


def media_marks(images: Column, videos: Column, numbered: bool = False) -> Column:
    """Template marks of a turn's media counts, optionally numbered per kind."""
    def marks(count: Column, pad: str, title: str) -> Column:
        core = f"<|vision_start|><|{pad}|><|vision_end|>"
        if not numbered:
            return F.repeat(F.lit(core), count)
        return F.when(count > 0, F.array_join(F.transform(
            F.sequence(F.lit(1), count),
            lambda i: F.concat(F.lit(f"{title} "), i.cast("string"), F.lit(": " + core))), "")).otherwise("")

    return F.concat(marks(images, "image_pad", "Picture"), marks(videos, "video_pad", "Video"))


def template_sections(text: Column) -> Column:
    """System, first-user and from-first-assistant parts of a template text."""
    system, user, assistant = (f"<|im_start|>{r}" for r in ("system", "user", "assistant"))
    user_at, answer_at = F.locate(user, text), F.locate(assistant, text)
    later = F.locate(assistant, F.substring(text, user_at, F.length(text)))
    return F.struct(
        F.when(text.contains(system) & (user_at > 1), F.substring(text, F.lit(1), user_at - 1)).alias("system"),
        F.when((user_at > 0) & (later > 0), F.substring(text, user_at, later - 1)).alias("user"),
        F.when(answer_at > 0, F.substring(text, answer_at, F.length(text))).alias("assistant"),
    )


def length_statistics(df: DataFrame, length: Column) -> DataFrame:
    n = length
    return df.agg(F.count("*").alias("samples"), F.min(n).alias("min_length"), F.max(n).alias("max_length"),
                  F.round(F.avg(n), 6).alias("mean_length"))


def approximate_lengths(turns: DataFrame, conv: str = "conv_id", has_media: Column | None = None) -> DataFrame:
    """Word length with the image surcharge, and its sign by modality."""
    media = F.coalesce(F.max(has_media), F.lit(False)) if has_media is not None else F.lit(False)
    sums = turns.groupBy(conv).agg(F.sum(word_count(F.col("value"))).alias("_words"), media.alias("_media"))
    return sums.select(
        conv,
        (F.col("_words") + F.when(F.col("_media"), IMAGE_LENGTH).otherwise(0)).alias("approx_length"),
        F.when(F.col("_media"), F.col("_words")).otherwise(-F.col("_words")).alias("signed_length"))


def step_history(steps: DataFrame, group: str, order: str, text: str) -> DataFrame:
    """Numbered steps joined to one progress line per group."""
    numbered = with_ordinal(steps, [F.col(order)], turn_bucket(order), [group], "step")
    clean = F.replace(F.replace(F.col(text), F.lit("\n"), F.lit("")), F.lit('"'), F.lit(""))
    line = F.concat(F.lit("Step "), F.col("step").cast("string"), F.lit(": "), clean, F.lit("; "))
    return numbered.select(group, "step", line.alias("_line")).groupBy(group).agg(
        ordered_text("_line", "", "step").alias("history"))


def history_messages(pairs: DataFrame, group: str, order: str) -> DataFrame:
    """Message rows of (query, answer) pairs with media-only queries.

    Columns ``query``, ``answer``, ``media`` ('image', 'video' or NULL). Media
    wait for the next text query; the answer of the last text query is left out.
    """
    is_text = F.when(F.col("media").isNull(), 1).otherwise(0)
    grouped = running_sums(pairs, [group], [F.col(order)], turn_bucket(order), {"_request": is_text}, inclusive=False)
    totals = pairs.groupBy(group).agg(F.sum(is_text).alias("_total"))
    kept = grouped.join(totals, group).where(F.col("_request") < F.col("_total"))
    user = F.struct((F.col("_request") * 2).alias("message"), F.lit("user").alias("role"),
                    F.coalesce("media", F.lit("text")).alias("type"), F.col("query").alias("value"))
    answer = F.when((F.col("media").isNull()) & (F.col("_request") < F.col("_total") - 1), F.struct(
        (F.col("_request") * 2 + 1).alias("message"), F.lit("assistant").alias("role"),
        F.lit("text").alias("type"), F.col("answer").alias("value")))
    return kept.select(group, order, F.inline(F.array_compact(F.array(user, answer))))


def normalise_items(items: Column) -> Column:
    """Typed content items of loose ones; image before text before video."""
    def typed(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("type"), value.alias("value"))

    return F.filter(F.transform(items, lambda e: F.when(e["image"].isNotNull(), typed("image", e["image"]))
                                .when(e["text"].isNotNull(), typed("text", e["text"]))
                                .when(e["video"].isNotNull(), typed("video", e["video"]))),
                    lambda e: e.isNotNull())


def timed_items(frames: DataFrame, group: str, order: list[Column], bucket: Column,
                seconds: Column, uri: Column) -> DataFrame:
    """Alternating time text and frame items, as rows in order."""
    placed = with_ordinal(frames, order, bucket, [group], "_frame")
    pair = F.array(
        F.struct(F.lit("text").alias("type"), F.concat(F.lit("<"), seconds.cast("string"), F.lit(" seconds>")).alias("value")),
        F.struct(F.lit("image").alias("type"), uri.alias("value")))
    return placed.select(group, "_frame", F.posexplode(pair).alias("_half", "item")).select(
        group, (F.col("_frame") * 2 - 1 + F.col("_half")).alias("position"), "item.type", "item.value")


def page_request(pages: DataFrame, document: str, order: str, bucket: Column, uri: Column, prompt: Column,
                 min_pixels: int = 512 * 32 * 32, max_pixels: int = 730 * 32 * 32) -> DataFrame:
    """Item rows of one request per document: its pages in order, then the prompt."""
    placed = with_ordinal(pages, [F.col(order)], bucket, [document], "position")
    items = placed.select(document, "position", F.lit("image").alias("type"), uri.alias("value"),
                          F.lit(min_pixels).alias("min_pixels"), F.lit(max_pixels).alias("max_pixels"))
    closing = pages.groupBy(document).agg((F.count("*") + 1).alias("position")).select(
        document, "position", F.lit("text").alias("type"), prompt.alias("value"),
        F.lit(None).cast("int").alias("min_pixels"), F.lit(None).cast("int").alias("max_pixels"))
    return items.unionByName(closing)
