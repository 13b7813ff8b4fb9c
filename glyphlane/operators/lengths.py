"""Token costs of samples from media facts and a pluggable text counter."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions.chat_roles import template_role
from ..functions.text import word_count

# Fixed values of the cost rules.
PATCH = 28
IMAGE_MIN, IMAGE_MAX = 32 * PATCH * PATCH, 2048 * PATCH * PATCH
FRAME_MIN, FRAME_MAX = 144 * PATCH * PATCH, 576 * PATCH * PATCH
SECONDS_PER_FRAME = 4
VIDEO_FRAMES = (4, 8)
SAMPLE_OVERHEAD = 21


def image_cost(height: Column, width: Column) -> Column:
    """Merged patches of one image; an absent image costs nothing."""
    plan = G.resize_plan(height, width, PATCH, IMAGE_MIN, IMAGE_MAX)
    return F.coalesce(G.image_tokens(plan, PATCH), F.lit(0).cast("bigint"))


def video_cost(height: Column, width: Column, total_frames: Column, fps: Column) -> Column:
    """Merged patches of the frames taken from one video."""
    low, high = VIDEO_FRAMES
    wanted = F.rint(total_frames / fps / SECONDS_PER_FRAME)
    target = F.least(F.greatest(wanted, F.lit(float(low))), F.lit(float(high)))
    frames = F.size(G.frame_indices_truncated(F.lit(0), total_frames - 1, target, unique=True))
    plan = G.resize_plan(height, width, PATCH, FRAME_MIN, FRAME_MAX)
    return F.coalesce(G.image_tokens(plan, PATCH) * F.ceil(frames / 2), F.lit(0)).cast("bigint")


def rendered_length(turns: Column, counter: Callable[[Column], Column] = word_count) -> Column:
    """Sum over the turns of the counter on each turn's template text."""
    return F.aggregate(turns, F.lit(0).cast("bigint"), lambda acc, m: acc + counter(F.concat(
        F.lit("<|im_start|>"), template_role(m["from"]), F.lit("\n"), m["value"], F.lit("<|im_end|>\n"))))


def sample_costs(samples: DataFrame, facts: DataFrame, sample_id: str,
                 counter: Callable[[Column], Column] = word_count) -> DataFrame:
    """(sample_id, num_tokens). ``facts``: uri, height, width, total_frames, fps.

    A sample with images counts only those, even when it also has videos.
    """
    use_images = F.size("images") > 0
    wanted = samples.select(
        sample_id, F.when(use_images, "image").otherwise("video").alias("_kind"),
        F.explode(F.when(use_images, F.col("images")).otherwise(F.col("videos"))).alias("uri"))
    h, w = F.col("height"), F.col("width")
    media = wanted.join(facts, "uri", "left").groupBy(sample_id).agg(F.sum(
        F.when(F.col("_kind") == "image", image_cost(h, w))
        .otherwise(video_cost(h, w, F.col("total_frames"), F.col("fps")))).alias("_media"))
    text = samples.select(sample_id, rendered_length(F.col("conversations"), counter).alias("_text"))
    total = F.lit(SAMPLE_OVERHEAD) + F.col("_text") + F.coalesce("_media", F.lit(0))
    return text.join(media, sample_id, "left").select(sample_id, total.cast("bigint").alias("num_tokens"))


def counted_once(samples: DataFrame, known: DataFrame, key: str,
                 count: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Known counts plus counts of the samples that have none yet."""
    fresh = samples.join(known.select(key), key, "left_anti")
    return known.select(key, "num_tokens").unionByName(count(fresh).select(key, "num_tokens"))


def length_or_one(num_tokens: Column) -> Column:
    return F.coalesce(num_tokens, F.lit(1)).cast("bigint")
