"""Checks of conversation samples against their media."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json import kind
from ..functions.messages import IMAGE_TAG, VIDEO_TAG, tag_count
from ..functions.text import let, strip

PROBLEM = "array<struct<type:string,media_type:string,expected:bigint,actual:bigint,message:string>>"

NEITHER_KIND = "image, image_url or video should in content."  # fixed value
STOP_TYPE = "boolean"



def media_field(record: Column, name: str, plural: str) -> Column:
    """Media names of a record variant: text or list, anything else is empty."""
    one = F.try_variant_get(record, f"$.{name}", "variant")
    many = F.try_variant_get(record, f"$.{plural}", "variant")
    return let(F.coalesce(one, many), lambda v: F.when(
        kind(v) == "STRING", F.array(F.try_variant_get(v, "$", "string"))
    ).when(kind(v) == "ARRAY", F.try_variant_get(v, "$", "array<string>")).otherwise(
        F.array().cast("array<string>")))


def modality(images: Column, videos: Column) -> Column:
    has_image, has_video = F.size(images) > 0, F.size(videos) > 0
    return (F.when(has_image & has_video, "mixed").when(has_image, "image").when(has_video, "video")
            .otherwise("none"))


def missing_files(samples: DataFrame, listing: DataFrame, sample_id: str, folder: str) -> DataFrame:
    """Absent media as rows (sample_id, path). ``listing`` holds existing paths."""
    wanted = samples.select(sample_id, F.explode(F.concat("images", "videos")).alias("_name")).select(
        sample_id, F.concat(F.lit(f"{folder}/"), "_name").alias("path"))
    return wanted.join(listing.select("path"), "path", "left_anti")


def _problem(type_: str, message: Column, media: str | None = None, expected: Column | None = None,
             actual: Column | None = None) -> Column:
    none = F.lit(None).cast("bigint")
    return F.struct(
        F.lit(type_).alias("type"), F.lit(media).cast("string").alias("media_type"),
        (none if expected is None else expected.cast("bigint")).alias("expected"),
        (none if actual is None else actual).alias("actual"), message.alias("message"))


def _mismatch(media: str, names: Column, tag: str, turns: Column) -> Column:
    expected, actual = F.size(names), tag_count(turns, "human", tag)
    message = F.concat(F.lit("Expected "), expected.cast("string"), F.lit(f" {tag} tokens, found "), actual.cast("string"))
    return F.when(expected != actual, _problem("token_mismatch", message, media, expected, actual))


def validate(samples: DataFrame, listing: DataFrame, sample_id: str, folder: str = "media") -> DataFrame:
    """Adds ``modality`` and ``validation_problems``.

    Text checks are expressions on the record; only absent files come back
    through a join, after they were gathered per sample.
    """
    turns, images, videos = F.col("conversations"), F.col("images"), F.col("videos")
    absent = missing_files(samples, listing, sample_id, folder).groupBy(sample_id).agg(
        F.array_sort(F.collect_list("path")).alias("_absent"))
    missing = F.when(F.col("_absent").isNotNull(), _problem(
        "missing_files", F.concat(F.lit("Missing media files: "), F.array_join("_absent", ", "))))
    mismatch = F.coalesce(_mismatch("image", images, IMAGE_TAG, turns), _mismatch("video", videos, VIDEO_TAG, turns))
    leaked = F.when(F.exists(turns, lambda m: (m["from"] == "gpt") & (
        m["value"].contains(IMAGE_TAG) | m["value"].contains(VIDEO_TAG))),
        _problem("gpt_media_token", F.lit("GPT response contains media token (<image> or <video>)")))
    return samples.join(absent, sample_id, "left").withColumn(
        "validation_problems", F.array_compact(F.array(missing, mismatch, leaked)).cast(PROBLEM)
    ).withColumn("modality", modality(images, videos)).drop("_absent")


def valid_samples(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("validation_problems") == 0).drop("validation_problems", "modality")


def problem_samples(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("validation_problems") > 0).drop("modality")


def validation_summary(checked: DataFrame) -> DataFrame:
    problems = F.col("validation_problems")
    has = lambda type_: F.count_if(F.exists(problems, lambda p: p["type"] == type_))
    valid = F.count_if(F.size(problems) == 0)
    return checked.agg(
        F.count("*").alias("total"), valid.alias("valid"),
        F.round(valid / F.count("*") * 100, 6).alias("valid_percent"),
        F.count_if(F.col("modality") == "image").alias("image_only"),
        F.count_if(F.col("modality") == "video").alias("video_only"),
        F.count_if(F.col("modality") == "mixed").alias("mixed"),
        has("missing_files").alias("missing_media"), has("token_mismatch").alias("token_mismatches"),
        has("gpt_media_token").alias("gpt_media_tokens"))


# --- strict check while messages are built --------------------------------------

ITEM = "array<struct<pos:int,turn:int,role:string,type:string,text:string,uri:string>>"
TAG_EDGES = "(?=<image>|<video>)|(?<=<image>|<video>)"


def message_items(conversations: Column, images: Column, videos: Column, base: str) -> Column:
    """Struct of content items in order and the fault, if any.

    Human texts are cut at the tags; the k-th tag of a kind takes the k-th file
    of that kind, counted over all turns.
    """
    def pieces(turn: Column, i: Column) -> Column:
        human = turn["from"] == "human"
        cut = F.when(human, F.split(turn["value"], TAG_EDGES)).otherwise(F.array(turn["value"]))
        return F.transform(cut, lambda p: F.struct(
            i.alias("turn"), F.when(human, "user").otherwise("assistant").alias("role"),
            F.when(human & (p == IMAGE_TAG), "image").when(human & (p == VIDEO_TAG), "video")
            .otherwise("text").alias("type"),
            F.when(human, strip(p)).otherwise(p).alias("text")))

    def numbered(flat: Column) -> Column:
        return F.transform(flat, lambda p, i: F.struct(i.alias("pos"), p["turn"], p["role"], p["type"], p["text"]))

    def paired(flat: Column, type_: str, names: Column) -> Column:
        tags = F.filter(flat, lambda p: p["type"] == type_)
        return F.zip_with(tags, names, lambda p, name: F.struct(
            p["pos"].alias("pos"), p["turn"].alias("turn"), p["role"].alias("role"), p["type"].alias("type"),
            F.lit(None).cast("string").alias("text"), F.concat(F.lit(f"{base}/"), name).alias("uri")))

    def assemble(flat: Column) -> Column:
        texts = F.transform(
            F.filter(flat, lambda p: (p["type"] == "text") & ((p["role"] == "assistant") | (p["text"] != ""))),
            lambda p: F.struct(p["pos"].alias("pos"), p["turn"].alias("turn"), p["role"].alias("role"),
                               p["type"].alias("type"), p["text"].alias("text"),
                               F.lit(None).cast("string").alias("uri")))
        return F.array_sort(F.concat(texts, paired(flat, "image", images), paired(flat, "video", videos)).cast(ITEM))

    def fault(items: Column) -> Column:
        short = lambda type_: F.exists(items, lambda p: (p["type"] == type_) & p["uri"].isNull())
        return (
            F.when(short("image"), "more <image> placeholders than images")
            .when(short("video"), "more <video> placeholders than videos")
            .when(F.exists(items, lambda p: p["pos"].isNull()), "unused media"))

    flat = numbered(F.flatten(F.transform(conversations, pieces)))
    return let(let(flat, assemble), lambda items: F.struct(items.alias("items"), fault(items).alias("fault")))


def build_messages(samples: DataFrame, base: str, on_fault: str = "QUARANTINE") -> DataFrame:
    """Adds ``items``; faulty samples stop the job (FAIL), keep their fault
    (QUARANTINE) or leave (DROP)."""
    built = samples.withColumn("_built", message_items(
        F.col("conversations"), F.col("images"), F.col("videos"), base))
    fault = F.col("_built.fault")
    items = F.when(fault.isNull(), F.col("_built.items"))
    if on_fault == "FAIL":
        items = F.when(fault.isNotNull(), F.raise_error(fault)).otherwise(F.col("_built.items"))
    out = built.withColumn("items", items).withColumn("fault", fault).drop("_built")
    return out.where(F.col("fault").isNull()) if on_fault == "DROP" else out


def vision_items(items: Column) -> Column:
    """Image and video items of a message array."""
    return F.filter(items, lambda p: p["type"].isin("image", "image_url", "video"))


def route_vision(items: Column) -> Column:
    """Struct of image and video inputs; an empty kind is NULL."""
    some = lambda a: F.when(F.size(a) > 0, a)
    pick = lambda *types: F.transform(
        F.filter(items, lambda p: p["type"].isin(*types)), lambda p: p["uri"])
    return F.struct(some(pick("image", "image_url")).alias("images"), some(pick("video")).alias("videos"))


def vision_requests(items: Column, sample_fps: Column, with_metadata: bool = False) -> Column:
    """Struct images, videos, do_sample_frames, fps of one request's vision items.

    ``sample_fps`` holds the effective rate of each video in turn; it is passed
    on unless ``with_metadata``. An item of neither kind stops the job.
    """
    strange = F.exists(items, lambda p: ~F.coalesce(p["type"].isin("image", "image_url", "video"), F.lit(False)))
    checked = F.when(strange, F.raise_error(F.lit(NEITHER_KIND)).cast(STOP_TYPE)).otherwise(F.lit(False))
    routed = route_vision(items)
    rates = F.lit(None).cast("array<double>") if with_metadata else F.coalesce(sample_fps, F.array().cast("array<double>"))
    return F.struct(routed["images"].alias("images"), routed["videos"].alias("videos"), checked.alias("do_sample_frames"),
                    rates.alias("fps"))
