"""Answers about moments of a video, matched to its frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FEW_TIMES = 64


def match_times(frames: DataFrame, answers: DataFrame, group: list[str], frame: str, text: str, time: str,
                order: str, few: int = FEW_TIMES) -> DataFrame:
    """Last answer whose time text occurs in a frame's time text.

    Occurrence is by substring, so "1.0" also fits "<11.0 seconds>". A group of
    at most ``few`` time texts hands them to its frames as one list, so that no
    frame is multiplied. In the others a frame offers the substrings of its
    short time text that are as long as some answer of its group as join keys;
    answers meet them by equality.
    """
    last = answers.groupBy(*group, F.col(time).alias("_part")).agg(F.max(order).alias("_order"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy("_part"))
    listed = last.withColumn("_n", place).where(F.col("_n") <= few + 1).groupBy(*group).agg(
        F.collect_list(F.struct("_part", "_order")).alias("_told"))
    joined = frames.join(listed, group, "left")
    many = F.coalesce(F.size("_told") > few, F.lit(False))
    held = F.filter("_told", lambda a: (a["_part"] != "") & F.contains(F.col(text), a["_part"]))
    read = joined.where(~many).select(*frames.columns, F.array_max(F.transform(held, lambda a: a["_order"])).alias("answer_order"))

    wide = joined.where(many).select(frames.columns)
    lengths = last.groupBy(*group).agg(F.collect_set(F.length("_part")).alias("_lengths"))
    size = F.length(text)
    parts = F.array_distinct(F.flatten(F.transform(F.filter("_lengths", lambda n: (n > 0) & (n <= size)), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda i: F.substring(F.col(text), i, n)))))
    offered = wide.join(lengths, group).select(*group, frame, F.explode(parts).alias("_part"))
    hits = offered.join(last, [*group, "_part"]).groupBy(*group, frame).agg(F.max("_order").alias("answer_order"))
    return read.unionByName(wide.join(hits, [*group, frame], "left").select(read.columns))
