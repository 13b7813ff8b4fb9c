"""Label masks and multi-axis positions of token sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import prefix_sums
from ..functions.text import let
from .ordinal import running_sums
from .packing import IGNORED_LABEL

# Token ids that open an answer and close a turn.
ANSWER_MARK = 77091
TURN_END = 151645
SEGMENT_BUCKET = 4096
TEMPORAL_PATCH = 2


# Signs of the events of a sequence: a mark, a turn end right behind a mark, any other turn end.
MARK, NEXT, END = "M", "n", "E"
ANSWER = f"{MARK}{NEXT}?+[^{NEXT}{END}]*[{NEXT}{END}]"


def answer_spans(ids: Column) -> Column:
    """[first, last] label positions of every closed answer.

    An answer starts two places after its mark and ends one place after the
    first turn end; marks inside an answer do not count. Marks and turn ends
    become a text of signs, in which one pattern finds all answers in one pass;
    their places are running sums of the lengths of answers and of what lies
    between them.
    """
    def events(tokens: Column) -> Column:
        before = lambda i: F.get(tokens, i - 1) == ANSWER_MARK
        found = F.transform(tokens, lambda x, i: F.when(x == ANSWER_MARK, F.struct(i.alias("at"), F.lit(MARK).alias("sign"))).when(
            x == TURN_END, F.struct(i.alias("at"), F.when(before(i), NEXT).otherwise(END).alias("sign"))))
        return F.filter(found, lambda e: e.isNotNull())

    def spans(found: Column) -> Column:
        signs = F.array_join(F.transform(found, lambda e: e["sign"]), "")
        closed = F.regexp_replace(signs, f"[^{NEXT}{END}]+$", "")  # an answer without an end is none

        def places(text: Column) -> Column:
            answers = F.transform(F.regexp_extract_all(text, F.lit(ANSWER), F.lit(0)), F.length)
            between = F.slice(F.transform(F.split(text, ANSWER, -1), F.length), F.lit(1), F.size(answers))
            upto = prefix_sums(F.zip_with(between, answers, lambda a, b: a + b))
            at = lambda i: F.get(found, i.cast("int"))["at"]
            return F.zip_with(upto, answers, lambda end, size: F.struct((at(end - size) + 2).alias("first"), (at(end - 1) + 1).alias("last")))

        return let(closed, places)

    return let(ids, lambda tokens: let(events(tokens), spans))


def label_mask(ids: Column) -> Column:
    """Labels of a token array: answer tokens, all others ignored. Spans rise, so pieces are joined once."""
    ignored = lambda n: F.array_repeat(F.lit(IGNORED_LABEL).cast("bigint"), n.cast("int"))

    def build(spans: Column) -> Column:
        last = lambda i: F.coalesce(F.get(spans, i)["last"], F.lit(-1))
        pieces = F.transform(spans, lambda s, i: F.concat(
            ignored(s["first"] - last(i - 1) - 1), F.slice(ids, s["first"] + 1, s["last"] - s["first"] + 1)))
        return F.concat(F.flatten(pieces), ignored(F.greatest(F.lit(0), F.size(ids) - 1 - last(F.size(spans) - 1))))

    return let(answer_spans(ids), build)


def split_video_grids(segments: DataFrame) -> DataFrame:
    """Every frame of a grid as a grid of its own, numbered in ``frame``."""
    frames = F.sequence(F.lit(1), F.coalesce("t", F.lit(1)).cast("int"))
    return segments.withColumn("frame", F.explode(frames)).withColumn(
        "t", F.when(F.col("t").isNotNull(), F.lit(1)))


def _time_index(i: Column, seconds: Column | None) -> Column:
    return i.cast("bigint") if seconds is None else (i * seconds * 2).cast("bigint")


def _advance(seconds: Column | None) -> Column:
    last = F.greatest(_time_index(F.col("t") - 1, seconds), (F.col("h") - 1).cast("bigint"), (F.col("w") - 1).cast("bigint"))
    return F.when(F.col("n").isNotNull(), F.col("n")).otherwise(last + 1).cast("bigint")


def segment_offsets(segments: DataFrame, sample: str, order: list[str],
                    seconds_per_grid: Column | None = None) -> DataFrame:
    """Adds ``offset``: where each segment's positions start.

    Text segments carry ``n``, vision segments ``t``, ``h``, ``w`` with h and w
    already divided by the merge size. With ``seconds_per_grid`` the time axis
    runs in that unit.
    """
    bucket = F.floor(F.col(order[0]) / SEGMENT_BUCKET)
    return running_sums(segments, [sample], [F.col(c) for c in order], bucket,
                        {"offset": _advance(seconds_per_grid)}, inclusive=False)


def position_rows(segments: DataFrame, sample: str, order: list[str],
                  seconds_per_grid: Column | None = None) -> DataFrame:
    """One row per token: sample, order, token, and its t, h, w positions."""
    placed = segment_offsets(segments, sample, order, seconds_per_grid)
    count = F.coalesce(F.col("n"), F.col("t") * F.col("h") * F.col("w"))
    tokens = placed.where(count > 0).withColumn("token", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))
    j, h, w = F.col("token"), F.col("h"), F.col("w")
    is_text = F.col("n").isNotNull()
    at = lambda v: (F.col("offset") + F.when(is_text, j).otherwise(v)).cast("bigint")
    return tokens.select(
        sample, *order, "token", at(_time_index(F.floor(j / (h * w)), seconds_per_grid)).alias("pos_t"),
        at(F.floor(j / w) % h).alias("pos_h"), at(j % w).alias("pos_w"))


def position_deltas(segments: DataFrame, sample: str, seconds_per_grid: Column | None = None) -> DataFrame:
    """Largest position + 1 - token count, without building the positions."""
    tokens = F.coalesce(F.col("n"), F.col("t") * F.col("h") * F.col("w"))
    return segments.groupBy(sample).agg(
        (F.sum(_advance(seconds_per_grid)) - F.sum(tokens)).cast("bigint").alias("delta"))


def masked_positions(tokens: DataFrame, sample: str, position: str, mask: str) -> DataFrame:
    """Text-only positions under a 0/1 mask; masked places get 1."""
    bucket = F.floor(F.col(position) / SEGMENT_BUCKET)
    summed = running_sums(tokens, [sample], [F.col(position)], bucket, {"_seen": F.col(mask)})
    return summed.withColumn("text_position", F.when(F.col(mask) == 0, F.lit(1)).otherwise(F.col("_seen") - 1).cast("bigint")).drop("_seen")


def seconds_per_grid(fps: Column, videos: Column | int = 1) -> Column:
    return F.array_repeat(F.lit(float(TEMPORAL_PATCH)) / fps, videos if isinstance(videos, Column) else F.lit(videos))
