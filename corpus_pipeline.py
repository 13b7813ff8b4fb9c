"""A corpus pipeline of five stages, each over all rows that its predecessor kept.

Toxic and low-quality documents go, lines that many documents share stay in one
of them, one document of each near-duplicate group stays, and the rest is packed
into token sequences. A stage is a function of (spark, docs, sf_dir); its result
is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphlane.llm.bin_packing import best_fit_packing
from glyphlane.llm.common import table, written
from glyphlane.llm.line_dedup import line_dedup
from glyphlane.llm.near_dedup import near_dedup
from glyphlane.llm.quality import of_quality
from glyphlane.llm.queries import tokenizer
from glyphlane.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, learned from the labels, scores below 0.5."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose labelled neighbours vote 0.3 or more."""
    return of_quality(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; lines held by three or more stay in the last of them. n_chars follows the text."""
    shortened = line_dedup(docs, counts=None)
    if "n_chars" in docs.columns:
        shortened = shortened.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return shortened.select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id."""
    return near_dedup(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 4096 tokens."""
    return best_fit_packing(docs, tokenizer("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_copies),
    ("best-fit packing", pack_sequences),
]

#: SQL can express neither the classifiers nor the packing; the tests restate the stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
