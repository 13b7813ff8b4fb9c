"""Writers of training rows, predictions, tables and summaries."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH = "batch"
CONTROL_CHARACTERS = r"[\x00-\x08\x0B-\x0C\x0E-\x1F]"  # fixed value


def json_lines(df: DataFrame, kept: str | None = None) -> DataFrame:
    """Each row as JSON text in ``value``, absent fields left out; ``kept`` stays beside it."""
    return df.select(*([kept] if kept else []), F.to_json(F.struct(*df.columns)).alias("value"))


def table_lines(df: DataFrame, kept: str | None = None, separator: str = ",") -> DataFrame:
    """Each row as a CSV record in ``value``."""
    options = {"sep": separator, "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return df.select(*([kept] if kept else []), F.to_csv(F.struct(*df.columns), options).alias("value"))


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    json_lines(df).write.mode(mode).text(path)


def _as_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lead = "["
    for batch in batches:
        texts = batch.column(0).to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([(lead if i == 0 else ",") + t for i, t in enumerate(texts)], pa.string())], ["value"])
        lead = "," if texts else lead
    yield pa.RecordBatch.from_arrays([pa.array(["]" if lead == "," else "[]"])], ["value"])


def write_json_array(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Part files that are one JSON array each, an object to a line."""
    json_lines(df).mapInArrow(_as_array, "value string").write.mode(mode).text(path)


def _next_batch(spark: SparkSession, path: str) -> int:
    """How many times a table folder was written to."""
    try:
        batches = spark.read.text(path).select(F.max(F.regexp_extract("_metadata.file_path", BATCH + r"=(\d+)", 1).cast("int")))
        return (batches.collect()[0][0] or 0) + 1
    except AnalysisException:  # no such folder
        return 0


def write_table(df: DataFrame, path: str, mode: str = "errorifexists", separator: str = ",") -> None:
    """A CSV table in part files: a folder for each call, the header once, as the first file of the first one.

    All files, by name, are one table; ``append`` adds rows behind it.
    """
    lines = table_lines(df, separator=separator)
    number = _next_batch(df.sparkSession, path) if mode == "append" else 0
    if number == 0:
        named = df.sparkSession.createDataFrame([tuple(df.columns)], ", ".join(f"`{c}` string" for c in df.columns)).coalesce(1)
        lines = table_lines(named, separator=separator).unionByName(lines)
    lines.withColumn(BATCH, F.lit(f"{number:08d}")).write.mode(mode).partitionBy(BATCH).text(path)


def write_summary(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A one-row frame as one JSON text."""
    df.select(F.to_json(F.struct(*df.columns)).alias("value")).write.mode(mode).text(path)


def without_control_characters(df: DataFrame) -> DataFrame:
    """Text columns without the characters table files cannot hold."""
    return df.select(*[
        F.regexp_replace(c, CONTROL_CHARACTERS, "").alias(c) if kind == "string" else F.col(c) for c, kind in df.dtypes])


def encoded_images(rows: DataFrame, index: str, image: str, image_path: str | None = None) -> DataFrame:
    """(path, content) of base64 image cells.

    With ``image_path`` both columns are lists of equal length; else the single
    cell is named after the index.
    """
    if image_path is None:
        return rows.select(F.concat(F.col(index).cast("string"), F.lit(".jpg")).alias("path"), F.unbase64(image).alias("content"))
    pairs = rows.select(F.explode(F.arrays_zip(F.col(image_path).alias("path"), F.col(image).alias("image"))).alias("p"))
    return pairs.select("p.path", F.unbase64("p.image").alias("content"))


def write_new_images(images: DataFrame, existing: DataFrame, path: str) -> None:
    """Appends images whose path is not there yet."""
    images.join(existing.select("path"), "path", "left_anti").write.mode("append").parquet(path)
