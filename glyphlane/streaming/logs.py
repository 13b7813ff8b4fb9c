"""Incremental log conversion.

The batch job reads a log in chunks and appends each converted chunk. Here new
log files are the chunks: the conversion holds no state, so the same expressions
run on a file stream with an append sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.logformat import convert_cells
from ..schemas import AGENT_LOG


def read_log_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    reader = spark.readStream.schema(AGENT_LOG).option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(folder, header=True, multiLine=True, escape='"', quote='"')


def convert_log_stream(rows: DataFrame, out: str, checkpoint: str, catalog: Column | None = None) -> StreamingQuery:
    """Appends converted rows until the files present are used up."""
    converted = convert_cells(rows, catalog)
    writer = converted.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(out)
