"""Where the query modules enter their queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


class Tables:
    """The given tables of one scale as lazily read frames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self._dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self._dir}/{name}.parquet")

    def spread(self, name: str, *columns: str) -> DataFrame:
        """Some columns of a table, for work that is heavy per row.

        The session setting ``glyphlane.spread`` names a number of partitions
        to deal them to; a cluster whose tables have enough splits sets none.
        """
        rows, wanted = getattr(self, name).select(*columns), self.spark.conf.get("glyphlane.spread", None)
        return rows if wanted is None else rows.repartition(int(wanted))

    def dealt(self, name: str, *columns: str) -> DataFrame:
        """The same for work so heavy that even a small file needs all cores: few splits are always dealt out."""
        if self.spark.conf.get("glyphlane.spread", None) is not None:
            return self.spread(name, *columns)
        rows, wanted = getattr(self, name).select(*columns), 2 * self.spark.sparkContext.defaultParallelism
        return rows.repartition(max(wanted, rows.rdd.getNumPartitions()))


@dataclass(frozen=True)
class Query:
    name: str
    operators: str
    build: Callable[[Tables], DataFrame]
    check_sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, operators: str, check_sql: str | None = None):
    """Registers a function from tables to a frame under ``name``."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(name, operators, build, check_sql)
        return build

    return register
