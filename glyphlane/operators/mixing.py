"""Dataset requests, exact sampling, concatenation and seeded shuffling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordinal import hash_bucket, seeded_hash, with_ordinal

RATE_SUFFIX = r"%(\d+)$"


def sampling_rate(request: Column) -> Column:
    """Share named by a ``%<number>`` suffix, 1.0 without one."""
    digits = F.regexp_extract(request, RATE_SUFFIX, 1)
    return F.when(digits != "", digits.cast("double") / 100).otherwise(F.lit(1.0))


def dataset_name(request: Column) -> Column:
    return F.regexp_replace(request, RATE_SUFFIX, "")


def unknown_requests(requests: DataFrame, registry: DataFrame) -> DataFrame:
    named = requests.select(dataset_name(F.col("request")).alias("dataset"))
    return named.join(registry.select("dataset"), "dataset", "left_anti")


def resolve_requests(requests: DataFrame, registry: DataFrame) -> DataFrame:
    """Requests with rate and paths; an unknown name stops the job that reads it."""
    named = requests.select(
        dataset_name(F.col("request")).alias("dataset"), sampling_rate(F.col("request")).alias("rate"))
    joined = named.join(registry.withColumn("_known", F.lit(True)), "dataset", "left")
    checked = F.when(F.col("_known").isNull(), F.raise_error(
        F.concat(F.lit("do not find "), F.col("dataset"))).cast("string")).otherwise(F.col("dataset"))
    return joined.withColumn("dataset", checked).drop("_known")


def concatenate(datasets: dict[str, DataFrame]) -> DataFrame:
    """Union of the frames, each tagged with its data path."""
    tagged = [df.withColumn("data_path", F.lit(path)) for path, df in datasets.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def sample_exact(rows: DataFrame, rates: DataFrame, row_id: str, seed: int | str = 0,
                 dataset: str = "dataset", ordinal: str | None = None) -> DataFrame:
    """floor(n * rate) rows of every dataset, chosen by seeded hash order.

    ``rates``: one row per dataset with ``rate``. The rows are counted per hash
    bucket, which gives the bucket where each dataset's share ends. Rows beyond
    it go before anything is shuffled; one shuffle by bucket ranks the rest.
    With ``ordinal`` the chosen rows get their place in the hash order of the
    whole sample, whose offsets follow from the same counts. Pass narrow rows:
    their columns are shuffled once.
    """
    key = seeded_hash(F.col(row_id), seed)
    hashed = rows.withColumn("_key", key).withColumn("_bucket", hash_bucket(F.col("_key")))
    counts = hashed.groupBy(dataset, "_bucket").agg(F.count("*").alias("_n"))
    upto = Window.partitionBy(dataset).orderBy("_bucket")
    totals = counts.select(
        dataset, "_bucket", "_n", F.sum("_n").over(upto).alias("_upto"),
        F.sum("_n").over(Window.partitionBy(dataset)).alias("_total")
    ).join(rates.select(dataset, "rate"), dataset)
    wanted = F.when(F.col("rate") < 1, F.floor(F.col("_total") * F.col("rate"))).otherwise(F.col("_total"))
    placed = totals.withColumn("_wanted", wanted).withColumn("_rest", F.col("_wanted") - F.col("_upto") + F.col("_n"))
    ends = placed.where(F.col("_upto") >= F.col("_wanted")).groupBy(dataset).agg(
        F.min_by(F.struct("_bucket", "_rest"), F.col("_bucket")).alias("_end"))
    reached = hashed.join(ends, dataset).where(F.col("_bucket") <= F.col("_end._bucket")).repartition("_bucket")
    place = F.row_number().over(Window.partitionBy("_bucket", dataset).orderBy("_key", row_id))
    chosen = reached.withColumn("_place", place).where(
        (F.col("_bucket") < F.col("_end._bucket")) | (F.col("_place") <= F.col("_end._rest")))
    if ordinal is None:
        return chosen.select(*rows.columns)
    taken = placed.groupBy("_bucket").agg(F.sum(F.greatest(F.lit(0), F.least("_n", "_rest"))).alias("_taken"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # over buckets, not rows
    offsets = taken.select("_bucket", F.coalesce(F.sum("_taken").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key", row_id))
    return chosen.join(offsets, "_bucket").withColumn(ordinal, (inside + F.col("_before")).cast("bigint")).select(
        *rows.columns, ordinal)


def shuffled(rows: DataFrame, row_id: str, seed: int | str = 0, name: str = "ordinal") -> DataFrame:
    """Adds each row's place in a seeded global order."""
    keyed = rows.withColumn("_key", seeded_hash(F.col(row_id), seed))
    placed = with_ordinal(keyed, [F.col("_key"), F.col(row_id)], hash_bucket(F.col("_key")), name=name)
    return placed.drop("_key")


def dataset_counts(rows: DataFrame, dataset: str = "dataset") -> DataFrame:
    """Rows per dataset and, under NULL, in all."""
    return rows.rollup(dataset).agg(F.count("*").alias("rows"))


def head(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    return rows.orderBy(*order).limit(n)
