"""Row numbers and running sums that never sort one large group in one task.

A plain window over a hot key, or over no key at all, runs in a single task.
Here the order is cut into buckets first: the buckets are counted (or summed)
with map-side combine, the small bucket table gets the running offsets, and the
rows are then numbered inside ``keys + bucket`` only. The bucket expression must
never decrease along the wanted order and must depend on row values alone, so
that a lost executor recomputes the same buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.stored import stored

BUCKETS = 64
HASH_BUCKET_DIGITS = 4
RANGE_ROWS = 1 << 20


def in_buckets(rows: DataFrame, value: Column, name: str, of: DataFrame | None = None, buckets: int = BUCKETS,
               strict: bool = True) -> DataFrame:
    """Adds ``name``: the bucket of a numeric value between the approximate quantiles of its column.

    There are at most ``buckets`` of about equal size, however the values lie.
    The bounds are a scalar subquery of one small array, over ``of`` if that is
    cheaper to read than the rows and has the same values. The bucket is the
    number of bounds below the value, or, unless ``strict``, below or equal.
    """
    shares = [i / buckets for i in range(1, buckets)]
    bounds = f"{name}_bounds"
    told = rows.withColumn(bounds, (rows if of is None else of).agg(F.percentile_approx(value, shares, 100 * buckets)).scalar())
    passed = F.lit(0)
    for i in range(buckets - 1):
        bound = F.col(bounds)[i]
        passed = passed + F.coalesce((value > bound if strict else value >= bound).cast("int"), F.lit(0))
    return told.withColumn(name, passed).drop(bounds)


def seeded_hash(id_col: Column, seed: int | str) -> Column:
    """Uniform text key that stands in for an unseeded shuffle."""
    return F.md5(F.concat(F.lit(f"{seed}:"), id_col.cast("string")).cast("binary"))


def hash_bucket(hash_col: Column, digits: int = HASH_BUCKET_DIGITS) -> Column:
    """First hex digits of a hash: uniform whatever the keys are."""
    return F.substring(hash_col, 1, digits)


def _offsets(df: DataFrame, keys: list[str], values: dict[str, Column]) -> DataFrame:
    per_bucket = df.groupBy(*keys, "_bucket").agg(
        *[F.sum(value).alias(f"_sum_{name}") for name, value in values.items()]
    )
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return per_bucket.select(
        *keys,
        "_bucket",
        *[
            F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_before_{name}")
            for name in values
        ],
    )


def running_sums(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    bucket: Column,
    values: dict[str, Column],
    inclusive: bool = True,
) -> DataFrame:
    """Adds one running sum per entry of ``values`` within ``keys``."""
    bucketed = df.withColumn("_bucket", bucket)
    offsets = _offsets(bucketed, keys, values)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    joined = bucketed.join(offsets, [*keys, "_bucket"])
    return joined.select(
        *df.columns,
        *[
            (F.coalesce(F.sum(value).over(inside), F.lit(0)) + F.col(f"_before_{name}")).alias(name)
            for name, value in values.items()
        ],
    )


def with_ordinal(
    df: DataFrame,
    order: list[Column],
    bucket: Column,
    keys: list[str] | None = None,
    name: str = "ordinal",
) -> DataFrame:
    """1-based dense position along ``order``, per ``keys`` or over all rows."""
    keys = keys or []
    bucketed = df.withColumn("_bucket", bucket)
    offsets = _offsets(bucketed, keys, {name: F.lit(1)})
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    joined = bucketed.join(offsets, [*keys, "_bucket"])
    position = (F.row_number().over(inside) + F.col(f"_before_{name}")).cast("bigint")
    return joined.select(*df.columns, position.alias(name))


def with_global_ordinal(rows: DataFrame, order: list[Column], name: str = "ordinal", range_rows: int = RANGE_ROWS) -> DataFrame:
    """1-based dense position of all rows along ``order``, which must tell them apart.

    The order is cut into ranges of about ``range_rows`` rows, so their number
    follows the rows, however skewed or sparse the keys are. Each range is
    sorted by a task of its own and written with the places in it; one count per
    range gives the offsets. Pass narrow rows: their columns are written once.
    """
    spark = rows.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // range_rows))
    cut = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # the range and the row in it are the upper and lower bits of this id
    placed = stored(cut.withColumn("_row", F.monotonically_increasing_id()), "ranges")
    numbered = placed.withColumn("_range", F.shiftright("_row", 33)).withColumn("_row", F.col("_row").bitwiseAND((1 << 33) - 1))
    counts = numbered.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # over ranges, not rows
    offsets = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return numbered.join(offsets, "_range").select(*rows.columns, (F.col("_row") + F.col("_before") + 1).alias(name))
