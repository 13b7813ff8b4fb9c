"""Running state over arrays without growing an array element by element."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let


def prefix_sums(values: Column) -> Column:
    """Inclusive running sums of an array of numbers, by adding the array to its own shifts: log n passes over n elements."""
    def shifted(sums: Column, by: Column) -> Column:
        moved = F.concat(F.array_repeat(F.lit(0).cast("bigint"), by), F.slice(sums, F.lit(1), F.size(sums) - by))
        return F.zip_with(sums, moved, lambda a, b: a + b)

    def summed(whole: Column) -> Column:
        shifts = F.filter(F.array(*[F.lit(1 << k) for k in range(31)]), lambda s: s < F.size(whole))
        return F.aggregate(shifts, whole, shifted)

    return let(F.transform(values, lambda v: v.cast("bigint")), summed)
