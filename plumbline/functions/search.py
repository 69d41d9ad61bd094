"""Search in sorted arrays, by functions that Spark has for arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def leading(values: Column, holds: Callable[[Column], Column]) -> Column:
    """Number of elements at the beginning of an array for which ``holds``; no later element may. Halves
    the array as often as its length has binary digits; one element is compared at once."""
    n = F.size(values)
    halvings = F.sequence(F.lit(1), F.length(F.bin(n.cast("bigint"))))

    def halve(found: Column, _: Column) -> Column:
        low, high = found["low"], found["high"]
        middle = F.shiftright(low + high, 1)
        is_before = holds(F.get(values, middle))
        return F.when(low >= high, found).otherwise(
            F.struct(
                F.when(is_before, middle + 1).otherwise(low).alias("low"),
                F.when(is_before, high).otherwise(middle).alias("high"),
            )
        )

    start = F.struct(F.lit(0).alias("low"), n.alias("high"))
    searched = F.aggregate(halvings, start, halve, lambda found: found["low"])
    alone = holds(F.get(values, F.lit(0))).cast("int")
    return F.when(n < 1, 0).when(n == 1, alone).otherwise(searched)
