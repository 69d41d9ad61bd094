"""Counting violated rows and denominators.

Every check ends in two numbers: violated rows and denominator. Fused jobs compute many such pairs
in one wide aggregate; ``to_long`` turns that single row into one row per check.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHECK_KEY = "check_key"
VIOLATED = "num_violated_rows"
PERCENT = "pct_violated_rows"
DENOMINATOR = "num_denominator_rows"


def col(name: str) -> Column:
    """Column by its exact name, also when the name holds dots or spaces."""
    return F.col(f"`{name}`")


def tally(predicate: Column | None = None, weight: Column | None = None) -> Column:
    """Number of rows for which ``predicate`` is true; NULL counts as not true, as in WHERE.

    With ``weight`` each row counts that many times (duplicate cohort members).
    """
    if weight is None:
        return F.count(F.lit(1)) if predicate is None else F.count_if(predicate)
    counted = weight if predicate is None else F.when(predicate, weight)
    return F.coalesce(F.sum(counted), F.lit(0))


def pct_ratio(violated: Column, denominator: Column) -> Column:
    """Share of violated rows; 0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        violated.cast("double") / denominator.cast("double")
    )


def to_long(rows: DataFrame, pairs: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """Aggregate ``rows`` once and return (check_key, violated, denominator), one row per check."""
    wide = rows.agg(
        *[expr.cast("bigint").alias(f"v{i}") for i, (expr, _) in enumerate(pairs.values())],
        *[expr.cast("bigint").alias(f"d{i}") for i, (_, expr) in enumerate(pairs.values())],
    )
    records = [
        F.struct(
            F.lit(key).alias(CHECK_KEY),
            F.col(f"v{i}").alias(VIOLATED),
            F.col(f"d{i}").alias(DENOMINATOR),
        )
        for i, key in enumerate(pairs)
    ]
    return wide.select(F.inline(F.array(*records)))


def check_counts(counts: DataFrame) -> DataFrame:
    """Final shape of a single check: violated rows, their share, denominator."""
    violated, denominator = F.col(VIOLATED), F.col(DENOMINATOR)
    return counts.select(violated, pct_ratio(violated, denominator).alias(PERCENT), denominator)
