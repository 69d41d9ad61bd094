"""Checks decided per value of a field: duplicate keys and unmapped source values.

All such checks of a table share one scan and one shuffle: the fields are stacked as (slot, value),
with one value column per datatype, and counted per slot and value before they move. So a value that
fills a third of the table arrives as one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.counting import check_counts, col, tally, to_long
from plumbline.sources.cdm import WEIGHT, Cdm, Cohort


@dataclass(frozen=True)
class ValueCheck:
    """Check of the values of a field: are they unique or, with a field of standard concepts, mapped?"""

    field: str
    standard_field: str | None = None


def count_value_checks(
    cdm: Cdm, table: str, checks: Mapping[str, ValueCheck], cohort: Cohort | None = None
) -> DataFrame:
    """Checks of values of one table, one row per check.

    Duplicates: rows whose value occurs more than once, of all rows; searched in the whole table,
    also when a cohort restricts the rows that are judged, and NULL is no duplicate. Source values:
    distinct values with a row mapped to concept 0, of all distinct values of the judged rows; NULL
    is one value. Repeated cohort memberships count rows several times and values once.
    """
    rows, times = cdm[table], F.lit(1).cast("bigint")
    if cohort is not None:
        rows = cdm.weighted(table, cohort)
        times = F.coalesce(F.col(WEIGHT), F.lit(0).cast("bigint"))
    slots = list(dict.fromkeys(checks.values()))
    types = {slot: cdm.datatype(table, slot.field) for slot in slots}
    values = {kind: f"value{i}" for i, kind in enumerate(dict.fromkeys(types.values()))}

    def entry(slot: ValueCheck):
        cells = [
            (col(slot.field) if types[slot] == kind else F.lit(None)).cast(kind).alias(name)
            for kind, name in values.items()
        ]
        unmapped = F.lit(False) if slot.standard_field is None else F.coalesce(col(slot.standard_field) == 0, F.lit(False))
        return F.struct(F.lit(slots.index(slot)).alias("slot"), *cells, unmapped.alias("unmapped"))

    stacked = rows.select(times.alias("times"), F.inline(F.array(*map(entry, slots))))
    groups = stacked.groupBy("slot", *values.values()).agg(
        F.count(F.lit(1)).alias("found"),
        F.sum("times").alias("judged"),
        F.max(F.col("unmapped") & (F.col("times") > 0)).alias("unmapped"),
    )
    filled = F.coalesce(*[F.col(name).cast("string") for name in values.values()]).isNotNull()
    pairs = {}
    for key, slot in checks.items():
        own, judged = F.col("slot") == slots.index(slot), F.col("judged")
        if slot.standard_field is None:
            pairs[key] = (tally(own & filled & (F.col("found") > 1), judged), tally(own, judged))
        else:
            pairs[key] = (tally(own & F.col("unmapped")), tally(own & (judged > 0)))
    return to_long(groups, pairs)


def is_primary_key(cdm: Cdm, table: str, field: str, cohort: Cohort | None = None) -> DataFrame:
    """Rows whose key is not unique, of all rows."""
    return check_counts(count_value_checks(cdm, table, {"": ValueCheck(field)}, cohort))


def source_value_completeness(
    cdm: Cdm, table: str, field: str, standard_field: str, cohort: Cohort | None = None
) -> DataFrame:
    """Distinct source values mapped to concept 0, of all distinct source values."""
    return check_counts(count_value_checks(cdm, table, {"": ValueCheck(field, standard_field)}, cohort))
