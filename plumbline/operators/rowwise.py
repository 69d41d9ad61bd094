"""Checks decided by one row alone.

A rule says which rows violate and which rows count. Any number of rules over the same table are
counted in one scan: one aggregate without a shuffle of the rows, only one partial result per task.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.counting import check_counts, col, tally, to_long
from plumbline.functions.values import (
    DATE_TYPES,
    as_date,
    bound,
    is_numeric_text,
    is_numeric_type,
)
from plumbline.sources.cdm import Cdm, Cohort, Rows

# Tables whose unit is only expected where there is a number to have a unit.
UNIT_FIELD = "unit_concept_id"
UNIT_TABLES = ("measurement", "observation")
VALUE_FIELD = "value_as_number"
BIRTH_TABLE = "person"
BIRTH_YEAR_FIELD = "year_of_birth"
BIRTH_MONTH_DAY = "-06-01"


@dataclass(frozen=True)
class RowRule:
    """``violated``: rows that break the rule. ``counted``: rows of the denominator, None for all."""

    violated: Column
    counted: Column | None = None


def not_null_rule(field: str) -> RowRule:
    return RowRule(col(field).isNull())


def numeric_rule(cdm: Cdm, table: str, field: str) -> RowRule:
    """Filled values that are not numbers. A numeric column cannot hold any."""
    if is_numeric_type(cdm.datatype(table, field)):
        return RowRule(F.lit(False))
    value = col(field)
    return RowRule(value.isNotNull() & ~is_numeric_text(value))


def zero_concept_rule(
    table: str,
    field: str,
    unit_tables: tuple[str, ...] = UNIT_TABLES,
    unit_field: str = UNIT_FIELD,
    value_field: str = VALUE_FIELD,
) -> RowRule:
    """Rows mapped to concept 0; units are only judged where a number is given."""
    zero = col(field) == 0
    if field.lower() == unit_field and table.lower() in unit_tables:
        has_value = col(value_field).isNotNull()
        return RowRule(zero & has_value, has_value)
    return RowRule(zero)


def range_rule(
    field: str, limit: object, datatype: str | None = None, *, high: bool = False
) -> RowRule:
    """Values below a low limit, or above a high one; dates are compared as whole days."""
    edge = bound(limit, datatype)
    value = as_date(col(field)) if (datatype or "").lower() in DATE_TYPES else col(field)
    return RowRule(value > edge if high else value < edge, col(field).isNotNull())


def both_unmapped_rule(field: str, source_field: str) -> RowRule:
    """Neither the standard concept nor the source concept is known."""

    def unmapped(name: str) -> Column:
        return (col(name) == 0) | col(name).isNull()

    return RowRule(unmapped(field) & unmapped(source_field))


def birth_date(field: str, year_field: str = BIRTH_YEAR_FIELD) -> Column:
    """Recorded birth date, else the middle of the birth year."""
    fallback = F.concat(col(year_field).cast("string"), F.lit(BIRTH_MONTH_DAY))
    return F.coalesce(as_date(col(field)), as_date(fallback))


def own_date_order_rule(table: str, field: str, earlier_field: str) -> RowRule:
    """An earlier date of the same row lies after ``field``."""
    is_birth = table.lower() == BIRTH_TABLE
    earlier = birth_date(earlier_field) if is_birth else as_date(col(earlier_field))
    return RowRule(earlier > as_date(col(field)))


def count_rules(rows: Rows, rules: Mapping[str, RowRule]) -> DataFrame:
    """(check_key, violated, denominator) of all rules in one scan."""
    return to_long(
        rows.df,
        {
            key: (tally(rule.violated, rows.weight), tally(rule.counted, rows.weight))
            for key, rule in rules.items()
        },
    )


def _single(cdm: Cdm, table: str, rule: RowRule, cohort: Cohort | None) -> DataFrame:
    return check_counts(count_rules(cdm.rows(table, cohort), {"": rule}))


def is_required(cdm: Cdm, table: str, field: str, cohort: Cohort | None = None) -> DataFrame:
    """Rows with NULL in a field that must be filled, of all rows."""
    return _single(cdm, table, not_null_rule(field), cohort)


def measure_value_completeness(
    cdm: Cdm, table: str, field: str, cohort: Cohort | None = None
) -> DataFrame:
    """Rows with NULL in a field, of all rows."""
    return _single(cdm, table, not_null_rule(field), cohort)


def cdm_datatype(cdm: Cdm, table: str, field: str) -> DataFrame:
    """Rows of an integer field whose value is not numeric, of all rows."""
    return _single(cdm, table, numeric_rule(cdm, table, field), None)


def concept_record_completeness(
    cdm: Cdm, table: str, field: str, cohort: Cohort | None = None
) -> DataFrame:
    """Rows whose concept is 0, of all rows (units: of the rows with a number)."""
    return _single(cdm, table, zero_concept_rule(table, field), cohort)


def table_concept_completeness(
    cdm: Cdm, table: str, field: str, source_field: str, cohort: Cohort | None = None
) -> DataFrame:
    """Rows without standard and without source concept, of all rows."""
    return _single(cdm, table, both_unmapped_rule(field, source_field), cohort)


def plausible_value_low(
    cdm: Cdm,
    table: str,
    field: str,
    low: object,
    datatype: str | None = None,
    cohort: Cohort | None = None,
) -> DataFrame:
    """Rows below the lowest plausible value, of the rows with a value."""
    return _single(cdm, table, range_rule(field, low, datatype), cohort)


def plausible_value_high(
    cdm: Cdm,
    table: str,
    field: str,
    high: object,
    datatype: str | None = None,
    cohort: Cohort | None = None,
) -> DataFrame:
    """Rows above the highest plausible value, of the rows with a value."""
    return _single(cdm, table, range_rule(field, high, datatype, high=True), cohort)
