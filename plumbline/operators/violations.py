"""The rows behind the counts.

Each function has the name and parameters of a counting operator and returns the violating rows of
the table themselves, for field checks with a label column ``violating_field``. Rows repeat where
an SQL join repeats them: per matching partner row and per cohort membership. Here the rows are the
result, so these are joins; adaptive execution splits a key that dominates either input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.counting import col
from plumbline.functions.values import as_date, split_list
from plumbline.operators import lookup, rowwise, temporal
from plumbline.operators.concepts import FEMALE_CONCEPT, MALE, MALE_CONCEPT, NO_UNITS
from plumbline.sources.cdm import Cdm, Cohort, spread

OTHER = "__partner_key"


def _label(rows: DataFrame, table: str, field: str) -> DataFrame:
    label = F.lit(f"{table.lower()}.{field.lower()}").alias("violating_field")
    return rows.select(label, "*")


def _by_rule(cdm, table, field, rule, cohort) -> DataFrame:
    return _label(cdm.member_rows(table, cohort).where(rule.violated), table, field)


def _partner(
    cdm: Cdm,
    table: str,
    key: str,
    partner: str,
    partner_key: str,
    columns: dict[str, Column],
    where: Column | None = None,
) -> tuple[DataFrame, Column]:
    """Partner rows under names that clash with nothing, and the condition that joins them."""
    as_type = lookup.key_type([cdm.datatype(table, key), cdm.datatype(partner, partner_key)])
    rows = cdm[partner] if where is None else cdm[partner].where(where)
    rows = rows.select(
        col(partner_key).cast(as_type).alias(OTHER),
        *[expr.alias(name) for name, expr in columns.items()],
    )
    return rows, col(key).cast(as_type) == F.col(OTHER)


def tagged_rows(
    cdm: Cdm,
    table: str,
    rules: Mapping[str, rowwise.RowRule],
    key_checks: Mapping[str, lookup.KeyCheck] | None = None,
    cohort: Cohort | None = None,
) -> DataFrame:
    """The rows of a table that break any of many checks, each once (with a cohort: once per membership), with the
    names of the checks they break in ``violated_checks``, in order.

    All row rules are judged in one scan. ``key_checks`` are vocabulary rules, or None for keys that must be known; each of
    their fields is one join with a partner that has one row per concept, and rows are not multiplied."""
    rows, tags, helpers = cdm.member_rows(table, cohort), {}, []
    names = list(rows.columns)
    for name, rule in rules.items():
        tags[name] = rule.violated
    by_field: dict[str, dict[str, lookup.KeyCheck]] = {}
    for name, check in (key_checks or {}).items():
        by_field.setdefault(check.field, {})[name] = check
    for i, (field, checks) in enumerate(by_field.items()):
        key, broken = f"__key{i}", {name: f"__broken{i}_{j}" for j, name in enumerate(checks)}
        as_type = lookup.key_type([cdm.datatype(table, field), cdm.datatype(lookup.CONCEPT, lookup.CONCEPT_KEY)])
        partner = cdm[lookup.CONCEPT].where(col(lookup.CONCEPT_KEY).isNotNull()).select(
            col(lookup.CONCEPT_KEY).cast(as_type).alias(key),
            *[
                (F.coalesce(check.rule.broken, F.lit(False)) if check.rule else F.lit(False)).alias(broken[name])
                for name, check in checks.items()
            ],
        )
        partner = partner.groupBy(key, spread(key).alias("__spread")).agg(*[F.max(b).alias(b) for b in broken.values()])
        rows = rows.join(partner.drop("__spread"), col(field).cast(as_type) == F.col(key), "left")
        for name, check in checks.items():
            tags[name] = F.col(broken[name]) if check.rule else col(field).isNotNull() & F.col(key).isNull()
        helpers += [key, *broken.values()]
    found = F.array_compact(F.array(*[F.when(violated, F.lit(name)) for name, violated in tags.items()]))
    return rows.withColumn("violated_checks", found).where(F.size("violated_checks") > 0).select(*map(col, names), "violated_checks")


def write_tagged_rows(rows: DataFrame, path: str, format: str = "parquet") -> None:
    """Rows of ``tagged_rows`` as files, in one folder ``violated_check=<name>`` per check: a check's rows are read without
    the others'. A row that breaks several checks is in the folder of each."""
    by_check = rows.withColumn("violated_check", F.explode("violated_checks")).drop("violated_checks")
    by_check.write.format(format).mode("overwrite").partitionBy("violated_check").save(path)


def is_required(cdm: Cdm, table: str, field: str, cohort: Cohort | None = None) -> DataFrame:
    return _by_rule(cdm, table, field, rowwise.not_null_rule(field), cohort)


def measure_value_completeness(
    cdm: Cdm, table: str, field: str, cohort: Cohort | None = None
) -> DataFrame:
    return _by_rule(cdm, table, field, rowwise.not_null_rule(field), cohort)


def cdm_datatype(cdm: Cdm, table: str, field: str) -> DataFrame:
    return _by_rule(cdm, table, field, rowwise.numeric_rule(cdm, table, field), None)


def concept_record_completeness(
    cdm: Cdm, table: str, field: str, cohort: Cohort | None = None
) -> DataFrame:
    return _by_rule(cdm, table, field, rowwise.zero_concept_rule(table, field), cohort)


def table_concept_completeness(
    cdm: Cdm, table: str, field: str, source_field: str, cohort: Cohort | None = None
) -> DataFrame:
    rule = rowwise.both_unmapped_rule(field, source_field)
    return cdm.member_rows(table, cohort).where(rule.violated)


def plausible_value_low(
    cdm: Cdm,
    table: str,
    field: str,
    low: object,
    datatype: str | None = None,
    cohort: Cohort | None = None,
) -> DataFrame:
    return _by_rule(cdm, table, field, rowwise.range_rule(field, low, datatype), cohort)


def plausible_value_high(
    cdm: Cdm,
    table: str,
    field: str,
    high: object,
    datatype: str | None = None,
    cohort: Cohort | None = None,
) -> DataFrame:
    rule = rowwise.range_rule(field, high, datatype, high=True)
    return _by_rule(cdm, table, field, rule, cohort)


def is_primary_key(cdm: Cdm, table: str, field: str, cohort: Cohort | None = None) -> DataFrame:
    repeated = (
        cdm[table]
        .where(col(field).isNotNull())
        .select(col(field).alias(OTHER))
        .groupBy(OTHER, spread(OTHER))
        .agg(F.count(F.lit(1)).alias("__found"))
        .where(F.col("__found") > 1)
    )
    rows = cdm.member_rows(table, cohort)
    return _label(rows.join(repeated, col(field) == F.col(OTHER), "left_semi"), table, field)


def source_value_completeness(
    cdm: Cdm, table: str, field: str, standard_field: str, cohort: Cohort | None = None
) -> DataFrame:
    """Distinct source values mapped to concept 0."""
    rows = cdm.member_rows(table, cohort).where(col(standard_field) == 0)
    return _label(rows.select(col(field)).distinct(), table, field)


def is_foreign_key(
    cdm: Cdm,
    table: str,
    field: str,
    fk_table: str,
    fk_field: str,
    cohort: Cohort | None = None,
) -> DataFrame:
    partners, same = _partner(cdm, table, field, fk_table, fk_field, {})
    rows = cdm.member_rows(table, cohort).where(col(field).isNotNull())
    return _label(rows.join(partners, same, "left_anti"), table, field)


def _by_concept(cdm, table, field, rule, cohort) -> DataFrame:
    partners, same = _partner(
        cdm, table, field, lookup.CONCEPT, lookup.CONCEPT_KEY, {}, rule.broken
    )
    rows = cdm.member_rows(table, cohort)
    return _label(rows.join(partners, same).drop(OTHER), table, field)


def fk_domain(
    cdm: Cdm, table: str, field: str, domains: str | Sequence[str], cohort: Cohort | None = None
) -> DataFrame:
    return _by_concept(cdm, table, field, lookup.domain_rule(domains), cohort)


def fk_class(
    cdm: Cdm, table: str, field: str, concept_class: str, cohort: Cohort | None = None
) -> DataFrame:
    return _by_concept(cdm, table, field, lookup.class_rule(concept_class), cohort)


def is_standard_valid_concept(
    cdm: Cdm, table: str, field: str, cohort: Cohort | None = None
) -> DataFrame:
    return _by_concept(cdm, table, field, lookup.standard_rule(), cohort)


def person_completeness(
    cdm: Cdm,
    table: str,
    person_table: str = "person",
    person_key: str = "person_id",
    cohort: Cohort | None = None,
) -> DataFrame:
    """Persons without a row in ``table``; persons without an id are listed, though not counted."""
    partners, same = _partner(cdm, person_table, person_key, table, person_key, {})
    return cdm.member_rows(person_table, cohort).join(partners, same, "left_anti")


def plausible_temporal_after(
    cdm: Cdm,
    table: str,
    field: str,
    earlier_table: str,
    earlier_field: str,
    cohort: Cohort | None = None,
) -> DataFrame:
    if earlier_table.lower() == table.lower():
        rule = rowwise.own_date_order_rule(table, field, earlier_field)
        return _by_rule(cdm, table, field, rule, cohort)
    is_birth = earlier_table.lower() == rowwise.BIRTH_TABLE
    earlier = rowwise.birth_date(earlier_field) if is_birth else as_date(col(earlier_field))
    key = temporal.PERSON_KEY
    partners, same = _partner(cdm, table, key, earlier_table, key, {"__earlier": earlier})
    late = F.col("__earlier") > as_date(col(field))
    rows = cdm.member_rows(table, cohort).join(partners, same & late)
    return _label(rows.drop(OTHER, "__earlier"), table, field)


def plausible_during_life(
    cdm: Cdm, table: str, field: str, cohort: Cohort | None = None
) -> DataFrame:
    key, death = temporal.PERSON_KEY, as_date(col(temporal.DEATH_FIELD))
    last = F.date_add(death, temporal.DAYS_AFTER_DEATH)
    partners, same = _partner(cdm, table, key, temporal.DEATH_TABLE, key, {"__last": last})
    dead = as_date(col(field)) > F.col("__last")
    rows = cdm.member_rows(table, cohort).join(partners, same & dead)
    return _label(rows.drop(OTHER, "__last"), table, field)


def within_visit_dates(
    cdm: Cdm, table: str, field: str, cohort: Cohort | None = None
) -> DataFrame:
    key, days = temporal.VISIT_KEY, temporal.DAYS_AROUND_VISIT
    first = F.date_sub(as_date(col(temporal.VISIT_START)), days)
    last = F.date_add(as_date(col(temporal.VISIT_END)), days)
    partners, same = _partner(
        cdm,
        table,
        key,
        temporal.VISIT_TABLE,
        key,
        {"__first": temporal.day_position(first), "__last": temporal.day_position(last)},
    )
    place = temporal.moment_position(cdm, table, field)
    outside = (place < F.col("__first")) | (place > F.col("__last"))
    rows = cdm.member_rows(table, cohort).join(partners, same & outside)
    return _label(rows.drop(OTHER, "__first", "__last"), table, field)


def concept_plausible_gender(
    cdm: Cdm, table: str, field: str, concept_id: int, gender: str, cohort: Cohort | None = None
) -> DataFrame:
    expected = MALE_CONCEPT if gender == MALE else FEMALE_CONCEPT
    key = temporal.PERSON_KEY
    wrong = col("gender_concept_id") != expected
    partners, same = _partner(cdm, table, key, "person", key, {}, wrong)
    rows = cdm.member_rows(table, cohort).where(col(field) == concept_id)
    return rows.join(partners, same).drop(OTHER)


def concept_plausible_unit_concept_ids(
    cdm: Cdm,
    table: str,
    field: str,
    concept_id: int,
    units: str | Sequence[int],
    cohort: Cohort | None = None,
) -> DataFrame:
    unit = col("unit_concept_id")
    if isinstance(units, str) and units.strip() in NO_UNITS:
        wrong = unit.isNotNull()
    else:
        given = split_list(units if isinstance(units, str) else list(units))
        wrong = ~unit.isin([int(part) for part in given])
    return cdm.member_rows(table, cohort).where(
        (col(field) == concept_id)
        & wrong
        & col("value_as_number").isNotNull()
        & col("unit_source_value").isNotNull()
    )


def _by_value(cdm, table, field, concept_id, unit_concept_id, wrong, cohort) -> DataFrame:
    return cdm.member_rows(table, cohort).where(
        (col(field) == concept_id) & (col("unit_concept_id") == unit_concept_id) & wrong
    )


def concept_plausible_value_low(
    cdm: Cdm,
    table: str,
    field: str,
    concept_id: int,
    unit_concept_id: int,
    low: float,
    cohort: Cohort | None = None,
) -> DataFrame:
    wrong = col("value_as_number") < low
    return _by_value(cdm, table, field, concept_id, unit_concept_id, wrong, cohort)


def concept_plausible_value_high(
    cdm: Cdm,
    table: str,
    field: str,
    concept_id: int,
    unit_concept_id: int,
    high: float,
    cohort: Cohort | None = None,
) -> DataFrame:
    wrong = col("value_as_number") > high
    return _by_value(cdm, table, field, concept_id, unit_concept_id, wrong, cohort)
