"""Checks against another table by key: foreign keys, vocabulary rules, persons without records.

None of them needs a join. Both sides are reduced to numbers per key - how many rows carry the key,
how many partner rows have it, how many of those break a rule - stacked and summed by key in one
shuffle. An SQL join would give every pair of rows; its size per key is the product of the two
numbers, so duplicates on either side are counted exactly as a join would. Partial sums go into
the shuffle: a key that holds a third of a table is one row per task, nothing is broadcast, and no
task sees more than one row per key and task of the stage before.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.counting import check_counts, col, tally, to_long
from plumbline.functions.values import split_list
from plumbline.sources.cdm import Cdm, Cohort, Rows

KEY = "key"
FOUND = "found"
CONCEPT, CONCEPT_KEY = "concept", "concept_id"


def key_type(types: Sequence[T.DataType]) -> str:
    """Type in which keys of different columns are compared without losing any value."""
    if all(isinstance(t, T.IntegralType) for t in types):
        return "bigint"
    if all(isinstance(t, (T.IntegralType, T.DecimalType)) for t in types):
        scale = max(t.scale for t in types if isinstance(t, T.DecimalType))
        return f"decimal(38,{scale})"
    if all(isinstance(t, T.NumericType) for t in types):
        return "double"
    first = types[0]
    return first.simpleString() if all(t == first for t in types) else "string"


def sum_by_key(sides: Sequence[DataFrame]) -> DataFrame:
    """Stack keyed frames and sum every measure per key; a measure a key lacks is NULL."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sides)
    measures = [name for name in stacked.columns if name != KEY]
    return stacked.groupBy(KEY).agg(*[F.sum(name).alias(name) for name in measures])


def slot_side(rows: Rows, slots: Mapping[str, str], as_type: str) -> DataFrame:
    """Keys of several fields of one table from one scan: measure ``slot`` counts the rows with
    that key in the slot's field."""
    if len(slots) == 1:
        ((slot, field),) = slots.items()
        return rows.df.select(col(field).cast(as_type).alias(KEY), rows.times.alias(slot))
    cells = [cell for s, f in slots.items() for cell in (F.lit(s), col(f).cast(as_type))]
    long = rows.df.select(
        F.stack(F.lit(len(slots)), *cells).alias("slot", KEY), rows.times.alias("times")
    )
    return long.select(
        KEY, *[F.when(F.col("slot") == slot, F.col("times")).alias(slot) for slot in slots]
    )


@dataclass(frozen=True)
class VocabularyRule:
    """``broken``: condition on a concept row that makes rows referring to it violate."""

    broken: Column


def domain_rule(domains: str | Sequence[str]) -> VocabularyRule:
    """Concept outside the expected domains; unknown concepts and concept 0 pass."""
    expected = F.col("domain_id").isin(split_list(domains))
    return VocabularyRule((F.col(CONCEPT_KEY) != 0) & ~expected)


def class_rule(concept_class: str) -> VocabularyRule:
    """Concept of another class than expected."""
    return VocabularyRule(
        (F.col(CONCEPT_KEY) != 0) & (F.col("concept_class_id") != concept_class)
    )


def standard_rule() -> VocabularyRule:
    """Concept that is not standard or no longer valid. NULL as standard flag alone passes."""
    return VocabularyRule(
        (F.col(CONCEPT_KEY) != 0)
        & ((F.col("standard_concept") != "S") | F.col("invalid_reason").isNotNull())
    )


@dataclass(frozen=True)
class KeyCheck:
    """One check of a field against the partner table: a vocabulary rule, or None for the foreign
    key itself; ``reverse`` asks for partner rows without any row (persons without records)."""

    field: str
    rule: VocabularyRule | None = None
    reverse: bool = False


def count_key_checks(
    cdm: Cdm,
    table: str,
    partner: str,
    partner_key: str,
    checks: Mapping[str, KeyCheck],
    cohort: Cohort | None = None,
) -> DataFrame:
    """All checks of one table against one partner table in one shuffle: each table is scanned once.

    With a cohort, ``reverse`` checks must be counted by themselves: there the partner's rows are
    restricted and the table's are not.
    """
    fields = list(dict.fromkeys(check.field.lower() for check in checks.values()))
    slots = {f"slot{i}": field for i, field in enumerate(fields)}
    slot_of = {field: slot for slot, field in slots.items()}
    rules = {
        name: check.rule.broken for name, check in checks.items() if check.rule is not None
    }
    rule_of = {name: f"rule{i}" for i, name in enumerate(rules)}

    reverse = any(check.reverse for check in checks.values())
    if cohort is not None and reverse and not all(check.reverse for check in checks.values()):
        raise ValueError("count reverse checks by themselves when a cohort is given")
    rows = cdm.rows(table, None if reverse else cohort)
    partners = cdm.rows(partner, cohort if reverse else None)
    as_type = key_type(
        [cdm.datatype(table, f) for f in fields] + [cdm.datatype(partner, partner_key)]
    )
    merged = sum_by_key(
        [
            slot_side(rows, slots, as_type),
            partners.df.select(
                col(partner_key).cast(as_type).alias(KEY),
                partners.times.alias(FOUND),
                *[
                    F.when(rules[name], F.lit(1).cast("bigint")).alias(column)
                    for name, column in rule_of.items()
                ],
            ),
        ]
    )

    known = F.col(KEY).isNotNull()

    def pair(name: str, check: KeyCheck) -> tuple[Column, Column]:
        times = F.col(slot_of[check.field.lower()])
        if check.reverse:
            found = F.col(FOUND)
            return tally(known & times.isNull(), found), tally(None, found)
        if check.rule is None:
            return tally(known & F.col(FOUND).isNull(), times), tally(None, times)
        return tally(known, times * F.col(rule_of[name])), tally(None, times)

    return to_long(merged, {name: pair(name, check) for name, check in checks.items()})


def count_era_persons(
    cdm: Cdm,
    table: str,
    source: str = "condition_occurrence",
    cohort: Cohort | None = None,
    person_key: str = "person_id",
    key: str = "",
) -> DataFrame:
    """Distinct persons of ``source`` without a row in ``table``, of the distinct persons there."""
    as_type = key_type([cdm.datatype(source, person_key), cdm.datatype(table, person_key)])
    # A membership of a cohort is yes or no here, since persons are counted once.
    occurrences = cdm.rows(source, cohort)
    merged = sum_by_key(
        [
            occurrences.df.select(
                col(person_key).cast(as_type).alias(KEY), occurrences.times.alias("seen")
            ),
            cdm[table].select(
                col(person_key).cast(as_type).alias(KEY), F.lit(1).cast("bigint").alias(FOUND)
            ),
        ]
    )
    person = F.col(KEY).isNotNull() & (F.col("seen") > 0)
    return to_long(merged, {key: (tally(person & F.col(FOUND).isNull()), tally(person))})


def _single(cdm, table, partner, partner_key, check, cohort) -> DataFrame:
    return check_counts(count_key_checks(cdm, table, partner, partner_key, {"": check}, cohort))


def is_foreign_key(
    cdm: Cdm,
    table: str,
    field: str,
    fk_table: str,
    fk_field: str,
    cohort: Cohort | None = None,
) -> DataFrame:
    """Rows whose filled key has no partner row, of all rows."""
    return _single(cdm, table, fk_table, fk_field, KeyCheck(field), cohort)


def fk_domain(
    cdm: Cdm, table: str, field: str, domains: str | Sequence[str], cohort: Cohort | None = None
) -> DataFrame:
    """Rows whose concept lies outside the expected domains, of all rows."""
    check = KeyCheck(field, domain_rule(domains))
    return _single(cdm, table, CONCEPT, CONCEPT_KEY, check, cohort)


def fk_class(
    cdm: Cdm, table: str, field: str, concept_class: str, cohort: Cohort | None = None
) -> DataFrame:
    """Rows whose concept has another class than expected, of all rows."""
    check = KeyCheck(field, class_rule(concept_class))
    return _single(cdm, table, CONCEPT, CONCEPT_KEY, check, cohort)


def is_standard_valid_concept(
    cdm: Cdm, table: str, field: str, cohort: Cohort | None = None
) -> DataFrame:
    """Rows whose concept is not a standard, valid one, of all rows."""
    return _single(cdm, table, CONCEPT, CONCEPT_KEY, KeyCheck(field, standard_rule()), cohort)


def person_completeness(
    cdm: Cdm,
    table: str,
    person_table: str = "person",
    person_key: str = "person_id",
    cohort: Cohort | None = None,
) -> DataFrame:
    """Persons without any row in ``table``, of all persons."""
    check = KeyCheck(person_key, reverse=True)
    return _single(cdm, table, person_table, person_key, check, cohort)


def condition_era_completeness(
    cdm: Cdm,
    table: str = "condition_era",
    source: str = "condition_occurrence",
    cohort: Cohort | None = None,
) -> DataFrame:
    """Persons with a condition but without a row in ``table``, of the persons with a condition."""
    return check_counts(count_era_persons(cdm, table, source, cohort))
