"""The registered queries in SQL, written the way the question reads and not the way it is run."""

from __future__ import annotations

import re

from plumbline.fixtures import (
    BASE_TABLES,
    CDM_VIEWS,
    CONCEPT_FIELD,
    CONCEPT_RULES,
    FIELD_RULES,
    VIEWS,
)
from plumbline.sources.standard import TABLES

NUMERIC = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"
PCT = "CASE WHEN {d} = 0 THEN 0.0 ELSE CAST({v} AS DOUBLE) / {d} END"


def statement(sql: str, **tables: str) -> str:
    """``sql`` preceded by the views, and the tables given by name, that it uses."""
    named = VIEWS | tables
    used: list[str] = []

    def need(text: str) -> None:
        for name in named:
            if name not in used and re.search(rf"\b{name}\b", text):
                if name in tables:
                    need(tables[name])
                used.append(name)

    need(sql)
    if not used:
        return sql
    ctes = ",\n".join(f"{name} AS ({named[name]})" for name in used)
    return f"WITH {ctes}\n{sql}"


def _strictest(check: str) -> str:
    """Threshold cells of control rows with one key: a blank threshold before any number."""
    number = f"TRY_CAST(NULLIF({check}Threshold, '') AS DOUBLE)"
    unreadable = f"{number} IS NULL AND {check}Threshold <> ''"
    return f"""CASE WHEN COUNT({number}) = COUNT(*) THEN MIN({number}) END AS threshold_value,
        MIN({check}Notes) AS notes_value,
        MIN(CASE WHEN {unreadable} THEN 'threshold is not readable: ' || {check}Threshold END) AS bad"""


def counts(violated: str, denominator: str) -> str:
    return statement(
        f"""SELECT CAST(v.n AS BIGINT) AS num_violated_rows,
        {PCT.format(v='v.n', d='d.n')} AS pct_violated_rows,
        CAST(d.n AS BIGINT) AS num_denominator_rows
        FROM ({violated}) v(n), ({denominator}) d(n)"""
    )


def number(table: str, condition: str = "TRUE") -> str:
    return f"SELECT COUNT(*) FROM {table} WHERE {condition}"


BY_CONCEPT = "measurement t JOIN concept co ON t.measurement_concept_id = co.concept_id"
BY_PERSON = "measurement t JOIN person p ON t.person_id = p.person_id"
BY_DEATH = "measurement t JOIN death de ON t.person_id = de.person_id"
BY_VISIT = "measurement t JOIN visit_occurrence vo ON t.visit_occurrence_id = vo.visit_occurrence_id"
BIRTH = "COALESCE(p.birth_datetime, CAST(CONCAT(p.year_of_birth, '-06-01') AS DATE))"
AFTER_DEATH = "t.measurement_date > de.death_date + 60"
NOT_IN_VISIT = (
    "(t.measurement_date < vo.visit_start_date - 7 OR t.measurement_date > vo.visit_end_date + 7)"
)
NOT_NUMERIC = f"provider_text IS NOT NULL AND NOT regexp_matches(provider_text, '{NUMERIC}')"
BOTH_UNMAPPED = (
    "(measurement_concept_id = 0 OR measurement_concept_id IS NULL) AND "
    "(measurement_source_concept_id = 0 OR measurement_source_concept_id IS NULL)"
)
REPEATED = (
    "measurement_id IN (SELECT measurement_id FROM measurement GROUP BY measurement_id "
    "HAVING COUNT(*) > 1)"
)
NO_LOCATION = (
    "location_id IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM location f WHERE f.location_id = t.location_id)"
)
NOT_VALID = "(co.standard_concept <> 'S' OR co.invalid_reason IS NOT NULL)"
NO_ERA = "NOT EXISTS (SELECT 1 FROM condition_era e WHERE e.person_id = t.person_id)"
MEASURED = "measurement_concept_id = 7 AND value_as_number IS NOT NULL"
WITH_UNIT = f"{MEASURED} AND unit_source_value IS NOT NULL"
SOURCE_VALUES = (
    "SELECT COUNT(DISTINCT {c}) + COUNT(DISTINCT CASE WHEN {c} IS NULL THEN 1 END) FROM {t}"
)
DISTINCT_UNMAPPED = (
    "SELECT COUNT(*) FROM (SELECT DISTINCT condition_source_value FROM {t} "
    "WHERE condition_concept_id = 0) x"
)

# Violated rows and denominator of each check.
PAIRS = {
    "person_completeness": (number("person t", NO_ERA), number("person")),
    "condition_era_completeness": (
        "SELECT COUNT(DISTINCT person_id) FROM condition_occurrence t WHERE " + NO_ERA,
        "SELECT COUNT(DISTINCT person_id) FROM condition_occurrence",
    ),
    "table_concept_completeness": (number("measurement", BOTH_UNMAPPED), number("measurement")),
    "is_required": (number("person", "gender_concept_id IS NULL"), number("person")),
    "measure_value_completeness": (
        number("measurement", "value_as_number IS NULL"),
        number("measurement"),
    ),
    "cdm_datatype": (number("measurement", NOT_NUMERIC), number("measurement")),
    "is_primary_key": (number("measurement", REPEATED), number("measurement")),
    "is_foreign_key": (number("person t", NO_LOCATION), number("person")),
    "fk_domain": (
        number(BY_CONCEPT, "co.concept_id <> 0 AND co.domain_id NOT IN ('PROMO')"),
        number("measurement"),
    ),
    "fk_class": (
        number(BY_CONCEPT, "co.concept_id <> 0 AND co.concept_class_id <> 'Brand#12'"),
        number("measurement"),
    ),
    "is_standard_valid_concept": (
        number(BY_CONCEPT, f"co.concept_id <> 0 AND {NOT_VALID}"),
        number("measurement"),
    ),
    "concept_record_completeness": (
        number("measurement", "measurement_concept_id = 0"),
        number("measurement"),
    ),
    "concept_record_completeness_unit": (
        number("measurement", "unit_concept_id = 0 AND value_as_number IS NOT NULL"),
        number("measurement", "value_as_number IS NOT NULL"),
    ),
    "source_value_completeness": (
        DISTINCT_UNMAPPED.format(t="condition_occurrence"),
        SOURCE_VALUES.format(c="condition_source_value", t="condition_occurrence"),
    ),
    "plausible_value_low": (
        number("person", "year_of_birth < 1950"),
        number("person", "year_of_birth IS NOT NULL"),
    ),
    "plausible_value_low_date": (
        number("measurement", "measurement_date < DATE '1996-01-01'"),
        number("measurement", "measurement_date IS NOT NULL"),
    ),
    "plausible_value_high": (
        number("measurement", "value_as_number > 45"),
        number("measurement", "value_as_number IS NOT NULL"),
    ),
    "plausible_value_high_date": (
        number("measurement", "measurement_date > DATE '2001-01-01'"),
        number("measurement", "measurement_date IS NOT NULL"),
    ),
    "plausible_temporal_after_birth": (
        number(BY_PERSON, f"{BIRTH} > t.measurement_date"),
        number("measurement"),
    ),
    "plausible_temporal_after_self": (
        number("visit_occurrence", "visit_start_date > visit_end_date"),
        number("visit_occurrence"),
    ),
    "plausible_temporal_after_table": (
        number(
            "condition_occurrence t JOIN visit_occurrence vo ON t.person_id = vo.person_id",
            "vo.visit_start_date > t.condition_start_date",
        ),
        number("condition_occurrence"),
    ),
    "plausible_during_life": (
        number(BY_DEATH, AFTER_DEATH),
        number("measurement", "person_id IN (SELECT person_id FROM death)"),
    ),
    "within_visit_dates": (number(BY_VISIT, NOT_IN_VISIT), number(BY_VISIT)),
    "concept_plausible_gender": (
        number(BY_PERSON, "t.measurement_concept_id = 7 AND p.gender_concept_id <> 8507"),
        number("measurement", "measurement_concept_id = 7"),
    ),
    "concept_plausible_unit_concept_ids": (
        number("measurement", f"{WITH_UNIT} AND unit_concept_id NOT IN (2, 3, 4)"),
        number("measurement", WITH_UNIT),
    ),
    "concept_plausible_unit_any": (
        number("measurement", f"{WITH_UNIT} AND unit_concept_id IS NOT NULL"),
        number("measurement", WITH_UNIT),
    ),
    "concept_plausible_value_low": (
        number("measurement", f"{MEASURED} AND unit_concept_id = 2 AND value_as_number < 10"),
        number("measurement", f"{MEASURED} AND unit_concept_id = 2"),
    ),
    "concept_plausible_value_high": (
        number("measurement", f"{MEASURED} AND unit_concept_id = 2 AND value_as_number > 25"),
        number("measurement", f"{MEASURED} AND unit_concept_id = 2"),
    ),
}

# The same for the members of cohort 1; an inner join, so repeated memberships repeat rows.
MEMBERS = {
    name: f"SELECT x.* FROM {name} x JOIN cohort c ON x.person_id = c.subject_id "
    "AND c.cohort_definition_id = 1"
    for name in ("measurement", "person", "condition_occurrence", "visit_occurrence")
}


def _in_cohort(sql: str, *names: str) -> str:
    """The first mention of each table, the one that is counted, restricted to the cohort."""
    for name in names:
        sql = re.sub(
            rf"FROM {name}( t)?\b", lambda m: f"FROM ({MEMBERS[name]}){m.group(1) or ' t'}", sql, count=1
        )
    return sql


COHORT_PAIRS = {
    f"cohort_{key}": tuple(_in_cohort(sql, table) for sql in PAIRS[source])
    for key, source, table in (
        ("is_required", "measure_value_completeness", "measurement"),
        ("filtered_in_the_scan", "measure_value_completeness", "measurement"),
        ("is_primary_key", "is_primary_key", "measurement"),
        ("source_value_completeness", "source_value_completeness", "condition_occurrence"),
        ("fk_domain", "fk_domain", "measurement"),
        ("person_completeness", "person_completeness", "person"),
        ("condition_era_completeness", "condition_era_completeness", "condition_occurrence"),
        ("within_visit_dates", "within_visit_dates", "measurement"),
        ("plausible_during_life", "plausible_during_life", "measurement"),
        ("concept_plausible_gender", "concept_plausible_gender", "measurement"),
        ("measure_value_completeness", "measure_value_completeness", "measurement"),
        ("concept_record_completeness", "concept_record_completeness", "measurement"),
        ("table_concept_completeness", "table_concept_completeness", "measurement"),
        ("is_foreign_key", "is_foreign_key", "person"),
        ("fk_class", "fk_class", "measurement"),
        ("is_standard_valid_concept", "is_standard_valid_concept", "measurement"),
        ("plausible_value_low", "plausible_value_low", "person"),
        ("plausible_value_high", "plausible_value_high", "measurement"),
        ("plausible_temporal_after", "plausible_temporal_after_birth", "measurement"),
        ("concept_plausible_unit_concept_ids", "concept_plausible_unit_concept_ids", "measurement"),
        ("concept_plausible_value_low", "concept_plausible_value_low", "measurement"),
        ("concept_plausible_value_high", "concept_plausible_value_high", "measurement"),
    )
}


def long_counts(pairs: dict[str, tuple[str, str]]) -> str:
    """One row per key: check_key, violated rows, denominator."""
    return "\nUNION ALL\n".join(
        f"SELECT '{key}' AS check_key, CAST(({v}) AS BIGINT) AS num_violated_rows, "
        f"CAST(({d}) AS BIGINT) AS num_denominator_rows"
        for key, (v, d) in pairs.items()
    )


def labelled(field: str, rows: str) -> str:
    return statement(f"SELECT '{field}' AS violating_field, {rows}")


VIOLATED_ROWS = {
    "is_required": labelled(
        "person.gender_concept_id", "t.* FROM person t WHERE gender_concept_id IS NULL"
    ),
    "cdm_datatype": labelled(
        "measurement.provider_text", f"t.* FROM measurement t WHERE {NOT_NUMERIC}"
    ),
    "measure_value_completeness": labelled(
        "measurement.value_as_number", "t.* FROM measurement t WHERE value_as_number IS NULL"
    ),
    "concept_record_completeness": labelled(
        "measurement.unit_concept_id",
        "t.* FROM measurement t WHERE unit_concept_id = 0 AND value_as_number IS NOT NULL",
    ),
    "tagged": statement(
        "\nUNION ALL\n".join(
            f"SELECT '{check}' AS violated_check, t.* FROM measurement t {condition}"
            for check, condition in {
                "filled": "WHERE value_as_number IS NULL",
                "numeric": f"WHERE {NOT_NUMERIC}",
                "mapped": "WHERE measurement_concept_id = 0",
                "unit_mapped": "WHERE unit_concept_id = 0 AND value_as_number IS NOT NULL",
                "any_mapped": f"WHERE {BOTH_UNMAPPED}",
                "not_early": "WHERE measurement_date < DATE '1996-01-01'",
                "not_high": "WHERE value_as_number > 45",
                "known": "WHERE measurement_concept_id IS NOT NULL AND NOT EXISTS "
                "(SELECT 1 FROM concept co WHERE co.concept_id = t.measurement_concept_id)",
                "domain": "JOIN concept co ON t.measurement_concept_id = co.concept_id "
                "WHERE co.concept_id <> 0 AND co.domain_id NOT IN ('PROMO')",
                "source_class": "JOIN concept co ON t.measurement_source_concept_id = co.concept_id "
                "WHERE co.concept_id <> 0 AND co.concept_class_id <> 'Brand#12'",
            }.items()
        )
    ),
    "cohort_is_required": labelled(
        "measurement.value_as_number", f"t.* FROM ({MEMBERS['measurement']}) t WHERE value_as_number IS NULL"
    ),
    "cohort_fk_domain": labelled(
        "measurement.measurement_concept_id",
        f"t.* FROM ({MEMBERS['measurement']}) t JOIN concept co ON t.measurement_concept_id = co.concept_id "
        "WHERE co.concept_id <> 0 AND co.domain_id NOT IN ('PROMO')",
    ),
    "table_concept_completeness": statement(f"SELECT * FROM measurement WHERE {BOTH_UNMAPPED}"),
    "plausible_value_low": labelled(
        "measurement.measurement_date",
        "t.* FROM measurement t WHERE measurement_date < DATE '1996-01-01'",
    ),
    "plausible_value_high": labelled(
        "measurement.value_as_number", "t.* FROM measurement t WHERE value_as_number > 45"
    ),
    "is_primary_key": labelled(
        "measurement.measurement_id", f"t.* FROM measurement t WHERE {REPEATED}"
    ),
    "source_value_completeness": statement(
        "SELECT DISTINCT 'condition_occurrence.condition_source_value' AS violating_field, "
        "condition_source_value FROM condition_occurrence WHERE condition_concept_id = 0"
    ),
    "is_foreign_key": labelled("person.location_id", f"t.* FROM person t WHERE {NO_LOCATION}"),
    "fk_domain": labelled(
        "measurement.measurement_concept_id",
        f"t.* FROM {BY_CONCEPT} WHERE co.concept_id <> 0 AND co.domain_id <> 'PROMO'",
    ),
    "fk_class": labelled(
        "measurement.measurement_concept_id",
        f"t.* FROM {BY_CONCEPT} WHERE co.concept_id <> 0 AND co.concept_class_id <> 'Brand#12'",
    ),
    "is_standard_valid_concept": labelled(
        "measurement.measurement_concept_id",
        f"t.* FROM {BY_CONCEPT} WHERE co.concept_id <> 0 AND {NOT_VALID}",
    ),
    "person_completeness": statement(f"SELECT t.* FROM person t WHERE {NO_ERA}"),
    "plausible_temporal_after": labelled(
        "measurement.measurement_date",
        f"t.* FROM {BY_PERSON} WHERE {BIRTH} > t.measurement_date",
    ),
    "plausible_during_life": labelled(
        "measurement.measurement_date", f"t.* FROM {BY_DEATH} WHERE {AFTER_DEATH}"
    ),
    "within_visit_dates": labelled(
        "measurement.measurement_date", f"t.* FROM {BY_VISIT} WHERE {NOT_IN_VISIT}"
    ),
    "concept_plausible_gender": statement(
        f"SELECT t.* FROM {BY_PERSON} WHERE t.measurement_concept_id = 7 "
        "AND p.gender_concept_id <> 8507"
    ),
    "concept_plausible_unit_concept_ids": statement(
        f"SELECT * FROM measurement WHERE {WITH_UNIT} AND unit_concept_id NOT IN (2, 3, 4)"
    ),
    "concept_plausible_value_low": statement(
        f"SELECT * FROM measurement WHERE {MEASURED} AND unit_concept_id = 2 "
        "AND value_as_number < 10"
    ),
    "concept_plausible_value_high": statement(
        f"SELECT * FROM measurement WHERE {MEASURED} AND unit_concept_id = 2 "
        "AND value_as_number > 25"
    ),
}


def _presence() -> dict[str, str]:
    tables = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, CAST(0 AS BIGINT) AS num_violated_rows, "
        f"CAST(1 AS BIGINT) AS num_denominator_rows, COUNT(*) AS num_rows FROM {name}"
        for name in CDM_VIEWS
    )
    fields = " UNION ALL ".join(
        f"SELECT 'PERSON' AS table_name, '{name}' AS field_name, "
        f"CAST(0 AS BIGINT) AS num_violated_rows, CAST(1 AS BIGINT) AS num_denominator_rows, "
        f"COUNT({name}) AS num_values FROM person"
        for name in ("person_id", "year_of_birth", "location_id")
    )
    return {
        "cdm_table": statement(f"{tables} UNION ALL SELECT 'note', 1, 1, NULL"),
        "cdm_field": statement(f"{fields} UNION ALL SELECT 'PERSON', 'no_such_field', 1, 1, NULL"),
    }


def _fused() -> dict[str, str]:
    rules = {
        "filled": "measure_value_completeness",
        "numeric": "cdm_datatype",
        "mapped": "concept_record_completeness",
        "unit_mapped": "concept_record_completeness_unit",
        "any_mapped": "table_concept_completeness",
        "not_early": "plausible_value_low_date",
        "not_late": "plausible_value_high_date",
        "not_high": "plausible_value_high",
    }
    keys = {}
    for name, field in (
        ("standard", "measurement_concept_id"),
        ("source", "measurement_source_concept_id"),
    ):
        joined = f"measurement t JOIN concept co ON t.{field} = co.concept_id"
        unknown = (
            f"t.{field} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM concept co WHERE co.concept_id = t.{field})"
        )
        everything = number("measurement")
        keys |= {
            f"{name}_known": (number("measurement t", unknown), everything),
            f"{name}_domain": (
                number(joined, "co.concept_id <> 0 AND co.domain_id NOT IN ('PROMO', 'ECONOMY')"),
                everything,
            ),
            f"{name}_class": (
                number(joined, "co.concept_id <> 0 AND co.concept_class_id <> 'Brand#12'"),
                everything,
            ),
            f"{name}_valid": (number(joined, f"co.concept_id <> 0 AND {NOT_VALID}"), everything),
        }
    dates = {}
    visits = "visit_occurrence t JOIN {p} ON t.person_id = {k}.person_id"
    for field in ("visit_start_date", "visit_end_date"):
        dates |= {
            f"{field}_birth": (
                number(visits.format(p="person p", k="p"), f"{BIRTH} > t.{field}"),
                number("visit_occurrence"),
            ),
            f"{field}_death": (
                number(
                    visits.format(p="death de", k="de"), f"t.{field} > de.death_date + 60"
                ),
                number("visit_occurrence", "person_id IN (SELECT person_id FROM death)"),
            ),
        }
    return {
        "row_rules_fused": statement(long_counts({k: PAIRS[v] for k, v in rules.items()})),
        "vocabulary_checks_fused": statement(long_counts(keys)),
        "date_checks_fused": statement(long_counts(dates)),
    }


def _concept_batch() -> str:
    per_kind = {
        "gender": (
            "t.measurement_concept_id = k.p_partkey",
            "(SELECT COUNT(*) FROM person p WHERE p.person_id = t.person_id AND "
            "p.gender_concept_id <> CASE WHEN k.p_size % 2 = 0 THEN 8507 ELSE 8532 END)",
        ),
        "units": (
            "t.measurement_concept_id = k.p_partkey AND t.value_as_number IS NOT NULL "
            "AND t.unit_source_value IS NOT NULL",
            "CASE WHEN CASE WHEN k.p_size % 5 = 0 THEN t.unit_concept_id IS NOT NULL "
            "ELSE t.unit_concept_id NOT IN (2, 3, 4) END THEN 1 ELSE 0 END",
        ),
        "low": (
            "t.measurement_concept_id = k.p_partkey AND t.unit_concept_id = k.p_partkey % 10 "
            "AND t.value_as_number IS NOT NULL",
            "CASE WHEN t.value_as_number < k.p_size THEN 1 ELSE 0 END",
        ),
        "high": (
            "t.measurement_concept_id = k.p_partkey AND t.unit_concept_id = k.p_partkey % 10 "
            "AND t.value_as_number IS NOT NULL",
            "CASE WHEN t.value_as_number > k.p_size THEN 1 ELSE 0 END",
        ),
    }
    return statement(
        " UNION ALL ".join(
            f"""SELECT CONCAT('{kind}_', k.p_partkey) AS check_key,
            CAST(COALESCE(SUM(CASE WHEN t.measurement_id IS NOT NULL THEN {violated} END), 0)
                AS BIGINT) AS num_violated_rows,
            COUNT(t.measurement_id) AS num_denominator_rows
            FROM part k LEFT JOIN measurement t ON {applies} GROUP BY k.p_partkey"""
            for kind, (applies, violated) in per_kind.items()
        )
    )


HISTORY = f"""SELECT run_id, result_id, check_level, check_name, cdm_table_name, cdm_field_name,
    concept_id, unit_concept_id, category, NULLIF(TRIM(subcategory), '') AS subcategory,
    num_violated_rows, {PCT.format(v='num_violated_rows', d='num_denominator_rows')}
        AS pct_violated_rows,
    num_denominator_rows, NULLIF(TRIM(error), '') AS error, threshold_value, notes_value,
    check_description FROM check_history"""


def cascade(source: str) -> dict[str, str]:
    """From stored results to verdicts, one step at a time, as common table expressions."""
    table = "run_id, cdm_table_name"
    field = f"{table}, cdm_field_name"

    def step(before: str, keys: str, name: str, found: str, flag: str, where: str) -> str:
        names = keys.split(", ")
        same = " AND ".join(f"r.{key} = m.{key}" for key in names)
        return f"""SELECT r.*, CASE WHEN m.{names[1]} IS NOT NULL AND r.is_error = 0
            AND {where} THEN 1 END AS {flag}
            FROM {before} r LEFT JOIN (SELECT DISTINCT {keys} FROM {before} WHERE {found}) m
            ON {same}"""

    nothing = " AND ".join(
        f"{name} IS NULL"
        for name in ("table_is_missing", "field_is_missing", "table_is_empty", "field_is_empty")
    )
    no_concept = (
        f"is_error = 0 AND {nothing} AND check_level = 'CONCEPT' AND num_denominator_rows = 0"
    )
    return {
        "history": source,
        "evaluated": """SELECT h.*, CASE WHEN error IS NOT NULL THEN 1 ELSE 0 END AS is_error,
            CASE WHEN error IS NOT NULL THEN 0
                WHEN threshold_value IS NULL OR threshold_value = 0
                    THEN CASE WHEN num_violated_rows > 0 THEN 1 ELSE 0 END
                WHEN pct_violated_rows * 100 > threshold_value THEN 1 ELSE 0 END AS failed
            FROM history h""",
        "step1": step(
            "evaluated", table, "t", "check_name = 'cdmTable' AND failed = 1",
            "table_is_missing", "r.check_name <> 'cdmTable'",
        ),
        "step2": step(
            "step1", field, "f",
            "check_name = 'cdmField' AND failed = 1 AND table_is_missing IS NULL",
            "field_is_missing", "r.check_name <> 'cdmField'",
        ),
        "step3": step(
            "step2", table, "t",
            "check_name = 'measureValueCompleteness' AND num_denominator_rows = 0 AND "
            "is_error = 0 AND table_is_missing IS NULL AND field_is_missing IS NULL",
            "table_is_empty", "r.check_name NOT IN ('cdmTable', 'cdmField')",
        ),
        "step4": step(
            "step3", field, "f",
            "check_name = 'measureValueCompleteness' AND num_denominator_rows = "
            "num_violated_rows AND table_is_missing IS NULL AND field_is_missing IS NULL AND "
            "table_is_empty IS NULL",
            "field_is_empty",
            "r.check_name NOT IN ('measureValueCompleteness', 'cdmField', 'isRequired')",
        ),
        "flags": f"""SELECT s.*,
            CASE WHEN {no_concept} AND unit_concept_id IS NULL THEN 1 END AS concept_is_missing,
            CASE WHEN {no_concept} AND unit_concept_id IS NOT NULL THEN 1 END
                AS concept_and_unit_are_missing FROM step4 s""",
        "reasoned": """SELECT f.*,
            CASE WHEN table_is_missing = 1 OR field_is_missing = 1 OR table_is_empty = 1
                OR field_is_empty = 1 OR concept_is_missing = 1
                OR concept_and_unit_are_missing = 1 THEN 1 ELSE 0 END AS not_applicable,
            CASE WHEN table_is_missing = 1
                    THEN 'Table ' || cdm_table_name || ' does not exist.'
                WHEN field_is_missing = 1
                    THEN 'Field ' || cdm_table_name || '.' || cdm_field_name || ' does not exist.'
                WHEN table_is_empty = 1 THEN 'Table ' || cdm_table_name || ' is empty.'
                WHEN field_is_empty = 1
                    THEN 'Field ' || cdm_table_name || '.' || cdm_field_name
                        || ' is not populated.'
                WHEN concept_is_missing = 1 THEN cdm_field_name || '=' || concept_id
                    || ' is missing from the ' || cdm_table_name || ' table.'
                WHEN concept_and_unit_are_missing = 1
                    THEN 'Combination of ' || cdm_field_name || '=' || concept_id
                        || ', UNIT_CONCEPT_ID=' || unit_concept_id
                        || ' and VALUE_AS_NUMBER IS NOT NULL is missing from the '
                        || cdm_table_name || ' table.' END AS not_applicable_reason
            FROM flags f""",
        "verdicts": """SELECT r.* EXCLUDE (failed),
            CASE WHEN not_applicable = 1 THEN 0 ELSE failed END AS failed,
            CASE WHEN failed = 0 AND is_error = 0 AND not_applicable = 0 THEN 1 ELSE 0 END
                AS passed
            FROM reasoned r""",
        "shown": """SELECT v.*, CASE WHEN is_error = 1 THEN 'ERROR'
            WHEN not_applicable = 1 THEN 'NOT APPLICABLE' WHEN failed = 1 THEN 'FAIL'
            ELSE 'PASS' END AS status FROM verdicts v""",
    }


def counters() -> str:
    lines = [
        "COUNT(*) AS countTotal",
        "COUNT(CASE WHEN failed = 1 AND error IS NULL THEN 1 END) AS countThresholdFailed",
        "COUNT(error) AS countErrorFailed",
        "COUNT(CASE WHEN failed = 1 THEN 1 END) AS countOverallFailed",
        "COUNT(*) - COUNT(CASE WHEN failed = 1 THEN 1 END) AS countPassed",
    ]
    for prefix, extra in (("Total", ""), ("Failed", "AND failed = 1"), ("Passed", "AND passed = 1")):
        for category in ("Plausibility", "Conformance", "Completeness"):
            lines.append(
                f"COUNT(CASE WHEN category = '{category}' {extra} THEN 1 END) "
                f"AS count{prefix}{category}"
            )
    return ", ".join(lines)


REPORT_COLUMNS = """result_id, status, cdm_table_name AS "table",
    COALESCE(NULLIF(cdm_field_name, ''), 'None') AS field, check_name AS "check", category,
    COALESCE(NULLIF(subcategory, ''), 'None') AS subcategory, check_level AS level,
    CASE WHEN notes_value IS NULL THEN 'None' ELSE 'Exists' END AS notes,
    check_description || CASE WHEN threshold_value IS NULL THEN ''
        ELSE ' (Threshold=' || regexp_replace(CAST(threshold_value AS VARCHAR), '\\.0$', '')
            || '%).' END AS description,
    CASE WHEN COALESCE(pct_violated_rows, 0) = 0 THEN '0%'
        ELSE printf('%.2f', pct_violated_rows * 100) || '%' END AS percent_records"""


def _results() -> dict[str, str]:
    steps = cascade(HISTORY)

    def over(sql: str) -> str:
        return statement(sql, **steps)

    ids = "run_id, result_id"
    stored = """run_id, CAST(result_id AS VARCHAR) AS checkid, check_level, check_name,
        cdm_table_name, cdm_field_name, concept_id, unit_concept_id, category, subcategory,
        num_violated_rows, pct_violated_rows, num_denominator_rows, error, is_error,
        not_applicable, failed, passed, not_applicable_reason, threshold_value, notes_value"""
    level = stored.replace(" concept_id, unit_concept_id,", "").replace(" error,", "")
    return {
        "threshold_eval": over(f"SELECT {ids}, is_error, failed FROM evaluated"),
        **{
            name: over(f"SELECT {ids}, {name} FROM flags")
            for name in (
                "table_is_missing", "field_is_missing", "table_is_empty", "field_is_empty",
                "concept_is_missing", "concept_and_unit_are_missing",
            )
        },
        "not_applicable": over(f"SELECT {ids}, not_applicable FROM reasoned"),
        "not_applicable_reason": over(f"SELECT {ids}, not_applicable_reason FROM reasoned"),
        "final_status": over(
            f"SELECT {ids}, is_error, not_applicable, failed, passed FROM verdicts"
        ),
        "overview": over(f"SELECT run_id, {counters()} FROM verdicts GROUP BY run_id"),
        "status_column": over(f"SELECT {ids}, status FROM shown"),
        "report_view": over(f"SELECT {REPORT_COLUMNS} FROM shown"),
        "report_view_page": over(
            f"""SELECT {REPORT_COLUMNS} FROM shown WHERE check_level = 'FIELD'
            AND status = 'FAIL' ORDER BY COALESCE(pct_violated_rows, 0) DESC, result_id
            LIMIT 10 OFFSET 10"""
        ),
        "report_view_stored_page": over(
            f"""SELECT {REPORT_COLUMNS} FROM shown ORDER BY COALESCE(pct_violated_rows, 0) DESC, result_id
            LIMIT 10 OFFSET 990"""
        ),
        "report_filter_values": over(
            "SELECT DISTINCT COALESCE(NULLIF(subcategory, ''), 'None') AS subcategory FROM shown"
        ),
        "write_results_csv": over(f"SELECT {stored} FROM verdicts"),
        "write_results_table": over(f"SELECT {stored} FROM verdicts"),
        "write_results_level_table": over(
            f"SELECT {level} FROM verdicts WHERE check_level = 'FIELD'"
        ),
        "write_report_json": over(
            """SELECT v.run_id, o.count_total, o.count_failed,
            CAST(v.result_id AS VARCHAR) AS checkid, v.failed, v.pct_violated_rows,
            v.not_applicable_reason
            FROM verdicts v JOIN (SELECT run_id, COUNT(*) AS count_total,
                COUNT(CASE WHEN failed = 1 THEN 1 END) AS count_failed
                FROM verdicts GROUP BY run_id) o ON v.run_id = o.run_id"""
        ),
        "write_reports": over(
            """SELECT v.run_id, o.count_total, o.count_failed,
            CAST(v.result_id AS VARCHAR) AS checkid, v.failed, v.pct_violated_rows,
            v.not_applicable_reason
            FROM verdicts v JOIN (SELECT run_id, COUNT(*) AS count_total,
                COUNT(CASE WHEN failed = 1 THEN 1 END) AS count_failed
                FROM verdicts GROUP BY run_id) o ON v.run_id = o.run_id"""
        ),
        "blank_to_null": statement(
            """SELECT result_id, NULLIF(TRIM(subcategory), '') AS subcategory,
            NULLIF(TRIM(error), '') AS error, NULLIF(TRIM(notes_value), '') AS notes_value
            FROM check_history"""
        ),
    }


def _control() -> dict[str, str]:
    columns = (
        "cdmTableName", "cdmFieldName", "cdmDatatype", "isForeignKey", "fkDomain", "fkClass",
        "fkDomainThreshold", "fkDomainNotes", "plausibleValueLow",
    )
    filled = ", ".join(f"NULLIF(TRIM({c}), '') AS {c}" for c in columns)
    vocabulary = (
        "'CONCEPT', 'VOCABULARY', 'CONCEPT_ANCESTOR', 'CONCEPT_RELATIONSHIP', 'CONCEPT_CLASS', "
        "'CONCEPT_SYNONYM', 'RELATIONSHIP', 'DOMAIN'"
    )
    chosen = " UNION ALL ".join(
        f"""SELECT 'FIELD' AS check_level, '{name}' AS check_name,
        cdmTableName AS cdm_table_name, cdmFieldName AS cdm_field_name,
        {threshold} AS threshold_value, {notes} AS notes_value, 'Conformance' AS category
        FROM field_control WHERE isForeignKey = 'Yes' AND {name} <> ''"""
        for name, threshold, notes in (
            ("fkDomain", "TRY_CAST(NULLIF(fkDomainThreshold, '') AS DOUBLE)", "fkDomainNotes"),
            ("fkClass", "CAST(NULL AS DOUBLE)", "CAST(NULL AS VARCHAR)"),
        )
    )
    everything = "SELECT * FROM field_control"
    return {
        "read_control": statement(f"SELECT {filled} FROM field_control"),
        "select_tables_include": statement(
            f"{everything} WHERE cdmTableName IN ('PERSON', 'CONCEPT')"
        ),
        "select_tables_exclude": statement(
            f"{everything} WHERE cdmTableName NOT IN ({vocabulary})"
        ),
        "drop_offset_field": statement(f"{everything} WHERE cdmFieldName <> 'offset'"),
        "evaluation_filter": statement(
            f"{everything} WHERE isForeignKey = 'Yes' AND fkDomain <> ''"
        ),
        "select_checks": statement(chosen),
        "check_id": statement(
            """SELECT lower(concat_ws('_', 'FIELD', 'fkDomain', NULLIF(cdmTableName, ''),
            NULLIF(cdmFieldName, ''), NULLIF(replace(fkDomain, ' ', ''), ''),
            NULLIF(replace(fkClass, ' ', ''), ''))) AS checkid, cdmFieldName AS field
            FROM field_control"""
        ),
        "render_description": statement(
            """SELECT cdmFieldName AS field, 'Rows of ' || cdmTableName || '.' || cdmFieldName
            || ' outside ' || COALESCE(fkDomain, '') || ' (), ' || COALESCE(fkClass, '') || '.'
            AS text FROM field_control"""
        ),
        "threshold_lookup": statement(
            f"""SELECT r.check_name, r.cdmTableName AS cdm_table_name,
            r.cdmFieldName AS cdm_field_name, k.threshold_value, k.notes_value
            FROM (SELECT CASE WHEN isForeignKey = 'Yes' THEN 'fkDomain' ELSE 'fkClass' END
                AS check_name, cdmTableName, cdmFieldName FROM field_control) r
            LEFT JOIN (SELECT 'fkDomain' AS check_name, cdmTableName, cdmFieldName,
                {_strictest("fkDomain")} FROM field_control
                GROUP BY cdmTableName, cdmFieldName) k
            ON r.check_name = k.check_name AND r.cdmTableName = k.cdmTableName
            AND r.cdmFieldName = k.cdmFieldName"""
        ),
        "threshold_lookup_table": statement(
            f"""SELECT CASE WHEN p_size % 7 = 0 THEN 'cdmTable' ELSE 'measurePersonCompleteness' END
                AS check_name, 'TABLE_' || p_partkey AS cdm_table_name,
            CAST(NULL AS VARCHAR) AS cdm_field_name, threshold_value, notes_value, bad AS error
            FROM part LEFT JOIN (SELECT cdmTableName, {_strictest("measurePersonCompleteness")}
                FROM table_control GROUP BY cdmTableName) k
            ON cdmTableName = 'Table_' || p_partkey AND p_size % 7 <> 0"""
        ),
        "threshold_lookup_concept": statement(
            """SELECT r.result_id, r.concept_id, r.unit_concept_id,
            CASE WHEN e.c IS NOT NULL THEN e.threshold_value WHEN g.c IS NOT NULL THEN g.threshold_value
                WHEN r.unit_concept_id IS NULL THEN w.threshold_value END AS threshold_value,
            CASE WHEN e.c IS NOT NULL THEN e.notes_value WHEN g.c IS NOT NULL THEN g.notes_value
                WHEN r.unit_concept_id IS NULL THEN w.notes_value END AS notes_value,
            coalesce(r.error, CASE WHEN e.c IS NOT NULL THEN e.bad WHEN g.c IS NOT NULL THEN g.bad
                WHEN r.unit_concept_id IS NULL THEN w.bad END) AS error
            FROM (SELECT l_orderkey * 10 + l_linenumber AS result_id, CAST(l_partkey AS VARCHAR) AS concept_id,
                CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_orderkey % 6 AS VARCHAR) END AS unit_concept_id,
                CASE WHEN l_linenumber = 5 THEN 'failed' END AS error FROM lineitem) r
            LEFT JOIN unit_rows e ON e.c = r.concept_id AND e.u = r.unit_concept_id
            LEFT JOIN unit_rows g ON g.c = r.concept_id AND g.u = ''
            LEFT JOIN concept_rows w ON w.c = r.concept_id""",
            unit_rows=f"""SELECT conceptId AS c, unitConceptId AS u, {_strictest("plausibleGender")}
                FROM concept_control GROUP BY conceptId, unitConceptId""",
            concept_rows=f"""SELECT conceptId AS c, {_strictest("plausibleGender")}
                FROM concept_control GROUP BY conceptId""",
        ),
        "record_result": statement(
            f"""SELECT c.v AS num_violated_rows, {PCT.format(v='c.v', d='c.d')}
            AS pct_violated_rows, c.d AS num_denominator_rows, 'fkDomain' AS check_name,
            'FIELD' AS check_level,
            'The number and percent of records that have a value in the ' || k.cdmFieldName
                || ' field in the ' || k.cdmTableName || ' table that do not conform to the '
                || k.fkDomain || ' domain.' AS check_description,
            k.cdmTableName AS cdm_table_name, k.cdmFieldName AS cdm_field_name,
            'Conformance' AS category,
            lower('field_fkdomain_' || k.cdmTableName || '_' || k.cdmFieldName) AS checkid,
            TRY_CAST(NULLIF(k.fkDomainThreshold, '') AS DOUBLE) AS threshold_value,
            k.fkDomainNotes AS notes_value, CAST(NULL AS VARCHAR) AS error
            FROM field_control k LEFT JOIN (SELECT l_partkey, COUNT(*) AS d,
                COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS v
                FROM lineitem GROUP BY l_partkey) c
            ON k.cdmFieldName = 'field_' || c.l_partkey
            WHERE k.isForeignKey = 'Yes' AND k.fkDomain <> '' AND k.cdmFieldName <> 'offset'"""
        ),
    }


def _sources() -> dict[str, str]:
    union = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS num_rows FROM {name}" for name in BASE_TABLES
    )
    empty = ", ".join(
        f"CAST(NULL AS VARCHAR) AS {name}"
        for name in (
            "CDM_SOURCE_ABBREVIATION", "CDM_HOLDER", "SOURCE_DESCRIPTION",
            "SOURCE_DOCUMENTATION_REFERENCE", "CDM_RELEASE_DATE", "CDM_VERSION",
            "VOCABULARY_VERSION",
        )
    )
    return {
        "read_cdm": union,
        "read_cdm_source": f"""SELECT 'orders' AS CDM_SOURCE_NAME, {empty},
            CAST(COUNT(*) AS VARCHAR) AS CDM_ETL_REFERENCE,
            CAST(CAST(MAX(o_orderdate) AS DATE) AS VARCHAR) AS SOURCE_RELEASE_DATE,
            '0.1.0' AS ENGINE_VERSION FROM orders""",
        "union_results": statement(
            long_counts(
                {
                    f"{table}.{field}": (number(table, f"{field} IS NULL"), number(table))
                    for table, field in (
                        ("person", "gender_concept_id"),
                        ("person", "birth_datetime"),
                        ("visit_occurrence", "visit_end_date"),
                        ("measurement", "value_as_number"),
                        ("measurement", "unit_concept_id"),
                    )
                }
            )
        ),
        "pct_ratio": statement(
            f"""SELECT unit_concept_id, v AS num_violated_rows, {PCT.format(v='v', d='d')}
            AS pct_violated_rows, d AS num_denominator_rows FROM (
                SELECT unit_concept_id,
                COUNT(CASE WHEN value_as_number > 45 THEN 1 END) AS v,
                COUNT(CASE WHEN value_as_number IS NOT NULL AND unit_concept_id <> 3
                    THEN 1 END) AS d FROM measurement GROUP BY unit_concept_id) x"""
        ),
    }


# Checks of the whole run: name, level, category, and where its two numbers come from.
RUN_PAIRS = {
    ("isRequired", "PERSON", "gender_concept_id"): PAIRS["is_required"],
    ("measureValueCompleteness", "PERSON", "gender_concept_id"): PAIRS["is_required"],
    ("plausibleValueLow", "PERSON", "year_of_birth"): PAIRS["plausible_value_low"],
    ("isForeignKey", "PERSON", "location_id"): PAIRS["is_foreign_key"],
    ("isPrimaryKey", "MEASUREMENT", "measurement_id"): PAIRS["is_primary_key"],
    ("isForeignKey", "MEASUREMENT", "measurement_concept_id"): (
        number(
            "measurement t",
            "t.measurement_concept_id IS NOT NULL AND NOT EXISTS "
            "(SELECT 1 FROM concept co WHERE co.concept_id = t.measurement_concept_id)",
        ),
        number("measurement"),
    ),
    ("fkDomain", "MEASUREMENT", "measurement_concept_id"): PAIRS["fk_domain"],
    ("fkClass", "MEASUREMENT", "measurement_concept_id"): PAIRS["fk_class"],
    ("isStandardValidConcept", "MEASUREMENT", "measurement_concept_id"): PAIRS[
        "is_standard_valid_concept"
    ],
    ("standardConceptRecordCompleteness", "MEASUREMENT", "measurement_concept_id"): PAIRS[
        "concept_record_completeness"
    ],
    ("plausibleValueLow", "MEASUREMENT", "measurement_date"): PAIRS["plausible_value_low_date"],
    ("plausibleValueHigh", "MEASUREMENT", "measurement_date"): PAIRS["plausible_value_high_date"],
    ("plausibleTemporalAfter", "MEASUREMENT", "measurement_date"): PAIRS[
        "plausible_temporal_after_birth"
    ],
    ("plausibleDuringLife", "MEASUREMENT", "measurement_date"): PAIRS["plausible_during_life"],
    ("withinVisitDates", "MEASUREMENT", "measurement_date"): PAIRS["within_visit_dates"],
    ("measureValueCompleteness", "MEASUREMENT", "value_as_number"): PAIRS[
        "measure_value_completeness"
    ],
    ("plausibleValueHigh", "MEASUREMENT", "value_as_number"): PAIRS["plausible_value_high"],
    ("standardConceptRecordCompleteness", "MEASUREMENT", "unit_concept_id"): PAIRS[
        "concept_record_completeness_unit"
    ],
    ("cdmDatatype", "MEASUREMENT", "provider_text"): PAIRS["cdm_datatype"],
    ("sourceConceptRecordCompleteness", "MEASUREMENT", "measurement_source_concept_id"): (
        number("measurement", "measurement_source_concept_id = 0"),
        number("measurement"),
    ),
    ("sourceValueCompleteness", "MEASUREMENT", "unit_source_value"): (
        "SELECT COUNT(*) FROM (SELECT DISTINCT unit_source_value FROM measurement WHERE unit_concept_id = 0) x",
        SOURCE_VALUES.format(c="unit_source_value", t="measurement"),
    ),
    ("conceptCompleteness", "MEASUREMENT", "measurement_concept_id"): PAIRS["table_concept_completeness"],
    ("plausibleTemporalAfter", "CONDITION_OCCURRENCE", "condition_start_date"): PAIRS[
        "plausible_temporal_after_table"
    ],
    ("plausibleTemporalAfter", "VISIT_OCCURRENCE", "visit_end_date"): PAIRS[
        "plausible_temporal_after_self"
    ],
    ("sourceValueCompleteness", "CONDITION_OCCURRENCE", "condition_source_value"): PAIRS[
        "source_value_completeness"
    ],
}
CATEGORY = {
    "Conformance": (
        "cdmTable", "cdmField", "isRequired", "cdmDatatype", "isPrimaryKey", "isForeignKey",
        "fkDomain", "fkClass", "isStandardValidConcept", "withinVisitDates",
    ),
    "Completeness": (
        "measurePersonCompleteness", "measureConditionEraCompleteness",
        "measureValueCompleteness", "standardConceptRecordCompleteness",
        "sourceConceptRecordCompleteness", "sourceValueCompleteness", "conceptCompleteness",
    ),
    "Plausibility": (
        "plausibleValueLow", "plausibleValueHigh", "plausibleTemporalAfter",
        "plausibleDuringLife", "plausibleGender", "plausibleUnitConceptIds",
    ),
}


def _run(cohort: bool = False) -> dict[str, str]:
    """The whole run; with ``cohort``, checks of fields and concepts are for its members."""
    category = {name: kind for kind, names in CATEGORY.items() for name in names}
    rows = []

    def add(level, name, table, field, concept, unit, threshold, pair) -> None:
        def text(value) -> str:
            return "CAST(NULL AS VARCHAR)" if value is None else f"'{value}'"

        parts = [level, name, table, field, concept, unit]
        ident = "_".join(p for p in parts if p).lower()
        v, d = pair if pair else ("NULL", "NULL")
        if cohort and level != "TABLE" and name not in ("cdmField", "cdmDatatype"):
            v, d = (_in_cohort(sql, table.lower()) if table.lower() in MEMBERS else sql for sql in (v, d))
        rows.append(
            f"""SELECT 1 AS run_id, '{ident}' AS checkid, '{level}' AS check_level,
            '{name}' AS check_name, '{table}' AS cdm_table_name, {text(field)} AS cdm_field_name,
            {text(concept)} AS concept_id, {text(unit)} AS unit_concept_id,
            '{category[name]}' AS category, CAST(({v}) AS BIGINT) AS v, CAST(({d}) AS BIGINT) AS d,
            CAST({'NULL' if threshold is None else threshold} AS DOUBLE) AS threshold_value"""
        )

    def at(level, name, rule, pair) -> None:
        add(
            level, name, rule["cdmTableName"], rule.get("cdmFieldName"), rule.get("conceptId"),
            rule.get("unitConceptId"), rule.get(f"{name}Threshold"), pair,
        )

    present, absent = ("0", "1"), ("1", "1")
    for table in ("PERSON", "VISIT_OCCURRENCE", "CONDITION_OCCURRENCE", "MEASUREMENT", "NOTE",
                  "LOCATION", "CONDITION_ERA"):
        add("TABLE", "cdmTable", table, None, None, None, None,
            absent if table == "NOTE" else present)
        threshold = dict(TABLES)[table]
        if threshold is not None:
            without = (
                f"NOT EXISTS (SELECT 1 FROM {table.lower()} e WHERE e.person_id = t.person_id)"
            )
            pair = (number("person t", without), number("person"))
            add("TABLE", "measurePersonCompleteness", table, None, None, None, threshold,
                None if table == "NOTE" else pair)
    add("TABLE", "measureConditionEraCompleteness", "CONDITION_ERA", None, None, None, 0,
        PAIRS["condition_era_completeness"])
    for rule in FIELD_RULES:
        table, field = rule["cdmTableName"], rule["cdmFieldName"]
        if table == "NOTE":
            at("FIELD", "cdmField", rule, None)
        else:
            at("FIELD", "cdmField", rule, absent if field == "no_such_field" else present)
        if table == "NOTE" or field == "no_such_field":
            at("FIELD", "isRequired", rule, None)
        for (name, *where), pair in RUN_PAIRS.items():
            if where == [table, field]:
                at("FIELD", name, rule, pair)
    for rule in (CONCEPT_FIELD | rule for rule in CONCEPT_RULES):
        here = f"measurement_concept_id = {rule['conceptId']}"
        in_unit = f"{here} AND unit_concept_id = {rule.get('unitConceptId')}"
        measured = f"{here} AND value_as_number IS NOT NULL AND unit_source_value IS NOT NULL"
        if "plausibleGender" in rule:
            expected = 8507 if rule["plausibleGender"] == "Male" else 8532
            at("CONCEPT", "plausibleGender", rule, (
                number(BY_PERSON, f"t.{here} AND p.gender_concept_id <> {expected}"),
                number("measurement", here),
            ))
        if "plausibleUnitConceptIdsThreshold" in rule:
            units = rule["plausibleUnitConceptIds"]
            wrong = "IS NOT NULL" if units == "NA" else f"NOT IN ({units})"
            at("CONCEPT", "plausibleUnitConceptIds", rule, (
                number("measurement", f"{measured} AND unit_concept_id {wrong}"),
                number("measurement", measured),
            ))
        for name, sign in (("plausibleValueLow", "<"), ("plausibleValueHigh", ">")):
            if name in rule:
                at("CONCEPT", name, rule, (
                    number("measurement", f"{in_unit} AND value_as_number {sign} {rule[name]}"),
                    number("measurement", f"{in_unit} AND value_as_number IS NOT NULL"),
                ))
    source = f"""SELECT c.* EXCLUDE (v, d), v AS num_violated_rows,
        {PCT.format(v='v', d='d')} AS pct_violated_rows, d AS num_denominator_rows,
        CAST(NULL AS VARCHAR) AS error FROM counted c"""
    steps = {"counted": "\nUNION ALL\n".join(rows), **cascade(source)}
    return {
        "run_checks_cohort" if cohort else "run_checks": statement(
            """SELECT checkid, check_level, check_name, cdm_table_name, cdm_field_name,
            concept_id, unit_concept_id, category, num_violated_rows, pct_violated_rows,
            num_denominator_rows, error, threshold_value, is_error, not_applicable, failed,
            passed, not_applicable_reason FROM verdicts""",
            **steps,
        ),
        "run_overview": statement(f"SELECT {counters()} FROM verdicts", **steps),
    }


def oracle_sql() -> dict[str, str]:
    return {
        **_presence(),
        **{name: counts(*pair) for name, pair in (PAIRS | COHORT_PAIRS).items()},
        **_fused(),
        "concept_checks_batch": _concept_batch(),
        **{f"violated_rows_{name}": sql for name, sql in VIOLATED_ROWS.items()},
        **_sources(),
        **_control(),
        **_results(),
        **_run(cohort=True),
        **_run(),
    }
