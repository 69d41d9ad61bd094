"""The list of checks of a run: one row per check description and control row it applies to."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.counting import (
    CHECK_KEY,
    DENOMINATOR,
    PERCENT,
    VIOLATED,
    pct_ratio,
)
from plumbline.functions.text import check_id, render_description
from plumbline.operators.selection import evaluation_filter
from plumbline.sources.control import Controls

# Control columns that parameterise checks.
PARAMETERS = (
    "cdmDatatype",
    "cdmSourceFieldName",
    "fkTableName",
    "fkFieldName",
    "fkDomain",
    "fkClass",
    "standardConceptFieldName",
    "plausibleValueLow",
    "plausibleValueHigh",
    "plausibleTemporalAfterTableName",
    "plausibleTemporalAfterFieldName",
    "plausibleGender",
    "plausibleUnitConceptIds",
    "runForCohort",
)


def union_results(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of several DataFrames as one; columns that one of them lacks are NULL there."""
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part, allowMissingColumns=True)
    return union


def level_checks(descriptions: DataFrame, control: DataFrame, level: str) -> DataFrame | None:
    """The checks of one level: control rows that pass the filter of a description, with the texts
    of the description and the threshold and notes that the control row has for that check."""
    chosen = [
        row.asDict() for row in descriptions.where(F.col("checkLevel") == level).collect()
    ]
    if not chosen:
        return None
    there = {name.lower(): f"`{name}`" for name in control.columns}

    def filled(name: str) -> str:
        found = there.get(name.lower(), "NULL")
        return f"CASE WHEN trim({found}) != '' THEN CAST({found} AS STRING) END"

    parts = [
        evaluation_filter(control, row["evaluationFilter"]).selectExpr(
            "*",
            f"'{row['checkName']}' AS check_name",
            f"try_cast({filled(row['checkName'] + 'Threshold')} AS DOUBLE) AS threshold_value",
            f"{filled(row['checkName'] + 'Threshold')} AS threshold_cell",
            f"{filled(row['checkName'] + 'Notes')} AS notes_value",
        )
        for row in chosen
    ]
    templates = " ".join(row["checkDescription"] or "" for row in chosen)
    mentioned = [
        name for name in dict.fromkeys(re.findall(r"@(\w+)", templates)) if name in control.columns
    ]
    texts = descriptions.where(F.col("checkLevel") == level).drop("checkLevel")
    rows = union_results(parts).join(texts, F.col("check_name") == F.col("checkName"))
    return rows.withColumn(
        "rendered", render_description(F.coalesce("checkDescription", F.lit("")), mentioned)
    ).selectExpr(
        f"'{level}' AS check_level",
        "check_name",
        "rendered AS check_description",
        "cdmTableName AS cdm_table_name",
        f"{filled('cdmFieldName')} AS cdm_field_name",
        f"{filled('conceptId')} AS concept_id",
        f"{filled('unitConceptId')} AS unit_concept_id",
        "sqlFile AS sql_file",
        "kahnCategory AS category",
        "kahnSubcategory AS subcategory",
        "kahnContext AS context",
        "threshold_value",
        "threshold_cell",
        "notes_value",
        *[f"CAST({there.get(p.lower(), 'NULL')} AS STRING) AS {p}" for p in PARAMETERS],
    )


def checks_to_run(controls: Controls) -> DataFrame:
    """All checks of a run with their parameters and thresholds."""
    known = controls.descriptions.select("checkLevel").distinct().collect()
    levels = {row["checkLevel"]: controls.level(row["checkLevel"]) for row in known}
    parts = [level_checks(controls.descriptions, df, level) for level, df in levels.items()]
    ident = ("check_level", "check_name", "cdm_table_name", "cdm_field_name", "concept_id")
    return union_results([part for part in parts if part is not None]).withColumn(
        "checkid", check_id(*[F.col(name) for name in (*ident, "unit_concept_id")])
    )


def record_result(checks: DataFrame, counts: DataFrame) -> DataFrame:
    """Result rows: what is known about each check, with its counts. A check without counts (not
    run, or in error) keeps NULLs."""
    there = set(counts.columns)

    def extra(name: str) -> Column:
        value = F.col(f"count.{name}") if name in there else F.lit(None)
        return value.cast("string").alias(name)

    violated, denominator = F.col(f"count.{VIOLATED}"), F.col(f"count.{DENOMINATOR}")
    return (
        checks.alias("check")
        .join(counts.alias("count"), F.col(f"check.{CHECK_KEY}") == F.col(f"count.{CHECK_KEY}"), "left")
        .select(
            f"check.{CHECK_KEY}",
            violated,
            pct_ratio(violated, denominator).alias(PERCENT),
            denominator,
            extra("execution_time"),
            "check.query_text",
            "check.check_name",
            "check.check_level",
            "check.check_description",
            "check.cdm_table_name",
            "check.cdm_field_name",
            "check.concept_id",
            "check.unit_concept_id",
            "check.sql_file",
            "check.category",
            "check.subcategory",
            "check.context",
            extra("warning"),
            extra("error"),
            "check.checkid",
            "check.threshold_value",
            "check.notes_value",
        )
    )
