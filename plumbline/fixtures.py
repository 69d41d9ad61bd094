"""Dirty clinical tables derived from the driver's tables, for tests and registered queries.

Each text is valid in Spark SQL and in DuckDB as it stands, so the same definition feeds both
sides of a comparison. The driver's tables have no NULLs and no broken keys; these views do.
"""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from plumbline.operators.selection import select_tables
from plumbline.sources.cdm import Cdm
from plumbline.sources.control import Controls
from plumbline.sources.standard import (
    standard_descriptions,
    standard_table_control,
    strings_frame,
)

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

VIEWS = {
    "person": """
        SELECT c_custkey AS person_id,
        CASE WHEN c_custkey % 10 = 9 THEN NULL WHEN c_custkey % 2 = 0 THEN 8507 ELSE 8532 END AS
            gender_concept_id,
        CAST(1930 + c_custkey % 80 AS INT) AS year_of_birth,
        CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST('1930-01-15' AS DATE) + CAST((c_custkey
            % 80) * 365 AS INT) END AS birth_datetime,
        CASE WHEN c_custkey % 25 = 0 THEN NULL ELSE c_nationkey END AS location_id
        FROM customer
    """,
    "location": """
        SELECT n_nationkey AS location_id
        FROM nation
        WHERE n_nationkey < 20
    """,
    "visit_occurrence": """
        SELECT o_orderkey AS visit_occurrence_id,
        o_custkey AS person_id,
        CAST(o_orderdate AS DATE) AS visit_start_date,
        CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey
            % 9 - 1 AS INT) END AS visit_end_date
        FROM orders
    """,
    "measurement": """
        SELECT l_orderkey * 10 + l_linenumber AS measurement_id,
        CAST(o_custkey AS BIGINT) AS person_id,
        l_orderkey AS visit_occurrence_id,
        CASE WHEN l_partkey % 20 = 0 THEN 0 WHEN l_partkey % 33 = 0 THEN l_partkey + 1000000
            ELSE l_partkey END AS measurement_concept_id,
        CAST(l_shipdate AS DATE) AS measurement_date,
        CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity END AS value_as_number,
        CASE WHEN l_suppkey % 10 = 1 THEN NULL ELSE l_suppkey % 10 END AS unit_concept_id,
        CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_returnflag = 'A' THEN '' ELSE l_linestatus
            END AS unit_source_value,
        CASE WHEN l_linenumber = 3 THEN 'n/a' WHEN l_linenumber = 4 THEN NULL ELSE
            CAST(l_linenumber AS STRING) END AS provider_text,
        CASE WHEN l_suppkey % 7 = 0 THEN 0 WHEN l_suppkey % 7 = 1 THEN NULL ELSE l_suppkey END
            AS measurement_source_concept_id
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
    """,
    "concept": """
        SELECT p_partkey AS concept_id,
        p_type AS domain_id,
        p_brand AS concept_class_id,
        CASE p_size % 3 WHEN 0 THEN 'S' WHEN 1 THEN NULL ELSE 'C' END AS standard_concept,
        CASE WHEN p_size % 7 = 0 THEN 'D' ELSE NULL END AS invalid_reason
        FROM part
    """,
    "death": """
        SELECT c_custkey AS person_id,
        CAST('1996-06-01' AS DATE) + CAST(c_custkey % 1500 AS INT) AS death_date
        FROM customer
        WHERE c_custkey % 10 = 3
    """,
    "condition_occurrence": """
        SELECT event_id AS condition_occurrence_id,
        CASE WHEN event_id % 50 = 0 THEN NULL ELSE user_id END AS person_id,
        CAST(ts AS DATE) AS condition_start_date,
        CASE WHEN event_id % 100 = 0 THEN 0 WHEN event_type = 'view' THEN 1 WHEN event_type =
            'click' THEN 2 ELSE 3 END AS condition_concept_id,
        CASE WHEN event_id % 13 = 0 THEN NULL ELSE props END AS condition_source_value
        FROM events
    """,
    "condition_era": """
        SELECT user_id AS person_id,
        MIN(CAST(ts AS DATE)) AS condition_era_start_date
        FROM events
        WHERE user_id % 4 <> 0
        GROUP BY user_id
    """,
    "cohort": """
        SELECT 1 AS cohort_definition_id,
        c_custkey AS subject_id
        FROM customer
        WHERE c_mktsegment = 'BUILDING'
        UNION ALL SELECT 1 AS cohort_definition_id,
        c_custkey AS subject_id
        FROM customer
        WHERE c_mktsegment = 'BUILDING' AND c_custkey % 5 < 2
        UNION ALL SELECT 2 AS cohort_definition_id,
        c_custkey AS subject_id
        FROM customer
        WHERE c_mktsegment = 'MACHINERY'
    """,
}

# Stored results of many runs (one run per ten customers) and a field control table, built from rows of
# the driver's tables so that they grow with them.
VIEWS |= {
    "check_history": """
        SELECT CAST(FLOOR(o_custkey / 10) AS BIGINT) AS run_id,
        o_orderkey AS result_id,
        CASE WHEN o_orderkey % 11 < 2 THEN 'TABLE' WHEN o_orderkey % 11 < 9 THEN 'FIELD'
            ELSE 'CONCEPT' END AS check_level,
        CASE o_orderkey % 11 WHEN 0 THEN 'cdmTable' WHEN 1 THEN 'measurePersonCompleteness'
            WHEN 2 THEN 'cdmField' WHEN 3 THEN 'isRequired' WHEN 4 THEN 'measureValueCompleteness'
            WHEN 5 THEN 'isPrimaryKey' WHEN 6 THEN 'fkDomain' WHEN 7 THEN 'plausibleValueLow'
            WHEN 8 THEN 'measureValueCompleteness' WHEN 9 THEN 'plausibleGender'
            ELSE 'plausibleUnitConceptIds' END AS check_name,
        CASE CAST(FLOOR(o_orderkey / 11) AS BIGINT) % 3 WHEN 0 THEN 'PERSON' WHEN 1 THEN 'NOTE'
            ELSE 'MEASUREMENT' END AS cdm_table_name,
        CASE WHEN o_orderkey % 11 >= 2 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'a_concept_id'
            ELSE 'b_value' END END AS cdm_field_name,
        CASE WHEN o_orderkey % 11 >= 9 THEN CAST(o_orderkey % 50 AS STRING) END AS concept_id,
        CASE WHEN o_orderkey % 11 = 10 THEN CAST(o_orderkey % 7 AS STRING)
            END AS unit_concept_id,
        CASE WHEN o_orderkey % 11 IN (1, 3, 4, 8) THEN 'Completeness'
            WHEN o_orderkey % 11 IN (7, 9, 10) THEN 'Plausibility'
            ELSE 'Conformance' END AS category,
        CASE WHEN o_orderkey % 5 = 0 THEN '  ' WHEN o_orderkey % 5 = 1 THEN NULL
            ELSE 'Relational' END AS subcategory,
        CASE WHEN o_orderkey % 23 = 0 THEN NULL
            WHEN o_orderkey % 11 IN (0, 2) THEN CASE WHEN o_orderkey % 4 = 1 THEN 1 ELSE 0 END
            WHEN o_orderkey % 7 = 0 THEN CAST(FLOOR(o_totalprice) AS BIGINT) % 5 * 25
            ELSE o_orderkey % (CAST(FLOOR(o_totalprice) AS BIGINT) % 5 * 25 + 1)
            END AS num_violated_rows,
        CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 11 IN (0, 2) THEN 1
            ELSE CAST(FLOOR(o_totalprice) AS BIGINT) % 5 * 25 END AS num_denominator_rows,
        CASE WHEN o_orderkey % 23 = 0 THEN 'failed to run' WHEN o_orderkey % 23 = 1 THEN ' '
            END AS error,
        CASE WHEN o_orderkey % 11 IN (0, 2) THEN NULL WHEN o_orderkey % 3 = 0 THEN NULL
            WHEN o_orderkey % 3 = 1 THEN 0.0 ELSE CAST(o_orderkey % 80 AS DOUBLE) / 2
            END AS threshold_value,
        CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END AS notes_value,
        'Rows of the table that break the rule' AS check_description
        FROM orders
    """,
    "field_control": """
        SELECT CASE p_partkey % 5 WHEN 0 THEN 'PERSON' WHEN 1 THEN 'MEASUREMENT'
            WHEN 2 THEN 'CONCEPT' WHEN 3 THEN 'VISIT_OCCURRENCE' ELSE 'VOCABULARY'
            END AS cdmTableName,
        CASE WHEN p_partkey % 17 = 0 THEN 'offset'
            ELSE CONCAT('field_', CAST(p_partkey AS STRING)) END AS cdmFieldName,
        CASE WHEN p_partkey % 3 = 0 THEN 'integer' ELSE 'varchar(50)' END AS cdmDatatype,
        CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END AS isForeignKey,
        CASE WHEN p_size % 4 = 0 THEN p_type WHEN p_size % 4 = 1 THEN '' END AS fkDomain,
        CASE WHEN p_size % 3 = 0 THEN p_brand ELSE '' END AS fkClass,
        CASE WHEN p_size % 5 = 0 THEN '' ELSE CAST(p_size AS STRING) END AS fkDomainThreshold,
        CASE WHEN p_size % 6 = 0 THEN p_name END AS fkDomainNotes,
        CASE WHEN p_size % 7 = 0 THEN CAST(p_retailprice AS STRING) ELSE '' END AS plausibleValueLow
        FROM part
    """,
    "table_control": """
        SELECT CONCAT('Table_', CAST(CASE WHEN p_partkey % 10 = 0 THEN p_partkey - 1
            ELSE p_partkey END AS STRING)) AS cdmTableName,
        CASE WHEN p_size % 5 = 0 THEN '' WHEN p_size % 5 = 1 THEN CONCAT(CAST(p_size AS STRING), '%')
            ELSE CAST(p_size AS STRING) END AS measurePersonCompletenessThreshold,
        CASE WHEN p_size % 6 = 0 THEN p_name END AS measurePersonCompletenessNotes
        FROM part
    """,
    "concept_control": """
        SELECT 'MEASUREMENT' AS cdmTableName,
        'measurement_concept_id' AS cdmFieldName,
        CAST(l_partkey AS STRING) AS conceptId,
        CASE WHEN l_linenumber % 3 = 0 THEN '' ELSE CAST(l_suppkey % 4 AS STRING) END AS unitConceptId,
        CASE WHEN CAST(l_quantity AS INT) % 10 = 0 THEN '' WHEN CAST(l_quantity AS INT) = 13 THEN '13%'
            ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS plausibleGenderThreshold,
        CASE WHEN l_linenumber = 2 THEN l_linestatus END AS plausibleGenderNotes
        FROM lineitem
        WHERE l_partkey % 4 <> 0
    """,
}


def base_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def view(
    spark: SparkSession, folder: str, name: str, tables: dict[str, DataFrame] | None = None
) -> DataFrame:
    """One view as a DataFrame; ``tables`` keeps the driver's tables that were opened already."""
    sql, tables = VIEWS[name], {} if tables is None else tables
    used = re.findall(r"(?:FROM|JOIN) (\w+)", sql)
    for table in used:
        if table not in tables:
            tables[table] = base_table(spark, folder, table)
    sql = re.sub(r"(FROM|JOIN) (\w+)", r"\1 {\2} AS \2", sql)
    return spark.sql(sql, **{table: tables[table] for table in used})


CDM_VIEWS = (
    "person", "location", "visit_occurrence", "measurement", "concept", "death",
    "condition_occurrence", "condition_era",
)


def fixture_cdm(spark: SparkSession, folder: str) -> Cdm:
    tables: dict[str, DataFrame] = {}
    return Cdm({name: partial(view, spark, folder, name, tables) for name in CDM_VIEWS})


def with_views(sql: str, *names: str) -> str:
    """The statement with the named views in front of it as common table expressions."""
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in names)
    return f"WITH {ctes}\n{sql}" if names else sql


# Control tables for the views. NOTE and PERSON.no_such_field do not exist, to show what a run
# says about missing tables and fields.
FIELD_RULES = (
    {"cdmTableName": "PERSON", "cdmFieldName": "gender_concept_id", "isRequired": "Yes",
     "isRequiredThreshold": "0", "measureValueCompleteness": "Yes",
     "measureValueCompletenessThreshold": "100"},
    {"cdmTableName": "PERSON", "cdmFieldName": "year_of_birth", "plausibleValueLow": "1950",
     "plausibleValueLowThreshold": "1"},
    {"cdmTableName": "PERSON", "cdmFieldName": "location_id", "isForeignKey": "Yes",
     "fkTableName": "LOCATION", "fkFieldName": "LOCATION_ID", "isForeignKeyThreshold": "0"},
    {"cdmTableName": "MEASUREMENT", "cdmFieldName": "measurement_id", "isPrimaryKey": "Yes",
     "isPrimaryKeyThreshold": "0"},
    {"cdmTableName": "MEASUREMENT", "cdmFieldName": "measurement_concept_id",
     "isForeignKey": "Yes", "fkTableName": "CONCEPT", "fkFieldName": "CONCEPT_ID",
     "fkDomain": "PROMO", "fkClass": "Brand#12", "isStandardValidConcept": "Yes",
     "cdmSourceFieldName": "measurement_source_concept_id",
     "standardConceptRecordCompleteness": "Yes",
     "standardConceptRecordCompletenessThreshold": "5"},
    {"cdmTableName": "MEASUREMENT", "cdmFieldName": "measurement_date", "cdmDatatype": "date",
     "plausibleValueLow": "'1996-01-01'", "plausibleValueHigh": "'20010101'",
     "plausibleTemporalAfter": "Yes", "plausibleTemporalAfterTableName": "PERSON",
     "plausibleTemporalAfterFieldName": "BIRTH_DATETIME", "plausibleDuringLife": "Yes",
     "plausibleDuringLifeThreshold": "50", "withinVisitDates": "Yes",
     "withinVisitDatesThreshold": "5", "plausibleTemporalAfterThreshold": "20"},
    {"cdmTableName": "MEASUREMENT", "cdmFieldName": "value_as_number",
     "measureValueCompleteness": "Yes", "measureValueCompletenessThreshold": "10",
     "plausibleValueHigh": "45", "plausibleValueHighThreshold": "10"},
    {"cdmTableName": "MEASUREMENT", "cdmFieldName": "unit_concept_id",
     "standardConceptRecordCompleteness": "Yes"},
    {"cdmTableName": "MEASUREMENT", "cdmFieldName": "provider_text", "cdmDatatype": "integer"},
    {"cdmTableName": "MEASUREMENT", "cdmFieldName": "measurement_source_concept_id",
     "sourceConceptRecordCompleteness": "Yes", "sourceConceptRecordCompletenessThreshold": "20"},
    {"cdmTableName": "MEASUREMENT", "cdmFieldName": "unit_source_value",
     "sourceValueCompleteness": "Yes", "sourceValueCompletenessThreshold": "30",
     "standardConceptFieldName": "UNIT_CONCEPT_ID"},
    {"cdmTableName": "CONDITION_OCCURRENCE", "cdmFieldName": "condition_start_date",
     "plausibleTemporalAfter": "Yes", "plausibleTemporalAfterTableName": "VISIT_OCCURRENCE",
     "plausibleTemporalAfterFieldName": "VISIT_START_DATE", "plausibleTemporalAfterThreshold": "90"},
    {"cdmTableName": "VISIT_OCCURRENCE", "cdmFieldName": "visit_end_date",
     "plausibleTemporalAfter": "Yes", "plausibleTemporalAfterTableName": "VISIT_OCCURRENCE",
     "plausibleTemporalAfterFieldName": "VISIT_START_DATE"},
    {"cdmTableName": "CONDITION_OCCURRENCE", "cdmFieldName": "condition_source_value",
     "sourceValueCompleteness": "Yes", "sourceValueCompletenessThreshold": "10",
     "standardConceptFieldName": "CONDITION_CONCEPT_ID"},
    {"cdmTableName": "NOTE", "cdmFieldName": "note_id", "isRequired": "Yes"},
    {"cdmTableName": "PERSON", "cdmFieldName": "no_such_field", "isRequired": "Yes"},
)
FIELD_COLUMNS = (
    "cdmTableName", "cdmFieldName", "cdmDatatype", "cdmSourceFieldName", "isRequired",
    "isPrimaryKey", "isForeignKey", "fkTableName", "fkFieldName", "fkDomain", "fkClass",
    "isStandardValidConcept", "measureValueCompleteness", "standardConceptRecordCompleteness",
    "sourceConceptRecordCompleteness", "sourceValueCompleteness", "standardConceptFieldName",
    "plausibleValueLow", "plausibleValueHigh", "plausibleTemporalAfter",
    "plausibleTemporalAfterTableName", "plausibleTemporalAfterFieldName", "plausibleDuringLife",
    "withinVisitDates", "runForCohort", "cdmFieldThreshold", "isRequiredThreshold",
    "isPrimaryKeyThreshold", "isForeignKeyThreshold", "measureValueCompletenessThreshold",
    "standardConceptRecordCompletenessThreshold", "sourceConceptRecordCompletenessThreshold",
    "sourceValueCompletenessThreshold",
    "plausibleValueLowThreshold", "plausibleValueHighThreshold",
    "plausibleTemporalAfterThreshold", "plausibleDuringLifeThreshold",
    "withinVisitDatesThreshold",
)
CONCEPT_FIELD = {"cdmTableName": "MEASUREMENT", "cdmFieldName": "measurement_concept_id"}
CONCEPT_RULES = (
    {"conceptId": "7", "conceptName": "seven", "plausibleGender": "Male",
     "plausibleGenderThreshold": "5", "plausibleUnitConceptIds": "2,3,4",
     "plausibleUnitConceptIdsThreshold": "5"},
    {"conceptId": "8", "conceptName": "eight", "plausibleUnitConceptIds": "NA",
     "plausibleUnitConceptIdsThreshold": "5"},
    {"conceptId": "7", "conceptName": "seven", "unitConceptId": "2", "plausibleValueLow": "10",
     "plausibleValueHigh": "25"},
    {"conceptId": "999999", "conceptName": "absent", "plausibleGender": "Female"},
    {"conceptId": "999999", "conceptName": "absent", "unitConceptId": "2",
     "plausibleUnitConceptIds": "2", "plausibleUnitConceptIdsThreshold": "5",
     "plausibleValueLow": "1"},
)
CONCEPT_COLUMNS = (
    "cdmTableName", "cdmFieldName", "conceptId", "conceptName", "unitConceptId",
    "plausibleGender", "plausibleGenderThreshold", "plausibleUnitConceptIds",
    "plausibleUnitConceptIdsThreshold", "plausibleValueLow", "plausibleValueLowThreshold",
    "plausibleValueHigh", "plausibleValueHighThreshold",
)
RUN_TABLES = ("PERSON", "VISIT_OCCURRENCE", "CONDITION_OCCURRENCE", "MEASUREMENT", "NOTE",
              "LOCATION", "CONDITION_ERA")


def fixture_controls(spark: SparkSession, cohort: bool = False) -> Controls:
    """Controls for the views, with the checks that belong to no standard set too. With ``cohort``, all
    field checks that can be are restricted to a cohort."""

    def frame(columns: tuple[str, ...], rules: tuple[dict, ...], **same: str) -> DataFrame:
        rows = [tuple((same | rule).get(name) for name in columns) for rule in rules]
        return strings_frame(spark, list(columns), rows)

    return Controls(
        standard_descriptions(spark, extra=True),
        select_tables(standard_table_control(spark), include=RUN_TABLES),
        frame(FIELD_COLUMNS, FIELD_RULES, runForCohort="Yes" if cohort else None),
        frame(
            CONCEPT_COLUMNS,
            CONCEPT_RULES,
            **CONCEPT_FIELD,
        ),
    )
