"""Checks and table-level control of the OMOP Common Data Model that come with the package.

Field- and concept-level control tables are not included; read them with ``read_control``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

DESCRIPTION_COLUMNS = (
    "checkLevel",
    "checkName",
    "checkDescription",
    "kahnContext",
    "kahnCategory",
    "kahnSubcategory",
    "sqlFile",
    "evaluationFilter",
)

# Level, name, description, context, category, subcategory and filter of each check.
# Names, texts and filters are part of the result format, so they are given word by word.
CHECKS = (
    (
        "TABLE", "cdmTable",
        "A yes or no value indicating if @cdmTableName table is present as expected based on the specification. ",
        "Verification", "Conformance", "Relational", "cdmTableName!=''",
    ),
    (
        "TABLE", "measurePersonCompleteness",
        "The number and percent of persons in the CDM that do not have at least one record in the @cdmTableName table",
        "Validation", "Completeness", None, "measurePersonCompleteness=='Yes'",
    ),
    (
        "TABLE", "measureConditionEraCompleteness",
        "The number and Percent of persons that does not have condition_era built successfully for all persons in condition_occurrence",
        "Validation", "Completeness", None, "measureConditionEraCompleteness=='Yes'",
    ),
    (
        "FIELD", "cdmField",
        "A yes or no value indicating if @cdmFieldName is present in the @cdmTableName table as expected based on the specification. ",
        "Verification", "Conformance", "Relational", "cdmFieldName!=''",
    ),
    (
        "FIELD", "isRequired",
        "The number and percent of records with a NULL value in the @cdmFieldName of the @cdmTableName that is considered not nullable.",
        "Validation", "Conformance", "Relational", "isRequired=='Yes'",
    ),
    (
        "FIELD", "cdmDatatype",
        "A yes or no value indicating if the @cdmFieldName in the @cdmTableName is the expected data type based on the specification.",
        "Verification", "Conformance", "Value", "cdmDatatype=='integer'",
    ),
    (
        "FIELD", "isPrimaryKey",
        "The number and percent of records that have a duplicate value in the @cdmFieldName field of the @cdmTableName.",
        "Verification", "Conformance", "Relational", "isPrimaryKey=='Yes'",
    ),
    (
        "FIELD", "isForeignKey",
        "The number and percent of records that have a value in the @cdmFieldName field in the @cdmTableName table that does not exist in the @fkTableName table.",
        "Verification", "Conformance", "Relational", "isForeignKey=='Yes'",
    ),
    (
        "FIELD", "fkDomain",
        "The number and percent of records that have a value in the @cdmFieldName field in the @cdmTableName table that do not conform to the @fkDomain domain.",
        "Verification", "Conformance", "Value", "isForeignKey=='Yes' & fkDomain!= ''",
    ),
    (
        "FIELD", "fkClass",
        "The number and percent of records that have a value in the @cdmFieldName field in the @cdmTableName table that do not conform to the @fkClass class.",
        "Verification", "Conformance", "Computational", "isForeignKey=='Yes' & fkClass!=''",
    ),
    (
        "FIELD", "isStandardValidConcept",
        "The number and percent of records that do not have a standard, valid concept in the @cdmFieldName field in the @cdmTableName table. ",
        "Verification", "Conformance", "Value", "isStandardValidConcept=='Yes'",
    ),
    (
        "FIELD", "measureValueCompleteness",
        "The number and percent of records with a NULL value in the @cdmFieldName of the @cdmTableName.",
        "Verification", "Completeness", None, "measureValueCompleteness=='Yes'",
    ),
    (
        "FIELD", "standardConceptRecordCompleteness",
        "The number and percent of records with a value of 0 in the standard concept field @cdmFieldName in the @cdmTableName table.",
        "Verification", "Completeness", None, "standardConceptRecordCompleteness=='Yes'",
    ),
    (
        "FIELD", "sourceConceptRecordCompleteness",
        "The number and percent of records with a value of 0 in the source concept field @cdmFieldName in the @cdmTableName table.",
        "Verification", "Completeness", None, "sourceConceptRecordCompleteness=='Yes'",
    ),
    (
        "FIELD", "sourceValueCompleteness",
        "The number and percent of distinct source values in the @cdmFieldName field of the @cdmTableName table mapped to 0.",
        "Verification", "Completeness", None, "sourceValueCompleteness=='Yes'",
    ),
    (
        "FIELD", "plausibleValueLow",
        "The number and percent of records with a value in the @cdmFieldName field of the @cdmTableName table less than @plausibleValueLow.",
        "Verification", "Plausibility", "Atemporal", "plausibleValueLow!=''",
    ),
    (
        "FIELD", "plausibleValueHigh",
        "The number and percent of records with a value in the @cdmFieldName field of the @cdmTableName table greater than @plausibleValueHigh.",
        "Verification", "Plausibility", "Atemporal", "plausibleValueHigh!=''",
    ),
    (
        "FIELD", "plausibleTemporalAfter",
        "The number and percent of records with a value in the @cdmFieldName field of the @cdmTableName that occurs prior to the date in the @plausibleTemporalAfterFieldName field of the @plausibleTemporalAfterTableName table.",
        "Verification", "Plausibility", "Temporal", "plausibleTemporalAfter=='Yes'",
    ),
    (
        "FIELD", "plausibleDuringLife",
        "If yes, the number and percent of records with a date value in the @cdmFieldName field of the @cdmTableName table that occurs after death.",
        "Verification", "Plausibility", "Temporal", "plausibleDuringLife=='Yes'",
    ),
    (
        "FIELD", "withinVisitDates",
        "The number and percent of records not within one week on either side of the corresponding visit occurrence start and end date",
        "Verification", "Conformance", None, "withinVisitDates=='Yes'",
    ),
    (
        "CONCEPT", "plausibleGender",
        "For a CONCEPT_ID @conceptId (@conceptName), the number and percent of records associated with patients with an implausible gender (correct gender = @plausibleGender).",
        "Validation", "Plausibility", "Atemporal", "plausibleGender!=''",
    ),
    (
        "CONCEPT", "plausibleUnitConceptIds",
        "The number and percent of records for a given CONCEPT_ID @conceptId (@conceptName) with implausible units (i.e., UNIT_CONCEPT_ID NOT IN  (@plausibleUnitConceptIds)).",
        "Verification", "Plausibility", "Atemporal", "plausibleUnitConceptIdsThreshold!=''",
    ),
)

# Checks that exist as operators but belong to no standard set; ``extra=True`` adds them.
EXTRA_CHECKS = (
    (
        "FIELD", "conceptCompleteness",
        "The number and percent of records with neither a standard nor a source concept in @cdmFieldName and @cdmSourceFieldName of the @cdmTableName table.",
        "Verification", "Completeness", None, "cdmSourceFieldName!=''",
    ),
    (
        "CONCEPT", "plausibleValueLow",
        "For the combination of CONCEPT_ID @conceptId (@conceptName) and UNIT_CONCEPT_ID @unitConceptId, the number and percent of records that have a value less than @plausibleValueLow.",
        "Verification", "Plausibility", "Atemporal", "plausibleValueLow!=''",
    ),
    (
        "CONCEPT", "plausibleValueHigh",
        "For the combination of CONCEPT_ID @conceptId (@conceptName) and UNIT_CONCEPT_ID @unitConceptId, the number and percent of records that have a value higher than @plausibleValueHigh.",
        "Verification", "Plausibility", "Atemporal", "plausibleValueHigh!=''",
    ),
)

# Tables of the model (version 5.3) and the threshold in percent of
# measurePersonCompleteness, None where the check is off. VISIT_DETAIL is not in version 5.2.
TABLES = (
    ("PERSON", None),
    ("OBSERVATION_PERIOD", "0"),
    ("VISIT_OCCURRENCE", "95"),
    ("CONDITION_OCCURRENCE", "95"),
    ("DRUG_EXPOSURE", "95"),
    ("PROCEDURE_OCCURRENCE", "95"),
    ("DEVICE_EXPOSURE", "100"),
    ("MEASUREMENT", "95"),
    ("VISIT_DETAIL", "100"),
    ("NOTE", "100"),
    ("NOTE_NLP", None),
    ("OBSERVATION", "95"),
    ("SPECIMEN", "100"),
    ("FACT_RELATIONSHIP", None),
    ("LOCATION", None),
    ("CARE_SITE", None),
    ("PROVIDER", None),
    ("PAYER_PLAN_PERIOD", "100"),
    ("COST", None),
    ("DRUG_ERA", "95"),
    ("DOSE_ERA", "100"),
    ("CONDITION_ERA", "95"),
)
ERA_TABLE, ERA_THRESHOLD = "CONDITION_ERA", "0"


def strings_frame(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """Small table of text columns that Spark holds as a constant of the plan."""
    arrays = [pa.array([row[i] for row in rows], pa.string()) for i in range(len(columns))]
    return spark.createDataFrame(pa.table(arrays, names=columns))


def standard_descriptions(spark: SparkSession, extra: bool = False) -> DataFrame:
    """The check descriptions; ``sqlFile`` holds the name of the operator's check."""
    rows = [
        (level, name, text, context, category, subcategory, name, condition)
        for level, name, text, context, category, subcategory, condition in (
            CHECKS + (EXTRA_CHECKS if extra else ())
        )
    ]
    return strings_frame(spark, list(DESCRIPTION_COLUMNS), rows)


def standard_table_control(spark: SparkSession, cdm_version: str = "5.3") -> DataFrame:
    """Table-level control of a version of the data model: 5.2, 5.3 or 5.4."""
    if cdm_version not in ("5.2", "5.3", "5.4"):
        raise ValueError(f"there is no table control for version {cdm_version}")
    rows = [
        (
            table,
            "No" if threshold is None else "Yes",
            threshold,
            None,
            "Yes" if table == ERA_TABLE else "No",
            ERA_THRESHOLD if table == ERA_TABLE else None,
            None,
        )
        for table, threshold in TABLES
        if cdm_version != "5.2" or table != "VISIT_DETAIL"
    ]
    columns = [
        "cdmTableName",
        "measurePersonCompleteness",
        "measurePersonCompletenessThreshold",
        "measurePersonCompletenessNotes",
        "measureConditionEraCompleteness",
        "measureConditionEraCompletenessThreshold",
        "measureConditionEraCompletenessNotes",
    ]
    return strings_frame(spark, columns, rows)
