"""Every operator as a query: (session, folder of the driver's tables) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.fixtures import (
    BASE_TABLES,
    CDM_VIEWS,
    fixture_cdm,
    fixture_controls,
    view,
)
from plumbline.functions.counting import (
    CHECK_KEY,
    DENOMINATOR,
    PERCENT,
    VIOLATED,
    pct_ratio,
    tally,
)
from plumbline.functions.text import blank_to_null, check_id, render_description
from plumbline.operators import (
    concepts,
    evaluation,
    keyed,
    lookup,
    presence,
    report,
    rowwise,
    selection,
    temporal,
    violations,
)
from plumbline.plans.checks import level_checks, record_result, union_results
from plumbline.plans.runner import run_checks
from plumbline.sources import sinks
from plumbline.sources.cdm import Cdm, Cohort, cdm_from_files, row_counts
from plumbline.sources.control import read_control
from plumbline.sources.standard import standard_descriptions, strings_frame

Query = Callable[[SparkSession, str], DataFrame]

M, MC, MD = "measurement", "measurement_concept_id", "measurement_date"
RUN = ("run_id",)


def output_folder(spark: SparkSession) -> str:
    """A new folder where all executors can write: below the shared folder that the cluster names, or
    else below the warehouse, which they share too."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/plumbline-{uuid.uuid4().hex}"


def on_cdm(count: Callable[[Cdm], DataFrame]) -> Query:
    return lambda spark, folder: count(fixture_cdm(spark, folder))


def with_cohort(count: Callable[[Cdm, Cohort], DataFrame]) -> Query:
    return lambda spark, folder: count(
        fixture_cdm(spark, folder), Cohort(view(spark, folder, "cohort"), 1)
    )


# --- checks -----------------------------------------------------------------------------------

def _expected(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    return strings_frame(spark, ["table_name", "field_name"], pairs)


def cdm_table(spark: SparkSession, folder: str) -> DataFrame:
    """Expected tables, whether they exist, and how many rows can be read from them."""
    cdm = fixture_cdm(spark, folder)
    expected = _expected(spark, [(name, "") for name in (*CDM_VIEWS, "note")])
    found = presence.cdm_table(expected.select("table_name"), cdm)
    return found.join(row_counts(cdm), "table_name", "left")


def cdm_field(spark: SparkSession, folder: str) -> DataFrame:
    """Expected fields of the person table, whether they exist, and how many values they hold."""
    cdm = fixture_cdm(spark, folder)
    fields = ["person_id", "year_of_birth", "location_id"]
    expected = _expected(spark, [("PERSON", name) for name in (*fields, "no_such_field")])
    filled = cdm["person"].agg(*[F.count(name).alias(name) for name in fields])
    values = filled.unpivot([], fields, "field_name", "num_values")
    return presence.cdm_field(expected, cdm).join(values, "field_name", "left")


def conditions_before_visits(cdm: Cdm) -> DataFrame:
    """Conditions dated before a visit of the same person starts: another table by person."""
    return temporal.plausible_temporal_after(
        cdm, "condition_occurrence", "condition_start_date", "visit_occurrence", "visit_start_date"
    )


def all_concepts(spark: SparkSession, folder: str) -> DataFrame:
    """Gender, unit and value checks of every concept at once."""
    part = spark.read.parquet(f"{folder.rstrip('/')}/part.parquet")
    ident = F.col("p_partkey").cast("string")
    rules = {
        concepts.GENDER: {"gender": F.when(F.col("p_size") % 2 == 0, "Male").otherwise("Female")},
        concepts.UNITS: {"units": F.when(F.col("p_size") % 5 == 0, "NA").otherwise("2,3,4")},
        concepts.LOW: {"low": F.col("p_size").cast("double")},
        concepts.HIGH: {"high": F.col("p_size").cast("double")},
    }
    control = union_results(
        [
            part.select(
                F.concat(F.lit(f"{kind}_"), ident).alias(CHECK_KEY),
                F.lit(kind).alias("kind"),
                F.col("p_partkey").alias("concept_id"),
                (F.col("p_partkey") % 10).alias("unit_concept_id"),
                *[
                    cells.get(name, F.lit(None)).cast(kind_type).alias(name)
                    for name, kind_type in (
                        ("gender", "string"),
                        ("units", "string"),
                        ("low", "double"),
                        ("high", "double"),
                    )
                ],
            )
            for kind, cells in rules.items()
        ]
    )
    return concepts.count_concept_checks(fixture_cdm(spark, folder), M, MC, control)


def fused_rules(spark: SparkSession, folder: str) -> DataFrame:
    """All row rules of a table in one scan, as the runner counts them."""
    cdm = fixture_cdm(spark, folder)
    rules = {
        "filled": rowwise.not_null_rule("value_as_number"),
        "numeric": rowwise.numeric_rule(cdm, M, "provider_text"),
        "mapped": rowwise.zero_concept_rule(M, MC),
        "unit_mapped": rowwise.zero_concept_rule(M, "unit_concept_id"),
        "any_mapped": rowwise.both_unmapped_rule(MC, "measurement_source_concept_id"),
        "not_early": rowwise.range_rule(MD, "1996-01-01", "date"),
        "not_late": rowwise.range_rule(MD, "2001-01-01", "date", high=True),
        "not_high": rowwise.range_rule("value_as_number", 45, high=True),
    }
    return rowwise.count_rules(cdm.rows(M), rules)


def tagged(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that break any of ten checks of a table, found in one pass, written by check and read again."""
    cdm = fixture_cdm(spark, folder)
    rules = {
        "filled": rowwise.not_null_rule("value_as_number"),
        "numeric": rowwise.numeric_rule(cdm, M, "provider_text"),
        "mapped": rowwise.zero_concept_rule(M, MC),
        "unit_mapped": rowwise.zero_concept_rule(M, "unit_concept_id"),
        "any_mapped": rowwise.both_unmapped_rule(MC, "measurement_source_concept_id"),
        "not_early": rowwise.range_rule(MD, "1996-01-01", "date"),
        "not_high": rowwise.range_rule("value_as_number", 45, high=True),
    }
    keys = {
        "known": lookup.KeyCheck(MC),
        "domain": lookup.KeyCheck(MC, lookup.domain_rule("PROMO")),
        "source_class": lookup.KeyCheck("measurement_source_concept_id", lookup.class_rule("Brand#12")),
    }
    path = f"{output_folder(spark)}/violated"
    violations.write_tagged_rows(violations.tagged_rows(cdm, M, rules, keys), path)
    stored = spark.read.schema(f"{spark_schema(cdm[M])}, violated_check string").parquet(path)
    return stored.select("violated_check", *cdm[M].columns)


def spark_schema(df: DataFrame) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema)


def fused_keys(spark: SparkSession, folder: str) -> DataFrame:
    """All vocabulary checks of two concept fields of a table in one shuffle."""
    checks = {}
    for name, field in (("standard", MC), ("source", "measurement_source_concept_id")):
        checks |= {
            f"{name}_known": lookup.KeyCheck(field),
            f"{name}_domain": lookup.KeyCheck(field, lookup.domain_rule(["PROMO", "ECONOMY"])),
            f"{name}_class": lookup.KeyCheck(field, lookup.class_rule("Brand#12")),
            f"{name}_valid": lookup.KeyCheck(field, lookup.standard_rule()),
        }
    cdm = fixture_cdm(spark, folder)
    return lookup.count_key_checks(cdm, M, lookup.CONCEPT, lookup.CONCEPT_KEY, checks)


def fused_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Birth and death checks of two date fields of a table in one pass."""
    checks = {}
    for field in ("visit_start_date", "visit_end_date"):
        checks |= {
            f"{field}_birth": temporal.DateCheck(field, "after", "person", "birth_datetime"),
            f"{field}_death": temporal.DateCheck(field, "life"),
        }
    return temporal.count_date_checks(fixture_cdm(spark, folder), "visit_occurrence", checks)


def share_by_unit(spark: SparkSession, folder: str) -> DataFrame:
    """The ratio of all checks, by unit: units without numbers have a denominator of 0."""
    has_value = F.col("value_as_number").isNotNull()
    counts = (
        view(spark, folder, M)
        .groupBy("unit_concept_id")
        .agg(
            tally((F.col("value_as_number") > 45) & has_value).alias(VIOLATED),
            tally(has_value & (F.col("unit_concept_id") != 3)).alias(DENOMINATOR),
        )
    )
    share = pct_ratio(F.col(VIOLATED), F.col(DENOMINATOR)).alias(PERCENT)
    return counts.select("unit_concept_id", VIOLATED, share, DENOMINATOR)


# --- sources and sinks ------------------------------------------------------------------------

def read_cdm(spark: SparkSession, folder: str) -> DataFrame:
    return row_counts(cdm_from_files(spark, folder, [*BASE_TABLES, "no_such_table"]))


def read_control_query(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{output_folder(spark)}/control"
    view(spark, folder, "field_control").write.option("header", True).csv(path)
    return read_control(spark, path)


def read_cdm_source(spark: SparkSession, folder: str) -> DataFrame:
    orders = spark.read.parquet(f"{folder.rstrip('/')}/orders.parquet")
    source = orders.agg(
        F.lit("orders").alias("cdm_source_name"),
        F.max(F.col("o_orderdate").cast("date")).cast("string").alias("source_release_date"),
        F.count(F.lit(1)).cast("string").alias("cdm_etl_reference"),
    )
    return sinks.read_cdm_source(Cdm({"CDM_SOURCE": source}))


def history(spark: SparkSession, folder: str) -> DataFrame:
    """Stored results of many runs, with shares."""
    rows = blank_to_null(view(spark, folder, "check_history"))
    return rows.withColumn(PERCENT, pct_ratio(F.col(VIOLATED), F.col(DENOMINATOR)))


def judged(spark: SparkSession, folder: str) -> DataFrame:
    return evaluation.evaluate(history(spark, folder), RUN).withColumn(
        "checkid", F.col("result_id").cast("string")
    )


RESULT_KEYS = ("run_id", "checkid")
STORED = (
    *RESULT_KEYS, "check_level", "check_name", "cdm_table_name", "cdm_field_name", "concept_id",
    "unit_concept_id", "category", "subcategory", VIOLATED, PERCENT, DENOMINATOR, "error",
    "is_error", "not_applicable", "failed", "passed", "not_applicable_reason", "threshold_value",
    "notes_value",
)


def write_results_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = f"{output_folder(spark)}/results"
    sinks.write_results_csv(judged(spark, folder), path, RUN)
    return sinks.read_results_csv(spark, path, RUN, "run_id bigint").select(*STORED)


def write_results_table(spark: SparkSession, folder: str) -> DataFrame:
    base = output_folder(spark)
    name = f"results_{uuid.uuid4().hex}"
    sinks.write_results_table(judged(spark, folder), name, run=RUN, path=f"{base}/all")
    return spark.table(name).select(*STORED)


def write_results_level_table(spark: SparkSession, folder: str) -> DataFrame:
    base = output_folder(spark)
    name = f"results_{uuid.uuid4().hex}"
    sinks.write_results_table(judged(spark, folder), name, "FIELD", RUN, path=f"{base}/field")
    return spark.table(name).select(
        *[c for c in STORED if c not in sinks.LEVEL_WITHOUT["FIELD"]]
    )


def write_report_json(spark: SparkSession, folder: str) -> DataFrame:
    """Reports of all runs, written as nested documents and read back: one row per check result."""
    path = f"{output_folder(spark)}/report"
    document = sinks.report_document(judged(spark, folder), run=RUN)
    sinks.write_report_json(document, path)
    return report_records(spark.read.schema(document.schema).json(path))


def write_reports(spark: SparkSession, folder: str) -> DataFrame:
    """Reports of all runs, written line by line and read back: one row per check result."""
    path = f"{output_folder(spark)}/reports"
    results = judged(spark, folder)
    schema = sinks.report_document(results.limit(0), run=RUN).schema
    sinks.write_reports(results, path, run=RUN)
    return report_records(spark.read.schema(schema).options(multiLine=True, recursiveFileLookup=True).json(path))


def report_records(reports: DataFrame) -> DataFrame:
    return reports.select(
        "run_id",
        F.col("Overview.countTotal").alias("count_total"),
        F.col("Overview.countOverallFailed").alias("count_failed"),
        F.explode("CheckResults").alias("result"),
    ).select(
        "run_id",
        "count_total",
        "count_failed",
        F.col("result.checkId").alias("checkid"),
        F.col("result.FAILED").alias("failed"),
        F.col("result.PCT_VIOLATED_ROWS").alias(PERCENT),
        F.col("result.NOT_APPLICABLE_REASON").alias("not_applicable_reason"),
    )


# --- selection --------------------------------------------------------------------------------

def on_control(choose: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: choose(view(spark, folder, "field_control"))


def select_checks(spark: SparkSession, folder: str) -> DataFrame:
    """The checks that a choice of two makes of the control table."""
    chosen = selection.select_checks(standard_descriptions(spark), ["fkDomain", "fkClass"])
    checks = level_checks(chosen, view(spark, folder, "field_control"), "FIELD")
    return checks.select(
        "check_level", "check_name", "cdm_table_name", "cdm_field_name", "threshold_value",
        "notes_value", "category",
    )


# --- results ----------------------------------------------------------------------------------

def record_results(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per part, attached to the checks of a control table with one row per part."""
    chosen = selection.select_checks(standard_descriptions(spark), ["fkDomain"])
    control = selection.drop_offset_field(view(spark, folder, "field_control"))
    checks = level_checks(chosen, control, "FIELD").withColumns(
        {
            CHECK_KEY: F.col("cdm_field_name"),
            "query_text": F.lit("fk_domain"),
            "checkid": check_id(
                *map(F.col, ("check_level", "check_name", "cdm_table_name", "cdm_field_name"))
            ),
        }
    )
    lines = spark.read.parquet(f"{folder.rstrip('/')}/lineitem.parquet")
    counts = (
        lines.groupBy("l_partkey")
        .agg(tally(F.col("l_returnflag") == "R").alias(VIOLATED), tally().alias(DENOMINATOR))
        .withColumn(CHECK_KEY, F.concat(F.lit("field_"), F.col("l_partkey").cast("string")))
    )
    return record_result(checks, counts).select(
        VIOLATED, PERCENT, DENOMINATOR, "check_name", "check_level", "check_description",
        "cdm_table_name", "cdm_field_name", "category", "checkid", "threshold_value",
        "notes_value", "error",
    )


def union_of_results(spark: SparkSession, folder: str) -> DataFrame:
    """Counts of the filled values of several tables, one below the other."""
    cdm = fixture_cdm(spark, folder)
    parts = []
    for table, fields in (
        ("person", ("gender_concept_id", "birth_datetime")),
        ("visit_occurrence", ("visit_end_date",)),
        (M, ("value_as_number", "unit_concept_id")),
    ):
        rules = {f"{table}.{field}": rowwise.not_null_rule(field) for field in fields}
        parts.append(rowwise.count_rules(cdm.rows(table), rules))
    return union_results(parts)


def check_ids(spark: SparkSession, folder: str) -> DataFrame:
    parts = (F.lit("FIELD"), F.lit("fk Domain"), F.col("cdmTableName"), F.col("cdmFieldName"))
    control = view(spark, folder, "field_control")
    return control.select(
        check_id(*parts, F.col("fkDomain"), F.col("fkClass")).alias("checkid"),
        F.col("cdmFieldName").alias("field"),
    )


def descriptions(spark: SparkSession, folder: str) -> DataFrame:
    template = F.lit("Rows of @cdmTableName.@cdmFieldName outside @fkDomain (@unknown), @fkClass.")
    names = ["cdmTableName", "cdmFieldName", "fkDomain", "fkClass"]
    control = view(spark, folder, "field_control")
    return control.select(
        F.col("cdmFieldName").alias("field"), render_description(template, names).alias("text")
    )


def blanks(spark: SparkSession, folder: str) -> DataFrame:
    rows = blank_to_null(view(spark, folder, "check_history"))
    return rows.select("result_id", "subcategory", "error", "notes_value")


def stored_page(spark: SparkSession, folder: str) -> DataFrame:
    """The hundredth page of the report of all runs, read from sorted ranges."""
    path = f"{output_folder(spark)}/pages"
    results = evaluation.evaluate(history(spark, folder), RUN)
    report.write_pages(results, path, keep=["result_id"], tie_breakers=["result_id"])
    return report.read_page(spark, path, 99, 10)


THRESHOLD_COLUMNS = ("check_name", "cdm_table_name", "cdm_field_name", "threshold_value", "notes_value", "error")


def thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """Thresholds for stored results; half of the results ask for a check without thresholds."""
    control = view(spark, folder, "field_control")
    results = control.select(
        F.lit("FIELD").alias("check_level"),
        F.when(F.col("isForeignKey") == "Yes", "fkDomain").otherwise("fkClass").alias("check_name"),
        F.col("cdmTableName").alias("cdm_table_name"),
        F.col("cdmFieldName").alias("cdm_field_name"),
        F.lit(None).cast("string").alias("concept_id"),
        F.lit(None).cast("string").alias("unit_concept_id"),
    )
    known = evaluation.control_thresholds(control, "FIELD")
    return evaluation.threshold_lookup(results, known).select(*THRESHOLD_COLUMNS[:-1])


def table_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """Thresholds of table checks: repeated control rows, and cells that hold no number."""
    control = view(spark, folder, "table_control")
    none = F.lit(None).cast("string")
    results = spark.read.parquet(f"{folder.rstrip('/')}/part.parquet").select(
        F.lit("TABLE").alias("check_level"),
        F.when(F.col("p_size") % 7 == 0, "cdmTable").otherwise("measurePersonCompleteness").alias("check_name"),
        F.concat(F.lit("TABLE_"), F.col("p_partkey").cast("string")).alias("cdm_table_name"),
        *[none.alias(name) for name in ("cdm_field_name", "concept_id", "unit_concept_id", "error")],
    )
    known = evaluation.control_thresholds(control, "TABLE")
    return evaluation.threshold_lookup(results, known).select(*THRESHOLD_COLUMNS)


def concept_thresholds(spark: SparkSession, folder: str) -> DataFrame:
    """Thresholds of concept checks with and without a unit, from control rows with and without one."""
    control = view(spark, folder, "concept_control")
    results = spark.read.parquet(f"{folder.rstrip('/')}/lineitem.parquet").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("result_id"),
        F.lit("CONCEPT").alias("check_level"),
        F.lit("plausibleGender").alias("check_name"),
        F.lit("MEASUREMENT").alias("cdm_table_name"),
        F.lit("MEASUREMENT_CONCEPT_ID").alias("cdm_field_name"),
        F.col("l_partkey").cast("string").alias("concept_id"),
        F.when(F.col("l_linenumber") % 2 == 1, (F.col("l_orderkey") % 6).cast("string")).alias("unit_concept_id"),
        F.when(F.col("l_linenumber") == 5, "failed").alias("error"),
    )
    known = evaluation.control_thresholds(control, "CONCEPT")
    return evaluation.threshold_lookup(results, known).select(
        "result_id", "concept_id", "unit_concept_id", *THRESHOLD_COLUMNS[-3:]
    )


def on_history(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: step(history(spark, folder))


def flag(name: str) -> Query:
    return on_history(
        lambda rows: evaluation.absence_flags(evaluation.threshold_eval(rows), RUN).select(
            "run_id", "result_id", name
        )
    )


def flagged(add: Callable[[DataFrame], DataFrame], name: str) -> Query:
    return on_history(
        lambda rows: add(
            evaluation.absence_flags(evaluation.threshold_eval(rows), RUN)
        ).select("run_id", "result_id", name)
    )


RUN_COLUMNS = (
    "checkid", "check_level", "check_name", "cdm_table_name", "cdm_field_name", "concept_id",
    "unit_concept_id", "category", VIOLATED, PERCENT, DENOMINATOR, "error",
    "threshold_value", "is_error", "not_applicable", "failed", "passed", "not_applicable_reason",
)


def run_cdm(spark: SparkSession, folder: str, cohort: Cohort | None = None) -> Cdm:
    """The tables of a whole run: the one that is a join is built once for all its checks."""
    return fixture_cdm(spark, folder).stored([M], output_folder(spark), cohort)


def run_all(spark: SparkSession, folder: str) -> DataFrame:
    """The whole run: select, count, judge."""
    run = run_checks(spark, run_cdm(spark, folder), fixture_controls(spark))
    return run.results.select(*RUN_COLUMNS)


def run_cohort(spark: SparkSession, folder: str) -> DataFrame:
    """The whole run for the members of a cohort."""
    members = Cohort(view(spark, folder, "cohort"), 1)
    run = run_checks(
        spark, run_cdm(spark, folder, members), fixture_controls(spark, cohort=True), cohort=members
    )
    return run.results.select(*RUN_COLUMNS)


def run_overview(spark: SparkSession, folder: str) -> DataFrame:
    run = run_checks(spark, run_cdm(spark, folder), fixture_controls(spark))
    return run.overview()


CHECKS: dict[str, Query] = {
    "cdm_table": cdm_table,
    "cdm_field": cdm_field,
    "person_completeness": on_cdm(lambda c: lookup.person_completeness(c, "condition_era")),
    "condition_era_completeness": on_cdm(lookup.condition_era_completeness),
    "table_concept_completeness": on_cdm(
        lambda c: rowwise.table_concept_completeness(c, M, MC, "measurement_source_concept_id")
    ),
    "is_required": on_cdm(lambda c: rowwise.is_required(c, "person", "gender_concept_id")),
    "cdm_datatype": on_cdm(lambda c: rowwise.cdm_datatype(c, M, "provider_text")),
    "is_primary_key": on_cdm(lambda c: keyed.is_primary_key(c, M, "measurement_id")),
    "is_foreign_key": on_cdm(
        lambda c: lookup.is_foreign_key(c, "person", "location_id", "location", "location_id")
    ),
    "fk_domain": on_cdm(lambda c: lookup.fk_domain(c, M, MC, "PROMO")),
    "fk_class": on_cdm(lambda c: lookup.fk_class(c, M, MC, "Brand#12")),
    "is_standard_valid_concept": on_cdm(lambda c: lookup.is_standard_valid_concept(c, M, MC)),
    "within_visit_dates": on_cdm(lambda c: temporal.within_visit_dates(c, M, MD)),
    "measure_value_completeness": on_cdm(
        lambda c: rowwise.measure_value_completeness(c, M, "value_as_number")
    ),
    "concept_record_completeness": on_cdm(
        lambda c: rowwise.concept_record_completeness(c, M, MC)
    ),
    "concept_record_completeness_unit": on_cdm(
        lambda c: rowwise.concept_record_completeness(c, M, "unit_concept_id")
    ),
    "source_value_completeness": on_cdm(
        lambda c: keyed.source_value_completeness(
            c, "condition_occurrence", "condition_source_value", "condition_concept_id"
        )
    ),
    "plausible_value_low": on_cdm(
        lambda c: rowwise.plausible_value_low(c, "person", "year_of_birth", 1950)
    ),
    "plausible_value_low_date": on_cdm(
        lambda c: rowwise.plausible_value_low(c, M, MD, "'19960101'", "date")
    ),
    "plausible_value_high": on_cdm(
        lambda c: rowwise.plausible_value_high(c, M, "value_as_number", 45)
    ),
    "plausible_value_high_date": on_cdm(
        lambda c: rowwise.plausible_value_high(c, M, MD, "2001-01-01", "date")
    ),
    "plausible_temporal_after_birth": on_cdm(
        lambda c: temporal.plausible_temporal_after(c, M, MD, "person", "birth_datetime")
    ),
    "plausible_temporal_after_self": on_cdm(
        lambda c: temporal.plausible_temporal_after(
            c, "visit_occurrence", "visit_end_date", "visit_occurrence", "visit_start_date"
        )
    ),
    "plausible_temporal_after_table": on_cdm(conditions_before_visits),
    "plausible_during_life": on_cdm(lambda c: temporal.plausible_during_life(c, M, MD)),
    "concept_plausible_gender": on_cdm(
        lambda c: concepts.concept_plausible_gender(c, M, MC, 7, "Male")
    ),
    "concept_plausible_unit_concept_ids": on_cdm(
        lambda c: concepts.concept_plausible_unit_concept_ids(c, M, MC, 7, "2,3,4")
    ),
    "concept_plausible_unit_any": on_cdm(
        lambda c: concepts.concept_plausible_unit_concept_ids(c, M, MC, 7, "NA")
    ),
    "concept_plausible_value_low": on_cdm(
        lambda c: concepts.concept_plausible_value_low(c, M, MC, 7, 2, 10)
    ),
    "concept_plausible_value_high": on_cdm(
        lambda c: concepts.concept_plausible_value_high(c, M, MC, 7, 2, 25)
    ),
    "concept_checks_batch": all_concepts,
    "row_rules_fused": fused_rules,
    "vocabulary_checks_fused": fused_keys,
    "date_checks_fused": fused_dates,
    "pct_ratio": share_by_unit,
}
def filtered_cohort(spark: SparkSession, folder: str) -> DataFrame:
    """A check for a cohort whose members are known to the scan by a Bloom filter."""
    members = Cohort(view(spark, folder, "cohort"), 1, filter_words=4096)
    return rowwise.is_required(fixture_cdm(spark, folder), M, "value_as_number", members)


COHORT: dict[str, Query] = {
    "cohort_filtered_in_the_scan": filtered_cohort,
    "cohort_is_required": with_cohort(
        lambda c, g: rowwise.is_required(c, M, "value_as_number", g)
    ),
    "cohort_is_primary_key": with_cohort(
        lambda c, g: keyed.is_primary_key(c, M, "measurement_id", g)
    ),
    "cohort_source_value_completeness": with_cohort(
        lambda c, g: keyed.source_value_completeness(
            c, "condition_occurrence", "condition_source_value", "condition_concept_id", g
        )
    ),
    "cohort_fk_domain": with_cohort(lambda c, g: lookup.fk_domain(c, M, MC, "PROMO", g)),
    "cohort_person_completeness": with_cohort(
        lambda c, g: lookup.person_completeness(c, "condition_era", cohort=g)
    ),
    "cohort_condition_era_completeness": with_cohort(
        lambda c, g: lookup.condition_era_completeness(c, cohort=g)
    ),
    "cohort_within_visit_dates": with_cohort(
        lambda c, g: temporal.within_visit_dates(c, M, MD, g)
    ),
    "cohort_plausible_during_life": with_cohort(
        lambda c, g: temporal.plausible_during_life(c, M, MD, g)
    ),
    "cohort_concept_plausible_gender": with_cohort(
        lambda c, g: concepts.concept_plausible_gender(c, M, MC, 7, "Male", g)
    ),
    "cohort_measure_value_completeness": with_cohort(
        lambda c, g: rowwise.measure_value_completeness(c, M, "value_as_number", g)
    ),
    "cohort_concept_record_completeness": with_cohort(
        lambda c, g: rowwise.concept_record_completeness(c, M, MC, g)
    ),
    "cohort_table_concept_completeness": with_cohort(
        lambda c, g: rowwise.table_concept_completeness(c, M, MC, "measurement_source_concept_id", g)
    ),
    "cohort_is_foreign_key": with_cohort(
        lambda c, g: lookup.is_foreign_key(c, "person", "location_id", "location", "location_id", g)
    ),
    "cohort_fk_class": with_cohort(lambda c, g: lookup.fk_class(c, M, MC, "Brand#12", g)),
    "cohort_is_standard_valid_concept": with_cohort(
        lambda c, g: lookup.is_standard_valid_concept(c, M, MC, g)
    ),
    "cohort_plausible_value_low": with_cohort(
        lambda c, g: rowwise.plausible_value_low(c, "person", "year_of_birth", 1950, cohort=g)
    ),
    "cohort_plausible_value_high": with_cohort(
        lambda c, g: rowwise.plausible_value_high(c, M, "value_as_number", 45, cohort=g)
    ),
    "cohort_plausible_temporal_after": with_cohort(
        lambda c, g: temporal.plausible_temporal_after(c, M, MD, "person", "birth_datetime", g)
    ),
    "cohort_concept_plausible_unit_concept_ids": with_cohort(
        lambda c, g: concepts.concept_plausible_unit_concept_ids(c, M, MC, 7, "2,3,4", g)
    ),
    "cohort_concept_plausible_value_low": with_cohort(
        lambda c, g: concepts.concept_plausible_value_low(c, M, MC, 7, 2, 10, g)
    ),
    "cohort_concept_plausible_value_high": with_cohort(
        lambda c, g: concepts.concept_plausible_value_high(c, M, MC, 7, 2, 25, g)
    ),
}
ROWS: dict[str, Query] = {
    "violated_rows_tagged": tagged,
    "violated_rows_cohort_is_required": with_cohort(
        lambda c, g: violations.is_required(c, M, "value_as_number", g)
    ),
    "violated_rows_cohort_fk_domain": with_cohort(lambda c, g: violations.fk_domain(c, M, MC, "PROMO", g)),
    "violated_rows_is_required": on_cdm(
        lambda c: violations.is_required(c, "person", "gender_concept_id")
    ),
    "violated_rows_cdm_datatype": on_cdm(lambda c: violations.cdm_datatype(c, M, "provider_text")),
    "violated_rows_measure_value_completeness": on_cdm(
        lambda c: violations.measure_value_completeness(c, M, "value_as_number")
    ),
    "violated_rows_concept_record_completeness": on_cdm(
        lambda c: violations.concept_record_completeness(c, M, "unit_concept_id")
    ),
    "violated_rows_table_concept_completeness": on_cdm(
        lambda c: violations.table_concept_completeness(
            c, M, MC, "measurement_source_concept_id"
        )
    ),
    "violated_rows_plausible_value_low": on_cdm(
        lambda c: violations.plausible_value_low(c, M, MD, "1996-01-01", "date")
    ),
    "violated_rows_plausible_value_high": on_cdm(
        lambda c: violations.plausible_value_high(c, M, "value_as_number", 45)
    ),
    "violated_rows_is_primary_key": on_cdm(
        lambda c: violations.is_primary_key(c, M, "measurement_id")
    ),
    "violated_rows_source_value_completeness": on_cdm(
        lambda c: violations.source_value_completeness(
            c, "condition_occurrence", "condition_source_value", "condition_concept_id"
        )
    ),
    "violated_rows_is_foreign_key": on_cdm(
        lambda c: violations.is_foreign_key(c, "person", "location_id", "location", "location_id")
    ),
    "violated_rows_fk_domain": on_cdm(lambda c: violations.fk_domain(c, M, MC, "PROMO")),
    "violated_rows_fk_class": on_cdm(lambda c: violations.fk_class(c, M, MC, "Brand#12")),
    "violated_rows_is_standard_valid_concept": on_cdm(
        lambda c: violations.is_standard_valid_concept(c, M, MC)
    ),
    "violated_rows_person_completeness": on_cdm(
        lambda c: violations.person_completeness(c, "condition_era")
    ),
    "violated_rows_plausible_temporal_after": on_cdm(
        lambda c: violations.plausible_temporal_after(c, M, MD, "person", "birth_datetime")
    ),
    "violated_rows_plausible_during_life": on_cdm(
        lambda c: violations.plausible_during_life(c, M, MD)
    ),
    "violated_rows_within_visit_dates": on_cdm(lambda c: violations.within_visit_dates(c, M, MD)),
    "violated_rows_concept_plausible_gender": on_cdm(
        lambda c: violations.concept_plausible_gender(c, M, MC, 7, "Male")
    ),
    "violated_rows_concept_plausible_unit_concept_ids": on_cdm(
        lambda c: violations.concept_plausible_unit_concept_ids(c, M, MC, 7, "2,3,4")
    ),
    "violated_rows_concept_plausible_value_low": on_cdm(
        lambda c: violations.concept_plausible_value_low(c, M, MC, 7, 2, 10)
    ),
    "violated_rows_concept_plausible_value_high": on_cdm(
        lambda c: violations.concept_plausible_value_high(c, M, MC, 7, 2, 25)
    ),
}
TABLES: dict[str, Query] = {
    "read_cdm": read_cdm,
    "read_control": read_control_query,
    "read_cdm_source": read_cdm_source,
    "write_report_json": write_report_json,
    "write_reports": write_reports,
    "write_results_csv": write_results_csv,
    "write_results_table": write_results_table,
    "write_results_level_table": write_results_level_table,
    "select_tables_include": on_control(
        lambda df: selection.select_tables(df, ["person", "Concept"], ())
    ),
    "select_tables_exclude": on_control(selection.select_tables),
    "drop_offset_field": on_control(selection.drop_offset_field),
    "select_checks": select_checks,
    "evaluation_filter": on_control(
        lambda df: selection.evaluation_filter(df, "isForeignKey=='Yes' & fkDomain!= ''")
    ),
}
RESULTS: dict[str, Query] = {
    "record_result": record_results,
    "union_results": union_of_results,
    "check_id": check_ids,
    "render_description": descriptions,
    "blank_to_null": blanks,
    "threshold_lookup": thresholds,
    "threshold_lookup_table": table_thresholds,
    "threshold_lookup_concept": concept_thresholds,
    "threshold_eval": on_history(
        lambda rows: evaluation.threshold_eval(rows).select(
            "run_id", "result_id", "is_error", "failed"
        )
    ),
    **{name: flag(name) for name in evaluation.FLAGS},
    "not_applicable": flagged(
        lambda rows: rows.withColumn("not_applicable", evaluation.not_applicable()),
        "not_applicable",
    ),
    "not_applicable_reason": flagged(evaluation.not_applicable_reason, "not_applicable_reason"),
    "final_status": on_history(
        lambda rows: evaluation.evaluate(rows, RUN).select(
            "run_id", "result_id", "is_error", "not_applicable", "failed", "passed"
        )
    ),
    "overview": on_history(lambda rows: report.overview(evaluation.evaluate(rows, RUN), RUN)),
    "status_column": on_history(
        lambda rows: evaluation.evaluate(rows, RUN).select(
            "run_id", "result_id", report.status_column().alias("status")
        )
    ),
    "report_view": on_history(
        lambda rows: report.report_view(evaluation.evaluate(rows, RUN), keep=["result_id"])
    ),
    "report_view_page": on_history(
        lambda rows: report.report_view(
            evaluation.evaluate(rows, RUN),
            filters={"level": "FIELD", "status": "FAIL"},
            page_size=10,
            page=1,
            keep=["result_id"],
            tie_breakers=["result_id"],
        )
    ),
    "report_view_stored_page": stored_page,
    "report_filter_values": on_history(
        lambda rows: report.filter_values(evaluation.evaluate(rows, RUN), "subcategory")
    ),
    "run_checks": run_all,
    "run_checks_cohort": run_cohort,
    "run_overview": run_overview,
}


def queries() -> dict[str, Query]:
    return CHECKS | COHORT | ROWS | TABLES | RESULTS
