"""Data-quality checks on Spark DataFrames."""

from plumbline.plans.runner import Run, run_checks
from plumbline.sources.cdm import (
    Cdm,
    Cohort,
    cdm_from_catalog,
    cdm_from_files,
)
from plumbline.sources.control import Controls, read_control, read_controls
from plumbline.sources.database import Database, cdm_from_database, cdm_from_jdbc
from plumbline.sources.sinks import (
    write_report_json,
    write_results_csv,
    write_results_table,
)
from plumbline.sources.standard import standard_descriptions, standard_table_control

__all__ = [
    "Cdm",
    "Cohort",
    "Controls",
    "Database",
    "Run",
    "cdm_from_catalog",
    "cdm_from_database",
    "cdm_from_files",
    "cdm_from_jdbc",
    "read_control",
    "read_controls",
    "run_checks",
    "standard_descriptions",
    "standard_table_control",
    "write_report_json",
    "write_results_csv",
    "write_results_table",
]
