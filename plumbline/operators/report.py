"""Summaries and views over judged results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.counting import PERCENT
from plumbline.functions.text import number_text, percent_text

# The columns of the view.
VIEW_COLUMNS = (
    "status", "table", "field", "check", "category", "subcategory", "level", "notes",
    "description", "percent_records",
)


def counters() -> dict[str, Column]:
    """The 14 counters of a report as aggregates. ``countPassed`` is everything that did not fail,
    so it includes errors and checks that do not apply."""
    # The names of the counters.
    result = {
        "countTotal": "count(1)",
        "countThresholdFailed": "count_if(failed = 1 AND error IS NULL)",
        "countErrorFailed": "count(error)",
        "countOverallFailed": "count_if(failed = 1)",
        "countPassed": "count_if(NOT failed <=> 1)",
        "countTotalPlausibility": "count_if(category = 'Plausibility')",
        "countTotalConformance": "count_if(category = 'Conformance')",
        "countTotalCompleteness": "count_if(category = 'Completeness')",
        "countFailedPlausibility": "count_if(category = 'Plausibility' AND failed = 1)",
        "countFailedConformance": "count_if(category = 'Conformance' AND failed = 1)",
        "countFailedCompleteness": "count_if(category = 'Completeness' AND failed = 1)",
        "countPassedPlausibility": "count_if(category = 'Plausibility' AND passed = 1)",
        "countPassedConformance": "count_if(category = 'Conformance' AND passed = 1)",
        "countPassedCompleteness": "count_if(category = 'Completeness' AND passed = 1)",
    }
    return {name: F.expr(sql) for name, sql in result.items()}


def overview(results: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """The counters, one row per run."""
    return results.groupBy(*run).agg(*[expr.alias(name) for name, expr in counters().items()])


STATUS = """CASE WHEN is_error = 1 THEN 'ERROR' WHEN not_applicable = 1 THEN 'NOT APPLICABLE'
    WHEN failed = 1 THEN 'FAIL' ELSE 'PASS' END"""


def status_column() -> Column:
    """One word per result: an error outranks 'not applicable', which outranks a failure."""
    return F.expr(STATUS)


def report_rows(results: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Results as they are shown to a reader, unordered; ``keep`` names columns to carry along."""
    shown = results.withColumns(
        {
            "threshold_text": number_text(F.col("threshold_value")),
            "percent_records": percent_text(PERCENT),
        }
    )
    # The words None, Exists and Threshold.
    return shown.selectExpr(
        *keep,
        f"{STATUS} AS status",
        "cdm_table_name AS table",
        "CASE WHEN cdm_field_name != '' THEN cdm_field_name ELSE 'None' END AS field",
        "check_name AS check",
        "category",
        "CASE WHEN subcategory != '' THEN subcategory ELSE 'None' END AS subcategory",
        "check_level AS level",
        "IF(notes_value IS NULL, 'None', 'Exists') AS notes",
        "IF(threshold_text IS NULL, check_description, "
        "concat(check_description, ' (Threshold=', threshold_text, '%).')) AS description",
        "percent_records",
        f"{PERCENT} AS share",
    )


def _chosen(rows: DataFrame, filters: Mapping[str, str] | None) -> DataFrame:
    for name, value in (filters or {}).items():
        rows = rows.where(F.col(name) == value)
    return rows


def _order(tie_breakers: Sequence[str], keep: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col("share"), F.lit(0.0)).desc(), *map(F.col, tie_breakers), *map(F.col, keep)]


def report_view(
    results: DataFrame,
    filters: Mapping[str, str] | None = None,
    page_size: int | None = None,
    page: int = 0,
    keep: Sequence[str] = (),
    tie_breakers: Sequence[str] = ("table", "field", "check"),
) -> DataFrame:
    """The table of a report: rows equal to all ``filters``, highest share first, one page of them
    or all. Without a page size the rows are sorted by range over many tasks; with one only the
    first pages travel to the last task. For pages far behind, see ``write_pages``."""
    rows = _chosen(report_rows(results, keep), filters)
    rows = rows.orderBy(*_order(tie_breakers, keep))
    if page_size is not None:
        rows = rows.offset(page * page_size).limit(page_size) if page else rows.limit(page_size)
    return rows.select(*keep, *VIEW_COLUMNS)


PLACE, RANGE_BITS = "place", 33


def write_pages(
    results: DataFrame,
    path: str,
    filters: Mapping[str, str] | None = None,
    keep: Sequence[str] = (),
    tie_breakers: Sequence[str] = ("table", "field", "check"),
) -> None:
    """The table of a report as files from which any page is read alone (``read_page``), sorted once.

    Rows are dealt out by ranges of their order, each range sorted and written by one task; a row's
    place is its range and its number there. The index beside them has the number of rows of each range."""
    rows = _chosen(report_rows(results, keep), filters)
    order = _order(tie_breakers, keep)
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranges.select(*keep, *VIEW_COLUMNS, F.monotonically_increasing_id().alias(PLACE))
    placed.write.mode("overwrite").parquet(f"{path}/rows")
    stored = results.sparkSession.read.parquet(f"{path}/rows")
    sizes = stored.groupBy(F.shiftright(PLACE, RANGE_BITS).alias("range")).agg(F.count(F.lit(1)).alias("size"))
    sizes.coalesce(1).write.mode("overwrite").parquet(f"{path}/ranges")


def read_page(spark: SparkSession, path: str, page: int, page_size: int) -> DataFrame:
    """One page of ``write_pages``, in order. The index, one row per range, says which places the page has; files of other
    ranges are passed over by the statistics of their places."""
    first, last, before, parts = page * page_size, (page + 1) * page_size, 0, []
    for row in sorted(spark.read.parquet(f"{path}/ranges").collect(), key=lambda row: row["range"]):
        low, high = max(first - before, 0), min(last - before, row["size"])
        if low < high:
            start = row["range"] << RANGE_BITS
            parts.append(F.col(PLACE).between(start + low, start + high - 1))
        before += row["size"]
    rows = spark.read.parquet(f"{path}/rows")
    return rows.where(reduce(or_, parts, F.lit(False))).orderBy(PLACE).drop(PLACE)


def filter_values(results: DataFrame, column: str) -> DataFrame:
    """Values a reader can filter a column of the report by."""
    return report_rows(results).select(column).distinct()
