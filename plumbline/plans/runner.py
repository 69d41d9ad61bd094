"""Runs the checks of a control table with few jobs.

Checks that need the same pass over the same data are counted together: all row rules of a table in
one scan, all checks of a table against one partner table in one shuffle, all its date checks in
another, all concepts of a field in one. Each such group is one Spark action; its result is one row
per check. Control cells that cannot be read are errors of their checks before any job starts. If a
group fails all the same, it is halved again and again, so one bad check among n costs 2 log n jobs.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from time import monotonic

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.counting import CHECK_KEY, DENOMINATOR, VIOLATED
from plumbline.operators import concepts, keyed, lookup, presence, rowwise, temporal
from plumbline.operators.evaluation import evaluate, threshold_error
from plumbline.operators.report import overview, report_view
from plumbline.operators.selection import VOCABULARY_TABLES, select_controls
from plumbline.plans.checks import checks_to_run, record_result, union_results
from plumbline.sources.cdm import Cdm, Cohort
from plumbline.sources.control import Controls
from plumbline.sources.sinks import CDM_SOURCE, read_cdm_source, report_document, result_table

log = logging.getLogger(__name__)

# Aggregates beyond spark.sql.codegen.maxFields (100) leave generated code; each rule needs two.
RULES_PER_SCAN = 40

ROW_RULES: dict[str, Callable[[Cdm, dict], rowwise.RowRule]] = {
    "isRequired": lambda cdm, c: rowwise.not_null_rule(c["field"]),
    "measureValueCompleteness": lambda cdm, c: rowwise.not_null_rule(c["field"]),
    "cdmDatatype": lambda cdm, c: rowwise.numeric_rule(cdm, c["table"], c["field"]),
    "standardConceptRecordCompleteness": lambda cdm, c: rowwise.zero_concept_rule(
        c["table"], c["field"]
    ),
    "sourceConceptRecordCompleteness": lambda cdm, c: rowwise.zero_concept_rule(
        c["table"], c["field"]
    ),
    "conceptCompleteness": lambda cdm, c: rowwise.both_unmapped_rule(
        c["field"], c["cdmSourceFieldName"]
    ),
    "plausibleValueLow": lambda cdm, c: rowwise.range_rule(
        c["field"], c["plausibleValueLow"], c["cdmDatatype"]
    ),
    "plausibleValueHigh": lambda cdm, c: rowwise.range_rule(
        c["field"], c["plausibleValueHigh"], c["cdmDatatype"], high=True
    ),
    "plausibleTemporalAfter": lambda cdm, c: rowwise.own_date_order_rule(
        c["table"], c["field"], c["plausibleTemporalAfterFieldName"]
    ),
}
VOCABULARY_RULES: dict[str, Callable[[dict], lookup.VocabularyRule]] = {
    "fkDomain": lambda c: lookup.domain_rule(c["fkDomain"]),
    "fkClass": lambda c: lookup.class_rule(c["fkClass"]),
    "isStandardValidConcept": lambda c: lookup.standard_rule(),
}
CONCEPT_KINDS = {
    "plausibleGender": concepts.GENDER,
    "plausibleUnitConceptIds": concepts.UNITS,
    "plausibleValueLow": concepts.LOW,
    "plausibleValueHigh": concepts.HIGH,
}
# Call that repeats a check by itself: operator and the control columns it takes.
CALLS = {
    ("TABLE", "cdmTable"): ("cdm_table", ()),
    ("TABLE", "measurePersonCompleteness"): ("person_completeness", ()),
    ("TABLE", "measureConditionEraCompleteness"): ("condition_era_completeness", ()),
    ("FIELD", "cdmField"): ("cdm_field", ()),
    ("FIELD", "isRequired"): ("is_required", ()),
    ("FIELD", "cdmDatatype"): ("cdm_datatype", ()),
    ("FIELD", "isPrimaryKey"): ("is_primary_key", ()),
    ("FIELD", "isForeignKey"): ("is_foreign_key", ("fkTableName", "fkFieldName")),
    ("FIELD", "fkDomain"): ("fk_domain", ("fkDomain",)),
    ("FIELD", "fkClass"): ("fk_class", ("fkClass",)),
    ("FIELD", "isStandardValidConcept"): ("is_standard_valid_concept", ()),
    ("FIELD", "measureValueCompleteness"): ("measure_value_completeness", ()),
    ("FIELD", "standardConceptRecordCompleteness"): ("concept_record_completeness", ()),
    ("FIELD", "sourceConceptRecordCompleteness"): ("concept_record_completeness", ()),
    ("FIELD", "conceptCompleteness"): ("table_concept_completeness", ("cdmSourceFieldName",)),
    ("FIELD", "sourceValueCompleteness"): (
        "source_value_completeness",
        ("standardConceptFieldName",),
    ),
    ("FIELD", "plausibleValueLow"): ("plausible_value_low", ("plausibleValueLow", "cdmDatatype")),
    ("FIELD", "plausibleValueHigh"): (
        "plausible_value_high",
        ("plausibleValueHigh", "cdmDatatype"),
    ),
    ("FIELD", "plausibleTemporalAfter"): (
        "plausible_temporal_after",
        ("plausibleTemporalAfterTableName", "plausibleTemporalAfterFieldName"),
    ),
    ("FIELD", "plausibleDuringLife"): ("plausible_during_life", ()),
    ("FIELD", "withinVisitDates"): ("within_visit_dates", ()),
    ("CONCEPT", "plausibleGender"): (
        "concept_plausible_gender",
        ("concept_id", "plausibleGender"),
    ),
    ("CONCEPT", "plausibleUnitConceptIds"): (
        "concept_plausible_unit_concept_ids",
        ("concept_id", "plausibleUnitConceptIds"),
    ),
    ("CONCEPT", "plausibleValueLow"): (
        "concept_plausible_value_low",
        ("concept_id", "unit_concept_id", "plausibleValueLow"),
    ),
    ("CONCEPT", "plausibleValueHigh"): (
        "concept_plausible_value_high",
        ("concept_id", "unit_concept_id", "plausibleValueHigh"),
    ),
}


NUMBERS = {
    "concept_id": int,
    "unit_concept_id": int,
    "plausibleValueLow": float,
    "plausibleValueHigh": float,
}


def call_text(check: dict) -> str:
    """The operator call of a check, e.g. ``is_required(cdm, 'person', 'gender_concept_id')``."""
    name, parameters = CALLS[check["check_level"], check["check_name"]]

    def value(parameter: str) -> object:
        text = check[parameter]
        if check["check_level"] == "CONCEPT" and parameter in NUMBERS and text:
            try:
                return NUMBERS[parameter](text)
            except ValueError:  # shown as it is; running the check reports it
                return text
        return text

    given = [check["table"], check["field"], *[value(p) for p in parameters]]
    return f"{name}({', '.join(['cdm', *[repr(v) for v in given if v is not None]])})"


@dataclass(frozen=True)
class Checks:
    """Checks of a run: as a DataFrame for joining, and as rows for putting jobs together."""

    df: DataFrame
    rows: list[dict]

    def only(self, keys: Iterable[str]) -> DataFrame:
        """The checks with these keys: a join, since a list of thousands of keys in an expression
        would make the plan as long."""
        wanted = pa.table({CHECK_KEY: pa.array(list(keys), pa.string())})
        return self.df.join(self.df.sparkSession.createDataFrame(wanted), CHECK_KEY, "left_semi")


def prepare(
    spark: SparkSession,
    controls: Controls,
    include: Iterable[str] = (),
    exclude: Iterable[str] = VOCABULARY_TABLES,
    names: Iterable[str] = (),
) -> Checks:
    """Select the checks and give each a key. Only control rows pass through the driver."""
    selected = select_controls(controls.local(), include, exclude, names)
    table = checks_to_run(selected).toArrow()
    rows = []
    for number, row in enumerate(table.to_pylist()):
        field = row["cdm_field_name"]
        row["table"] = row["cdm_table_name"].lower()
        row["field"] = field.lower() if field else None
        row[CHECK_KEY] = f"{number:06d}"
        if (row["check_level"], row["check_name"]) not in CALLS:
            raise ValueError(f"unknown check {row['check_level']} {row['check_name']}")
        row["query_text"] = call_text(row)
        rows.append(row)
    for name in (CHECK_KEY, "query_text"):
        table = table.append_column(name, pa.array([row[name] for row in rows], pa.string()))
    return Checks(spark.createDataFrame(table), rows)


def shape(check: dict, cohort: Cohort | None) -> tuple:
    """Checks of equal shape are counted in one pass."""
    name, table, field = check["check_name"], check["table"], check["field"]
    if check["check_level"] == "CONCEPT":
        return ("concepts", table, field, cohort is not None)
    restricted = cohort is not None and check["runForCohort"] == "Yes"
    if name in ("cdmTable", "cdmField"):
        return ("presence", name)
    if name == "cdmDatatype":
        return ("rows", table, False)
    if name == "plausibleTemporalAfter" and not _own_date(check):
        return ("dates", table, "person", restricted)
    if name in ROW_RULES:
        return ("rows", table, restricted)
    if name in ("isPrimaryKey", "sourceValueCompleteness"):
        return ("values", table, restricted)
    if name == "measureConditionEraCompleteness":
        return ("era", table, restricted)
    if name == "plausibleDuringLife":
        return ("dates", table, "person", restricted)
    if name == "withinVisitDates":
        return ("dates", table, "visit", restricted)
    partner, key = lookup.CONCEPT, lookup.CONCEPT_KEY
    reverse = name == "measurePersonCompleteness"
    if reverse:
        partner, key = "person", "person_id"
    elif name == "isForeignKey":
        partner, key = check["fkTableName"].lower(), check["fkFieldName"].lower()
    return ("keys", table, partner, key, restricted, reverse and restricted)


def _own_date(check: dict) -> bool:
    return (check["plausibleTemporalAfterTableName"] or "").lower() == check["table"]


@dataclass(frozen=True)
class Group:
    """Checks counted in one pass."""

    shape: tuple
    checks: tuple[dict, ...]

    def counts(self, cdm: Cdm, checks: Checks, cohort: Cohort | None) -> DataFrame:
        """(check_key, violated, denominator), not yet executed."""
        kind, *rest = self.shape
        first = self.checks[0]
        table, field = first["table"], first["field"]
        members = {check[CHECK_KEY]: check for check in self.checks}

        def restricted(flag: bool) -> Cohort | None:
            return cohort if flag else None

        if kind == "presence":
            expected = checks.only(members).select(
                CHECK_KEY,
                F.col("cdm_table_name").alias("table_name"),
                F.col("cdm_field_name").alias("field_name"),
            )
            found = presence.cdm_table if rest[0] == "cdmTable" else presence.cdm_field
            tables = [check["table"] for check in self.checks]
            return found(expected, cdm, tables).select(CHECK_KEY, VIOLATED, DENOMINATOR)
        if kind == "rows":
            rules = {key: ROW_RULES[c["check_name"]](cdm, c) for key, c in members.items()}
            return rowwise.count_rules(cdm.rows(table, restricted(rest[1])), rules)
        if kind == "values":
            values = {
                key: keyed.ValueCheck(
                    c["field"], c["standardConceptFieldName"] if c["check_name"] != "isPrimaryKey" else None
                )
                for key, c in members.items()
            }
            return keyed.count_value_checks(cdm, table, values, restricted(rest[1]))
        if kind == "era":
            return lookup.count_era_persons(
                cdm, table, cohort=restricted(rest[1]), key=first[CHECK_KEY]
            )
        if kind == "dates":
            date_checks = {key: _date_check(check) for key, check in members.items()}
            return temporal.count_date_checks(cdm, table, date_checks, restricted(rest[2]))
        if kind == "keys":
            _, partner, partner_key, flag, _ = rest
            key_checks = {key: _key_check(check) for key, check in members.items()}
            return lookup.count_key_checks(
                cdm, table, partner, partner_key, key_checks, restricted(flag)
            )

        def number(name: str, kind: str) -> Column:
            """Number in a control cell; a cell that holds something else fails its check."""
            return F.expr(f"CAST(nullif(trim({name}), '') AS {kind})")

        def own(name: str, cell: Column) -> Column:
            """The cell of the check itself; a control row may hold cells of other checks too."""
            return F.when(F.col("check_name") == name, cell)

        kinds = sorted({CONCEPT_KINDS[check["check_name"]] for check in self.checks})
        names = F.create_map(*[F.lit(part) for pair in CONCEPT_KINDS.items() for part in pair])
        control = checks.only(members).select(
            CHECK_KEY,
            names[F.col("check_name")].alias("kind"),
            number("concept_id", "bigint").alias("concept_id"),
            number("unit_concept_id", "bigint").alias("unit_concept_id"),
            F.col("plausibleGender").alias("gender"),
            own("plausibleUnitConceptIds", F.col("plausibleUnitConceptIds")).alias("units"),
            own("plausibleValueLow", number("plausibleValueLow", "double")).alias("low"),
            own("plausibleValueHigh", number("plausibleValueHigh", "double")).alias("high"),
        )
        return concepts.count_concept_checks(cdm, table, field, control, kinds, cohort)


def _date_check(check: dict) -> temporal.DateCheck:
    if check["check_name"] == "plausibleDuringLife":
        return temporal.DateCheck(check["field"], "life")
    if check["check_name"] == "withinVisitDates":
        return temporal.DateCheck(check["field"], "visit")
    return temporal.DateCheck(
        check["field"],
        "after",
        check["plausibleTemporalAfterTableName"],
        check["plausibleTemporalAfterFieldName"],
    )


def _key_check(check: dict) -> lookup.KeyCheck:
    name = check["check_name"]
    if name == "measurePersonCompleteness":
        return lookup.KeyCheck("person_id", reverse=True)
    rule = VOCABULARY_RULES[name](check) if name in VOCABULARY_RULES else None
    return lookup.KeyCheck(check["field"], rule)


def group_checks(rows: Sequence[dict], cohort: Cohort | None = None) -> list[Group]:
    """Checks by shape; row rules of a very wide table are spread over several scans, each reading
    the columns of its own rules."""
    by_shape: dict[tuple, list[dict]] = {}
    for check in rows:
        by_shape.setdefault(shape(check, cohort), []).append(check)
    groups = []
    for key, members in by_shape.items():
        size = len(members)
        if key[0] in ("rows", "values"):
            members, size = sorted(members, key=lambda c: c["field"]), RULES_PER_SCAN
        elif key[0] == "era":
            size = 1
        for start in range(0, len(members), size):
            groups.append(Group(key, tuple(members[start : start + size])))
    return groups


def split_missing(rows: Sequence[dict], cdm: Cdm) -> tuple[list[dict], dict[str, str]]:
    """Checks that can run, and errors of those that cannot. A check on a table or field that does
    not exist is left without counts if the run reports the absence by itself (it is then judged
    as not applicable); otherwise it is an error, as is every check of a table that cannot be opened."""
    reported = {
        (c["table"], c["field"]) for c in rows if c["check_name"] in ("cdmTable", "cdmField")
    }
    ready, errors = [], {}
    for check in rows:
        table, field = check["table"], check["field"]
        failure = cdm.failure(table)
        if failure is not None:  # only the checks of this table, and of those that need it, fail
            errors[check[CHECK_KEY]] = str(failure) or type(failure).__name__
        elif check["check_name"] == "cdmTable":
            ready.append(check)
        elif table not in cdm:
            if (table, None) not in reported:
                errors[check[CHECK_KEY]] = f"Table {check['cdm_table_name']} does not exist."
        elif check["check_name"] == "cdmField" or field is None or cdm.has_field(table, field):
            ready.append(check)
        elif (table, field) not in reported:
            where = f"{check['cdm_table_name']}.{check['cdm_field_name']}"
            errors[check[CHECK_KEY]] = f"Field {where} does not exist."
    return ready, errors


def unreadable_cells(checks: Checks) -> dict[str, str]:
    """Errors of checks whose control cells should hold numbers and hold something else: thresholds, and
    the cells of concept checks."""
    kinds = {"concept_id": "BIGINT", "unit_concept_id": "BIGINT"}
    bad = [
        (name, f"trim({name}) != '' AND try_cast(trim({name}) AS {kind}) IS NULL")
        for name, kind in kinds.items()
    ]
    bad += [
        (name, f"check_name = '{name}' AND trim({name}) != '' AND try_cast(trim({name}) AS DOUBLE) IS NULL")
        for name in ("plausibleValueLow", "plausibleValueHigh")
    ]
    units = "plausibleUnitConceptIds"
    nothing = ", ".join(f"'{text}'" for text in concepts.NO_UNITS)
    bad.append((
        units,
        f"check_name = '{units}' AND trim({units}) NOT IN ({nothing}) "
        f"AND exists(split({units}, ','), x -> try_cast(trim(x) AS BIGINT) IS NULL)",
    ))
    texts = " ".join(
        f"WHEN check_level = 'CONCEPT' AND {sql} THEN concat('{name} is not readable: ', {name})" for name, sql in bad
    )
    texts += f" WHEN threshold_cell IS NOT NULL AND threshold_value IS NULL THEN {threshold_error('threshold_cell')}"
    found = checks.df.selectExpr(CHECK_KEY, f"CASE {texts} END AS error")
    return {row[CHECK_KEY]: row["error"] for row in found.where("error IS NOT NULL").collect()}


def count_checks(cdm: Cdm, checks: Checks, cohort: Cohort | None = None) -> DataFrame:
    """Counts of all checks as one DataFrame, nothing executed yet. A failing check fails its job;
    ``count_isolated`` is the way to run many checks."""
    ready, errors = split_missing(checks.rows, cdm)
    parts = [group.counts(cdm, checks, cohort) for group in group_checks(ready, cohort)]
    parts.append(_counts_frame(checks.df.sparkSession, [], errors))
    return union_results(parts)


def _counts_frame(
    spark: SparkSession, counted: Sequence[tuple], errors: dict[str, str]
) -> DataFrame:
    rows = [(*row, None) for row in counted]
    rows += [(key, None, None, None, text) for key, text in errors.items()]
    columns = list(zip(*rows)) if rows else [()] * 5
    names = (CHECK_KEY, VIOLATED, DENOMINATOR, "execution_time", "error")
    types = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
    arrays = [pa.array(values, kind) for values, kind in zip(columns, types)]
    return spark.createDataFrame(pa.table(arrays, names=list(names)))


def count_isolated(
    cdm: Cdm, checks: Checks, cohort: Cohort | None = None, parallel: int = 4
) -> DataFrame:
    """Counts of all checks, executed group by group, ``parallel`` groups at a time. Only counts
    come back, one row per check. A failing group is repeated in halves."""
    spark = checks.df.sparkSession
    unreadable = unreadable_cells(checks)
    rows = [check for check in checks.rows if check[CHECK_KEY] not in unreadable]
    ready, errors = split_missing(rows, cdm)
    errors |= unreadable

    def run(group: Group) -> tuple[list[tuple], dict[str, str]]:
        started = monotonic()
        try:
            rows = group.counts(cdm, checks, cohort).collect()
        except Exception as error:  # whatever a check raises is the result of that check
            if len(group.checks) == 1:
                check = group.checks[0]
                log.error("%s: %s", check["checkid"], error)
                return [], {check[CHECK_KEY]: str(error)}
            half = len(group.checks) // 2
            parts = [
                run(Group(group.shape, part)) for part in (group.checks[:half], group.checks[half:])
            ]
            counted = [row for rows, _ in parts for row in rows]
            return counted, {key: text for _, found in parts for key, text in found.items()}
        spent = f"{int(monotonic() - started)} seconds"
        return [(row[CHECK_KEY], row[VIOLATED], row[DENOMINATOR], spent) for row in rows], {}

    groups = group_checks(ready, cohort)
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        done = [pool.submit(inheritable_thread_target(spark)(run), group) for group in groups]
        parts = [job.result() for job in done]
    counted = [row for rows, _ in parts for row in rows]
    for _, found in parts:
        errors |= found
    return _counts_frame(spark, counted, errors)


@dataclass(frozen=True)
class Run:
    """A finished run: judged results and what belongs to them."""

    results: DataFrame
    started: datetime
    ended: datetime
    metadata: DataFrame | None

    def overview(self) -> DataFrame:
        return overview(self.results)

    def view(self, **options) -> DataFrame:
        return report_view(self.results, **options)

    def document(self, output_file: str = "results.json") -> DataFrame:
        """The nested report, ready for ``write_report_json``."""
        stamps = [F.lit(t.isoformat()).cast("timestamp") for t in (self.started, self.ended)]
        return report_document(self.results, *stamps, self.metadata, output_file)


def run_checks(
    spark: SparkSession,
    cdm: Cdm,
    controls: Controls,
    include: Iterable[str] = (),
    exclude: Iterable[str] = VOCABULARY_TABLES,
    names: Iterable[str] = (),
    cohort: Cohort | None = None,
    parallel: int = 4,
) -> Run:
    """Select the checks, count group by group, judge the counts. Counting happens here; judging
    is lazy, over one small row per check."""
    started = datetime.now(timezone.utc)
    checks = prepare(spark, controls, include, exclude, names)
    counts = count_isolated(cdm, checks, cohort, parallel)
    results = result_table(evaluate(record_result(checks.df, counts)))
    failure = cdm.failure(CDM_SOURCE)
    if failure is not None:  # the report then has no metadata
        log.error("%s: %s", CDM_SOURCE, failure)
    metadata = read_cdm_source(cdm) if failure is None else None
    return Run(results, started, datetime.now(timezone.utc), metadata)
