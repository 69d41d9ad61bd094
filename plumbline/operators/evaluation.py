"""From counts to verdicts.

All functions take a DataFrame of results with lower-case result columns. It may hold one run or
the history of many: the columns named in ``run`` tell runs apart, and a whole history is judged
again in one job. What is known about tables and fields is counted first (one row per table and
field of a run) and then joined back, so a run that holds a third of the history is spread over
many tasks like any other rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.counting import DENOMINATOR, PERCENT, VIOLATED
from plumbline.sources.control import Controls

TABLE_CHECK, FIELD_CHECK = "cdmTable", "cdmField"
REQUIRED_CHECK, FILLED_CHECK = "isRequired", "measureValueCompleteness"
FLAGS = (
    "table_is_missing",
    "field_is_missing",
    "table_is_empty",
    "field_is_empty",
    "concept_is_missing",
    "concept_and_unit_are_missing",
)


KNOWN_KEYS = ("check_level", "check_name", "cdm_table_name", "cdm_field_name", "concept_id")
THRESHOLD_CELLS = ("threshold_value", "notes_value", "threshold_error")


def strictest() -> list[Column]:
    """One set of threshold cells for control rows that repeat a key. The strictest threshold counts: a
    blank one, which lets no violated row pass, before any number. ``threshold_error`` is about a
    cell that holds no number."""
    value = F.when(F.count("threshold_value") == F.count("*"), F.min("threshold_value"))
    return [value.alias("threshold_value"), *[F.min(name).alias(name) for name in THRESHOLD_CELLS[1:]]]


def control_thresholds(control: DataFrame, level: str) -> DataFrame:
    """Long form of the ``<check>Threshold`` and ``<check>Notes`` columns of a control table: one
    row per check and table, field, concept and unit, with table and field in lower case; see
    ``strictest`` for repeated keys."""
    suffix = "Threshold"
    there = {name.lower(): f"`{name}`" for name in control.columns}
    names = [name[: -len(suffix)] for name in control.columns if name.endswith(suffix)] or [""]

    def filled(name: str) -> str:
        found = there.get(name.lower(), "NULL")
        return f"CASE WHEN trim({found}) != '' THEN CAST({found} AS STRING) END"

    cells = ", ".join(
        f"named_struct('check_name', '{name}', 'cell', {filled(name + suffix)}, "
        f"'notes_value', {filled(name + 'Notes')})"
        for name in names
    )
    return (
        control.selectExpr(
            f"'{level}' AS check_level",
            "lower(cdmTableName) AS cdm_table_name",
            f"lower({filled('cdmFieldName')}) AS cdm_field_name",
            f"{filled('conceptId')} AS concept_id",
            f"{filled('unitConceptId')} AS unit_concept_id",
            f"inline(array({cells}))",
        )
        .selectExpr(
            "*",
            "try_cast(cell AS DOUBLE) AS threshold_value",
            f"CASE WHEN try_cast(cell AS DOUBLE) IS NULL THEN {threshold_error('cell')} END AS threshold_error",
        )
        .groupBy(*KNOWN_KEYS, "unit_concept_id")
        .agg(*strictest())
    )


def threshold_error(cell: str) -> str:
    """What is said about a threshold cell (an SQL expression) that holds no number."""
    return f"concat('threshold is not readable: ', {cell})"


def threshold_lookup(results: DataFrame, controls: Controls | DataFrame) -> DataFrame:
    """Results with ``threshold_value`` and ``notes_value`` of their control row; both NULL where
    the control tables say nothing. ``controls`` may be the long form already.

    The most specific control row counts. For a result with a unit, that is the row of its concept
    and unit, or else the row of its concept without a unit; for one without a unit, the row without
    a unit, or else the strictest of all rows of its concept. Rows of a concept are gathered first, by
    unit, so that there is one join and no result is multiplied. If the results have a column
    ``error``, a threshold that holds no number becomes the error of those without another.
    """
    if isinstance(controls, Controls):
        known = control_thresholds(controls.tables, "TABLE")
        known = known.unionByName(control_thresholds(controls.fields, "FIELD"))
        known = known.unionByName(control_thresholds(controls.concepts, "CONCEPT"))
    else:
        known = controls
    unit, row = F.col("unit_concept_id"), F.struct(*THRESHOLD_CELLS)
    by_concept = known.groupBy(*KNOWN_KEYS).agg(
        F.map_from_entries(F.collect_list(F.when(unit.isNotNull(), F.struct(unit, row)))).alias("by_unit"),
        F.max(F.when(unit.isNull(), row)).alias("without_unit"),
        F.struct(*strictest()).alias("of_any"),
    )
    same = [f"result.{key} = known.{key}" for key in ("check_level", "check_name")]
    same.append("lower(result.cdm_table_name) = known.cdm_table_name")
    same.append("lower(result.cdm_field_name) <=> known.cdm_field_name")
    same.append("CAST(result.concept_id AS STRING) <=> known.concept_id")
    rows = results.drop("threshold_value", "notes_value")
    own_unit = F.col("result.unit_concept_id").cast("string")
    found = F.when(own_unit.isNull(), F.coalesce("known.without_unit", "known.of_any")).otherwise(
        F.coalesce(F.try_element_at("known.by_unit", own_unit), "known.without_unit")
    )
    met = rows.alias("result").join(by_concept.alias("known"), F.expr(" AND ".join(same)), "left")
    met = met.select("result.*", found.alias("__found"))
    if "error" in rows.columns:
        met = met.withColumn("error", F.coalesce("error", "__found.threshold_error"))
    return met.select(*rows.columns, "__found.threshold_value", "__found.notes_value")


def threshold_eval(results: DataFrame) -> DataFrame:
    """Adds ``is_error`` and ``failed``. Without a threshold, or with 0, any violated row fails a
    check; otherwise the percentage must exceed the threshold."""
    failed = f"""CASE WHEN error IS NOT NULL THEN false
        WHEN threshold_value IS NULL OR threshold_value = 0 THEN {VIOLATED} > 0
        ELSE {PERCENT} * 100 > threshold_value END"""
    return results.withColumns(
        {
            "is_error": F.expr("CAST(error IS NOT NULL AS INT)"),
            "failed": F.expr(f"CAST(coalesce({failed}, false) AS INT)"),
        }
    )


def _known_absences(results: DataFrame, run: Sequence[str]) -> DataFrame:
    """Per run, table and field (in lower case): is the table or field missing or empty?"""
    table = [*run, "cdm_table_name"]
    results = results.withColumns({name: F.lower(name) for name in ("cdm_table_name", "cdm_field_name")})
    filled = f"check_name = '{FILLED_CHECK}'"
    found = {
        "no_table": f"check_name = '{TABLE_CHECK}' AND failed = 1",
        "no_field": f"check_name = '{FIELD_CHECK}' AND failed = 1",
        "no_rows": f"{filled} AND {DENOMINATOR} = 0 AND is_error = 0",
        "no_values": f"{filled} AND {DENOMINATOR} = {VIOLATED} AND is_error = 0",
        "no_values_in_error": f"{filled} AND {DENOMINATOR} = {VIOLATED} AND is_error = 1",
    }
    facts = results.groupBy(*table, "cdm_field_name").agg(
        *[F.expr(f"max(coalesce({sql}, false)) AS {name}") for name, sql in found.items()]
    )
    whole = Window.partitionBy(*table)
    facts = facts.withColumn("table_missing", F.max("no_table").over(whole))
    facts = facts.withColumn("field_missing", F.expr("no_field AND NOT table_missing"))
    facts = facts.withColumn("present", F.expr("NOT table_missing AND NOT field_missing"))
    facts = facts.withColumn("table_empty", F.max(F.expr("no_rows AND present")).over(whole))
    return facts.selectExpr(
        *table,
        "cdm_field_name",
        "table_missing",
        "field_missing",
        "table_empty",
        "(no_values AND present AND NOT table_empty) OR no_values_in_error AS field_empty",
    )


# When each flag is set, in order of precedence: what is known about the table or field, and the
# checks that keep their verdict all the same.
ABSENCES = {
    "table_is_missing": ("table_missing", (TABLE_CHECK,)),
    "field_is_missing": ("field_missing", (FIELD_CHECK,)),
    "table_is_empty": ("table_empty", (TABLE_CHECK, FIELD_CHECK)),
    "field_is_empty": ("field_empty", (FILLED_CHECK, FIELD_CHECK, REQUIRED_CHECK)),
}
NO_CONCEPT_ROWS = f"check_level = 'CONCEPT' AND {DENOMINATOR} = 0 AND is_error = 0"


def _with_absences(results: DataFrame, run: Sequence[str], *columns: str) -> DataFrame:
    """Results joined with what is known about their table and field, plus ``columns`` (SQL)."""
    known = _known_absences(results, run)
    keys = {key: f"result.{key}" for key in run}
    keys |= {key: f"lower(result.{key})" for key in ("cdm_table_name", "cdm_field_name")}
    same = " AND ".join(f"{mine} <=> known.{key}" for key, mine in keys.items())
    joined = results.alias("result").join(known.alias("known"), F.expr(same), "left")
    return joined.selectExpr("result.*", *columns)


def _absence(found: str, but: Sequence[str]) -> str:
    names = ", ".join(f"'{name}'" for name in but)
    return f"known.{found} AND result.check_name NOT IN ({names}) AND result.is_error = 0"


def absence_flags(results: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """Adds the six flags (1 or NULL) that make a check not applicable. Needs ``threshold_eval``."""
    flagged = _with_absences(
        results,
        run,
        *[f"IF({_absence(*spec)}, 1, NULL) AS {name}" for name, spec in ABSENCES.items()],
    )
    alone = f"{NO_CONCEPT_ROWS} AND coalesce({', '.join(ABSENCES)}) IS NULL"
    return flagged.withColumns(
        {
            "concept_is_missing": F.expr(f"IF({alone} AND unit_concept_id IS NULL, 1, NULL)"),
            "concept_and_unit_are_missing": F.expr(
                f"IF({alone} AND unit_concept_id IS NOT NULL, 1, NULL)"
            ),
        }
    )


def first_flag() -> Column:
    """Place (1 to 6) of the first flag that is set, or NULL."""
    cases = [f"WHEN {name} IS NOT NULL THEN {i}" for i, name in enumerate(FLAGS, 1)]
    return F.expr(f"CASE {' '.join(cases)} END")


def not_applicable() -> Column:
    """1 if any of the six flags is set, else 0."""
    return F.expr(f"coalesce({', '.join(FLAGS)}, 0)")


# The message of each flag.
MESSAGES = (
    "Table {cdm_table_name} does not exist.",
    "Field {cdm_table_name}.{cdm_field_name} does not exist.",
    "Table {cdm_table_name} is empty.",
    "Field {cdm_table_name}.{cdm_field_name} is not populated.",
    "{cdm_field_name}={concept_id} is missing from the {cdm_table_name} table.",
    "Combination of {cdm_field_name}={concept_id}, UNIT_CONCEPT_ID={unit_concept_id} and "
    "VALUE_AS_NUMBER IS NOT NULL is missing from the {cdm_table_name} table.",
)


NOT_RUN = "The check was not run."


def _reason(flag: str) -> Column:
    """Message of the flag whose place is given by the SQL expression ``flag``. One template is
    picked and filled, which is far less generated code than six concatenations; long methods are
    not compiled by the JVM."""
    templates = ", ".join(f"'{message}'" for message in MESSAGES)
    text = f"elt({flag}, {templates})"
    for name in ("cdm_table_name", "cdm_field_name", "concept_id", "unit_concept_id"):
        text = f"replace({text}, '{{{name}}}', coalesce(CAST({name} AS STRING), ''))"
    return F.expr(text)


def not_applicable_reason(results: DataFrame) -> DataFrame:
    """Adds ``not_applicable_reason``, the message of the first flag that is set."""
    first = results.withColumn("first_flag", first_flag())
    return first.withColumn("not_applicable_reason", _reason("first_flag")).drop("first_flag")


def final_status(results: DataFrame) -> DataFrame:
    """From ``first_flag``: ``not_applicable`` with its reason, and the final ``failed`` and
    ``passed``. A check that does not apply has neither failed nor passed. One that has no counts,
    though it applies and reports no error, did not run, which is an error."""
    unrun = F.expr(f"first_flag IS NULL AND error IS NULL AND {VIOLATED} IS NULL")
    return (
        results.withColumn("error", F.when(unrun, NOT_RUN).otherwise(F.col("error")))
        .withColumn("is_error", F.expr("IF(error IS NOT NULL, 1, is_error)"))
        .withColumns(
            {
                "not_applicable": F.expr("CAST(first_flag IS NOT NULL AS INT)"),
                "not_applicable_reason": _reason("first_flag"),
                "failed": F.expr("IF(first_flag IS NULL, failed, 0)"),
                "passed": F.expr(
                    "CAST(first_flag IS NULL AND failed = 0 AND is_error = 0 AS INT)"
                ),
            }
        )
    ).drop("first_flag")


def evaluate(results: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """Counts and thresholds in, verdicts out. Only the first flag of a result matters here, so
    that alone is worked out and not all six."""
    cases = [f"WHEN {_absence(*spec)} THEN {i}" for i, spec in enumerate(ABSENCES.values(), 1)]
    cases.append(f"WHEN {NO_CONCEPT_ROWS} THEN IF(unit_concept_id IS NULL, 5, 6)")
    flag = f"CASE {' '.join(cases)} END AS first_flag"
    return final_status(_with_absences(threshold_eval(results), run, flag))
