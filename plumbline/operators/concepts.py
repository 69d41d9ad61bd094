"""Checks of single concepts: plausible gender, units and values.

A control table says what is plausible for each concept; it stays a DataFrame, so thousands of
concepts are judged in one pass over the table. It is small and Spark broadcasts it while its
measured size stays below ``spark.sql.autoBroadcastJoinThreshold``; above that it joins by
shuffle. Results are counted per control row before they move.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions.counting import (
    CHECK_KEY,
    DENOMINATOR,
    VIOLATED,
    check_counts,
    col,
    tally,
)
from plumbline.functions.search import leading
from plumbline.functions.values import split_list
from plumbline.operators.lookup import key_type
from plumbline.sources.cdm import Cdm, Cohort

GENDER, UNITS, LOW, HIGH = "gender", "units", "low", "high"
CONCEPT_KINDS = (GENDER, UNITS, LOW, HIGH)
MALE, MALE_CONCEPT, FEMALE_CONCEPT = "Male", 8507, 8532
NO_UNITS = ("", "NA")
CONTROL_SCHEMA = (
    "check_key string, kind string, concept_id bigint, unit_concept_id bigint, "
    "gender string, units string, low double, high double"
)


def concept_control(
    spark: SparkSession,
    check_key: str,
    kind: str,
    concept_id: int,
    unit_concept_id: int | None = None,
    gender: str | None = None,
    units: str | None = None,
    low: float | None = None,
    high: float | None = None,
) -> DataFrame:
    """Control table with one row."""
    return spark.createDataFrame(
        pa.table(
            {
                "check_key": pa.array([check_key], pa.string()),
                "kind": pa.array([kind], pa.string()),
                "concept_id": pa.array([concept_id], pa.int64()),
                "unit_concept_id": pa.array([unit_concept_id], pa.int64()),
                "gender": pa.array([gender], pa.string()),
                "units": pa.array([units], pa.string()),
                "low": pa.array([low], pa.float64()),
                "high": pa.array([high], pa.float64()),
            }
        )
    )


def unit_list(text: Column) -> Column:
    """Plausible unit ids; NULL when the cell is blank or 'NA', i.e. when no unit is plausible. A
    part that is not a number fails the check and is not passed over."""
    parts = F.transform(F.split(text, ","), lambda part: F.trim(part).cast("bigint"))
    return F.when(~F.coalesce(F.trim(text), F.lit("")).isin(*NO_UNITS), parts)


IDS = ("concept_id", "unit_concept_id")


def _value_counts(control: DataFrame, counted: DataFrame) -> DataFrame:
    """Low and high checks from rows counted per concept, unit and place between the bounds.

    The i-th of the sorted bounds is broken, if low, by the rows with at most i bounds below them and,
    if high, by those with more. So the counts are put on one line with the checks, and running sums
    along it are the answers: no count meets more than one check."""
    line = [*IDS, "kind", "at", "n", CHECK_KEY]
    rules = control.where(F.col("kind").isin(LOW, HIGH) & F.col("concept_id").isNotNull() & F.col("unit_concept_id").isNotNull())
    bound = F.when(F.col("kind") == LOW, F.col("low")).otherwise(F.col("high"))
    order = Window.partitionBy(*IDS, "kind").orderBy(bound.asc_nulls_last())
    # A check without a bound is broken by nothing: it lies before all places if low, after all if high.
    place = F.when(bound.isNotNull(), F.dense_rank().over(order) - 1).when(F.col("kind") == LOW, -1).otherwise(2**31 - 1)
    asked = rules.select(*IDS, "kind", place.cast("int").alias("at"), F.lit(None).cast("bigint").alias("n"), CHECK_KEY)
    places = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(f"{kind}_at").alias("at")) for kind in (LOW, HIGH)])
    # Rows without a place are left out after the counting, so that the unit checks share its shuffle.
    found = counted.select(*IDS, "n", F.inline(places), F.lit(None).cast("string").alias(CHECK_KEY))
    found = found.where(F.col("at").isNotNull()).groupBy(*IDS, "kind", "at", CHECK_KEY).agg(F.sum("n").alias("n")).select(*line)
    whole = Window.partitionBy(*IDS, "kind")
    so_far = whole.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    total, upto = (F.coalesce(F.sum("n").over(w), F.lit(0)) for w in (whole, so_far))
    violated = F.when(F.col("kind") == LOW, F.col("upto")).otherwise(F.col("total") - F.col("upto"))
    answered = asked.select(*line).unionByName(found).withColumns({"total": total, "upto": upto})
    return answered.where(F.col(CHECK_KEY).isNotNull()).select(
        CHECK_KEY, violated.cast("bigint").alias(VIOLATED), F.col("total").cast("bigint").alias(DENOMINATOR)
    )


def _unit_counts(control: DataFrame, counted: DataFrame) -> DataFrame:
    """Unit checks from rows counted per concept and unit."""
    rules = control.where(F.col("kind") == UNITS).select(
        CHECK_KEY, F.col("concept_id").alias("rule_concept"), unit_list(F.col("units")).alias("unit_ids")
    )
    units = counted.groupBy(*IDS).agg(F.sum(F.when(F.col("has_source_unit"), F.col("n"))).alias("n"))
    units = units.where(F.col("n").isNotNull())
    unit = F.col("unit_concept_id")
    violated = F.when(F.col("unit_ids").isNull(), unit.isNotNull()).otherwise(~F.array_contains("unit_ids", unit))
    return (
        units.join(rules, F.col("concept_id") == F.col("rule_concept"))
        .groupBy(CHECK_KEY)
        .agg(tally(violated, F.col("n")).alias(VIOLATED), tally(None, F.col("n")).alias(DENOMINATOR))
    )


def count_value_checks(
    cdm: Cdm, table: str, field: str, control: DataFrame, cohort: Cohort | None = None
) -> DataFrame:
    """Unit and value checks of all control rows of (table, field) in one scan.

    The bounds of a concept and unit are one row with two sorted arrays, so a checked row meets one row,
    however many checks there are, and looks up its place between the bounds. Rows are counted per
    concept, unit and place before they move, and only the counts meet the checks."""
    rows = cdm.rows(table, cohort)
    facts = rows.df.where(col("value_as_number").isNotNull()).select(
        col(field).cast("bigint").alias("concept_id"),
        col("unit_concept_id").cast("bigint").alias("unit_concept_id"),
        col("value_as_number").alias("value"),
        col("unit_source_value").isNotNull().alias("has_source_unit"),
        rows.times.alias("times"),
    )
    own = F.col("concept_id").alias("own_concept")
    wanted = control.where((F.col("kind") != GENDER) & F.col("concept_id").isNotNull()).select(own).distinct()
    sorted_set = lambda kind: F.sort_array(F.collect_set(F.when(F.col("kind") == kind, F.col(kind))))
    bounds = (
        control.where(F.col("kind").isin(LOW, HIGH))
        .groupBy(own, F.col("unit_concept_id").alias("own_unit"))
        .agg(sorted_set(LOW).alias("lows"), sorted_set(HIGH).alias("highs"))
    )
    same = (F.col("concept_id") == F.col("own_concept")) & (F.col("unit_concept_id") == F.col("own_unit"))
    placed = facts.join(wanted, F.col("concept_id") == F.col("own_concept"), "left_semi").join(bounds, same, "left")
    placed = placed.where(F.col("has_source_unit") | F.col("lows").isNotNull())
    value = F.col("value")
    counted = (
        placed.select(
            *IDS, "has_source_unit", "times",
            F.when(F.col("lows").isNotNull(), leading(F.col("lows"), lambda low: low <= value)).alias("low_at"),
            F.when(F.col("highs").isNotNull(), leading(F.col("highs"), lambda high: high < value)).alias("high_at"),
        )
        .groupBy(*IDS, "has_source_unit", "low_at", "high_at")
        .agg(F.sum("times").alias("n"))
    )
    return _value_counts(control, counted).unionByName(_unit_counts(control, counted))


def count_gender_checks(
    cdm: Cdm, table: str, field: str, control: DataFrame, cohort: Cohort | None = None
) -> DataFrame:
    """Gender checks of all control rows of (table, field). Rows are counted per check and person
    first; the persons are reduced to one row each, so repeated persons multiply the violated rows
    (as an SQL join does) but never the denominator."""
    rows = cdm.rows(table, cohort)
    as_type = key_type([cdm.datatype(table, "person_id"), cdm.datatype("person", "person_id")])
    rules = control.where(F.col("kind") == GENDER).select(
        CHECK_KEY, "concept_id", (F.col("gender") == MALE).alias("for_men")
    )
    facts = rows.df.select(
        col(field).cast("bigint").alias("fact_concept"),
        col("person_id").cast(as_type).alias("key"),
        rows.times.alias("times"),
    )
    per_person = (
        facts.join(rules, F.col("fact_concept") == F.col("concept_id"))
        .groupBy(CHECK_KEY, "for_men", "key")
        .agg(F.sum("times").alias("times"))
    )
    gender = col("gender_concept_id")
    persons = (
        cdm["person"]
        .where(gender.isNotNull() & col("person_id").isNotNull())
        .groupBy(col("person_id").cast(as_type).alias("key"))
        .agg(
            F.count_if(gender != MALE_CONCEPT).alias("not_men"),
            F.count_if(gender != FEMALE_CONCEPT).alias("not_women"),
        )
    )
    wrong = F.when(F.col("for_men"), F.col("not_men")).otherwise(F.col("not_women"))
    return (
        per_person.join(persons, "key", "left")
        .groupBy(CHECK_KEY)
        .agg(
            F.coalesce(F.sum(F.col("times") * wrong), F.lit(0)).alias(VIOLATED),
            F.sum("times").alias(DENOMINATOR),
        )
    )


def count_concept_checks(
    cdm: Cdm,
    table: str,
    field: str,
    control: DataFrame,
    kinds: Sequence[str] = CONCEPT_KINDS,
    cohort: Cohort | None = None,
) -> DataFrame:
    """(check_key, violated, denominator) for every control row; concepts without rows give 0 of 0."""
    parts = []
    if set(kinds) - {GENDER}:
        parts.append(count_value_checks(cdm, table, field, control, cohort))
    if GENDER in kinds:
        parts.append(count_gender_checks(cdm, table, field, control, cohort))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return (
        control.where(F.col("kind").isin(*kinds))
        .select(CHECK_KEY)
        .join(found, CHECK_KEY, "left")
        .select(
            CHECK_KEY,
            F.coalesce(VIOLATED, F.lit(0)).cast("bigint").alias(VIOLATED),
            F.coalesce(DENOMINATOR, F.lit(0)).cast("bigint").alias(DENOMINATOR),
        )
    )


def _single(cdm, table, field, kind, concept_id, cohort, **params) -> DataFrame:
    df = cdm[table].where(col(field) == concept_id)
    narrowed = cdm.with_table(table, df)
    control = concept_control(df.sparkSession, "", kind, concept_id, **params)
    return check_counts(count_concept_checks(narrowed, table, field, control, (kind,), cohort))


def concept_plausible_gender(
    cdm: Cdm, table: str, field: str, concept_id: int, gender: str, cohort: Cohort | None = None
) -> DataFrame:
    """Rows of a concept owned by a person of another gender, of the rows of the concept. Any
    gender but 'Male' stands for women; persons without a gender pass."""
    return _single(cdm, table, field, GENDER, concept_id, cohort, gender=gender)


def concept_plausible_unit_concept_ids(
    cdm: Cdm,
    table: str,
    field: str,
    concept_id: int,
    units: str | Sequence[int],
    cohort: Cohort | None = None,
) -> DataFrame:
    """Measured rows of a concept with an implausible unit. ``''`` and ``'NA'``: no unit is
    plausible. Rows without a unit pass."""
    text = units if isinstance(units, str) else ",".join(split_list(list(units)))
    return _single(cdm, table, field, UNITS, concept_id, cohort, units=text)


def concept_plausible_value_low(
    cdm: Cdm,
    table: str,
    field: str,
    concept_id: int,
    unit_concept_id: int,
    low: float,
    cohort: Cohort | None = None,
) -> DataFrame:
    """Measured rows of a concept and unit below the lowest plausible value."""
    return _single(
        cdm, table, field, LOW, concept_id, cohort, unit_concept_id=unit_concept_id, low=low
    )


def concept_plausible_value_high(
    cdm: Cdm,
    table: str,
    field: str,
    concept_id: int,
    unit_concept_id: int,
    high: float,
    cohort: Cohort | None = None,
) -> DataFrame:
    """Measured rows of a concept and unit above the highest plausible value."""
    return _single(
        cdm, table, field, HIGH, concept_id, cohort, unit_concept_id=unit_concept_id, high=high
    )
