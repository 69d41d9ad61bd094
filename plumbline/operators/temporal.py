"""Checks that compare a date with dates of another table: birth, death, visits.

SQL joins the tables and compares every pair. Only the number of violating pairs is wanted, so no
pair is built here. The partner is reduced to one row per key (person or visit): its limits in
order, each with the number of limits up to it. A checked row meets that one row and looks up how
many limits lie before its date, by binary search where the date lies between the first and the
last limit. So the checked rows move once, with nothing but key and dates, and the join has one row
on its other side: adaptive execution can split a key that dominates. Places on the time line are
bounded by the calendar, and so is the list of a key, however many rows the partner has. All date
fields and all partners of a table share one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.counting import check_counts, col, tally, to_long
from plumbline.functions.search import leading
from plumbline.functions.values import as_date, has_time_of_day
from plumbline.operators.lookup import key_type
from plumbline.operators.rowwise import (
    BIRTH_TABLE,
    birth_date,
    count_rules,
    own_date_order_rule,
)
from plumbline.sources.cdm import Cdm, Cohort, spread

KEY, AT = "key", "at"
PERSON_KEY, VISIT_KEY = "person_id", "visit_occurrence_id"
DEATH_TABLE, DEATH_FIELD = "death", "death_date"
VISIT_TABLE, VISIT_START, VISIT_END = "visit_occurrence", "visit_start_date", "visit_end_date"
DAYS_AFTER_DEATH = 60
DAYS_AROUND_VISIT = 7
# Place before every date, for limits that are always passed.
FIRST = -(2**62)


def day_position(date: Column) -> Column:
    """Place of a day on the time line. Days take even places; see ``moment_position``."""
    return F.unix_date(date).cast("bigint") * 2


def moment_position(cdm: Cdm, table: str, field: str) -> Column:
    """Place of a value that may hold a time of day: later than midnight is the odd place between
    its day and the next, so it is later than the day itself. Two places per day are enough to
    compare with days, and keep the number of places bounded by the calendar."""
    day = as_date(col(field))
    if not has_time_of_day(cdm.datatype(table, field)):
        return day_position(day)
    moment = col(field).try_cast("timestamp_ntz")
    late = F.when(moment > day.cast("timestamp_ntz"), 1).otherwise(0)
    return day_position(day) + late


@dataclass(frozen=True)
class Limits:
    """Limits of the partner on the time line: key, place, and measures to be summed."""

    df: DataFrame
    measures: tuple[str, ...]


def before(measure: str, place: Column) -> Column:
    """Number of limits before a place that is not NULL. Most keys have one limit, and most dates
    lie outside of several: then nothing is searched."""
    first, last = F.col(f"first_{measure}"), F.col(f"last_{measure}")
    limits = F.col(f"all_{measure}")
    return (
        F.when(first.isNull() | (place <= first), F.lit(0).cast("bigint"))
        .when(place > last, F.col(f"n_{measure}"))
        .otherwise(F.get(limits, leading(limits, lambda limit: limit["at"] < place) - 1)["upto"])
    )


def total(measure: str) -> Column:
    """Number of limits of the key."""
    return F.coalesce(F.col(f"n_{measure}"), F.lit(0).cast("bigint"))


def partner_rows(limits: Sequence[Limits]) -> DataFrame:
    """One row per key with the limits of all partners: per measure its number, first and last place
    and, where there are several places, the sorted list of (at, upto).

    The second, redundant key makes Spark deal the rows out again right below the join, without
    which adaptive execution does not split a key that dominates the checked rows."""
    measures = [m for part in limits for m in part.measures]
    stacked = limits[0].df
    for part in limits[1:]:
        stacked = stacked.unionByName(part.df, allowMissingColumns=True)
    keys = [KEY, "spread"]
    by_place = stacked.groupBy(KEY, spread(KEY).alias("spread"), AT).agg(*[F.sum(m).alias(m) for m in measures])
    so_far = Window.partitionBy(*keys).orderBy(AT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    by_place = by_place.select("*", *[F.sum(m).over(so_far).alias(f"upto_{m}") for m in measures])
    summary, lists = [], []
    for m in measures:
        there = F.when(F.col(m) > 0, F.col(AT))
        pair = F.when(F.col(m) > 0, F.struct(F.col(AT).alias("at"), F.col(f"upto_{m}").alias("upto")))
        summary += [
            F.sum(m).alias(f"n_{m}"),
            F.min(there).alias(f"first_{m}"),
            F.max(there).alias(f"last_{m}"),
            F.collect_list(pair).alias(f"all_{m}"),
        ]
        several = F.col(f"first_{m}") < F.col(f"last_{m}")
        lists.append(F.when(several, F.sort_array(f"all_{m}")).alias(f"all_{m}"))
    kept = [f"{kind}_{m}" for m in measures for kind in ("n", "first", "last")]
    return by_place.groupBy(*keys).agg(*summary).select(KEY, *kept, *lists)


def _one() -> Column:
    return F.lit(1).cast("bigint")


def person_limits(
    cdm: Cdm, table: str, field: str, prefix: str, as_type: str, person_key: str = PERSON_KEY
) -> Limits:
    """Dates that must not lie after the checked date: birth, or a date field of another table."""
    earliest = birth_date(field) if table.lower() == BIRTH_TABLE else as_date(col(field))
    df = (
        cdm[table]
        .select(
            col(person_key).cast(as_type).alias(KEY),
            day_position(earliest).alias(AT),
            _one().alias(f"{prefix}_from"),
        )
        .where(F.col(KEY).isNotNull() & F.col(AT).isNotNull())
    )
    return Limits(df, (f"{prefix}_from",))


def _two_events(rows: DataFrame, first: dict[str, Column], second: dict[str, Column]) -> DataFrame:
    """Two limits for each row; measures that one of them lacks are NULL, and a limit without a
    place does not exist."""
    names = list(dict.fromkeys([*first, *second]))

    def event(values: dict[str, Column]) -> Column:
        return F.struct(
            *[values.get(name, F.lit(None).cast("bigint")).alias(name) for name in names]
        )

    events = rows.select(KEY, F.inline(F.array(event(first), event(second))))
    return events.where(F.col(KEY).isNotNull() & F.col(AT).isNotNull())


def death_limits(
    cdm: Cdm,
    prefix: str,
    as_type: str,
    days: int = DAYS_AFTER_DEATH,
    table: str = DEATH_TABLE,
    field: str = DEATH_FIELD,
    person_key: str = PERSON_KEY,
) -> Limits:
    """Last plausible day after each death, and a mark of the dead person."""
    last = day_position(F.date_add(as_date(col(field)), days))
    deaths = cdm[table].select(col(person_key).cast(as_type).alias(KEY), last.alias("last"))
    df = _two_events(
        deaths,
        {AT: F.lit(FIRST), f"{prefix}_dead": _one()},
        {AT: F.col("last"), f"{prefix}_until": _one()},
    )
    return Limits(df, (f"{prefix}_dead", f"{prefix}_until"))


def visit_limits(
    cdm: Cdm,
    prefix: str,
    as_type: str,
    days: int = DAYS_AROUND_VISIT,
    table: str = VISIT_TABLE,
    visit_key: str = VISIT_KEY,
    start: str = VISIT_START,
    end: str = VISIT_END,
) -> Limits:
    """First and last plausible day of each visit; exactly one first day, so that these count the
    visits. Without a start nothing is too early: the first day is before every date. Where the
    last day comes before the first, no date fits: both are put before every date, so that each is
    too late and none is too early as well, and the two counts can be added."""
    visits = cdm[table].select(
        col(visit_key).cast(as_type).alias(KEY),
        day_position(F.date_sub(as_date(col(start)), days)).alias("first"),
        day_position(F.date_add(as_date(col(end)), days)).alias("last"),
    )
    impossible = F.col("last") < F.col("first")
    df = _two_events(
        visits,
        {
            AT: F.when(impossible | F.col("first").isNull(), FIRST).otherwise(F.col("first")),
            f"{prefix}_from": _one(),
        },
        {
            AT: F.when(impossible, FIRST).otherwise(F.col("last")),
            f"{prefix}_until": _one(),
        },
    )
    return Limits(df, (f"{prefix}_from", f"{prefix}_until"))


@dataclass(frozen=True)
class DateCheck:
    """Date check of a field: ``kind`` is ``after`` (with the earlier table and field),
    ``life`` or ``visit``."""

    field: str
    kind: str
    earlier_table: str | None = None
    earlier_field: str | None = None


def count_date_checks(
    cdm: Cdm, table: str, checks: Mapping[str, DateCheck], cohort: Cohort | None = None
) -> DataFrame:
    """All date checks of one table that share the partner key (person, or visit) in one pass."""
    by_visit = {check.kind == "visit" for check in checks.values()}
    if len(by_visit) != 1:
        raise ValueError("date checks by person and by visit are counted separately")
    key_name = VISIT_KEY if by_visit.pop() else PERSON_KEY
    partners = {
        VISIT_TABLE if c.kind == "visit" else DEATH_TABLE if c.kind == "life" else c.earlier_table
        for c in checks.values()
    }
    as_type = key_type([cdm.datatype(name, key_name) for name in [table, *sorted(partners)]])

    fields = list(dict.fromkeys(check.field.lower() for check in checks.values()))
    slot_of = {field: f"slot{i}" for i, field in enumerate(fields)}
    points = {
        slot: moment_position(cdm, table, field)
        if key_name == VISIT_KEY
        else day_position(as_date(col(field)))
        for field, slot in slot_of.items()
    }
    limits: dict[tuple, Limits] = {}
    prefix_of: dict[tuple, str] = {}

    def partner(check: DateCheck) -> str:
        ident = (check.kind, (check.earlier_table or "").lower(), (check.earlier_field or "").lower())
        if ident not in limits:
            prefix = prefix_of[ident] = f"p{len(limits)}"
            if check.kind == "after":
                limits[ident] = person_limits(
                    cdm, check.earlier_table, check.earlier_field, prefix, as_type
                )
            elif check.kind == "life":
                limits[ident] = death_limits(cdm, prefix, as_type)
            else:
                limits[ident] = visit_limits(cdm, prefix, as_type)
        return prefix_of[ident]

    rows, key = cdm.rows(table, cohort), "__key"
    facts = rows.df.select(
        col(key_name).cast(as_type).alias(key),
        *[place.alias(slot) for slot, place in points.items()],
        rows.times.alias("times"),
    )
    prefixes = [partner(check) for check in checks.values()]
    partners = partner_rows(list(limits.values()))
    met = facts.join(partners, F.col(key) == F.col(KEY), "left")
    times, cells, pairs = F.col("times"), {}, {}
    for (name, check), prefix in zip(checks.items(), prefixes):
        place = F.col(slot_of[check.field.lower()])
        since, until = f"{prefix}_from", f"{prefix}_until"
        # Limits after a date are those that are not before the next place.
        too_early = lambda: times * (total(since) - before(since, place + 1))  # noqa: B023, E731
        too_late = lambda: times * before(until, place)  # noqa: B023, E731
        if check.kind == "after":
            violated, judged = too_early(), times
        elif check.kind == "life":
            violated, judged = too_late(), F.when(total(f"{prefix}_dead") > 0, times)
        else:
            violated, judged = too_early() + too_late(), times * total(since)
        cells[f"v{len(pairs)}"] = F.when(place.isNotNull(), violated)
        cells[f"d{len(pairs)}"] = judged
        pairs[name] = tuple(tally(None, F.col(f"{kind}{len(pairs)}")) for kind in "vd")
    return to_long(met.select([cell.alias(name) for name, cell in cells.items()]), pairs)


def plausible_temporal_after(
    cdm: Cdm,
    table: str,
    field: str,
    earlier_table: str,
    earlier_field: str,
    cohort: Cohort | None = None,
) -> DataFrame:
    """Rows dated before the date that must come first, of all rows. The earlier date is taken
    from the same row, from the person's birth, or from another table by person."""
    if earlier_table.lower() == table.lower():
        rule = own_date_order_rule(table, field, earlier_field)
        return check_counts(count_rules(cdm.rows(table, cohort), {"": rule}))
    check = DateCheck(field, "after", earlier_table, earlier_field)
    return check_counts(count_date_checks(cdm, table, {"": check}, cohort))


def plausible_during_life(
    cdm: Cdm, table: str, field: str, cohort: Cohort | None = None
) -> DataFrame:
    """Rows dated more than 60 days after death, of the rows of dead persons."""
    return check_counts(count_date_checks(cdm, table, {"": DateCheck(field, "life")}, cohort))


def within_visit_dates(
    cdm: Cdm, table: str, field: str, cohort: Cohort | None = None
) -> DataFrame:
    """Rows dated more than a week before or after their visit, of the rows with a visit."""
    return check_counts(count_date_checks(cdm, table, {"": DateCheck(field, "visit")}, cohort))
