"""Counts against plain Python over every pair of rows: duplicates, NULLs, hot keys, odd dates."""

import random
from collections import Counter
from datetime import date, datetime, timedelta

import pytest

from conftest import counts
from plumbline.operators import concepts, keyed, lookup, rowwise, temporal, violations
from plumbline.sources.cdm import Cdm, Cohort

random.seed(11)
START = date(2000, 1, 1)
HOT = 1


def maybe(value, share=0.1):
    return None if random.random() < share else value


def key(n=40):
    """A third of all keys is the same one."""
    return maybe(HOT if random.random() < 0.35 else random.randint(1, n))


def day(spread=200):
    return maybe(START + timedelta(days=random.randint(0, spread)))


def moment():
    clock = random.choice([timedelta(0), timedelta(hours=random.randint(0, 23))])
    picked = day()
    return picked and datetime.combine(picked, datetime.min.time()) + clock


FACTS = [
    (i % 450, key(), key(), random.choice([0, 0, None, 1, 2, 3, 4, 5, 6]),
     random.choice([0, None, 1, 2]), day(), day(), moment(),
     maybe(float(random.randint(0, 9))), random.choice([None, 0, 1, 2]),
     random.choice([None, "", "mg"]), random.choice(["a", "b", None, "c", "d"]))
    for i in range(600)
]
FACT_SCHEMA = (
    "fact_id int, person_id bigint, visit_occurrence_id bigint, c_concept_id int, "
    "s_concept_id int, d date, e date, t timestamp_ntz, value_as_number double, "
    "unit_concept_id int, unit_source_value string, source string"
)
NAMES = [part.split()[0] for part in FACT_SCHEMA.split(", ")]
PERSONS = [
    (key(), random.choice([8507, 8532, None]), maybe(random.randint(1999, 2001)), maybe(day(), 0.4))
    for _ in range(80)
]
DEATHS = [(key(30), day(90)) for _ in range(25)]
VISITS = []
for _ in range(120):
    first = day()
    last = first and maybe(first + timedelta(days=random.randint(-40, 30)))
    VISITS.append((key(), first, last or day()))
CONCEPTS = [
    (random.choice([None, 0, 1, 2, 3, 4]), random.choice(["Drug", "Visit", None]),
     random.choice(["x", "y", None]), random.choice(["S", "C", None]), random.choice([None, "D"]))
    for _ in range(15)
]
COHORT = [(key(), random.choice([1, 2])) for _ in range(60)]


@pytest.fixture(scope="module")
def cdm(frame):
    return Cdm(
        {
            "FACT": frame(FACT_SCHEMA, FACTS),
            "person": frame(
                "person_id bigint, gender_concept_id int, year_of_birth int, birth date", PERSONS
            ),
            "death": frame("person_id int, death_date date", DEATHS),
            "visit_occurrence": frame(
                "visit_occurrence_id bigint, visit_start_date date, visit_end_date date", VISITS
            ),
            "concept": frame(
                "concept_id bigint, domain_id string, concept_class_id string, "
                "standard_concept string, invalid_reason string",
                CONCEPTS,
            ),
            "empty": frame(FACT_SCHEMA, []),
        }
    )


@pytest.fixture(scope="module", params=[False, True], ids=["all", "cohort"])
def scope(request, frame):
    """The facts that count, once per membership, and the cohort or None."""
    if not request.param:
        return [dict(zip(NAMES, row)) for row in FACTS], None
    members = frame("subject_id bigint, cohort_definition_id int", COHORT)
    times = Counter(s for s, c in COHORT if c == 1 and s is not None)
    rows = [dict(zip(NAMES, row)) for row in FACTS]
    return [row for row in rows for _ in range(times[row["person_id"]])], Cohort(members, 1)


def below(a, b):
    return a is not None and b is not None and a < b


def test_required(cdm, scope):
    facts, cohort = scope
    expected = sum(row["d"] is None for row in facts), len(facts)
    assert counts(rowwise.is_required(cdm, "fact", "D", cohort)) == expected
    assert violations.is_required(cdm, "fact", "d", cohort).count() == expected[0]


def test_unmapped(cdm, scope):
    facts, cohort = scope
    bad = [r for r in facts if not r["c_concept_id"] and not r["s_concept_id"]]
    args = (cdm, "fact", "c_concept_id", "s_concept_id", cohort)
    assert counts(rowwise.table_concept_completeness(*args)) == (len(bad), len(facts))
    assert violations.table_concept_completeness(*args).count() == len(bad)


def test_primary_key(cdm, scope):
    facts, cohort = scope
    times = Counter(row[0] for row in FACTS)
    bad = [row for row in facts if times[row["fact_id"]] > 1]
    args = (cdm, "fact", "fact_id", cohort)
    assert counts(keyed.is_primary_key(*args)) == (len(bad), len(facts))
    assert violations.is_primary_key(*args).count() == len(bad)


def test_null_is_no_duplicate_key(cdm):
    times = Counter(row[1] for row in FACTS)
    bad = sum(n for value, n in times.items() if value is not None and n > 1)
    assert counts(keyed.is_primary_key(cdm, "fact", "person_id")) == (bad, len(FACTS))


def test_source_values(cdm, scope):
    facts, cohort = scope
    every = {row["source"] for row in facts}
    unmapped = {row["source"] for row in facts if row["c_concept_id"] == 0}
    args = (cdm, "fact", "source", "c_concept_id", cohort)
    assert counts(keyed.source_value_completeness(*args)) == (len(unmapped), len(every))
    assert violations.source_value_completeness(*args).count() == len(unmapped)


def test_foreign_key(cdm, scope):
    facts, cohort = scope
    known = {row[0] for row in CONCEPTS}
    bad = [r for r in facts if r["c_concept_id"] is not None and r["c_concept_id"] not in known]
    args = (cdm, "fact", "c_concept_id", "CONCEPT", "CONCEPT_ID", cohort)
    assert counts(lookup.is_foreign_key(*args)) == (len(bad), len(facts))
    assert violations.is_foreign_key(*args).count() == len(bad)


BROKEN = {
    "domain": lambda c: c[1] is not None and c[1] not in ("Drug", "Device"),
    "class": lambda c: c[2] is not None and c[2] != "x",
    "standard": lambda c: (c[3] is not None and c[3] != "S") or c[4] is not None,
}


@pytest.mark.parametrize("rule", list(BROKEN))
def test_vocabulary(cdm, scope, rule):
    """Repeated concepts repeat the violation, as in a join."""
    facts, cohort = scope
    bad = sum(
        1
        for row in facts
        for c in CONCEPTS
        if c[0] and c[0] == row["c_concept_id"] and BROKEN[rule](c)
    )
    module = {
        "domain": lambda m: m.fk_domain(cdm, "fact", "c_concept_id", "Drug','Device", cohort),
        "class": lambda m: m.fk_class(cdm, "fact", "c_concept_id", "x", cohort),
        "standard": lambda m: m.is_standard_valid_concept(cdm, "fact", "c_concept_id", cohort),
    }[rule]
    assert counts(module(lookup)) == (bad, len(facts))
    assert module(violations).count() == bad


def test_persons_without_rows(cdm, scope):
    _, cohort = scope
    times = Counter(s for s, c in COHORT if c == 1)
    persons = [p for p in PERSONS for _ in range(times[p[0]] if cohort else 1)]
    if cohort:
        persons = [p for p in persons if p[0] is not None]
    dead = {row[0] for row in DEATHS}
    bad = [p for p in persons if p[0] is not None and p[0] not in dead]
    found = lookup.person_completeness(cdm, "death", cohort=cohort)
    assert counts(found) == (len(bad), len(persons))
    listed = violations.person_completeness(cdm, "death", cohort=cohort)
    assert listed.where("person_id IS NOT NULL").count() == len(bad)


def test_era_persons(cdm, scope):
    facts, cohort = scope
    seen = {row["person_id"] for row in facts} - {None}
    found = lookup.condition_era_completeness(cdm, "death", "fact", cohort)
    assert counts(found) == (len(seen - {row[0] for row in DEATHS}), len(seen))


def birth(person):
    return person[3] or (person[2] and date(person[2], 6, 1))


@pytest.mark.parametrize("field", ["d", "t"])
def test_after_birth(cdm, scope, field):
    facts, cohort = scope
    bad = 0
    for row in facts:
        when = row[field].date() if isinstance(row[field], datetime) else row[field]
        bad += sum(below(when, birth(p)) for p in PERSONS if p[0] and p[0] == row["person_id"])
    args = (cdm, "fact", field, "PERSON", "BIRTH", cohort)
    assert counts(temporal.plausible_temporal_after(*args)) == (bad, len(facts))
    assert violations.plausible_temporal_after(*args).count() == bad


def test_after_own_date(cdm, scope):
    facts, cohort = scope
    bad = sum(below(row["e"], row["d"]) for row in facts)
    args = (cdm, "fact", "e", "FACT", "d", cohort)
    assert counts(temporal.plausible_temporal_after(*args)) == (bad, len(facts))
    assert violations.plausible_temporal_after(*args).count() == bad


def test_person_after_own_birth(cdm):
    bad = sum(below(p[3], birth(p)) for p in PERSONS)
    found = temporal.plausible_temporal_after(cdm, "person", "birth", "PERSON", "birth")
    assert counts(found) == (bad, len(PERSONS))


def test_during_life(cdm, scope):
    facts, cohort = scope
    grace = timedelta(days=60)
    dead = {row[0] for row in DEATHS} - {None}
    bad = sum(
        below(last + grace, row["d"])
        for row in facts
        for person, last in DEATHS
        if person is not None and last is not None and person == row["person_id"]
    )
    args = (cdm, "fact", "d", cohort)
    total = sum(row["person_id"] in dead for row in facts)
    assert counts(temporal.plausible_during_life(*args)) == (bad, total)
    assert violations.plausible_during_life(*args).count() == bad


@pytest.mark.parametrize("field", ["d", "t"])
def test_within_visit(cdm, scope, field):
    """Open visits, visits that end long before they start, and times of day on the last day."""
    facts, cohort = scope
    week, bad, total = timedelta(days=7), 0, 0
    for row in facts:
        for visit, first, last in VISITS:
            if visit is None or visit != row["visit_occurrence_id"]:
                continue
            total += 1
            when = row[field]
            if isinstance(when, datetime):
                first = first and datetime.combine(first, datetime.min.time())
                last = last and datetime.combine(last, datetime.min.time())
            bad += below(when, first and first - week) or below(last and last + week, when)
    args = (cdm, "fact", field, cohort)
    assert counts(temporal.within_visit_dates(*args)) == (bad, total)
    assert violations.within_visit_dates(*args).count() == bad


def test_date_checks_together(cdm, scope):
    """Several fields and partners in one pass give the counts of single checks."""
    _, cohort = scope
    checks = {
        "d_birth": temporal.DateCheck("d", "after", "person", "birth"),
        "e_birth": temporal.DateCheck("e", "after", "person", "birth"),
        "d_life": temporal.DateCheck("d", "life"),
        "e_death": temporal.DateCheck("e", "after", "death", "death_date"),
    }
    together = {
        row[0]: (row[1], row[2])
        for row in temporal.count_date_checks(cdm, "fact", checks, cohort).collect()
    }
    for name, check in checks.items():
        alone = temporal.count_date_checks(cdm, "fact", {name: check}, cohort).first()
        assert together[name] == (alone[1], alone[2])


def test_gender(cdm, scope):
    facts, cohort = scope
    for gender, expected in (("Male", 8507), ("Female", 8532), ("Other", 8532)):
        rows = [row for row in facts if row["c_concept_id"] == 2]
        bad = sum(
            1
            for row in rows
            for p in PERSONS
            if p[0] and p[0] == row["person_id"] and p[1] and p[1] != expected
        )
        args = (cdm, "fact", "c_concept_id", 2, gender, cohort)
        assert counts(concepts.concept_plausible_gender(*args)) == (bad, len(rows))
        assert violations.concept_plausible_gender(*args).count() == bad


@pytest.mark.parametrize("units", ["1,2", "", "NA", [0]])
def test_units(cdm, scope, units):
    facts, cohort = scope
    allowed = {"1,2": {1, 2}, "": set(), "NA": set()}.get(units if isinstance(units, str) else 0, {0})
    rows = [
        r
        for r in facts
        if r["c_concept_id"] == 0
        and r["value_as_number"] is not None
        and r["unit_source_value"] is not None
    ]
    bad = [r for r in rows if r["unit_concept_id"] is not None and r["unit_concept_id"] not in allowed]
    args = (cdm, "fact", "c_concept_id", 0, units, cohort)
    assert counts(concepts.concept_plausible_unit_concept_ids(*args)) == (len(bad), len(rows))
    assert violations.concept_plausible_unit_concept_ids(*args).count() == len(bad)


def test_values(cdm, scope):
    facts, cohort = scope
    rows = [
        r["value_as_number"]
        for r in facts
        if r["c_concept_id"] == 0 and r["unit_concept_id"] == 1 and r["value_as_number"] is not None
    ]
    low = (cdm, "fact", "c_concept_id", 0, 1, 3, cohort)
    assert counts(concepts.concept_plausible_value_low(*low)) == (
        sum(v < 3 for v in rows),
        len(rows),
    )
    assert counts(concepts.concept_plausible_value_high(*low)) == (
        sum(v > 3 for v in rows),
        len(rows),
    )
    assert violations.concept_plausible_value_low(*low).count() == sum(v < 3 for v in rows)
    assert violations.concept_plausible_value_high(*low).count() == sum(v > 3 for v in rows)


def test_empty_table(cdm):
    assert counts(rowwise.is_required(cdm, "empty", "d")) == (0, 0)
    assert counts(keyed.is_primary_key(cdm, "empty", "fact_id")) == (0, 0)
    assert counts(keyed.source_value_completeness(cdm, "empty", "source", "c_concept_id")) == (0, 0)
    assert counts(lookup.fk_domain(cdm, "empty", "c_concept_id", "Drug")) == (0, 0)
    assert counts(temporal.within_visit_dates(cdm, "empty", "d")) == (0, 0)
    assert counts(concepts.concept_plausible_gender(cdm, "empty", "c_concept_id", 2, "Male")) == (
        0,
        0,
    )


def test_keys_of_different_types(frame):
    """Integers, decimals and text are compared by value, and no value is lost in between."""
    cdm = Cdm(
        {
            "a": frame("n int, s string", [(1, "1"), (2, "x"), (None, None), (3, "2")]),
            "b": frame("k bigint", [(1,), (2,)]),
            "c": frame("k decimal(20,0)", [(1,), (2,)]),
        }
    )
    assert counts(lookup.is_foreign_key(cdm, "a", "n", "b", "k")) == (1, 4)
    assert counts(lookup.is_foreign_key(cdm, "a", "n", "c", "k")) == (1, 4)
    assert counts(lookup.is_foreign_key(cdm, "a", "s", "b", "k")) == (1, 4)


def test_datatype_of_columns(frame):
    df = frame("i int, d double, s string", [(1, 1.5, "1.5"), (None, None, "one"), (2, 2.0, None)])
    cdm = Cdm({"a": df})
    assert counts(rowwise.cdm_datatype(cdm, "a", "i")) == (0, 3)
    assert counts(rowwise.cdm_datatype(cdm, "a", "d")) == (0, 3)
    assert counts(rowwise.cdm_datatype(cdm, "a", "s")) == (1, 3)


def test_ranges(cdm, scope):
    facts, cohort = scope
    edge = START + timedelta(days=100)
    dated = [row["d"] for row in facts if row["d"] is not None]
    args = (cdm, "fact", "d", edge.isoformat(), "date", cohort)
    low, high = sum(d < edge for d in dated), sum(d > edge for d in dated)
    assert counts(rowwise.plausible_value_low(*args)) == (low, len(dated))
    assert counts(rowwise.plausible_value_high(*args)) == (high, len(dated))
    assert violations.plausible_value_low(*args).count() == low
    assert violations.plausible_value_high(*args).count() == high


def test_zero_concepts_of_units_need_a_value(frame):
    rows = [(0, 1.0), (0, None), (3, 2.0), (None, 1.0)]
    df = frame("unit_concept_id int, value_as_number double", rows)
    cdm = Cdm({"measurement": df, "drug": df})
    check = rowwise.concept_record_completeness
    assert counts(check(cdm, "MEASUREMENT", "UNIT_CONCEPT_ID")) == (1, 3)
    assert counts(check(cdm, "drug", "unit_concept_id")) == (2, 4)
