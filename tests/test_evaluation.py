"""Verdicts: one stored result per rule, judged by hand."""

import pytest
from pyspark.sql import functions as F

from plumbline.functions.counting import pct_ratio
from plumbline.operators.evaluation import control_thresholds, evaluate, threshold_lookup
from plumbline.operators.report import overview, report_view, status_column
from plumbline.sources.control import Controls

SCHEMA = (
    "id string, check_level string, check_name string, cdm_table_name string, "
    "cdm_field_name string, concept_id string, unit_concept_id string, "
    "num_violated_rows bigint, num_denominator_rows bigint, error string, "
    "threshold_value double, category string"
)
C, P, L = "Conformance", "Plausibility", "Completeness"
GOLDENS = [
    ("g01", "TABLE", "cdmTable", "PERSON", None, None, None, 0, 1, None, None, C),
    ("g02", "TABLE", "cdmTable", "NOTE", None, None, None, 1, 1, None, None, C),
    ("g03", "FIELD", "cdmField", "NOTE", "note_id", None, None, None, None, None, 0.0, C),
    ("g04", "FIELD", "isRequired", "NOTE", "note_id", None, None, None, None, None, 0.0, C),
    ("g05", "FIELD", "cdmField", "PERSON", "foo", None, None, 1, 1, None, 0.0, C),
    ("g06", "FIELD", "isRequired", "PERSON", "foo", None, None, None, None, None, 0.0, C),
    ("g07", "TABLE", "cdmTable", "SPECIMEN", None, None, None, 0, 1, None, None, C),
    ("g08", "FIELD", "measureValueCompleteness", "SPECIMEN", "specimen_id", None, None, 0, 0,
     None, 0.0, L),
    ("g09", "FIELD", "isPrimaryKey", "SPECIMEN", "specimen_id", None, None, 0, 0, None, 0.0, C),
    ("g10", "FIELD", "measureValueCompleteness", "PERSON", "location_id", None, None, 100, 100,
     None, 100.0, L),
    ("g11", "FIELD", "isForeignKey", "PERSON", "location_id", None, None, 0, 100, None, 0.0, C),
    ("g12", "FIELD", "isRequired", "PERSON", "location_id", None, None, 100, 100, None, 0.0, C),
    ("g13", "FIELD", "fkDomain", "PERSON", "race_concept_id", None, None, 5, 100, None, 5.0, C),
    ("g14", "FIELD", "fkDomain", "PERSON", "gender_concept_id", None, None, 7, 100, None, 7.0, C),
    ("g15", "FIELD", "isStandardValidConcept", "PERSON", "race_concept_id", None, None, None,
     None, "boom", 5.0, C),
    ("g16", "CONCEPT", "plausibleGender", "MEASUREMENT", "measurement_concept_id", "7", None, 0,
     0, None, 5.0, P),
    ("g17", "CONCEPT", "plausibleUnitConceptIds", "MEASUREMENT", "measurement_concept_id", "7",
     "2", 0, 0, None, 5.0, P),
    ("g18", "FIELD", "sourceValueCompleteness", "PERSON", "race_source_value", None, None, 1, 50,
     None, None, L),
    ("g19", "FIELD", "plausibleValueLow", "PERSON", "year_of_birth", None, None, 0, 100, None,
     None, P),
]
EXPECTED = {
    "g01": ("PASS", None),
    "g02": ("FAIL", None),
    "g03": ("NOT APPLICABLE", "Table NOTE does not exist."),
    "g04": ("NOT APPLICABLE", "Table NOTE does not exist."),
    "g05": ("FAIL", None),
    "g06": ("NOT APPLICABLE", "Field PERSON.foo does not exist."),
    "g07": ("PASS", None),
    "g08": ("NOT APPLICABLE", "Table SPECIMEN is empty."),
    "g09": ("NOT APPLICABLE", "Table SPECIMEN is empty."),
    "g10": ("PASS", None),
    "g11": ("NOT APPLICABLE", "Field PERSON.location_id is not populated."),
    "g12": ("FAIL", None),
    "g13": ("PASS", None),
    "g14": ("FAIL", None),
    "g15": ("ERROR", None),
    "g16": (
        "NOT APPLICABLE",
        "measurement_concept_id=7 is missing from the MEASUREMENT table.",
    ),
    "g17": (
        "NOT APPLICABLE",
        "Combination of measurement_concept_id=7, UNIT_CONCEPT_ID=2 and VALUE_AS_NUMBER IS NOT "
        "NULL is missing from the MEASUREMENT table.",
    ),
    "g18": ("FAIL", None),
    "g19": ("PASS", None),
}
OVERVIEW = {
    "countTotal": 19,
    "countThresholdFailed": 5,
    "countErrorFailed": 1,
    "countOverallFailed": 5,
    "countPassed": 14,
    "countTotalConformance": 13,
    "countFailedConformance": 4,
    "countPassedConformance": 3,
    "countTotalCompleteness": 3,
    "countFailedCompleteness": 1,
    "countPassedCompleteness": 1,
    "countTotalPlausibility": 3,
    "countFailedPlausibility": 0,
    "countPassedPlausibility": 1,
}


def stored(frame):
    share = pct_ratio(F.col("num_violated_rows"), F.col("num_denominator_rows"))
    return frame(SCHEMA, GOLDENS).withColumn("pct_violated_rows", share)


def verdicts(judged, *keys):
    rows = judged.select(*keys, "id", status_column().alias("s"), "not_applicable_reason")
    return {tuple(row)[:-2]: tuple(row)[-2:] for row in rows.collect()}


def test_goldens(frame):
    found = verdicts(evaluate(stored(frame)))
    assert found == {(key,): value for key, value in EXPECTED.items()}


def test_overview(frame):
    assert overview(evaluate(stored(frame))).first().asDict() == OVERVIEW


def test_runs_do_not_touch_each_other(frame):
    """Three runs in one history: the second lacks the missing table, the third the empty field."""
    rows = stored(frame)
    history = rows.withColumn("run_id", F.lit(1))
    history = history.unionByName(rows.where("id != 'g02'").withColumn("run_id", F.lit(2)))
    history = history.unionByName(rows.where("id != 'g10'").withColumn("run_id", F.lit(3)))
    found = verdicts(evaluate(history, ["run_id"]), "run_id")
    assert {k[1]: v for k, v in found.items() if k[0] == 1} == EXPECTED
    assert found[2, "g04"] == ("ERROR", None)  # no counts, and nothing says why: it did not run
    assert found[3, "g11"] == ("PASS", None)
    assert found[3, "g04"] == EXPECTED["g04"]


def test_repeated_results_are_judged_each(frame):
    """A missing table that is reported twice marks the other checks once each."""
    rows = stored(frame)
    twice = rows.unionByName(rows.where("id in ('g02', 'g05', 'g08', 'g10')"))
    assert evaluate(twice).count() == 23
    assert verdicts(evaluate(twice)) == {(key,): value for key, value in EXPECTED.items()}


@pytest.mark.parametrize(
    ("violated", "rows", "threshold", "failed"),
    [(5, 100, 5.0, 0), (7, 100, 7.0, 1), (0, 10, None, 0), (1, 10, None, 1), (1, 10, 0.0, 1),
     (1, 10, 10.0, 0), (3, 2, 100.0, 1)],
)
def test_threshold_is_strict(frame, violated, rows, threshold, failed):
    one = [("x", "FIELD", "fkDomain", "T", "f", None, None, violated, rows, None, threshold, C)]
    share = pct_ratio(F.col("num_violated_rows"), F.col("num_denominator_rows"))
    judged = evaluate(frame(SCHEMA, one).withColumn("pct_violated_rows", share))
    assert judged.first()["failed"] == failed


def test_threshold_lookup(frame):
    tables = frame(
        "cdmTableName string, measurePersonCompletenessThreshold string, "
        "measurePersonCompletenessNotes string",
        [("VISIT", "95", "see wiki"), ("NOTE", "", None)],
    )
    fields = frame(
        "cdmTableName string, cdmFieldName string, isRequiredThreshold string",
        [("VISIT", "a", "3"), ("VISIT", "b", "x")],
    )
    concepts = frame(
        "cdmTableName string, cdmFieldName string, conceptId string, unitConceptId string, "
        "plausibleGenderThreshold string",
        [("M", "c", "7", None, "1"), ("M", "c", "7", "2", "5"), ("M", "c", "8", "2", "9"), ("M", "c", "8", "2", "6"),
         ("M", "c", "8", "3", "7"), ("M", "c", "9", "2", "5"), ("M", "c", "9", "3", "")],
    )
    controls = Controls(None, tables, fields, concepts)
    results = frame(
        "check_level string, check_name string, cdm_table_name string, cdm_field_name string, "
        "concept_id string, unit_concept_id string",
        [
            ("TABLE", "measurePersonCompleteness", "VISIT", None, None, None),
            ("TABLE", "measurePersonCompleteness", "NOTE", None, None, None),
            ("FIELD", "isRequired", "VISIT", "a", None, None),
            ("FIELD", "isRequired", "VISIT", "b", None, None),
            ("FIELD", "fkDomain", "VISIT", "a", None, None),
            ("CONCEPT", "plausibleGender", "M", "c", "7", None),
            ("CONCEPT", "plausibleGender", "M", "c", "7", "2"),
            # The row without a unit stands in for an unknown unit, and the strictest for a missing one.
            ("CONCEPT", "plausibleGender", "M", "c", "7", "4"),
            ("CONCEPT", "plausibleGender", "M", "c", "8", None),
            ("CONCEPT", "plausibleGender", "M", "c", "8", "2"),
            ("CONCEPT", "plausibleGender", "M", "c", "8", "4"),
            ("CONCEPT", "plausibleGender", "M", "c", "9", None),
        ],
    )
    found = {
        tuple(row)[1:6]: (row["threshold_value"], row["notes_value"])
        for row in threshold_lookup(results, controls).collect()
    }
    assert found == {
        ("measurePersonCompleteness", "VISIT", None, None, None): (95.0, "see wiki"),
        ("measurePersonCompleteness", "NOTE", None, None, None): (None, None),
        ("isRequired", "VISIT", "a", None, None): (3.0, None),
        ("isRequired", "VISIT", "b", None, None): (None, None),
        ("fkDomain", "VISIT", "a", None, None): (None, None),
        ("plausibleGender", "M", "c", "7", None): (1.0, None),
        ("plausibleGender", "M", "c", "7", "4"): (1.0, None),
        ("plausibleGender", "M", "c", "8", None): (6.0, None),
        ("plausibleGender", "M", "c", "8", "2"): (6.0, None),
        ("plausibleGender", "M", "c", "8", "4"): (None, None),
        ("plausibleGender", "M", "c", "9", None): (None, None),
        ("plausibleGender", "M", "c", "7", "2"): (5.0, None),
    }


def test_repeated_control_rows_give_the_strictest_threshold(frame):
    control = frame(
        "cdmTableName string, cdmFieldName string, isRequiredThreshold string",
        [("T", "f", "9"), ("T", "f", "4"), ("T", "f", None)],
    )
    assert control_thresholds(control.dropna(), "FIELD").first()["threshold_value"] == 4.0
    assert control_thresholds(control, "FIELD").first()["threshold_value"] is None  # no row may fail


def test_report_view(frame):
    judged = evaluate(stored(frame)).withColumns(
        {
            "check_description": F.lit("What is checked"),
            "notes_value": F.lit(None).cast("string"),
            "subcategory": F.lit(""),
        }
    )
    rows = report_view(judged, {"status": "FAIL"}, keep=["id"]).collect()
    assert [row["id"] for row in rows] == ["g02", "g05", "g12", "g14", "g18"]
    assert [row["percent_records"] for row in rows] == [
        "100.00%", "100.00%", "100.00%", "7.00%", "2.00%",
    ]
    assert rows[0]["field"] == "None" and rows[0]["subcategory"] == "None"
    assert rows[3]["description"] == "What is checked (Threshold=7%)."
    assert rows[4]["description"] == "What is checked"
    pages = [report_view(judged, page_size=5, page=n, keep=["id"]).collect() for n in range(4)]
    assert [len(page) for page in pages] == [5, 5, 5, 4]
    assert len({row["id"] for page in pages for row in page}) == 19
