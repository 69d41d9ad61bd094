"""Whole runs: selection, grouping, isolation of errors, cohorts, reports."""

import json
import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from plumbline import operators
from plumbline.fixtures import fixture_cdm, fixture_controls, view
from plumbline.operators import concepts, keyed, lookup, rowwise, temporal
from plumbline.plans.runner import (
    ROW_RULES,
    Checks,
    Group,
    count_checks,
    count_isolated,
    group_checks,
    prepare,
    run_checks,
)
from plumbline.sources.cdm import Cdm, Cohort
from plumbline.sources.sinks import RESULT_COLUMNS, write_report_json, write_reports


@pytest.fixture(scope="module")
def cdm(spark):
    return fixture_cdm(spark, DATA)


@pytest.fixture(scope="module")
def controls(spark):
    return fixture_controls(spark)


@pytest.fixture(scope="module")
def run(spark, cdm, controls):
    return run_checks(spark, cdm, controls)


def by_id(df):
    return {row["checkid"]: row for row in df.collect()}


def test_result_columns(run):
    assert run.results.dtypes == list(RESULT_COLUMNS.items())


def test_results_can_be_repeated_from_their_query_text(run, cdm):
    """The call recorded with each result gives the same counts."""
    modules = (concepts, keyed, lookup, rowwise, temporal)
    names = {n: getattr(m, n) for m in modules for n in dir(m) if not n.startswith("_")}
    checked = 0
    for row in run.results.where("num_violated_rows is not null").collect():
        if row["check_name"] in ("cdmTable", "cdmField"):
            continue
        text = row["query_text"]
        alone = eval(text, {**names, "cdm": cdm}).first()
        assert (alone[0], alone[2]) == (row["num_violated_rows"], row["num_denominator_rows"]), text
        checked += 1
    assert checked > 25


def test_lazy_counts_equal_isolated_counts(spark, cdm, controls):
    checks = prepare(spark, controls)
    lazy = {r[0]: (r[1], r[2]) for r in count_checks(cdm, checks).collect()}
    apart = {r[0]: (r[1], r[2]) for r in count_isolated(cdm, checks).collect()}
    assert lazy == apart


def test_one_bad_check_fails_alone(spark, cdm, controls):
    """A bound that cannot be computed: its check is an error, its neighbours in the scan are not."""
    broken = F.when(F.col("cdmFieldName") == "value_as_number", "1 / 0").otherwise(
        F.col("plausibleValueHigh")
    )
    fields = controls.fields.withColumn("plausibleValueHigh", broken)
    rows = by_id(run_checks(spark, cdm, replace(controls, fields=fields)).results)
    errors = [key for key, row in rows.items() if row["is_error"] == 1]
    assert errors == ["field_plausiblevaluehigh_measurement_value_as_number"]
    assert "DIVIDE_BY_ZERO" in rows[errors[0]]["error"]
    assert rows["field_plausiblevaluehigh_measurement_measurement_date"]["failed"] == 1
    assert rows["field_isprimarykey_measurement_measurement_id"]["failed"] == 1


def test_unreadable_concept_controls_are_errors(spark, cdm, controls):
    """A bound or unit list that is no number is reported, and not taken for 'no rule'."""
    concepts = controls.concepts.withColumns(
        {
            "plausibleValueHigh": F.when(F.col("plausibleValueHigh") == "25", "high"),
            "plausibleUnitConceptIds": F.when(
                F.col("plausibleUnitConceptIds") == "2,3,4", "2,mg"
            ).otherwise(F.col("plausibleUnitConceptIds")),
        }
    )
    rows = by_id(run_checks(spark, cdm, replace(controls, concepts=concepts)).results)
    base = "measurement_measurement_concept_id_7"
    assert sorted(key for key, row in rows.items() if row["is_error"] == 1) == [
        f"concept_plausibleunitconceptids_{base}",
        f"concept_plausiblevaluehigh_{base}_2",
    ]
    assert rows[f"concept_plausiblegender_{base}"]["num_denominator_rows"] is not None


def test_a_missing_partner_is_an_error_of_the_checks_that_need_it(spark, cdm, controls):
    without = Cdm({name: df for name, df in cdm.items() if name != "death"})
    rows = by_id(run_checks(spark, without, controls).results)
    errors = [key for key, row in rows.items() if row["is_error"] == 1]
    assert errors == ["field_plausibleduringlife_measurement_measurement_date"]
    assert "death does not exist" in rows[errors[0]]["error"]


def test_missing_tables_are_errors_unless_the_run_reports_them(spark, cdm, controls):
    alone = by_id(run_checks(spark, cdm, controls, names=["isRequired"]).results)
    assert alone["field_isrequired_note_note_id"]["error"] == "Table NOTE does not exist."
    missing = alone["field_isrequired_person_no_such_field"]
    assert missing["error"] == "Field PERSON.no_such_field does not exist."
    assert alone["field_isrequired_person_gender_concept_id"]["is_error"] == 0


def test_selection(spark, cdm, controls):
    rows = run_checks(spark, cdm, controls, include=["person"], names=["isRequired", "cdmTable"])
    assert {row["cdm_table_name"] for row in rows.results.collect()} == {"PERSON"}
    with pytest.raises(ValueError, match="no checks"):
        run_checks(spark, cdm, controls, names=["noSuchCheck"])


def test_unknown_level(spark, cdm, controls):
    odd = controls.descriptions.withColumn("checkLevel", F.lit("COLUMN"))
    with pytest.raises(ValueError, match="COLUMN"):
        run_checks(spark, cdm, replace(controls, descriptions=odd))


def test_cohort_run(spark, cdm, controls):
    """Checks marked for cohorts and all concept checks are restricted, the others are not."""
    cohort = Cohort(view(spark, DATA, "cohort"), 1)
    marked = F.when(F.col("cdmFieldName") != "provider_text", "Yes")
    fields = controls.fields.withColumn("runForCohort", marked)
    rows = by_id(run_checks(spark, cdm, replace(controls, fields=fields), cohort=cohort).results)
    full = cdm["measurement"].count()
    inside = cdm.member_rows("measurement", cohort).count()
    assert inside < full
    denominators = {
        "field_isprimarykey_measurement_measurement_id": inside,
        "field_fkdomain_measurement_measurement_concept_id": inside,
        "field_plausibletemporalafter_measurement_measurement_date": inside,
        "field_cdmdatatype_measurement_provider_text": full,
    }
    assert {key: rows[key]["num_denominator_rows"] for key in denominators} == denominators
    assert rows["field_isprimarykey_measurement_measurement_id"]["num_violated_rows"] > 0
    assert not [key for key, row in rows.items() if row["is_error"] == 1 and "visit" not in key]


def test_cohort_person_completeness(spark, cdm, controls):
    cohort = Cohort(view(spark, DATA, "cohort"), 1)
    tables = controls.tables.withColumn("runForCohort", F.lit("Yes"))
    fields = controls.fields.withColumn("runForCohort", F.lit("Yes"))
    both = replace(controls, tables=tables, fields=fields)
    rows = by_id(
        run_checks(spark, cdm, both, cohort=cohort, names=["measurePersonCompleteness"]).results
    )
    members = cdm.member_rows("person", cohort).count()
    found = rows["table_measurepersoncompleteness_condition_era"]
    assert found["num_denominator_rows"] == members
    alone = lookup.person_completeness(cdm, "condition_era", cohort=cohort).first()
    assert found["num_violated_rows"] == alone[0]


def test_descriptions_and_thresholds(run):
    rows = by_id(run.results)
    row = rows["concept_plausiblegender_measurement_measurement_concept_id_7"]
    assert row["check_description"].startswith("For a CONCEPT_ID 7 (seven), the number")
    assert row["check_description"].endswith("(correct gender = Male).")
    assert row["threshold_value"] == 5.0
    assert rows["field_isrequired_note_note_id"]["not_applicable"] == 1


def test_report(spark, run, tmp_path):
    path = str(tmp_path / "report")
    write_report_json(run.document("results.json"), path)
    (text,) = [row[0] for row in spark.read.text(path).collect()]
    report = json.loads(text)
    assert set(report) == {
        "startTimestamp", "endTimestamp", "executionTime", "CheckResults", "Overview",
        "Metadata", "outputFile",
    }
    assert len(report["CheckResults"]) == report["Overview"]["countTotal"] == 64
    assert set(report["CheckResults"][0]) == {
        "checkId" if name == "checkid" else name.upper() for name in RESULT_COLUMNS
    }
    assert report["executionTime"].endswith(" seconds")
    assert report["outputFile"] == "results.json"


def test_report_written_line_by_line(spark, run, tmp_path):
    """The same document as from one row, but each line holds one record at most."""
    whole, lines = str(tmp_path / "whole"), str(tmp_path / "lines")
    write_report_json(run.document("results.json"), whole)
    stamps = [F.lit(t.isoformat()).cast("timestamp") for t in (run.started, run.ended)]
    write_reports(run.results, lines, *stamps, run.metadata, "results.json")
    (text,) = [row[0] for row in spark.read.text(whole).collect()]
    (file,) = spark.sparkContext.wholeTextFiles(f"{lines}/*.txt").values().collect()
    assert json.loads(file) == json.loads(text)
    assert len(file.splitlines()) == 2 + len(json.loads(text)["CheckResults"])


def test_view(run):
    rows = run.view(filters={"table": "PERSON"}, page_size=5).collect()
    assert len(rows) == 5 and {row["table"] for row in rows} == {"PERSON"}


def test_public_names():
    for name in ("is_required", "fk_domain", "within_visit_dates", "concept_plausible_gender"):
        assert callable(getattr(operators, name))


def executions(monkeypatch):
    """Keys of the checks of every group that is counted."""
    done, count = [], Group.counts

    def counted(self, *rest):
        done.append([check["check_key"] for check in self.checks])
        return count(self, *rest)

    monkeypatch.setattr(Group, "counts", counted)
    return done


def concept_rows(frame, n, bad):
    names = "cdmTableName cdmFieldName conceptId unitConceptId plausibleUnitConceptIds plausibleUnitConceptIdsThreshold"
    rows = [("MEASUREMENT", "MEASUREMENT_CONCEPT_ID", str(i), None, "2;3" if i == bad else "2,3", "5") for i in range(n)]
    return frame(", ".join(f"{name} string" for name in names.split()), rows)


def test_an_unreadable_cell_costs_no_job(spark, frame, cdm, monkeypatch):
    done = executions(monkeypatch)
    controls = replace(fixture_controls(spark), concepts=concept_rows(frame, 1000, 77))
    run = run_checks(spark, cdm, controls, names=["plausibleUnitConceptIds"])
    found = {row["concept_id"]: row for row in run.results.where("check_level = 'CONCEPT'").collect()}
    assert len(done) == 1 and len(done[0]) == 999
    assert len(found) == 1000 and "plausibleUnitConceptIds is not readable: 2;3" in found["77"]["error"]
    assert all(row["error"] is None for key, row in found.items() if key != "77")


def test_a_failing_group_is_halved(spark, cdm, monkeypatch):
    checks = prepare(spark, fixture_controls(spark))
    rows = [c for c in checks.rows if c["check_name"] in ROW_RULES and c["table"] == "measurement"]
    done, count = [], Group.counts

    def failing(self, *rest):
        done.append(len(self.checks))
        if rows[2] in self.checks:
            raise RuntimeError("this check alone")
        return count(self, *rest)

    monkeypatch.setattr(Group, "counts", failing)
    found = {r["check_key"]: r["error"] for r in count_isolated(cdm, Checks(checks.df, rows), parallel=1).collect()}
    groups = group_checks(rows)
    most = max(len(g.checks) for g in groups)
    assert [key for key, error in found.items() if error] == [rows[2]["check_key"]] and len(found) == len(rows)
    assert len(done) <= len(groups) + 2 * math.ceil(math.log2(most))


def test_control_names_in_any_case(spark, frame, cdm):
    """A table that is absent, and spelled in three ways, fails once; its other checks do not apply, and none passes."""
    controls = fixture_controls(spark)
    fields = controls.fields.where("cdmTableName = 'NOTE'").withColumn("cdmTableName", F.lit("note"))
    more = controls.fields.where("cdmTableName = 'NOTE'").withColumn("cdmTableName", F.lit("Note"))
    concept = controls.fields.where("cdmTableName = 'NOTE'").withColumn("cdmTableName", F.lit("concept"))
    run = run_checks(spark, cdm, replace(controls, fields=fields.union(more).union(concept)))
    rows = run.results.where("lower(cdm_table_name) IN ('note', 'concept')").collect()
    assert {r["cdm_table_name"] for r in rows} == {"NOTE", "note", "Note"}
    assert all(r["passed"] == 0 for r in rows)
    assert {(r["check_name"], r["failed"]) for r in rows if r["failed"]} == {("cdmTable", 1)}
    assert all(r["not_applicable"] == 1 for r in rows if r["check_name"] != "cdmTable")


@pytest.mark.parametrize("broken", ["measurement", "death", "cdm_source"])
def test_a_failing_table_is_an_error_of_its_checks_alone(spark, controls, run, broken):
    """Checked tables, partner tables and the source's description; the loader is called once."""
    calls = []

    def fail():
        calls.append(broken)
        raise OSError("disk on fire")

    whole = fixture_cdm(spark, DATA)
    cdm = Cdm({**{name: whole[name] for name in whole if name != broken}, broken: fail})
    again = run_checks(spark, cdm, controls)
    expected, found = by_id(run.results), by_id(again.results)
    assert set(found) == set(expected) and calls == [broken]
    needs = {
        "measurement": lambda row: row["cdm_table_name"] == "MEASUREMENT",
        "death": lambda row: row["check_name"] == "plausibleDuringLife",
        "cdm_source": lambda row: False,
    }[broken]
    for key, row in found.items():
        if needs(row):
            assert row["is_error"] and "disk on fire" in row["error"]
        else:
            assert row["error"] == expected[key]["error"]
            assert row["num_violated_rows"] == expected[key]["num_violated_rows"]


def test_presence_opens_no_other_table(spark, frame):
    from plumbline.operators import presence

    def never():
        raise AssertionError("opened")

    cdm = Cdm({"person": frame("person_id long", [(1,)]), "death": never})
    expected = frame("table_name string, field_name string", [("PERSON", "person_id"), ("NOTE", "x")])
    for found in (presence.cdm_table(expected, cdm), presence.cdm_field(expected, cdm)):
        assert sorted(row["num_violated_rows"] for row in found.collect()) == [0, 1]


def test_unreadable_thresholds_are_errors(spark, cdm, controls):
    fields = controls.fields.where("measureValueCompleteness = 'Yes'").withColumn(
        "measureValueCompletenessThreshold", F.when(F.col("cdmTableName") == "PERSON", "5%").otherwise(" 20 ")
    )
    found = run_checks(spark, cdm, replace(controls, fields=fields), include=["PERSON", "MEASUREMENT"], names=["measureValueCompleteness"])
    rows = {row["cdm_table_name"]: row for row in found.results.collect()}
    assert rows["PERSON"]["error"] == "threshold is not readable: 5%" and rows["PERSON"]["is_error"] and not rows["PERSON"]["failed"]
    assert rows["MEASUREMENT"]["error"] is None and rows["MEASUREMENT"]["threshold_value"] == 20
