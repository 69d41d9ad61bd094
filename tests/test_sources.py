"""Reading tables and control files, writing results."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from plumbline.fixtures import fixture_controls, view
from plumbline.operators import keyed, rowwise
from plumbline.plans.checks import checks_to_run
from plumbline.registry.queries import run_cdm
from plumbline.sources import sinks
from plumbline.sources.cdm import Cdm, Cohort, cdm_from_catalog, cdm_from_files
from plumbline.sources.control import read_control, read_controls
from plumbline.sources.standard import standard_descriptions, standard_table_control

CSV = '''cdmTableName,note,units
PERSON,"two
lines, and ""quotes""",NA
VISIT,,"1,2"
NOTE,  ,
'''


def test_control_file(spark, tmp_path):
    path = tmp_path / "control.csv"
    path.write_text(CSV)
    rows = [tuple(row) for row in read_control(spark, str(path)).collect()]
    assert rows == [
        ("PERSON", 'two\nlines, and "quotes"', "NA"),
        ("VISIT", None, "1,2"),
        ("NOTE", None, None),
    ]


def test_control_files_give_the_same_checks(spark, tmp_path):
    controls = fixture_controls(spark)
    paths = {}
    for name in ("descriptions", "tables", "fields", "concepts"):
        paths[name] = str(tmp_path / name)
        options = {"header": True, "escape": '"', "ignoreTrailingWhiteSpace": False}
        getattr(controls, name).write.options(**options).csv(paths[name])
    direct = checks_to_run(controls)
    read = checks_to_run(read_controls(spark, **paths))
    assert sorted(map(str, read.collect())) == sorted(map(str, direct.collect()))


def test_standard_controls(spark):
    levels = standard_descriptions(spark).groupBy("checkLevel").count().collect()
    assert {row[0]: row[1] for row in levels} == {"TABLE": 3, "FIELD": 17, "CONCEPT": 2}
    assert standard_table_control(spark, "5.3").count() == 22
    assert standard_table_control(spark, "5.2").count() == 21
    era = standard_table_control(spark).where("measureConditionEraCompleteness = 'Yes'")
    assert [row["cdmTableName"] for row in era.collect()] == ["CONDITION_ERA"]


def test_tables_from_files(spark):
    cdm = cdm_from_files(spark, DATA, ["ORDERS", "no_such_table"])
    assert "orders" in cdm and "Orders" in cdm and "no_such_table" not in cdm
    assert list(cdm) == ["orders"] and len(cdm) == 1
    assert cdm.has_field("orders", "O_ORDERKEY") and not cdm.has_field("orders", "x")
    with pytest.raises(KeyError, match="Table no_such_table does not exist"):
        cdm["no_such_table"]
    with pytest.raises(KeyError, match="Field orders.x does not exist"):
        cdm.datatype("orders", "x")


def test_tables_from_other_formats(spark, tmp_path):
    for kind in ("orc", "json"):
        spark.range(3).write.format(kind).save(str(tmp_path / "things"))
        cdm = cdm_from_files(spark, str(tmp_path), ["THINGS"], kind)
        assert cdm["things"].count() == 3
        (tmp_path / "things").rename(tmp_path / f"done_{kind}")


def test_tables_from_the_catalog(spark):
    spark.range(4).write.mode("overwrite").saveAsTable("some_things")
    cdm = cdm_from_catalog(spark, ["SOME_THINGS", "other_things"], "default")
    assert cdm["some_things"].count() == 4 and "other_things" not in cdm
    spark.sql("DROP TABLE some_things")


def test_tables_open_only_when_asked_for(spark):
    opened = []

    def load(name):
        opened.append(name)
        return spark.range(1)

    cdm = Cdm({name: (lambda n=name: load(n)) for name in ("a", "b")})
    assert cdm["A"].count() == 1 and cdm["a"].count() == 1
    assert opened == ["a"]
    assert "b" in cdm.with_table("a", spark.range(2)) and cdm.with_table("a", spark.range(2))[
        "a"
    ].count() == 2


def test_source_description(frame):
    source = frame("cdm_source_name string, cdm_version string", [("Ours", "v5.3")])
    row = sinks.read_cdm_source(Cdm({"CDM_SOURCE": source}), version_key="TOOL").first().asDict()
    assert list(row) == [*sinks.METADATA_KEYS, "TOOL"]
    assert row["CDM_SOURCE_NAME"] == "Ours" and row["CDM_HOLDER"] is None
    assert sinks.read_cdm_source(Cdm({})) is None


RESULTS = [
    ("a", "TABLE", "cdmTable", 0, 1, 0.0, None),
    ("b", "FIELD", "isRequired", 3, 4, 0.75, ' line\nbreak, "quote" '),
    ("c", "CONCEPT", "plausibleGender", None, None, None, "x"),
]
SCHEMA = (
    "checkid string, check_level string, check_name string, num_violated_rows bigint, "
    "num_denominator_rows bigint, pct_violated_rows double, error string"
)


def test_csv_round_trip(spark, frame, tmp_path):
    path = str(tmp_path / "csv")
    table = sinks.result_table(frame(SCHEMA, RESULTS))
    sinks.write_results_csv(table, path)
    read = sinks.read_results_csv(spark, path)
    assert read.dtypes == table.dtypes
    assert sorted(map(str, read.collect())) == sorted(map(str, table.collect()))


def test_result_tables(spark, frame, tmp_path):
    results = frame(SCHEMA, RESULTS)
    for _ in range(2):  # writing again replaces the table
        sinks.write_results_table(results, "all_results", path=str(tmp_path / "all"))
    assert spark.table("all_results").count() == 3
    widths = {"TABLE": 22, "FIELD": 23, "CONCEPT": 26}
    for level, width in widths.items():
        name = f"results_{level.lower()}"
        sinks.write_results_table(results, name, level, path=str(tmp_path / level))
        table = spark.table(name)
        assert table.count() == 1 and len(table.columns) == width
        assert "x_row" in table.columns and "warning" not in table.columns
        spark.sql(f"DROP TABLE {name}")
    spark.sql("DROP TABLE all_results")


def test_report_of_several_runs(frame):
    columns = ["category string", "is_error int", "not_applicable int", "failed int", "passed int"]
    rows = [(f"{run}{r[0]}", *r[1:], "Conformance", 0, 0, run, 1 - run, run)
            for run in (0, 1) for r in RESULTS[:2]]
    results = frame(f"{SCHEMA}, {', '.join(columns)}, run_id int", rows)
    metadata = results.sparkSession.range(1).select(F.lit("Ours").alias("CDM_SOURCE_NAME"))
    found = sinks.report_document(results, metadata=metadata, run=["run_id"]).collect()
    assert sorted((r["run_id"], len(r["CheckResults"]), r["Overview"]["countOverallFailed"])
                  for r in found) == [(0, 2, 0), (1, 2, 2)]
    assert found[0]["Metadata"][0]["CDM_SOURCE_NAME"] == "Ours"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_stored_table_is_built_once_and_joins_no_cohort(spark, frame, tmp_path):
    facts = frame(
        "id bigint, person_id bigint, note string",
        [(1, 1, "a"), (2, 1, None), (3, 2, "b"), (4, None, "c"), (4, 3, None), (4, 1, "d")],
    )
    built = []

    def build():
        built.append(1)
        return facts.join(frame("other bigint", [(1,), (2,), (3,), (4,), (4,)]), F.col("id") == F.col("other")).drop("other")

    members = frame("cohort_definition_id bigint, subject_id bigint", [(1, 1), (1, 1), (1, 3), (2, 2), (1, None)])
    cohort, other = Cohort(members, 1), Cohort(members, 2)
    cdm = Cdm({"Facts": build})
    stored = cdm.stored(["FACTS"], str(tmp_path / "stored"), cohort)
    assert not built and stored["facts"].schema == cdm["facts"].schema
    assert sorted(map(str, stored["facts"].collect())) == sorted(map(str, cdm["facts"].collect()))
    for group in (None, cohort, other):
        for count in (
            lambda c: rowwise.is_required(c, "facts", "note", group),  # noqa: B023
            lambda c: keyed.is_primary_key(c, "facts", "id", group),  # noqa: B023
        ):
            assert count(stored).first() == count(cdm).first()
    assert "Join" in plan(cdm.rows("facts", cohort).df)
    assert "Join" not in plan(stored.rows("facts", cohort).df)
    assert "Join" not in plan(stored.weighted("facts", cohort)) and "Join" in plan(stored.weighted("facts", other))
    assert len(built) == 1
    changed = stored.with_table("facts", frame("id bigint, person_id bigint, note string", [(1, 2, None)]))
    assert changed.rows("facts", cohort).df.count() == 0 and changed.rows("facts", other).df.count() == 1


def test_a_table_that_cannot_be_stored_is_used_as_it_is(spark, tmp_path):
    facts = spark.range(2).selectExpr("id", "CASE WHEN id = 0 THEN 'x' END AS text").selectExpr("*", "CAST(text AS BIGINT) AS bad")
    cdm = Cdm({"facts": facts, "absent": lambda: None}).stored(["facts", "absent"], str(tmp_path / "stored"))
    assert rowwise.is_required(cdm, "facts", "text").first()[0] == 1
    assert "absent" not in cdm and cdm.failure("facts") is None


def test_whole_runs_build_the_joined_table_once(spark):
    for cohort in (None, Cohort(view(spark, DATA, "cohort"), 1)):
        cdm = run_cdm(spark, DATA, cohort)
        found = plan(cdm.rows("measurement", cohort).df)
        assert "Join" not in found and "lineitem.parquet" not in found


ODD_RUNS = [None, "", "2", "a/b", "x=1%", "ü ?", "{c:d}'\"#"]


def odd_results(frame, runs=ODD_RUNS):
    rows = [
        (run, f"c{i % 4}", i % 2, 1 - i % 2, "Plausibility", "\n\"," if i % 3 else None)
        for run in runs
        for i in range(5)
    ]
    return frame("site string, checkid string, failed int, passed int, category string, error string", rows)


def report_texts(folder):
    """Folder and text of each report; nothing but these and the mark of success is there."""
    files = sorted(path.relative_to(folder) for path in folder.rglob("*") if path.is_file())
    assert files.pop(files.index(Path("_SUCCESS"))) and {path.suffix for path in files} <= {".txt"}
    return sorted((str(path.parent), (folder / path).read_text()) for path in files)


def test_reports_of_runs(spark, frame, tmp_path):
    """One document per run, with its run; a null run and an empty one are two."""
    results = odd_results(frame)
    sinks.write_reports(results, str(tmp_path / "reports"), run=["site"])
    texts = report_texts(tmp_path / "reports")
    documents = {json.loads(text)["site"]: json.loads(text) for _, text in texts}
    assert len(texts) == len(documents) == len(ODD_RUNS) and set(documents) == set(ODD_RUNS)
    for site, document in documents.items():
        assert document["Overview"]["countTotal"] == 5 and document["Overview"]["countPassed"] == 3
        assert [row["checkId"] for row in document["CheckResults"]] == ["c0", "c0", "c1", "c2", "c3"]
    schema = sinks.report_document(results.limit(0), run=["site"]).schema
    options = {"multiLine": True, "recursiveFileLookup": True}
    read = spark.read.schema(schema).options(**options).json(str(tmp_path / "reports"))
    expected = sinks.report_document(results, run=["site"])
    rows = ["site", "Overview.*", F.size("CheckResults")]
    assert sorted(map(str, read.select(*rows).collect())) == sorted(map(str, expected.select(*rows).collect()))


def test_reports_of_runs_as_spark_writes_them(frame, tmp_path, monkeypatch):
    """Where only Spark can write, folders and texts are the same."""
    results = odd_results(frame, [run for run in ODD_RUNS if run != ""]).withColumn("day", F.lit("2024-02-29").cast("date"))
    sinks.write_reports(results, str(tmp_path / "own"), run=["site", "day"])
    monkeypatch.setattr(sinks, "_shared_disk", lambda spark, path: None)
    sinks.write_reports(results, f"file:{tmp_path}/spark", run=["site", "day"])
    for path in (tmp_path / "spark").rglob("*.crc"):
        path.unlink()
    own = report_texts(tmp_path / "own")
    assert own == report_texts(tmp_path / "spark") and len(own) == len(ODD_RUNS) - 1


def test_reports_work_results_out_once(spark, frame, tmp_path):
    """The results are not computed again for the overview, and no file but the reports is written."""
    seen = spark.sparkContext.accumulator(0)
    results = odd_results(frame)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    sinks.write_reports(results.mapInArrow(count, results.schema), f"file:{tmp_path}/reports", run=["site"])
    assert seen.value == 5 * len(ODD_RUNS)
    assert len(report_texts(tmp_path / "reports")) == len(ODD_RUNS)


def test_reports_replace_others_when_all_are_written(frame, tmp_path):
    results, folder = odd_results(frame), tmp_path / "reports"
    sinks.write_reports(results.where("site = '2'"), str(folder), run=["site"])
    before = report_texts(folder)
    bad = results.withColumn("category", F.expr("IF(site = 'a/b', raise_error('bad row'), category)"))
    with pytest.raises(Exception, match="bad row"):
        sinks.write_reports(bad, str(folder), run=["site"])
    assert report_texts(folder) == before and list(tmp_path.iterdir()) == [folder]
    sinks.write_reports(results.where("site = 'a/b'"), str(folder), run=["site"])
    assert [name for name, _ in report_texts(folder)] == ["site=a%2Fb"]
    sinks.write_reports(results.limit(0), str(folder), run=["site"])
    assert report_texts(folder) == [] and list(tmp_path.iterdir()) == [folder]


def test_report_without_results(spark, frame, tmp_path):
    """A run that has no results still has its document."""
    sinks.write_reports(odd_results(frame).limit(0), str(tmp_path / "none"))
    (text,) = [row[0] for row in spark.read.text(str(tmp_path / "none"), wholetext=True).collect() if row[0]]
    assert json.loads(text)["CheckResults"] == [] and json.loads(text)["Overview"]["countTotal"] == 0
