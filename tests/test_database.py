"""Reading from a database, with a fake one: DuckDB in this process, its results handed over as DataFrames."""

import duckdb
import pytest
from pyspark.sql import Row

from plumbline.fixtures import fixture_controls
from plumbline.plans.runner import run_checks
from plumbline.sources.database import MOST_PARTS, cdm_from_database, cutting_column, equal_shares


class Fake:
    def __init__(self, spark, *statements, broken=()):
        self.spark, self.duck, self.broken, self.reads = spark, duckdb.connect(), broken, []
        for sql in statements:
            self.duck.execute(sql)

    def query(self, sql):
        if any(name in sql for name in self.broken):
            raise RuntimeError(f"permission denied: {sql}")
        return [Row(*row) for row in self.duck.execute(sql).fetchall()]

    def read(self, table, predicates):
        self.reads.append((table, predicates))
        if any(name in table for name in self.broken):
            raise RuntimeError(f"permission denied: {table}")
        whole = None
        for predicate in predicates or ["TRUE"]:
            part = self.spark.createDataFrame(self.duck.execute(f"SELECT * FROM {table} WHERE {predicate}").to_arrow_table())
            whole = part if whole is None else whole.union(part)
        return whole


PERSON = """CREATE TABLE person AS SELECT i AS person_id, 8507 AS gender_concept_id, 1900 + i % 100 AS year_of_birth,
    i % 7 AS location_id, DATE '1950-01-01' AS birth_datetime FROM range(1, 2001) t(i)"""
#: Ids with gaps and clusters, one without a value; the only integer column that is not unique comes first.
VISIT = """CREATE TABLE visit_occurrence AS SELECT i % 3 AS person_id, CASE WHEN i = 5 THEN NULL WHEN i < 900 THEN i ELSE i * 1000003 END
    AS visit_occurrence_id, DATE '2020-01-01' AS visit_start_date, DATE '2020-01-02' AS visit_end_date FROM range(1000) t(i)"""
NOTE = "CREATE TABLE note AS SELECT 'text ' || i AS note_text FROM range(10) t(i)"
LOCATION = "CREATE TABLE location AS SELECT i AS location_id FROM range(5) t(i)"


def test_tables_are_found_and_cut_into_equal_shares(spark):
    fake = Fake(spark, PERSON, VISIT, NOTE)
    with pytest.warns(UserWarning, match="one connection"):
        cdm = cdm_from_database(fake, schema="main", rows_per_part=100)
        assert sorted(cdm) == ["note", "person", "visit_occurrence"]
    assert {name: cdm[name].count() for name in cdm} == {"note": 10, "person": 2000, "visit_occurrence": 1000}
    cuts = dict(fake.reads)
    assert [len(cuts[f"main.{name}"]) for name in ("note", "person", "visit_occurrence")] == [0, 20, 10]
    sizes = [fake.query(f"SELECT COUNT(*) FROM visit_occurrence WHERE {p}")[0][0] for p in cuts["main.visit_occurrence"]]
    assert sum(sizes) == 1000 and max(sizes) <= 102


def test_tables_are_opened_when_needed(spark):
    fake = Fake(spark, PERSON, VISIT, NOTE)
    cdm = cdm_from_database(fake, ["PERSON", "DEATH"], rows_per_part=5000)
    assert fake.reads == []
    assert "death" not in cdm and cdm["Person"].count() == 2000
    assert fake.reads == [("person", [])]


def test_one_value_with_most_rows_is_one_part(spark):
    fake = Fake(spark, "CREATE TABLE t AS SELECT CASE WHEN i < 600 THEN 7 ELSE i END AS t_id FROM range(1000) t(i)")
    predicates = equal_shares(fake, "t", "t_id", 100)
    sizes = [fake.query(f"SELECT COUNT(*) FROM t WHERE {p}")[0][0] for p in predicates]
    assert sum(sizes) == 1000 and sorted(sizes)[-2] <= 100
    assert equal_shares(fake, "t", "t_id", 1000) == []
    fake.duck.execute("CREATE TABLE same AS SELECT 1 AS t_id FROM range(1000) t(i)")
    assert equal_shares(fake, "same", "t_id", 10) == []
    assert len(equal_shares(Fake(spark, PERSON), "person", "person_id", 1)) == MOST_PARTS


def test_cutting_column():
    columns = [("value", "INTEGER"), ("person_id", "BIGINT"), ("VISIT_ID", "numeric(10,0)"), ("x_id", "varchar")]
    assert cutting_column("visit", columns) == "VISIT_ID"
    assert cutting_column("x", columns) == "person_id"
    assert cutting_column("x", columns[:1]) is None


def test_a_broken_table_is_the_failure_of_its_checks(spark):
    fake = Fake(spark, PERSON, VISIT, NOTE, LOCATION, broken=["visit_occurrence"])
    cdm = cdm_from_database(fake)
    results = run_checks(spark, cdm, fixture_controls(spark), include=["PERSON", "VISIT_OCCURRENCE", "LOCATION"]).results.collect()
    failed = {row["checkid"] for row in results if row["is_error"]}
    assert failed == {row["checkid"] for row in results if row["cdm_table_name"] == "VISIT_OCCURRENCE"}
    assert all("permission denied" in row["error"] for row in results if row["is_error"])
