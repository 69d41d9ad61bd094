"""What Spark does for a check: how often it scans, what it reads, what it shuffles."""

import re

import pytest

from plumbline.fixtures import CDM_VIEWS, fixture_controls, view
from plumbline.functions.values import bound
from plumbline.operators import concepts, keyed, lookup, rowwise, temporal, violations
from plumbline.plans.runner import group_checks, prepare, split_missing
from plumbline.sources.cdm import Cdm, Cohort, cdm_from_files
from conftest import DATA

M, MC, MD = "measurement", "measurement_concept_id", "measurement_date"


@pytest.fixture(scope="module")
def cdm(spark, tmp_path_factory):
    """The views as files, as in real use."""
    folder = str(tmp_path_factory.mktemp("cdm"))
    for name in CDM_VIEWS:
        view(spark, DATA, name).write.parquet(f"{folder}/{name}")
    return cdm_from_files(spark, folder, CDM_VIEWS)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    """Columns read by each scan."""
    return sorted(re.findall(r"FileScan parquet \[(.*?)\]", text))


def columns(text):
    return sorted(re.sub(r"#\d+L?", "", found) for found in scans(text))


def shuffles(text):
    return [found for found in re.findall(r"Exchange (\w+)", text) if found != "SinglePartition"]


def test_all_row_rules_of_a_table_are_one_scan_without_shuffle(cdm):
    rules = {
        "a": rowwise.not_null_rule("value_as_number"),
        "b": rowwise.zero_concept_rule(M, MC),
        "c": rowwise.range_rule(MD, bound("1996-01-01", "date"), "date"),
    }
    text = plan(rowwise.count_rules(cdm.rows(M), rules))
    assert columns(text) == [f"{MC},{MD},value_as_number"]
    assert shuffles(text) == []
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_duplicates_are_one_shuffle_with_partial_counts(cdm):
    text = plan(keyed.is_primary_key(cdm, M, "measurement_id"))
    assert columns(text) == ["measurement_id"]
    assert shuffles(text) == ["hashpartitioning"]
    assert "partial_count(1)" in text


def test_checks_of_values_of_a_table_are_one_scan_and_one_shuffle(cdm):
    """Three fields of different types, one of them judged by two standard fields."""
    checks = {
        "key": keyed.ValueCheck("measurement_id"),
        "date": keyed.ValueCheck(MD),
        "source": keyed.ValueCheck("unit_source_value", MC),
        "other": keyed.ValueCheck("unit_source_value", "unit_concept_id"),
    }
    found = keyed.count_value_checks(cdm, M, checks)
    text = plan(found)
    assert columns(text) == [f"measurement_id,{MC},{MD},unit_concept_id,unit_source_value"]
    assert shuffles(text) == ["hashpartitioning"] and "partial_count(1)" in text
    alone = {key: keyed.count_value_checks(cdm, M, {key: check}).first()[1:] for key, check in checks.items()}
    assert {row[0]: row[1:] for row in found.collect()} == alone


def test_all_vocabulary_checks_are_one_shuffle_without_join(cdm):
    checks = {
        "known": lookup.KeyCheck(MC),
        "domain": lookup.KeyCheck(MC, lookup.domain_rule("PROMO")),
        "other": lookup.KeyCheck("measurement_source_concept_id", lookup.standard_rule()),
    }
    text = plan(lookup.count_key_checks(cdm, M, "concept", "concept_id", checks))
    assert columns(text) == [
        "concept_id,domain_id,standard_concept,invalid_reason",
        f"{MC},measurement_source_concept_id",
    ]
    assert shuffles(text) == ["hashpartitioning"]
    assert "Join" not in text and "partial_sum" in text


def test_persons_without_rows_need_no_join(cdm):
    text = plan(lookup.person_completeness(cdm, M))
    assert columns(text) == ["person_id", "person_id"]
    assert "Join" not in text and shuffles(text) == ["hashpartitioning"]


def test_date_checks_move_the_checked_rows_once(cdm, spark):
    """The only join has one row per key on its other side, and the checked rows, reduced to key and
    place, are dealt out for it once."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        text = plan(temporal.within_visit_dates(cdm, M, MD))
        two = plan(temporal.count_date_checks(cdm, M, {
            "birth": temporal.DateCheck(MD, "after", "person", "birth_datetime"),
            "life": temporal.DateCheck(MD, "life"),
        }))
    finally:
        spark.conf.set(limit, before)
    for found in (text, two):
        assert found.count("SortMergeJoin") == 1 and "Cartesian" not in found and "NestedLoop" not in found
        left, right = re.split(r"\n.*:- Sort", found)[1].split("+- Sort [key", 1)
        assert left.count("Exchange") == 1 and "measurement_date" in left and "measurement_date" not in right
    assert columns(text)[0] == f"visit_occurrence_id,{MD}"


def test_rows_do_not_meet_every_rule_of_their_concept(cdm, spark):
    """Five hundred bounds of one concept and unit: the rows of the table are counted first, in one scan, and the counts
    meet the rules."""
    control = spark.range(1000).selectExpr(
        "CAST(id AS STRING) AS check_key", "IF(id % 2 = 0, 'low', 'high') AS kind", "7L AS concept_id", "2L AS unit_concept_id",
        "CAST(NULL AS STRING) AS gender", "CAST(NULL AS STRING) AS units",
        "IF(id % 2 = 0, id / 20, NULL) AS low", "IF(id % 2 = 1, id / 20, NULL) AS high",
    )
    counted = concepts.count_value_checks(cdm, M, MC, control)
    found = {int(r[0]): r[1:] for r in counted.collect()}
    values = cdm[M].where(f"{MC} = 7 AND unit_concept_id = 2 AND value_as_number IS NOT NULL")
    values = [float(r[0]) for r in values.select("value_as_number").collect()]
    assert found == {
        i: (sum(v < i / 20 if i % 2 == 0 else v > i / 20 for v in values), len(values)) for i in range(1000)
    }
    final = counted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert [text for text in columns(final) if "value_as_number" in text] == [
        f"{MC},value_as_number,unit_concept_id,unit_source_value"
    ]


def test_a_single_concept_is_filtered_in_the_scan(cdm):
    text = plan(concepts.concept_plausible_value_low(cdm, M, MC, 7, 2, 10))
    assert f"EqualTo({MC},7)" in text and "IsNotNull(value_as_number)" in text


def test_violated_rows_filter_in_the_scan(cdm):
    text = plan(violations.plausible_value_high(cdm, M, "value_as_number", 45))
    assert "GreaterThan(value_as_number,45.0)" in text


def test_rows_of_many_checks_are_tagged_in_one_scan(cdm, spark, tmp_path):
    rules = {"filled": rowwise.not_null_rule("value_as_number"), "mapped": rowwise.zero_concept_rule(M, MC),
             "late": rowwise.range_rule(MD, "2001-01-01", "date", high=True)}
    text = plan(violations.tagged_rows(cdm, M, rules))
    assert len(columns(text)) == 1 and shuffles(text) == [] and "Join" not in text
    keys = {"known": lookup.KeyCheck(MC), "domain": lookup.KeyCheck(MC, lookup.domain_rule("PROMO"))}
    twice = cdm.with_table("concept", cdm["concept"].union(cdm["concept"]))
    rows = violations.tagged_rows(twice, M, rules, keys)
    assert len(columns(plan(rows))) == 3
    alone = {
        "filled": violations.measure_value_completeness(cdm, M, "value_as_number"),
        "mapped": violations.concept_record_completeness(cdm, M, MC),
        "late": violations.plausible_value_high(cdm, M, MD, "2001-01-01", "date"),
        "known": violations.is_foreign_key(cdm, M, MC, "concept", "concept_id"),
        "domain": violations.fk_domain(cdm, M, MC, "PROMO"),
    }
    path = str(tmp_path / "tagged")
    violations.write_tagged_rows(rows, path)
    for name, df in alone.items():
        found = spark.read.parquet(f"{path}/violated_check={name}")
        assert found.columns == cdm[M].columns and found.count() == df.count() > 0
    assert rows.count() < sum(df.count() for df in alone.values())


def test_unmatched_keys_are_an_anti_join(cdm):
    text = plan(violations.is_foreign_key(cdm, "person", "location_id", "location", "location_id"))
    assert "LeftAnti" in text
    text = plan(violations.is_primary_key(cdm, M, "measurement_id"))
    assert "LeftSemi" in text


def test_nothing_large_is_broadcast_when_sizes_forbid_it(spark, cdm):
    """With a low size limit no plan falls back on a broadcast."""
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        for df in (
            concepts.concept_plausible_gender(cdm, M, MC, 7, "Male"),
            violations.fk_domain(cdm, M, MC, "PROMO"),
            violations.within_visit_dates(cdm, M, MD),
        ):
            assert "Broadcast" not in plan(df)
    finally:
        spark.conf.set(limit, before)


def test_a_run_scans_a_table_once_per_kind_of_check(spark, cdm):
    checks = prepare(spark, fixture_controls(spark))
    ready, _ = split_missing(checks.rows, cdm)
    by_kind = {}
    for group in group_checks(ready):
        if group.shape[0] != "presence" and group.checks[0]["table"] == M:
            by_kind[group.shape] = len(group.checks)
    assert by_kind == {
        ("rows", M, False): 9,
        ("values", M, False): 2,
        ("keys", M, "concept", "concept_id", False, False): 4,
        ("keys", M, "person", "person_id", False, False): 1,
        ("dates", M, "person", False): 2,
        ("dates", M, "visit", False): 1,
        ("concepts", M, MC, False): 8,
    }


def test_a_page_far_behind_is_read_from_its_range(spark, tmp_path):
    """All pages together are the whole view in order, and a page asks the files for its places."""
    from plumbline.operators import evaluation, report
    from plumbline.registry.queries import history

    results = evaluation.evaluate(history(spark, DATA), ("run_id",))
    path, size = str(tmp_path / "pages"), 400
    report.write_pages(results, path, keep=["result_id"], tie_breakers=["result_id"])
    whole = [row["result_id"] for row in report.report_view(results, keep=["result_id"], tie_breakers=["result_id"]).collect()]
    pages = -(-len(whole) // size)
    read = [[row["result_id"] for row in report.read_page(spark, path, i, size).collect()] for i in range(pages + 1)]
    assert [x for page in read for x in page] == whole and read[-1] == []
    assert all(len(page) == size for page in read[:-2])
    text = plan(report.read_page(spark, path, pages - 1, size))
    assert "GreaterThanOrEqual(place," in text and "LessThanOrEqual(place," in text
    chosen = report.write_pages(results, path, filters={"status": "FAIL"}, keep=["result_id"], tie_breakers=["result_id"])
    assert chosen is None and {row["status"] for row in report.read_page(spark, path, 0, 50).collect()} == {"FAIL"}


def test_rows_of_others_stay_in_the_scan(spark, tmp_path):
    """A cohort of one person in fifty: hardly more than their rows are dealt out, and the counts are those without a filter."""
    spark.range(100_000).selectExpr(
        "pmod(xxhash64(id), 20000) AS person_id", "IF(id % 7 = 0, NULL, id) AS x"
    ).write.parquet(f"{tmp_path}/{M}")
    cdm = cdm_from_files(spark, str(tmp_path), [M])
    members = spark.range(0, 20_000, 50).selectExpr("1 AS cohort_definition_id", "id AS subject_id")
    members = members.union(members.limit(90)).union(members.selectExpr("1", "subject_id + 1000000"))
    plain, filtered = Cohort(members, 1), Cohort(members, 1, filter_words=512)
    true_rows = plain.filtered(cdm[M]).join(members, cdm[M]["person_id"] == members["subject_id"], "left_semi").count()
    assert true_rows <= filtered.filtered(cdm[M]).count() < 1.2 * true_rows
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        df = rowwise.is_required(cdm, M, "x", filtered)
        assert df.first() == rowwise.is_required(cdm, M, "x", plain).first()
        text = plan(df)
    finally:
        spark.conf.set(limit, before)
    filters = [line for line in text.splitlines() if "Filter" in line and "subquery" in line]
    assert filters and text.index(filters[0]) > text.index("Exchange hashpartitioning(person_id")
    # Ids that may be equal without being hashed alike are not filtered.
    texts = Cohort(members.selectExpr("cohort_definition_id", "CAST(subject_id AS STRING) AS subject_id"), 1, filter_words=512)
    assert texts.filtered(cdm[M]).count() == 100_000
    assert filtered.bloom_filter().first()[0].count(0) < 512
    assert Cohort(members.limit(0), 1, filter_words=64).filtered(cdm[M]).count() == 0


HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
}


@pytest.mark.parametrize("check", ["is_required", "is_primary_key", "is_foreign_key", "rows of is_primary_key", "within_visit_dates"])
def test_a_hot_key_is_split(spark, check):
    """One person, and one duplicated key, with a third of the rows, and as many rows without a person."""
    rows = spark.range(60_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN NULL ELSE id END AS person_id",
        "IF(id % 3 = 0, 7, id) AS measurement_id", "IF(id % 3 = 0, 7, id) AS visit_occurrence_id",
        "date_add(DATE '2020-01-05', CAST(pmod(xxhash64(id), 20000) AS INT)) AS d", "id % 50 AS concept", "IF(id % 5 = 0, NULL, md5(CAST(id AS STRING))) AS filler",
    )
    members = spark.range(40_000).selectExpr("1 AS cohort_definition_id", "id AS subject_id")
    visits = spark.range(50_000).selectExpr(
        "id AS visit_occurrence_id", "DATE '2020-01-01' AS visit_start_date", "DATE '2020-01-02' AS visit_end_date"
    )
    cdm = Cdm({
        M: rows.repartition(8), "concept": spark.range(40).selectExpr("id AS concept_id"), "visit_occurrence": visits,
    })
    cohort = Cohort(members, 1)
    before = {name: spark.conf.get(name, None) for name in HOT}
    for name, value in HOT.items():
        spark.conf.set(name, value)
    try:
        df = {
            "is_required": lambda: rowwise.is_required(cdm, M, "filler", cohort),
            "is_primary_key": lambda: keyed.is_primary_key(cdm, M, "measurement_id", cohort),
            "is_foreign_key": lambda: lookup.is_foreign_key(cdm, M, "concept", "concept", "concept_id", cohort),
            "within_visit_dates": lambda: temporal.within_visit_dates(cdm, M, "d"),
            "rows of is_primary_key": lambda: violations.is_primary_key(cdm, M, "measurement_id"),
        }[check]()
        df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_unit_and_value_checks_share_one_scan(cdm, spark):
    """The rows of a table are read, joined and dealt out once for both, though each needs other ones of them."""
    control = concepts.concept_control(spark, "low", concepts.LOW, 7, unit_concept_id=2, low=10.0).unionAll(
        concepts.concept_control(spark, "units", concepts.UNITS, 7, units="2,3")
    )
    df = concepts.count_value_checks(cdm, M, MC, control)
    assert len(df.collect()) == 2
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert len([text for text in columns(final) if "value_as_number" in text]) == 1 and "ReusedExchange" in final
