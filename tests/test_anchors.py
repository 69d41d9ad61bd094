"""Known counts at scale factor 0.01, worked out independently of this package."""

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.01"
ANCHORS = {
    "person_completeness": (1388, 1500),
    "condition_era_completeness": (38, 150),
    "table_concept_completeness": (913, 60000),
    "is_required": (150, 1500),
    "measure_value_completeness": (8590, 60000),
    "cdm_datatype": (8489, 60000),
    "is_primary_key": (25953, 60000),
    "is_foreign_key": (286, 1500),
    "fk_domain": (46245, 60000),
    "fk_class": (52968, 60000),
    "is_standard_valid_concept": (23896, 60000),
    "concept_record_completeness": (3023, 60000),
    "concept_record_completeness_unit": (5206, 51410),
    "source_value_completeness": (57, 101),
    "plausible_value_low": (380, 1500),
    "plausible_value_low_date": (8840, 60000),
    "plausible_value_high": (5084, 51410),
    "plausible_value_high_date": (7237, 60000),
    "plausible_temporal_after_birth": (7828, 60000),
    "plausible_temporal_after_self": (1515, 15000),
    "plausible_during_life": (2851, 6212),
    "within_visit_dates": (56844, 60000),
    "concept_plausible_gender": (11, 28),
    "concept_plausible_unit_concept_ids": (7, 14),
    "concept_plausible_unit_any": (12, 14),
    "concept_plausible_value_low": (1, 2),
    "concept_plausible_value_high": (1, 2),
    "cohort_is_required": (2445, 17054),
}


@pytest.mark.parametrize("name", list(ANCHORS))
def test_anchor(spark, name):
    row = entry.queries()[name](spark, FOLDER).first()
    assert (row["num_violated_rows"], row["num_denominator_rows"]) == ANCHORS[name]
