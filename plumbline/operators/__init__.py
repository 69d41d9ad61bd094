"""Checks and what follows them. Counting operators are available here by name; the rows behind
the counts are in ``plumbline.operators.violations`` under the same names."""

from plumbline.operators.concepts import (
    concept_plausible_gender,
    concept_plausible_unit_concept_ids,
    concept_plausible_value_high,
    concept_plausible_value_low,
    count_concept_checks,
)
from plumbline.operators.keyed import is_primary_key, source_value_completeness
from plumbline.operators.lookup import (
    condition_era_completeness,
    fk_class,
    fk_domain,
    is_foreign_key,
    is_standard_valid_concept,
    person_completeness,
)
from plumbline.operators.presence import cdm_field, cdm_table
from plumbline.operators.rowwise import (
    cdm_datatype,
    concept_record_completeness,
    is_required,
    measure_value_completeness,
    plausible_value_high,
    plausible_value_low,
    table_concept_completeness,
)
from plumbline.operators.temporal import (
    plausible_during_life,
    plausible_temporal_after,
    within_visit_dates,
)

__all__ = [
    "cdm_datatype",
    "cdm_field",
    "cdm_table",
    "concept_plausible_gender",
    "concept_plausible_unit_concept_ids",
    "concept_plausible_value_high",
    "concept_plausible_value_low",
    "concept_record_completeness",
    "condition_era_completeness",
    "count_concept_checks",
    "fk_class",
    "fk_domain",
    "is_foreign_key",
    "is_primary_key",
    "is_required",
    "is_standard_valid_concept",
    "measure_value_completeness",
    "person_completeness",
    "plausible_during_life",
    "plausible_temporal_after",
    "plausible_value_high",
    "plausible_value_low",
    "source_value_completeness",
    "table_concept_completeness",
    "within_visit_dates",
]
