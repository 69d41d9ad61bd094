"""Column-level building blocks shared by the operators."""

from plumbline.functions.counting import (
    CHECK_KEY,
    DENOMINATOR,
    PERCENT,
    VIOLATED,
    check_counts,
    col,
    pct_ratio,
    tally,
    to_long,
)
from plumbline.functions.text import (
    blank_to_null,
    check_id,
    number_text,
    percent_text,
    render_description,
)
from plumbline.functions.values import as_date, bound, is_numeric_text, split_list

__all__ = [
    "CHECK_KEY",
    "DENOMINATOR",
    "PERCENT",
    "VIOLATED",
    "as_date",
    "blank_to_null",
    "bound",
    "check_counts",
    "check_id",
    "col",
    "is_numeric_text",
    "number_text",
    "pct_ratio",
    "percent_text",
    "render_description",
    "split_list",
    "tally",
    "to_long",
]
