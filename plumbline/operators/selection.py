"""Choosing checks: filters over the control tables and check descriptions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.sources.control import Controls

# Vocabulary tables that are not checked unless asked for.
VOCABULARY_TABLES = (
    "CONCEPT",
    "VOCABULARY",
    "CONCEPT_ANCESTOR",
    "CONCEPT_RELATIONSHIP",
    "CONCEPT_CLASS",
    "CONCEPT_SYNONYM",
    "RELATIONSHIP",
    "DOMAIN",
)
# A field of this name is a reserved word in many databases and is never checked.
OFFSET_FIELD = "offset"


def select_tables(
    control: DataFrame, include: Iterable[str] = (), exclude: Iterable[str] = VOCABULARY_TABLES
) -> DataFrame:
    """Control rows of the included tables (none given: all) that are not excluded. Names may be in
    any case, in the lists and in the control tables."""
    wanted = [name.upper() for name in include]
    unwanted = [name.upper() for name in exclude]
    name = F.upper("cdmTableName")
    if wanted:
        control = control.where(name.isin(wanted))
    if unwanted:
        control = control.where(~name.isin(unwanted))
    return control


def drop_offset_field(fields: DataFrame) -> DataFrame:
    """Field control without fields named exactly ``offset``."""
    return fields.where(F.col("cdmFieldName") != OFFSET_FIELD)


def select_checks(descriptions: DataFrame, names: Iterable[str] = ()) -> DataFrame:
    """Descriptions of the named checks (none given: all). It is an error if none remains."""
    names = list(names)
    if names:
        descriptions = descriptions.where(F.col("checkName").isin(names))
    if descriptions.isEmpty():
        raise ValueError("no checks are left to run; see the check names and excluded tables")
    return descriptions


def evaluation_filter(control: DataFrame, condition: str) -> DataFrame:
    """Control rows to which a check applies, e.g. ``isForeignKey=='Yes' & fkDomain!=''``. The
    condition is Spark SQL, except that ``&`` and ``|`` mean AND and OR."""
    words = {"&": " AND ", "|": " OR "}
    sql = re.sub(
        r"'[^']*'|[&|]", lambda found: words.get(found.group(), found.group()), condition
    )
    return control.where(F.expr(sql))


def select_controls(
    controls: Controls,
    include: Iterable[str] = (),
    exclude: Iterable[str] = VOCABULARY_TABLES,
    names: Iterable[str] = (),
) -> Controls:
    """All selections at once."""
    include, exclude = list(include), list(exclude)
    return Controls(
        select_checks(controls.descriptions, names),
        select_tables(controls.tables, include, exclude),
        drop_offset_field(select_tables(controls.fields, include, exclude)),
        select_tables(controls.concepts, include, exclude),
    )
