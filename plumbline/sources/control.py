"""Control tables: which checks run on which tables, fields and concepts."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from plumbline.functions.text import blank_to_null

LEVELS = ("TABLE", "FIELD", "CONCEPT")


def read_control(spark: SparkSession, path: str) -> DataFrame:
    """A control CSV with header. All columns are text; blank cells are NULL, ``NA`` stays text.
    Cells may hold line breaks and quotes."""
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
    return blank_to_null(spark.read.options(**options).csv(path))


@dataclass(frozen=True)
class Controls:
    """Check descriptions and the control table of each level."""

    descriptions: DataFrame
    tables: DataFrame
    fields: DataFrame
    concepts: DataFrame

    def level(self, name: str) -> DataFrame:
        if name not in LEVELS:
            raise ValueError(f"invalid check level: {name}")
        return {"TABLE": self.tables, "FIELD": self.fields, "CONCEPT": self.concepts}[name]

    def local(self) -> Controls:
        """The same tables as constants of the plan, so that selecting checks starts no jobs. They
        are configuration: one row per table, field or concept of the data model."""

        def constant(df: DataFrame) -> DataFrame:
            return df.sparkSession.createDataFrame(df.toArrow())

        return replace(
            self,
            descriptions=constant(self.descriptions),
            tables=constant(self.tables),
            fields=constant(self.fields),
            concepts=constant(self.concepts),
        )


def read_controls(
    spark: SparkSession, descriptions: str, tables: str, fields: str, concepts: str
) -> Controls:
    """The four control CSVs of one version of the data model, each by its path."""
    return Controls(*(read_control(spark, p) for p in (descriptions, tables, fields, concepts)))
