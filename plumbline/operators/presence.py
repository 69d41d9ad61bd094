"""Do the expected tables and fields exist? Decided from schemas, without reading rows."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.counting import DENOMINATOR, VIOLATED
from plumbline.sources.cdm import Cdm


def actual_fields(spark: SparkSession, cdm: Cdm, tables: Iterable[str]) -> DataFrame:
    """(table_name, field_name) of what is there of these tables, in lower case; no other table is
    opened."""
    names = dict.fromkeys(name.lower() for name in tables)
    pairs = [(name, field.lower()) for name in names if name in cdm for field in cdm[name].columns]
    return spark.createDataFrame(
        pa.table(
            {
                "table_name": pa.array([t for t, _ in pairs], pa.string()),
                "field_name": pa.array([f for _, f in pairs], pa.string()),
            }
        )
    )


def asked_for(expected: DataFrame) -> list[str]:
    """The tables named by control rows."""
    return [row["table_name"] for row in expected.select("table_name").distinct().collect() if row["table_name"]]


def _presence(expected: DataFrame, actual: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Expected rows with 1 of 1 violated where nothing of that name is there, in any case."""
    lower = {f"__{key}": key for key in keys}
    there = actual.select(*[F.col(key).alias(name) for name, key in lower.items()]).distinct()
    return (
        expected.withColumns({name: F.lower(key) for name, key in lower.items()})
        .join(there.withColumn("__there", F.lit(True)), list(lower), "left")
        .select(
            *expected.columns,
            F.col("__there").isNull().cast("bigint").alias(VIOLATED),
            F.lit(1).cast("bigint").alias(DENOMINATOR),
        )
    )


def cdm_table(expected: DataFrame, cdm: Cdm, tables: Iterable[str] | None = None) -> DataFrame:
    """1 of 1 violated for each expected ``table_name`` that does not exist, else 0 of 1. ``tables``
    may say which tables are expected, if that is known without asking the control rows."""
    fields = actual_fields(expected.sparkSession, cdm, asked_for(expected) if tables is None else tables)
    return _presence(expected, fields, ["table_name"])


def cdm_field(expected: DataFrame, cdm: Cdm, tables: Iterable[str] | None = None) -> DataFrame:
    """1 of 1 violated for each expected (``table_name``, ``field_name``) that does not exist."""
    fields = actual_fields(expected.sparkSession, cdm, asked_for(expected) if tables is None else tables)
    return _presence(expected, fields, ["table_name", "field_name"])
