"""Tables of a database, read over many connections that get equal shares of the rows."""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, Row, SparkSession

from plumbline.sources.cdm import Cdm

#: Types of columns that tables may be cut by, as databases name them.
INTEGERS = {"int", "int2", "int4", "int8", "integer", "bigint", "smallint", "number", "numeric", "decimal"}
#: More connections than this are not opened for one table.
MOST_PARTS = 1024


class Database(Protocol):
    """What is needed of a database. Names in results may be in any case."""

    def query(self, sql: str) -> list[Row]:
        """A small result: names of columns, or bounds."""

    def read(self, table: str, predicates: list[str]) -> DataFrame:
        """The rows of a table, one partition per predicate; without predicates in one."""


@dataclass(frozen=True)
class JdbcDatabase:
    """A database that Spark reaches through a JDBC driver."""

    spark: SparkSession
    url: str
    options: Mapping[str, object] = field(default_factory=dict)

    def query(self, sql: str) -> list[Row]:
        reader = self.spark.read.format("jdbc").option("url", self.url).option("query", sql)
        return reader.options(**self.options).load().collect()

    def read(self, table: str, predicates: list[str]) -> DataFrame:
        if predicates:
            texts = {name: str(value) for name, value in self.options.items()}
            return self.spark.read.jdbc(self.url, table, predicates=predicates, properties=texts)
        reader = self.spark.read.format("jdbc").option("url", self.url).option("dbtable", table)
        return reader.options(**self.options).load()


def table_columns(database: Database, schema: str | None) -> dict[str, tuple[str, list[tuple[str, str]]]]:
    """Per table in lower case: its own name, and names and types of its columns in order."""
    where = f" WHERE table_schema = '{schema}'" if schema else ""
    found: dict[str, tuple[str, list[tuple[str, str]]]] = {}
    listed = database.query(
        f"SELECT table_name, column_name, data_type, ordinal_position FROM information_schema.columns{where}"
    )
    for name, column, kind, _ in sorted(listed, key=lambda row: (row[0], row[3])):
        found.setdefault(name.lower(), (name, []))[1].append((column, kind))
    return found


def cutting_column(table: str, columns: Iterable[tuple[str, str]]) -> str | None:
    """The column to cut a table by: its own id, or else the first integer column whose name ends in ``_id``. An
    id is unique, so that no value can hold more than a row."""
    integers = [name for name, kind in columns if kind.lower().split("(")[0].strip() in INTEGERS]
    own = next((name for name in integers if name.lower() == f"{table.lower()}_id"), None)
    return own or next((name for name in integers if name.lower().endswith("_id")), None)


def equal_shares(database: Database, table: str, column: str, rows_per_part: int) -> list[str]:
    """Predicates that hold for each row of the table once, and for about as many rows each. The database finds the
    bounds as quantiles of the column, so that gaps and clusters of ids do no harm. Rows without a value
    go to the first part. No predicates for a table that is one part."""
    ((rows,),) = database.query(f"SELECT COUNT(*) AS n FROM {table}")
    parts = min(MOST_PARTS, math.ceil(int(rows) / rows_per_part))
    if parts < 2:
        return []
    found = database.query(
        f"SELECT MIN({column}) AS bound FROM (SELECT {column}, NTILE({parts}) OVER (ORDER BY {column}) AS part "
        f"FROM {table} WHERE {column} IS NOT NULL) shares GROUP BY part"
    )
    # One value may be the bound of several parts: they are one.
    bounds = sorted({int(row[0]) for row in found})[1:]
    if not bounds:
        return []
    between = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(bounds[:-1], bounds[1:])]
    return [f"{column} < {bounds[0]} OR {column} IS NULL", *between, f"{column} >= {bounds[-1]}"]


def cdm_from_database(
    database: Database,
    names: Iterable[str] | None = None,
    schema: str | None = None,
    rows_per_part: int = 1_000_000,
    cut_by: Mapping[str, str] | None = None,
) -> Cdm:
    """The tables of a schema: all of them, or those that are named. Names that the database does not list are
    missing tables.

    The list of tables and columns is asked for at once. A table is opened when it is first needed: it is cut by the
    column that ``cut_by`` names for it, or by ``cutting_column``, into ``equal_shares``; without such a column it is
    read through one connection, with a warning. What the database raises while a table is opened is the failure
    of that table alone.
    """
    there = table_columns(database, schema)
    given = {name.lower(): column for name, column in (cut_by or {}).items()}
    prefix = f"{schema}." if schema else ""

    def loader(key: str) -> Callable[[], DataFrame]:
        name, columns = there[key]

        def load() -> DataFrame:
            column = given.get(key) or cutting_column(key, columns)
            if column is None:
                warnings.warn(f"{name} is read through one connection: it has no integer id", stacklevel=2)
                return database.read(f"{prefix}{name}", [])
            return database.read(f"{prefix}{name}", equal_shares(database, f"{prefix}{name}", column, rows_per_part))

        return load

    wanted = there if names is None else [name.lower() for name in names if name.lower() in there]
    return Cdm({key: loader(key) for key in wanted})


def cdm_from_jdbc(
    spark: SparkSession,
    url: str,
    names: Iterable[str] | None = None,
    schema: str | None = None,
    rows_per_part: int = 1_000_000,
    cut_by: Mapping[str, str] | None = None,
    **options: object,
) -> Cdm:
    """Tables of a database with a JDBC driver and an ``information_schema``; see ``cdm_from_database``. ``options``
    are those of Spark's reader, such as user, password and driver."""
    return cdm_from_database(JdbcDatabase(spark, url, options), names, schema, rows_per_part, cut_by)
