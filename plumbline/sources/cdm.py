"""The tables under test: a case-insensitive mapping from table names to DataFrames."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

WEIGHT = "__weight"


@dataclass(frozen=True)
class Cohort:
    """Persons that a run is restricted to: ``members(subject_id, cohort_definition_id)``.

    Tables are joined with the members. With ``filter_words``, rows of other persons are left out before that, in
    the scan, by a Bloom filter of so many 64-bit words: worth it for a cohort that is a small part of the persons
    and yet too large to be broadcast. Three bits are set per person, so 5 persons a word let one in 130 others pass.
    A filter that is too small lets more pass and changes no result.
    """

    members: DataFrame
    definition_id: int
    filter_words: int | None = None

    def _bits(self, person: Column) -> list[Column]:
        """Places of a person in the filter."""
        number = person.cast("bigint")
        return [F.pmod(F.xxhash64(number, F.lit(i)), F.lit(self.filter_words * 64)) for i in range(3)]

    def bloom_filter(self) -> DataFrame:
        """The filter as one row with an array of words; set bits are put together per word before they move."""
        bits = self.subjects().select(F.explode(F.array(*self._bits(F.col("__subject")))).alias("bit"))
        word = F.floor(F.col("bit") / 64)
        mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("bit") % 64).cast("int"))
        words = bits.groupBy(word.alias("word")).agg(F.bit_or(mask).alias("mask"))
        every = self.members.sparkSession.range(self.filter_words).withColumnRenamed("id", "word")
        filled = every.join(words, "word", "left").select("word", F.coalesce("mask", F.lit(0).cast("bigint")).alias("mask"))
        ordered = F.sort_array(F.collect_list(F.struct("word", "mask")))
        return filled.agg(F.transform(ordered, lambda pair: pair["mask"]).alias("words"))

    def filtered(self, rows: DataFrame) -> DataFrame:
        """The rows of persons who may be members: all that are, and few others. Only whole numbers are hashed alike
        whatever their type, so that rows with other ids all stay."""
        types = [rows.schema["person_id"].dataType, self.members.schema["subject_id"].dataType]
        if self.filter_words is None or not all(isinstance(kind, T.IntegralType) for kind in types):
            return rows
        words = self.bloom_filter().scalar()
        for bit in self._bits(F.col("person_id")):
            word = F.get(words, F.floor(bit / 64).cast("int"))
            rows = rows.where(F.getbit(word, (bit % 64).cast("int")) == 1)
        return rows

    def subjects(self) -> DataFrame:
        """One row per membership of the wanted cohort."""
        return self.members.where(
            (F.col("cohort_definition_id") == self.definition_id) & F.col("subject_id").isNotNull()
        ).select(F.col("subject_id").alias("__subject"))

    def weights(self) -> DataFrame:
        """One row per subject with the number of its memberships.

        The second, redundant key makes Spark deal the rows out again right below a join on the
        subject; only then can adaptive execution split the rows of a subject who dominates."""
        subjects = self.subjects().groupBy("__subject", spread("__subject"))
        return subjects.agg(F.count(F.lit(1)).alias(WEIGHT)).select("__subject", WEIGHT)


def spread(key: str) -> Column:
    """A second grouping key that follows from the key, and so changes no group."""
    return F.pmod(F.xxhash64(key), F.lit(1024))


@dataclass(frozen=True)
class Rows:
    """Rows to count, and how often each of them counts (None: once)."""

    df: DataFrame
    weight: Column | None = None

    @property
    def times(self) -> Column:
        return F.lit(1).cast("bigint") if self.weight is None else self.weight


class NotInCdm(KeyError):
    """A table or field that does not exist."""

    def __str__(self) -> str:
        return str(self.args[0])


Loader = Callable[[], DataFrame | None]


class Cdm(Mapping[str, DataFrame]):
    """Tables under test. Names are looked up case-insensitively; absent tables are simply absent.

    A table may be given as a function that opens it, or returns None if it does not exist. It is
    called when the table is first asked for, so a run opens only the tables that it checks. If it
    fails, that is remembered: each use of the table raises the same error, and no other does.
    """

    def __init__(self, tables: Mapping[str, DataFrame | Loader]):
        self._tables: dict[str, DataFrame | None] = {}
        self._closed: dict[str, Loader] = {}
        self._failed: dict[str, Exception] = {}
        self._weighted: dict[str, tuple[Cohort, DataFrame]] = {}
        for name, table in tables.items():
            if isinstance(table, DataFrame):
                self._tables[name.lower()] = table
            else:
                self._closed[name.lower()] = table

    def _open(self, name: str) -> DataFrame | None:
        key = name.lower()
        if key in self._failed:
            raise self._failed[key]
        if key not in self._tables and key in self._closed:
            try:
                self._tables[key] = self._closed[key]()
            except Exception as error:
                self._failed[key] = error
                raise
        return self._tables.get(key)

    def __getitem__(self, name: str) -> DataFrame:
        table = self._open(name)
        if table is None:
            raise NotInCdm(f"Table {name} does not exist.")
        return table

    def __iter__(self) -> Iterator[str]:
        names = dict.fromkeys([*self._tables, *self._closed])
        return (name for name in names if self._open(name) is not None)

    def __len__(self) -> int:
        return sum(1 for _ in self)

    def __contains__(self, name: object) -> bool:
        return isinstance(name, str) and self._open(name) is not None

    def failure(self, name: str) -> Exception | None:
        """The error of opening the table, if it cannot be opened."""
        try:
            self._open(name)
        except Exception as error:
            return error
        return None

    def with_table(self, name: str, table: DataFrame) -> Cdm:
        """The same tables with one replaced."""
        changed = Cdm({**self._closed, **self._opened(), name.lower(): table})
        changed._weighted = {key: kept for key, kept in self._weighted.items() if key != name.lower()}
        return changed

    def stored(self, names: Iterable[str], folder: str, cohort: Cohort | None = None) -> Cdm:
        """The same tables, the named ones written below ``folder`` when they are first asked for, and read from there.

        For tables that are costly to build, such as joins, and read by many checks: they are built once, not
        once per group of checks. The folder must be one that all executors share. With a cohort, the memberships of each
        row are stored beside it, so that its checks join nothing. A table that cannot be written is used as it is.
        """
        found = Cdm({**self._closed, **self._opened()})
        found._weighted = dict(self._weighted)

        def loader(name: str) -> Loader:
            def load() -> DataFrame | None:
                if name not in self:
                    return None
                table, path = self[name], f"{folder.rstrip('/')}/{name}"
                weighted = cohort is not None and self.has_field(name, "person_id")
                rows = self.weighted(name, cohort) if weighted else table
                try:
                    rows.write.parquet(path)
                    kept = rows.sparkSession.read.schema(rows.schema).parquet(path)
                except Exception as error:  # checks of other columns may well succeed
                    log.warning("%s is not stored: %s", name, error)
                    return table
                if weighted:
                    found._weighted[name] = (cohort, kept)
                return kept.select(table.columns)

            return load

        for name in (name.lower() for name in names):
            found._tables.pop(name, None)
            found._closed[name] = loader(name)
        return found

    def _opened(self) -> dict[str, DataFrame]:
        return {name: table for name, table in self._tables.items() if table is not None}

    def field(self, table: str, field: str) -> T.StructField | None:
        """Schema entry of a field, or None."""
        if table not in self:
            return None
        return next((f for f in self[table].schema if f.name.lower() == field.lower()), None)

    def has_field(self, table: str, field: str) -> bool:
        return self.field(table, field) is not None

    def datatype(self, table: str, field: str) -> T.DataType:
        if table not in self:
            raise NotInCdm(f"Table {table} does not exist.")
        found = self.field(table, field)
        if found is None:
            raise NotInCdm(f"Field {table}.{field} does not exist.")
        return found.dataType

    def rows(self, table: str, cohort: Cohort | None = None) -> Rows:
        """Rows of a table for counting. With a cohort, a row counts once per membership.

        The cohort is reduced to one row per person first, so the join never multiplies the table;
        duplicate memberships become a weight.
        """
        df = self[table]
        if cohort is None:
            return Rows(df)
        kept = self._kept(table, cohort)
        if kept is not None:
            return Rows(kept.where(F.col(WEIGHT).isNotNull()), F.col(WEIGHT))
        weights = cohort.weights()
        joined = cohort.filtered(df).join(weights, F.col("person_id") == F.col("__subject")).drop("__subject")
        return Rows(joined, F.col(WEIGHT))

    def _kept(self, table: str, cohort: Cohort) -> DataFrame | None:
        """The stored rows with the memberships of this cohort, if there are any."""
        whose, kept = self._weighted.get(table.lower(), (None, None))
        return kept if whose is cohort else None

    def weighted(self, table: str, cohort: Cohort) -> DataFrame:
        """All rows of a table, with the number of memberships of their person; NULL for none."""
        df = self[table]
        kept = self._kept(table, cohort)
        if kept is not None:
            return kept
        return df.join(cohort.weights(), F.col("person_id") == F.col("__subject"), "left").drop("__subject")

    def member_rows(self, table: str, cohort: Cohort | None = None) -> DataFrame:
        """Rows of a table as rows: with a cohort, one output row per membership."""
        df = self[table]
        if cohort is None:
            return df
        subjects = cohort.subjects()
        return cohort.filtered(df).join(subjects, F.col("person_id") == F.col("__subject")).drop("__subject")


NOT_THERE = {"PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND"}


def _loaders(names: Iterable[str], read: Callable[[str], DataFrame]) -> Cdm:
    """Tables opened on demand; a name without data is left out (its checks report it missing)."""

    def loader(name: str) -> Loader:
        def load() -> DataFrame | None:
            try:
                return read(name)
            except AnalysisException as error:
                if error.getCondition() in NOT_THERE:
                    return None
                raise

        return load

    return Cdm({name: loader(name) for name in names})


def cdm_from_files(
    spark: SparkSession, folder: str, names: Iterable[str], format: str = "parquet", **options: str
) -> Cdm:
    """``folder/<name>.<format>`` or ``folder/<name>`` for each name (file names in lower case)."""

    def read(name: str) -> DataFrame:
        reader = spark.read.format(format).options(**options)
        base = f"{folder.rstrip('/')}/{name.lower()}"
        try:
            return reader.load(f"{base}.{format}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return reader.load(base)

    return _loaders(names, read)


def cdm_from_catalog(spark: SparkSession, names: Iterable[str], schema: str | None = None) -> Cdm:
    """Catalog tables ``schema.<name>``; also the way to tables of any Spark catalog plug-in."""
    prefix = f"{schema}." if schema else ""
    return _loaders(names, lambda name: spark.table(f"{prefix}{name}"))


def row_counts(cdm: Cdm) -> DataFrame:
    """(table_name, num_rows) of every table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("num_rows")).select(
            F.lit(name).alias("table_name"), "num_rows"
        )
        for name, df in cdm.items()
    ]
    result = counts[0]
    for frame in counts[1:]:
        result = result.unionAll(frame)
    return result


__all__ = [
    "Cdm",
    "Cohort",
    "NotInCdm",
    "Rows",
    "WEIGHT",
    "cdm_from_catalog",
    "cdm_from_files",
    "row_counts",
    "spread",
]
