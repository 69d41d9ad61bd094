"""Where results go: a nested JSON report, flat CSV, and tables."""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.operators.report import counters
from plumbline.sources.cdm import Cdm

# Columns of the result table, in order, with their types.
RESULT_COLUMNS = {
    "num_violated_rows": "bigint",
    "pct_violated_rows": "double",
    "num_denominator_rows": "bigint",
    "execution_time": "string",
    "query_text": "string",
    "check_name": "string",
    "check_level": "string",
    "check_description": "string",
    "cdm_table_name": "string",
    "cdm_field_name": "string",
    "concept_id": "string",
    "unit_concept_id": "string",
    "sql_file": "string",
    "category": "string",
    "subcategory": "string",
    "context": "string",
    "warning": "string",
    "error": "string",
    "checkid": "string",
    "is_error": "int",
    "not_applicable": "int",
    "failed": "int",
    "passed": "int",
    "not_applicable_reason": "string",
    "threshold_value": "double",
    "notes_value": "string",
}
# Columns that the tables of single levels do without.
LEVEL_WITHOUT = {
    "TABLE": ("cdm_field_name", "concept_id", "unit_concept_id", "warning", "error"),
    "FIELD": ("concept_id", "unit_concept_id", "warning", "error"),
    "CONCEPT": ("warning",),
}
# Keys of the metadata record.
CDM_SOURCE = "cdm_source"
METADATA_KEYS = (
    "CDM_SOURCE_NAME",
    "CDM_SOURCE_ABBREVIATION",
    "CDM_HOLDER",
    "SOURCE_DESCRIPTION",
    "SOURCE_DOCUMENTATION_REFERENCE",
    "CDM_ETL_REFERENCE",
    "SOURCE_RELEASE_DATE",
    "CDM_RELEASE_DATE",
    "CDM_VERSION",
    "VOCABULARY_VERSION",
)
ENGINE_VERSION = "0.1.0"


def result_table(results: DataFrame, run: Sequence[str] = ()) -> DataFrame:
    """Results in the fixed column order and types; absent columns are NULL."""
    there = {name.lower() for name in results.columns}
    return results.select(
        *run,
        *[
            (F.col(name) if name in there else F.lit(None)).cast(kind).alias(name)
            for name, kind in RESULT_COLUMNS.items()
        ],
    )


def level_table(results: DataFrame, level: str, run: Sequence[str] = ()) -> DataFrame:
    """Results of one level with the columns that level has, plus a row label ``x_row``."""
    return (
        result_table(results, run)
        .where(F.col("check_level") == level)
        .drop(*LEVEL_WITHOUT[level])
        .withColumn("x_row", F.monotonically_increasing_id().cast("string"))
    )


def write_results_csv(results: DataFrame, path: str, run: Sequence[str] = ()) -> None:
    """Flat results as CSV with header. Text may hold line breaks, quotes and outer blanks."""
    options = {"header": True, "quote": '"', "escape": '"'}
    options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    result_table(results, run).write.mode("overwrite").options(**options).csv(path)


def read_results_csv(spark, path: str, run: Sequence[str] = (), run_types: str = "") -> DataFrame:
    """Results written by ``write_results_csv``."""
    schema = ", ".join([run_types] * bool(run) + [f"{n} {t}" for n, t in RESULT_COLUMNS.items()])
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
    return spark.read.options(**options).schema(schema).csv(path)


def write_results_table(
    results: DataFrame,
    name: str,
    level: str | None = None,
    run: Sequence[str] = (),
    format: str = "parquet",
    path: str | None = None,
) -> None:
    """Replace the table ``name`` by the results, split by level on disk; with ``level`` by the
    results of that level in its own columns."""
    if level is not None:
        writer = level_table(results, level, run).write
    else:
        writer = result_table(results, run).write.partitionBy("check_level")
    writer = writer.format(format).mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def read_cdm_source(
    cdm: Cdm, version_key: str = "ENGINE_VERSION", table: str = CDM_SOURCE
) -> DataFrame | None:
    """The metadata record of a report: the source table's description of itself, NULL for what it
    does not say. None if there is no such table; an error if there is more than one row."""
    if table not in cdm:
        return None
    source = cdm[table]
    if source.limit(2).count() > 1:
        raise ValueError(f"{table} has more than one row")
    there = {name.lower(): name for name in source.columns}
    cells = [
        (F.col(f"`{there[key.lower()]}`") if key.lower() in there else F.lit(None))
        .cast("string")
        .alias(key)
        for key in METADATA_KEYS
    ]
    return source.limit(1).select(*cells, F.lit(ENGINE_VERSION).alias(version_key))


def report_document(
    results: DataFrame,
    started: Column | None = None,
    ended: Column | None = None,
    metadata: DataFrame | None = None,
    output_file: str = "results.json",
    run: Sequence[str] = (),
) -> DataFrame:
    """One nested row per run: time stamps, all results, the overview and the metadata. A document
    holds one run, i.e. one record per control row, whatever the size of the tables."""
    started = F.lit(None).cast("timestamp") if started is None else started
    ended = F.lit(None).cast("timestamp") if ended is None else ended
    names = [("checkId" if n == "checkid" else n.upper(), n) for n in RESULT_COLUMNS]
    record = F.struct(*[F.col(name).alias(key) for key, name in names])
    ordered = F.sort_array(F.collect_list(F.struct("checkid", record.alias("record"))))
    numbers = counters()
    document = (
        result_table(results, run)
        .groupBy(*run)
        .agg(
            ordered["record"].alias("CheckResults"),
            *[expr.alias(name) for name, expr in numbers.items()],
        )
    )
    return document.select(
        *run,
        *_stamps(started, ended),
        "CheckResults",
        F.struct(*numbers).alias("Overview"),
        _about(metadata).alias("Metadata"),
        F.lit(output_file).alias("outputFile"),
    )


def _stamps(started: Column, ended: Column) -> list[Column]:
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    seconds = F.floor(F.unix_millis(ended) / 1000 - F.unix_millis(started) / 1000)
    return [
        F.date_format(started, iso).alias("startTimestamp"),
        F.date_format(ended, iso).alias("endTimestamp"),
        F.concat(seconds.cast("string"), F.lit(" seconds")).alias("executionTime"),
    ]


def _about(metadata: DataFrame | None) -> Column:
    about = metadata.first() if metadata is not None else None
    facts = about.asDict() if about is not None else dict.fromkeys(METADATA_KEYS)
    return F.array(F.struct(*[F.lit(v).cast("string").alias(k) for k, v in facts.items()]))


def write_reports(
    results: DataFrame,
    path: str,
    started: Column | None = None,
    ended: Column | None = None,
    metadata: DataFrame | None = None,
    output_file: str = "results.json",
    run: Sequence[str] = (),
) -> None:
    """The documents of ``report_document``, one JSON file per run (in folders named by the ``run`` columns), written line
    by line: a head with everything else, the records in order, and a tail. No row ever holds more than one
    record, so a run may have any number. Read them with Spark's ``multiLine``. The run is in the document as well: many
    folders are read with ``recursiveFileLookup``, since the time in which Spark finds columns in the names of folders
    grows with the square of their number.

    The results are worked out once and moved once, as columns; their text is made where it is written. On a disk that the
    machines share, tasks write the files of runs themselves, see ``_write_files``."""
    started = F.lit(None).cast("timestamp") if started is None else started
    ended = F.lit(None).cast("timestamp") if ended is None else ended
    names = [("checkId" if n == "checkid" else n.upper(), n) for n in RESULT_COLUMNS]
    text = lambda value: F.to_json(value, {"ignoreNullFields": "false"})
    results, numbers = result_table(results, run), counters()
    about = F.struct(
        *run, *_stamps(started, ended), F.struct(*numbers).alias("Overview"), _about(metadata).alias("Metadata"),
        F.lit(output_file).alias("outputFile"),
    )
    opened = text(about)  # without its last brace, since the records follow
    head = F.concat(F.left(opened, F.length(opened) - 1), F.lit(',"CheckResults":[\n'))
    if not run and results.isEmpty():  # one document all the same
        none = results.agg(*[expr.alias(name) for name, expr in numbers.items()])
        none.select(F.concat(head, F.lit("]}")).alias("line")).write.mode("overwrite").text(path)
        return
    order = Window.partitionBy(*run).orderBy("checkid")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = [expr.over(whole).alias(name) for name, expr in numbers.items()]
    placed = results.select("*", *counted, F.row_number().over(order).alias("place"))
    line = F.concat(
        F.when(F.col("place") == 1, head).otherwise(F.lit(",")),
        text(F.struct(*[F.col(n).alias(key) for key, n in names])),
        F.when(F.col("place") == F.col("countTotal"), F.lit("\n]}")).otherwise(F.lit("")),
    )
    lines = placed.select(*run, "place", line.alias("line"))
    folder = _shared_disk(results.sparkSession, path) if run else None
    if folder is not None:
        _write_files(lines, folder, run)
        return
    writer = lines.sortWithinPartitions(*run, "place").select(*run, "line").write.mode("overwrite")
    (writer.partitionBy(*run) if run else writer).text(path)


def _shared_disk(spark: SparkSession, path: str) -> str | None:
    """The path as the operating system knows it, or None if it is not in its file system."""
    if getattr(spark, "_jvm", None) is None:
        return None
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    place = system.makeQualified(target).toUri()
    return place.getPath() if place.getScheme() == "file" else None


def _write_files(lines: DataFrame, folder: str, run: Sequence[str]) -> None:
    """What ``partitionBy(*run).text`` writes, written by the tasks as plain files. On disks, Spark's writer starts three
    processes per run, which set the modes of its folder, file and checksums; that takes several times as long as all the rest.

    ``lines`` come run by run and in order, the first of each with ``place`` 1. A file gets its name when it is whole, and the
    folder when all files are there; what was in its place goes then."""
    first = F.when(F.col("place") == 1, F.array(*[F.col(name).cast("string") for name in run]))
    rows = lines.select(first.alias("opens"), F.concat("line", F.lit("\n")).cast("binary").alias("line"))
    staged = f"{os.path.dirname(folder)}/.{os.path.basename(folder)}-{uuid.uuid4().hex}"
    os.makedirs(staged)
    try:
        rows.mapInArrow(_file_task(staged, tuple(run)), "files bigint").write.format("noop").mode("overwrite").save()
        open(f"{staged}/_SUCCESS", "w").close()
        if os.path.exists(folder):
            shutil.rmtree(folder)
        os.rename(staged, folder)
    except BaseException:
        shutil.rmtree(staged, ignore_errors=True)
        raise


def _file_task(
    folder: str, run: tuple[str, ...]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Writes each run to a file in its folder. Uses nothing of this package, which workers may not find."""

    def escaped(name):  # as Spark writes names of partitions
        return re.sub(r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]""", lambda found: f"%{ord(found[0]):02X}", name)

    def task(batches):
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        file, named, files = None, None, 0
        for batch in batches:
            for values, line in zip(batch["opens"].to_pylist(), batch["line"].to_pylist(), strict=True):
                if values is not None:
                    if file is not None:
                        file.close()
                        os.replace(file.name, named)
                    into = "/".join(
                        f"{escaped(name)}={escaped(value) if value else '__HIVE_DEFAULT_PARTITION__'}"
                        for name, value in zip(run, values, strict=True)
                    )
                    os.makedirs(f"{folder}/{into}", exist_ok=True)
                    # Repeated tasks write the same names, each with files of its own until they are whole.
                    name = f"part-{part:05d}-{files:06d}.txt"
                    file, named = open(f"{folder}/{into}/.{name}.{attempt}", "wb"), f"{folder}/{into}/{name}"
                    files += 1
                file.write(line)
        if file is not None:
            file.close()
            os.replace(file.name, named)
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    return task


def write_report_json(document: DataFrame, path: str) -> None:
    """One JSON document per run; keys with NULL are written too."""
    document.write.mode("overwrite").option("ignoreNullFields", False).json(path)
