"""What the operators of this subpackage share: columns, batches, checkpoints."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def column(df: DataFrame, name: str) -> Column:
    """The column of that name, dots in it included."""
    return df[f"`{name}`"]


def documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **more: str) -> DataFrame:
    """Only the columns an operator needs, under its own names, so that no other column of the input
    can clash with what it adds."""
    return docs.select(
        column(docs, doc_id).cast("long").alias("doc_id"),
        column(docs, text).cast("string").alias("text"),
        *[column(docs, name).alias(alias) for alias, name in more.items()],
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; where none is named, one below the warehouse,
    which executors share too. Also makes it the checkpoint folder of the session."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/plumbline-scratch")
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared folder; what led to them is not run again."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """Like ``cut``, but as Parquet below the shared folder: smaller, for tables with many rows. The files stay until the folder
    is cleaned up."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, text: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with at most so many bytes of text, but a row at least: what a task
    holds at a time does not depend on the number of rows in an Arrow batch."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    start = size = 0
    for row, n in enumerate(lengths):
        if row > start and size + n > most:
            yield batch.slice(start, row - start)
            start, size = row, 0
        size += n
    if batch.num_rows > start:
        yield batch.slice(start)


def released(task: Task) -> Task:
    """The task, which gives unused memory back to the system when its rows end. Spark keeps Python workers for later tasks and
    hands them out in turn, so what each of them once held would add up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU library has it
        if trim is not None:
            trim(0)

    return run
