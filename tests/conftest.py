import sys
from pathlib import Path

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from plumbline.fixtures import BASE_TABLES  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    scratch = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.checkpoint.dir", str(scratch / "shared"))
        .config("spark.sql.warehouse.dir", str(scratch / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in BASE_TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


@pytest.fixture(scope="session")
def frame(spark):
    """Small DataFrame from rows and a Spark schema text."""

    def make(schema: str, rows: list[tuple]):
        empty = spark.createDataFrame([], schema)
        if not rows:
            return empty
        target = empty.schema
        columns = list(zip(*rows))
        arrays = {
            field.name: pa.array(values) if any(v is not None for v in values) else pa.nulls(len(rows), pa.string())
            for field, values in zip(target, columns)
        }
        df = spark.createDataFrame(pa.table(arrays))
        return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in target])

    return make


def counts(df):
    """(violated, denominator) of a check."""
    row = df.first()
    violated, share, denominator = row
    assert share == (violated / denominator if denominator else 0.0)
    return violated, denominator
