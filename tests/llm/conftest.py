import pyarrow as pa
import pytest

#: Names that operators use inside; a column of the input may have any of them.
CLASHING = ["key", "kept", "h", "n", "row", "size", "block", "first", "spans", "found", "label2", "fingerprint", "part", "x0"]


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns that clash with inner names."""

    def make(rows):
        rows = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        ids, texts, langs, sources = zip(*rows, strict=True) if rows else ((), (), (), ())
        table = {
            "doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string()), "lang": pa.array(langs, pa.string()),
            "source": pa.array(sources, pa.string()), "n_chars": pa.array([len(t or "") for t in texts], pa.int64()),
        }
        table |= {name: pa.array(["?"] * len(rows), pa.string()) for name in CLASHING}
        return spark.createDataFrame(pa.table(table)).repartition(3)

    return make


@pytest.fixture(scope="session")
def sf_documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)
