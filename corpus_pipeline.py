"""From raw documents to packed training sequences: quality, near duplicates, repeats, mixing, packing.

Every stage takes (spark, docs, folder of the tables) and works on all that its predecessor kept. ``run`` writes what a stage
returns as Parquet in the shared folder and reads it again for the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import mixing, packing, quality, repeats, simhash
from plumbline.llm.common import shared_folder

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
KEY = "__document_key"


def _kept(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The documents whose key is among the verdicts, by the key of doc_id and text."""
    keys = verdicts.where("kept").select(F.col("key").alias(KEY)).distinct()
    return docs.withColumn(KEY, F.xxhash64("doc_id", "text")).join(keys, KEY)


def _others(docs: DataFrame, *own: str) -> dict[str, str]:
    """Aliases for the columns that a stage only passes on, so that none clashes with its own."""
    return {f"passed_{i}": name for i, name in enumerate(c for c in docs.columns if c not in own)}


def _restored(changed: DataFrame, docs: DataFrame, others: dict[str, str]) -> DataFrame:
    """The columns of the documents, with the number of characters of the texts as they are now."""
    alias = {name: alias for alias, name in others.items()}
    now = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return changed.select([now.get(c, F.col(alias.get(c, c))).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Without the documents that the quality rules reject."""
    return _kept(docs, quality.judge_quality(docs)).drop(KEY)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of copies and near copies: fingerprints of 3-word shingles that differ in 2 bits at most, or
    are linked by others that do. See ``simhash.one_of_each`` for nulls, repeated rows and ties."""
    return simhash.one_of_each(docs, words=3, radius=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without passages of 200 bytes or more that occur earlier; a document may be left with little or no text."""
    others = _others(docs, "doc_id", "text")
    found = repeats.remove_repeats(docs, keep_first=True, whole_characters=True, **others)
    return _restored(found.withColumn("text", F.col("kept").cast("string")), docs, others)


def mixed_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents, or parts of them, as often as the mix of sources uses them."""
    others = _others(docs, "doc_id", "text", "source")
    mix = mixing.mix_sources(docs, keep_text=True, **others)
    return _restored(mixing.mixed_texts(mix), docs, others)


def packed_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of the documents, as token ids, in sequences of 1024."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("mixed sources", mixed_sources),
    ("packed sequences", packed_sequences),
]

#: Fingerprints of shingles, draws and token ids have no counterpart in SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of the folder; the result of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    place = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        path = f"{place}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
