"""SHA-256 of texts that are spread over many rows, without putting them together."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: The digest of no text.
EMPTY = hashlib.sha256().hexdigest()


def digests_in_order(batches: Iterable[pa.RecordBatch], separator: bytes) -> Iterator[tuple[str, str]]:
    """Key and digest of each run of rows with one key."""
    key = digest = None
    for batch in batches:
        for now, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if digest is None or now != key:
                if digest is not None:
                    yield key, digest.hexdigest()
                key, digest = now, hashlib.sha256()
            else:
                digest.update(separator)
            digest.update(text.encode())
    if digest is not None:
        yield key, digest.hexdigest()


def joined_digests(rows: DataFrame, separator: str) -> DataFrame:
    """One row per key: key, sha256 (lowercase hexadecimal) of its texts, by place, joined by the separator.

    ``rows`` has key (a string), place (a long) and text, none of them null. A digest can only be taken from beginning to end, so the
    texts of a key pass one task; they do so one after the other, and are never held together.
    """
    ordered = rows.select("key", "place", "text").repartition("key").sortWithinPartitions("key", "place").drop("place")
    mark = separator.encode()

    def digest(batches):
        some: list[tuple[str, str]] = []
        for pair in digests_in_order(batches, mark):
            some.append(pair)
            if len(some) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*some, strict=True)], ["key", "sha256"])
                some = []
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*some, strict=True)], ["key", "sha256"])

    return ordered.mapInArrow(digest, "key string, sha256 string")


def joined_runs(rows: DataFrame, separator: str, most: int = 4096) -> DataFrame:
    """The rows of ``joined_digests`` with fewer of them: up to ``most`` texts of a key that follow each other are one. Keys with
    very many short texts are dealt out by ranges of (key, place) for this, so that no task has to sort a whole key."""
    ordered = rows.select("key", "place", "text").repartitionByRange("key", "place").sortWithinPartitions("key", "place")

    def runs(batches):
        names = ["key", "place", "text"]
        key = place = None
        texts: list[str] = []
        for batch in batches:
            out: list[tuple[str, int, str]] = []
            for now, at, text in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if texts and (now != key or len(texts) >= most):
                    out.append((key, place, separator.join(texts)))
                    texts = []
                if not texts:
                    key, place = now, at
                texts.append(text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
        if texts:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([place], pa.int64()), pa.array([separator.join(texts)])], names)

    return ordered.mapInArrow(runs, "key string, place bigint, text string")

