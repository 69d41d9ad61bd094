"""SimHash fingerprints, and near duplicates by bit-sliced comparison."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import column, cut, documents, released, slices
from plumbline.llm.components import connected_components
from plumbline.llm.mixing import scramble

SEED = 42
AT_ONCE = 1 << 16
PAIRS_AT_ONCE = 1 << 22


def shingle_hashes(text: str | None, words: int) -> np.ndarray:
    """XXH64 of the text's shingles of so many words, A-Z lower-cased, repeats included. A shorter text is one shingle, a text
    without words has none."""
    parts = text.encode().lower().split() if text else []  # bytes: only A-Z and the six ASCII white-space characters
    if not parts:
        return np.empty(0, np.uint64)
    rows = zip(*(parts[i:] for i in range(words)), strict=False) if len(parts) >= words else [parts]
    return np.fromiter((xxhash.xxh64_intdigest(x, SEED) for x in map(b" ".join, rows)), np.uint64)


def fingerprint(hashes: np.ndarray, width: int = 1) -> np.ndarray:
    """``width`` numbers of 64 bits: each bit is 1 if it is set in over half the hashes. The first number is from the hashes
    themselves, the others from further hashes of them."""
    total = np.zeros(64 * width, np.int64)
    for start in range(0, len(hashes), AT_ONCE):
        some = hashes[start : start + AT_ONCE, None]
        if width > 1:
            more = scramble(some + np.arange(1, width, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            some = np.concatenate([some, more], axis=1)
        bits = np.unpackbits(np.ascontiguousarray(some).view(np.uint8), axis=1, bitorder="little")
        for begin in range(0, len(bits), 255):  # so many fit into a byte
            total += bits[begin : begin + 255].sum(0, dtype=np.uint8)
    return np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)


def fingerprints(docs: DataFrame, words: int = 3, width: int = 1, ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: the ``ids``, w0, w1, ... (the fingerprint's numbers, as signed longs). Texts without words have zeros."""
    names = [f"w{i}" for i in range(width)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = np.empty((part.num_rows, width), np.uint64)
                for i, text in enumerate(part.column("text").to_pylist()):
                    found[i] = fingerprint(shingle_hashes(text, words), width)
                columns = [pa.array(c) for c in found.view(np.int64).T.copy()]
                yield pa.RecordBatch.from_arrays([*[part.column(i) for i in ids], *columns], [*ids, *names])

    schema = ", ".join(f"{name} long" for name in [*ids, *names])
    return docs.select(*ids, "text").mapInArrow(released(task), schema)


def far_apart(planes: np.ndarray, query: np.ndarray, radius: int) -> np.ndarray:
    """Which of 64 fingerprints of each block lie beyond the radius of that block's query, as bits of one number.

    planes: (blocks, bits), the b-th number of a block having bit b of its 64 fingerprints; query: (blocks, bits / 64). One
    pass over the bit planes adds their differences to all 64 distances at once, in carry-save counters:
    ``counter[i]`` holds the bits of weight 2**i of 64 distances. A distance beyond the counters' range is kept in
    ``over``. Blocks all of whose distances exceed the radius are abandoned.
    """
    width = max(1, radius.bit_length())
    over = np.zeros(len(query), np.uint64)
    counter = np.zeros((width, len(query)), np.uint64)
    live = np.arange(len(query))
    every = np.uint64(0xFFFFFFFFFFFFFFFF)
    n_bits = planes.shape[1]
    for b in range(n_bits):
        bit = (query[live, b // 64] >> np.uint64(b % 64)) & np.uint64(1)
        carry = planes[live, b] ^ (np.uint64(0) - bit)
        for i in range(width):
            counter[i, live], carry = counter[i, live] ^ carry, counter[i, live] & carry
        over[live] |= carry
        if b % 8 == 7 and b < n_bits - 1:
            live = live[(over[live] | above(counter[:, live], radius)) != every]
            if not len(live):
                break
    return over | above(counter, radius)


def above(counter: np.ndarray, radius: int) -> np.ndarray:
    """Which of the distances in the counters are greater than the radius."""
    greater = np.zeros(counter.shape[1], np.uint64)
    equal = ~greater
    for i in range(len(counter) - 1, -1, -1):
        if radius >> i & 1:
            equal &= counter[i]
        else:
            greater |= equal & counter[i]
            equal &= ~counter[i]
    return greater


def sliced(values: np.ndarray) -> np.ndarray:
    """Bit planes of consecutive blocks of 64 fingerprints, the last filled up with zeros: (blocks, bits)."""
    n, width = values.shape
    padded = np.zeros((-(-n // 64) * 64, width), np.uint64)
    padded[:n] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 64, 8 * width), axis=2, bitorder="little")
    packed = np.packbits(bits.transpose(0, 2, 1), axis=2, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64).reshape(-1, 64 * width)


def near_in_runs(keys: np.ndarray, values: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of fingerprints within the radius, among those with the same key; keys are in order."""
    n = len(keys)
    edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    ends = np.repeat(np.append(edges, n), np.diff(np.concatenate([[0], edges, [n]])))
    planes = sliced(values)
    at = np.arange(n)
    block, last = (at + 1) // 64, (ends - 1) // 64
    query = at[at + 1 < ends]
    while len(query):
        for start in range(0, len(query), 1 << 14):
            some = query[start : start + (1 << 14)]
            here = block[some]
            near = ~far_apart(planes[here], values[some], radius)
            low = np.maximum(some + 1 - here * 64, 0).astype(np.uint64)
            high = np.minimum(ends[some] - here * 64, 64).astype(np.uint64)
            near &= (~np.uint64(0)) << low
            near &= np.where(high == 64, ~np.uint64(0), (np.uint64(1) << (high % np.uint64(64))) - np.uint64(1))
            hit = np.flatnonzero(near)
            bits = np.unpackbits(near[hit].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            row, lane = np.nonzero(bits)
            if len(row):
                yield some[hit[row]], here[hit[row]] * 64 + lane
        block[query] += 1
        query = query[block[query] <= last[query]]


def forest(bucket: np.ndarray, value: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Pairs (as two lists of places) of a shortest spanning forest of each bucket's pairs within the radius."""
    found = []
    for i, j in near_in_runs(bucket, value, radius):
        distance = np.bitwise_count(value[i] ^ value[j]).sum(1).astype(np.uint16)
        found.append((distance, i.astype(np.int32), j.astype(np.int32)))
    us: list[int] = []
    vs: list[int] = []
    if not found:
        return us, vs
    distance, i, j = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(distance, kind="stable")
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (p := parent.get(x, x)) != x:
            parent[x] = parent.get(p, p)
            x = p
        return x

    for start in range(0, len(order), AT_ONCE):
        some = order[start : start + AT_ONCE]
        for a, b in zip(i[some].tolist(), j[some].tolist(), strict=True):
            a_root, b_root = root(a), root(b)
            if a_root != b_root:
                parent[b_root] = a_root
                us.append(a)
                vs.append(b)
    return us, vs


def bucket_links(rows: DataFrame, keys: list[str], width: int, radius: int) -> DataFrame:
    """Pairs (u, v) of nodes within the radius in some bucket, as many as the components of each bucket need.

    rows: the key columns, node, w0, w1, ...; a bucket is all rows with the same keys. It is dealt out to one task and
    compared block by block of 64. Of its pairs those of a shortest spanning forest are returned: in order of their distance,
    the ones that join what shorter ones have not joined.
    """
    names = [f"w{i}" for i in range(width)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the rows of the last, possibly unfinished bucket

        def pairs(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            own, node = columns[: len(keys)], columns[len(keys)]
            value = np.stack(columns[len(keys) + 1 :], axis=1).view(np.uint64)
            new = np.zeros(len(node), bool)
            for c in own:
                new[1:] |= c[1:] != c[:-1]
            bucket = np.cumsum(new)
            sizes = np.bincount(bucket)
            several = sizes[bucket] > 1
            bucket, node, value = bucket[several], node[several], value[several]
            # Whole buckets, with about PAIRS_AT_ONCE pairs at a time.
            squares = np.cumsum(np.where(sizes > 1, sizes.astype(np.int64) ** 2, 0))[bucket]
            cuts = np.flatnonzero(np.diff(squares // PAIRS_AT_ONCE, prepend=-1, append=np.iinfo(np.int64).max)).tolist()
            for start, end in zip(cuts, cuts[1:], strict=False):
                us, vs = forest(bucket[start:end], value[start:end], radius)
                if us:
                    us, vs = np.array(us) + start, np.array(vs) + start
                    yield pa.RecordBatch.from_arrays([pa.array(node[us]), pa.array(node[vs])], ["u", "v"])

        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if held:
                columns = [np.concatenate(c) for c in zip(held, columns, strict=True)]
            if not len(columns[0]):
                continue
            other = np.zeros(len(columns[0]), bool)
            for c in columns[: len(keys)]:
                other |= c != c[-1]
            at = len(other) - int(other[::-1].argmax()) if other.any() else 0
            if at:
                yield from pairs([c[:at] for c in columns])
            held = [c[at:] for c in columns]
        if held:
            yield from pairs(held)

    dealt = rows.select(*keys, "node", *names).repartition(*keys).sortWithinPartitions(*keys, "node")
    return dealt.mapInArrow(task, "u long, v long")


def linked(values: DataFrame, radius: int = 2, blocks: int = 8) -> DataFrame:
    """Pairs (u, v) of distinct fingerprints (``fingerprint``, 64 bits) within the radius, as many as their components need.

    Of ``blocks`` equal parts of the 64 bits, at least ``blocks - radius`` are the same in such a pair. So each fingerprint goes
    to one bucket for each choice of that many parts, and pairs are compared within buckets. A bucket's fingerprints differ
    in the other parts only, so with 8 parts and a radius of 2 it never holds more than 2**16 of them, whatever the data.
    """
    size = 64 // blocks
    masks = [sum(((1 << size) - 1) << (size * i) for i in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    choices = F.array(*[
        F.struct(F.lit(i).cast("byte").alias("choice"), F.col("fingerprint").bitwiseAND(F.lit(signed(m))).alias("key"))
        for i, m in enumerate(masks)
    ])
    rows = values.select(F.col("fingerprint").alias("node"), F.explode(choices).alias("c"))
    rows = rows.select("c.choice", "c.key", "node", F.col("node").alias("w0"))
    return bucket_links(rows, ["choice", "key"], 1, radius)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def near_duplicates(
    docs: DataFrame, words: int = 3, radius: int = 2, doc_id: str = "doc_id", text: str = "text", ids: tuple[str, ...] = ()
) -> DataFrame:
    """One row per document: doc_id, the ``ids`` (columns of longs that are passed on), fingerprint (long), component_id, component.

    Documents whose fingerprints differ in ``radius`` bits at most are linked; ``component_id`` is the smallest doc_id that
    links reach, ``component`` the smallest fingerprint. Null and empty texts have the fingerprint 0 and are linked like any
    other. Repeated rows each get their row. A null doc_id takes part and is the smallest only where there is no other. An
    empty table gives no rows.

    Only distinct fingerprints are compared, so any number of copies costs no more than one.
    """
    own = documents(docs, doc_id, text, **{f"id{i}": name for i, name in enumerate(ids)})
    passed = tuple(f"id{i}" for i in range(len(ids)))
    prints = cut(fingerprints(own, words, ids=("doc_id", *passed)).withColumnRenamed("w0", "fingerprint"))
    distinct = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first"))
    groups = connected_components(linked(distinct.select("fingerprint"), radius))
    groups = groups.withColumnRenamed("node", "fingerprint")
    least = distinct.join(groups, "fingerprint", "left").withColumn("component", F.coalesce("component", "fingerprint"))
    first = least.groupBy("component").agg(F.min("first").alias("component_id"))
    named = cut(least.join(first, "component").select("fingerprint", "component_id", "component"))
    return prints.join(named, "fingerprint").select(
        "doc_id", *[F.col(p).alias(name) for p, name in zip(passed, ids, strict=True)], "fingerprint", "component_id", "component"
    )


def one_of_each(docs: DataFrame, words: int = 3, radius: int = 2) -> DataFrame:
    """The documents without near duplicates: of each component of ``near_duplicates``, the row with the smallest doc_id (null
    first; of several, the least by a hash of all columns) stays, with all its columns, whatever their names.

    Rows that are equal in all columns are one. Null and empty texts are one component. An empty table gives no rows. Columns
    must not be maps, which have no hash. A row is known by 128 bits of all its columns. Repeated rows are made one per task before
    texts are shuffled, which happens once.
    """
    cells = [cell for name in docs.columns for cell in (column(docs, name).isNull(), column(docs, name))]
    keys = ["key1", "key2"]
    every = F.struct(*[column(docs, name) for name in docs.columns]).alias("row")
    rows = docs.select(every, *[F.xxhash64(F.lit(i), *cells).alias(key) for i, key in enumerate(keys)])
    texts = rows.select("row.doc_id", "row.text", *keys)
    found = near_duplicates(texts, words, radius, ids=tuple(keys))
    best = found.groupBy("component").agg(F.min(F.struct("doc_id", *keys)).alias("best")).select("best.key1", "best.key2")
    return rows.dropDuplicates(keys).join(best, keys, "left_semi").select("row.*")
