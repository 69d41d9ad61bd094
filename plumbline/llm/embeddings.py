"""Near-duplicate embeddings by spherical-cap filters with list-decodable product codes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import column, cut
from plumbline.llm.components import SALTS, connected_components


@lru_cache(8)
def product_code(dimension: int, size: int, repeats: int, seed: int) -> np.ndarray:
    """(repeats, 2, size, half): for each repeat and each half of the coordinates so many random unit vectors. A filter
    direction is one vector of each half, so ``size`` ** 2 directions need only 2 * ``size`` inner products. Each repeat
    deals the coordinates out to the halves anew."""
    half = -(-dimension // 2)
    rng = np.random.default_rng([seed, dimension])
    code = rng.standard_normal((repeats, 2, size, half))
    return code / np.linalg.norm(code, axis=3, keepdims=True)


@lru_cache(8)
def deals(dimension: int, repeats: int, seed: int) -> list[np.ndarray]:
    return [np.random.default_rng([seed, dimension, r]).permutation(dimension) for r in range(repeats)]


def caps(units: np.ndarray, size: int, repeats: int, threshold: float, seed: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, filter) for every filter direction that a unit vector exceeds, or else the one nearest to it: list decoding. First
    halves that reach the threshold with no second half are left out, then the sums of the rest are compared. Vectors of few
    dimensions can't be far from all directions: there codes are smaller (two to the power of the half's dimensions), and the
    threshold is at most half the square root of the dimensions."""
    n, d = units.shape
    half, least = -(-d // 2), min(threshold, np.sqrt(d) / 2) * np.sqrt(2 / d)
    padded = np.zeros((n, 2 * half))
    codes = product_code(d, min(size, 1 << min(half, 20)), repeats, seed)
    for r, (code, deal) in enumerate(zip(codes, deals(d, repeats, seed), strict=True)):
        padded[:, :d] = units[:, deal]
        first, second = padded[:, :half] @ code[0].T, padded[:, half:] @ code[1].T
        best = first.max(1) + second.max(1)
        alone = np.flatnonzero(best < least)
        yield alone, (r * size + first[alone].argmax(1)) * size + second[alone].argmax(1)
        row, a = np.nonzero(first + second.max(1, keepdims=True) >= least)
        for start in range(0, len(row), 1 << 14):
            part = slice(start, start + (1 << 14))
            hit, b = np.nonzero(first[row[part], a[part], None] + second[row[part]] >= least)
            yield row[part][hit], (r * size + a[part][hit]) * size + b


def part_links(rows: pa.RecordBatch, cosine: float) -> Iterator[pa.RecordBatch]:
    """(node, links, other): what a part of a cap adds to the links of each vector, and the least vector that these reach. Of
    the pairs that share several caps, only those whose first one this is are counted."""
    n = rows.num_rows
    if n < 2:
        return
    a, b, cap = (rows.column(name)[0].as_py() for name in ("a", "b", "cap"))
    own, weight = rows.column("own").to_numpy(), rows.column("weight").to_numpy()
    left = np.flatnonzero(own == a)
    right = left if a == b else np.flatnonzero(own == b)
    v = rows.column("v").flatten().to_numpy().astype(np.float64).reshape(n, -1)
    v /= np.abs(v).max(1, keepdims=True)
    norm = np.sqrt(np.einsum("ij,ij->i", v, v))
    mask = v[left] @ v[right].T / (norm[left, None] * norm[right]) >= cosine
    if a == b:
        np.fill_diagonal(mask, False)
    if not mask.any():
        return
    caps = rows.column("caps").flatten().to_numpy()
    row = np.repeat(np.arange(n), pc.list_value_length(rows.column("caps")).to_numpy())
    earlier = caps < cap
    _, place, counts = np.unique(caps[earlier], return_inverse=True, return_counts=True)
    several = counts[place] > 1
    number = np.cumsum(counts > 1) - 1
    within = np.zeros((n, int((counts > 1).sum())), np.float32)
    within[row[earlier][several], number[place[several]]] = 1
    mask &= within[left] @ within[right].T == 0
    links = np.zeros(n, np.int64)
    links[left] += mask @ weight[right]
    if a != b:
        links[right] += weight[left] @ mask
    least, before = np.arange(n), None
    while before is None or (least != before).any():
        before = least.copy()
        least[left] = np.minimum(least[left], np.where(mask, least[right], n).min(1))
        least[right] = np.minimum(least[right], np.where(mask, least[left, None], n).min(0))
    hit = np.flatnonzero(links)
    node = rows.column("node").to_numpy()
    yield pa.RecordBatch.from_arrays(
        [pa.array(node[hit]), pa.array(links[hit]), pa.array(node[least[hit]])], ["node", "links", "other"]
    )


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.98,
    code_size: int = 64,
    repeats: int = 6,
    threshold: float = 3.0,
    block: int = 512,
    seed: int = 11,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Vectors with equal, non-null labels and equal dimensions are linked if their cosine, in double precision, is at least
    ``cosine``. Null vectors, zero vectors, and those with null or non-finite components have no links and are components
    of their own; so have empty vectors. ``n_links`` counts other rows linked directly; ``component_id`` is the smallest vec_id
    that links reach; ``kept`` says that it is the vector's own (repeated rows of one vec_id are all kept). An empty table
    gives no rows.

    Equal vectors are compared once, with their number as weight. A vector goes to all caps it is in (``threshold`` standard
    deviations of a random direction: with 64 ** 2 directions in each of 6 codes, about 27 caps); a pair is compared where both
    are in a cap and counted in the first such cap only. Of 1,500 pairs of random vectors of 64 dimensions with a cosine of
    0.98, all shared one. Caps with more than ``block`` vectors are compared block against block in many tasks, so none is
    capped or held whole. For
    far more vectors a label than a million, raise ``threshold`` by what keeps a cap's share constant, and ``code_size`` to
    keep the number of caps.
    """
    single = vectors.schema[embedding].dataType.simpleString() == "array<float>"
    kind = "array<float>" if single else "array<double>"
    rows = vectors.select(
        column(vectors, vec_id).cast("long").alias("vec_id"),
        column(vectors, label).cast("string").alias("label"),
        column(vectors, embedding).cast(kind).alias("v"),
    )
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0)
    rows = rows.withColumn("v", F.when(F.coalesce(usable, F.lit(False)), F.col("v")))
    # 0.0 and -0.0 are equal, but not the same key.
    rows = rows.withColumn("v", F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x)).cast(kind))
    distinct = cut(
        rows.where("v IS NOT NULL").groupBy("label", "v", F.size("v").alias("d"))
        .agg(F.count("*").alias("weight"), F.min("vec_id").alias("id"))
        .withColumn("node", F.xxhash64("label", "v"))
    )

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.column("d").to_numpy()
            flat, offsets = batch.column("v").flatten().to_numpy().astype(np.float64), np.cumsum(np.append(0, d))
            filters: list[list[int]] = [[] for _ in d]
            for size in np.unique(d):
                some = np.flatnonzero(d == size)
                for start in range(0, len(some), 2048):
                    part = some[start : start + 2048]
                    x = flat[offsets[part][:, None] + np.arange(size)]
                    x = x / np.abs(x).max(1, keepdims=True)
                    x /= np.linalg.norm(x, axis=1, keepdims=True)
                    for row, cap in caps(x, code_size, repeats, threshold, seed):
                        for i, c in zip(part[row].tolist(), cap.tolist(), strict=True):
                            filters[i].append(c)
            names = ["label", "d", "node", "weight", "v", "caps"]
            data = [*[batch.column(name) for name in names[:-1]], pa.array(filters, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(data, names)

    schema = f"label string, d int, node long, weight long, v {kind}, caps array<int>"
    capped = distinct.select("label", "d", "node", "weight", "v").mapInArrow(decode, schema)
    key = ["label", "d", "cap"]
    members = capped.withColumn("cap", F.explode("caps"))
    sizes = members.groupBy(*key, F.pmod(F.xxhash64(*key), F.lit(SALTS))).agg(F.count("*").alias("n")).where("n > 1")
    own = F.pmod(F.xxhash64("node"), "blocks").cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda j: F.struct(F.least(j, "own").alias("a"), F.greatest(j, "own").alias("b")),
    )
    dealt = (
        members.join(sizes.select(*key, F.ceil(F.col("n") / block).cast("int").alias("blocks")), key)
        .withColumn("own", own)
        .withColumn("against", F.explode(others))
        .select(*key, "against.a", "against.b", "own", "node", "weight", "v", "caps")
    )
    parts = [*key, "a", "b"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None  # rows of the last, possibly unfinished part
        for batch in batches:
            for start in range(0, batch.num_rows, 4 * block):
                rows = batch.slice(start, 4 * block)
                if held is not None:
                    rows = pa.concat_batches([held, rows])
                new = np.zeros(rows.num_rows, bool)
                for name in parts:
                    values = rows.column(name).to_numpy(zero_copy_only=False)
                    new[1:] |= values[1:] != values[:-1]
                bounds = [0, *np.flatnonzero(new).tolist()]
                for i, j in zip(bounds, bounds[1:], strict=False):
                    yield from part_links(rows.slice(i, j - i), cosine)
                held = rows.slice(bounds[-1])
        if held is not None:
            yield from part_links(held, cosine)

    compared = cut(
        dealt.repartition(*parts).sortWithinPartitions(*parts).mapInArrow(compare, "node long, links long, other long")
    )
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected_components(compared.select(F.col("node").alias("u"), F.col("other").alias("v")))
    known = distinct.select("node", "id", "weight").join(links, "node", "left").join(groups, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    ids = known.groupBy("component").agg(F.min("id").alias("component_id"))
    known = cut(known.join(ids, "component").select(
        "node", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    ))
    node = F.when(F.col("v").isNotNull(), F.xxhash64("label", "v"))
    result = rows.select("vec_id", node.alias("node")).join(known, "node", "left")
    return result.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
    )
