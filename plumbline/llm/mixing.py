"""Mixing sources to target weights, in fixed-length blocks of words that output shards draw."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import WORD, cut, documents, released, slices

MOST_SOURCES = 10_000
MOST_SHARDS = 4_096
ROWS_A_CHUNK = 5_000


def cycling_weights(place: int) -> float:
    return 1.0 + place % 3


def fill_up(sizes: list[int], weights: list[float], most: float) -> list[float]:
    """Shares of the sum of sizes in proportion to the weights, none over ``most`` times its size; what is over goes to the
    others by weight until none is above."""
    targets, open_, left = [0.0] * len(sizes), {i for i, n in enumerate(sizes) if n}, float(sum(sizes))
    while open_:
        share = left / sum(weights[i] for i in open_)
        above = {i for i in open_ if share * weights[i] > most * sizes[i]}
        for i in above or open_:
            targets[i] = most * sizes[i] if above else share * weights[i]
        left -= sum(targets[i] for i in above)
        open_ = open_ - above if above else set()
    return targets


def draw_shards(totals: np.ndarray, shards: int, seed: int) -> np.ndarray:
    """How many blocks each shard takes of each source. Every shard draws from a multinomial distribution in proportion to
    the totals. Then shards give up, evenly, what is drawn too often of a source for what is drawn too rarely, so that
    the sums are the totals: the noise of the draws mixes shards, but does not move the targets."""
    slots = int(totals.sum())
    drawn = np.array([
        np.random.default_rng([seed, k]).multinomial(slots * (k + 1) // shards - slots * k // shards, totals / max(slots, 1))
        for k in range(shards)
    ], np.int64).reshape(shards, len(totals))
    over = drawn.sum(0) - totals
    for k in range(shards - 1, -1, -1):
        give = np.minimum(drawn[k], np.maximum(-(-np.maximum(over, 0) // (k + 1)), 0))
        room, take = int(give.sum()), np.zeros_like(give)
        for s in np.flatnonzero(over < 0):
            take[s] = min(room, -over[s])
            room -= take[s]
        for s in np.flatnonzero(give):  # what nobody takes stays
            back = min(room, give[s])
            give[s] -= back
            room -= back
        drawn[k] += take - give
        over += take - give
    return drawn


def scramble(value: np.ndarray) -> np.ndarray:
    """A 64-bit mix (the finalizer of SplitMix64)."""
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A pseudorandom permutation of 0 to n - 1, computed index by index: a Feistel network over the next even power of two,
    walked on while it leaves the range."""
    half = max(1, -(-(max(n - 1, 1).bit_length()) // 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = scramble(np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(key % (1 << 64)))
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        left, right = out[todo] >> shift, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (scramble(right + k) & mask)
        out[todo] = (left << shift) | right
        todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


@dataclass(frozen=True)
class Mix:
    """``documents``: one row per document with its place in its source. ``blocks``: how often the mix uses each block
    (place, block, uses). ``slots``: what each slot of each output shard holds (shard, slot, place, epoch, block).
    ``pieces``: the parts of documents in blocks, with the uses."""

    documents: DataFrame
    slots: DataFrame
    blocks: DataFrame
    pieces: DataFrame


def mix_sources(
    docs: DataFrame,
    weights: Callable[[int], float] = cycling_weights,
    most: float = 3.0,
    block_words: int = 128,
    shard_slots: int = 4_096,
    seed: int = 7,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep_text: bool = False,
    **more: str,
) -> Mix:
    """Draws as many words from each source as its weight asks for.

    A document's size is its number of words (null: 0). Sources, in the order of their code points with null last, weigh
    ``weights(place)`` and share the sum of all sizes; no target is above ``most`` times its source's size. The words of a
    source, document after document in an order by hash, are cut into as few blocks of at most ``block_words`` as hold them, equal
    to within a word; as many are drawn as come nearest the target, one at least if it is positive. The output has shards of
    ``shard_slots`` blocks (of more, if that made over ``MOST_SHARDS``), whose counts per source are drawn (``draw_shards``).
    The slots of a source are numbered through all shards; slot j of a source with n blocks takes block perm(j mod n), with
    another permutation for each round of n. So each block is used ``j // n`` times or once more, and none over ``most``
    times. Nothing depends on how rows are partitioned, so reruns agree. No documents or no words give no slots; sources
    without words have the target 0; repeated rows are documents of their own.

    Only the sizes per source (at most ``MOST_SOURCES``) and the counts per shard pass through the driver. Positions in a
    source come from sums per chunk of about ``ROWS_A_CHUNK`` documents and then within chunks, so a source with most of
    the documents is spread like the others.
    """
    spark = docs.sparkSession
    rows = documents(docs, doc_id, text, source=source, **more)
    rows = rows.withColumns({
        "tie": F.xxhash64("text"),
        "source": F.col("source").cast("string"),
        "size": F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long"),
    })
    if not keep_text:
        rows = cut(rows.drop("text", *more))  # texts are read once
    found = rows.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("rows")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["n"] for r in found]
    targets = fill_up(sizes, [weights(i) for i in range(len(found))], most)
    n_blocks = np.array([-(-n // block_words) for n in sizes], np.int64)
    totals = np.array(
        [min(max(round(t * b / n), 1), int(most * b)) if t > 0 else 0 for t, n, b in zip(targets, sizes, n_blocks.tolist(), strict=True)],
        np.int64,
    )
    sources = F.broadcast(spark.createDataFrame(
        pa.table({
            "of": pa.array([r["source"] for r in found], pa.string()), "place": pa.array(range(len(found)), pa.int32()),
            "source_size": pa.array(sizes, pa.int64()), "target": pa.array(targets, pa.float64()),
            # The first ``longer`` blocks of a source have a word more than the others.
            "least": pa.array([n // b if b else 0 for n, b in zip(sizes, n_blocks.tolist(), strict=True)], pa.int64()),
            "longer": pa.array([n % b if b else 0 for n, b in zip(sizes, n_blocks.tolist(), strict=True)], pa.int64()),
            "chunks": pa.array([-(-r["rows"] // ROWS_A_CHUNK) for r in found], pa.int64()),
        })
    ))

    # Where each document begins in its source: chunk by chunk, then within the chunk.
    rows = rows.join(sources, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), "chunks")).drop("chunks")
    in_order = Window.partitionBy("place").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    begins = rows.groupBy("place", "chunk").agg(F.sum("size").alias("n"))
    begins = begins.select("place", "chunk", F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias("begin"))
    own = Window.partitionBy("place", "chunk").orderBy("doc_id", "tie")
    up_to = own.rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumns({"row": F.row_number().over(own), "end": F.sum("size").over(up_to)})
    placed = placed.join(begins, ["place", "chunk"]).withColumn("first", F.col("begin") + F.col("end") - F.col("size"))
    placed = placed.drop("begin", "end")

    slots = shard_table(spark, totals, n_blocks, shard_slots, seed)
    blocks = slots.groupBy("place", "block").agg(F.count("*").alias("uses"))
    last = F.col("first") + F.col("size") - 1
    more_words = F.col("longer") * (F.col("least") + 1)
    of_word = lambda w: F.when(w < more_words, F.floor(w / (F.col("least") + 1))).otherwise(
        F.col("longer") + F.floor((w - more_words) / F.col("least"))
    )
    start = lambda b: b * F.col("least") + F.least(b, F.col("longer"))
    block = F.when(F.col("size") > 0, F.sequence(of_word(F.col("first")), of_word(last)))
    pieces = placed.drop("text", *more).withColumn("block", F.explode_outer(block))
    begin = F.greatest("first", start(F.col("block")))
    pieces = pieces.withColumns({
        "word": begin - F.col("first"),
        "n_words": F.coalesce(F.least(last + 1, start(F.col("block") + 1)) - begin, F.lit(0)),
    }).join(blocks.hint("merge"), ["place", "block"], "left").withColumn("uses", F.coalesce("uses", F.lit(0)))
    return Mix(placed.drop("least", "longer"), slots, blocks, pieces.drop("least", "longer"))


def shard_table(spark, totals: np.ndarray, n_blocks: np.ndarray, shard_slots: int, seed: int) -> DataFrame:
    """The slots of all shards, made where they are needed from the counts alone."""
    slots = int(totals.sum())
    shards = min(MOST_SHARDS, -(-slots // shard_slots))
    counts = draw_shards(totals, shards, seed)
    before = np.cumsum(counts, 0) - counts

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                place = np.repeat(np.arange(len(totals)), counts[shard])
                start = np.cumsum(counts[shard]) - counts[shard]
                j = np.arange(len(place)) - start[place] + before[shard][place]
                epoch, block = j // n_blocks[place], np.empty_like(j)
                for s, e in {*zip(place.tolist(), epoch.tolist(), strict=True)}:
                    some = (place == s) & (epoch == e)
                    n = int(n_blocks[s])
                    block[some] = permute(j[some] - e * n, n, (seed << 40) + (s << 8) + e)
                at = permute(np.arange(len(place)), max(len(place), 1), (seed << 40) + (1 << 38) + shard)
                for begin in range(0, len(place), 100_000):
                    part = slice(begin, begin + 100_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(place[part]), shard, np.int64)), pa.array(at[part]),
                         pa.array(place[part].astype(np.int32)), pa.array(epoch[part].astype(np.int32)), pa.array(block[part])],
                        ["shard", "slot", "place", "epoch", "block"],
                    )

    ids = spark.range(0, shards, 1, max(1, min(shards, 512)))
    return ids.mapInArrow(task, "shard long, slot long, place int, epoch int, block long")


def taken_words(mix: Mix) -> DataFrame:
    """One row per document: doc_id, size, source, source_size, target, taken (its words in the mix, repeats counted)."""
    keys = ["place", "chunk", "row", "doc_id", "source", "size", "source_size", "target"]
    taken = F.sum(F.col("n_words") * F.col("uses")).alias("taken")
    return mix.pieces.groupBy(*keys).agg(taken).drop("place", "chunk", "row")


def mixed_texts(mix: Mix) -> DataFrame:
    """The documents that the mix consists of: doc_id, source, text and what else ``mix_sources`` was to keep. A document comes
    as often as its blocks are used. Where they are not all used the same number of times, the text is cut at the edges of
    blocks, white space within kept. Documents without words are not in it. Needs ``keep_text``."""
    keys = ["place", "chunk", "row"]
    own = [*keys, "size", "source_size", "target", "tie", "first"]
    parts = mix.pieces.where("uses > 0").groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("word", "n_words", "uses"))).alias("parts")
    )

    def runs(parts: list[dict]) -> Iterator[tuple[int, int]]:
        for epoch in range(max(p["uses"] for p in parts)):
            begin = end = None
            for p in parts:
                if p["uses"] > epoch:
                    if end != p["word"]:
                        if end is not None:
                            yield begin, end
                        begin = p["word"]
                    end = p["word"] + p["n_words"]
            yield begin, end

    joined = mix.documents.join(parts, keys)
    kept = [name for name in mix.documents.columns if name not in own]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = re.compile(WORD)
        for batch in batches:
            for part in slices(batch):
                rows, texts = [], []
                columns = [part.column(name).to_pylist() for name in ("text", "size", "parts")]
                for i, (text, size, pieces) in enumerate(zip(*columns, strict=True)):
                    spans = None
                    for begin, end in runs(pieces):
                        if (begin, end) == (0, size):
                            cut_out = text
                        else:
                            spans = spans or [m.span() for m in words.finditer(text)]
                            cut_out = text[spans[begin][0] : spans[end - 1][1]]
                        rows.append(i)
                        texts.append(cut_out)
                take = pa.array(rows, pa.int64())
                data = [pa.array(texts, pa.string()) if name == "text" else part.column(name).take(take) for name in kept]
                yield pa.RecordBatch.from_arrays(data, kept)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in mix.documents.select(*kept).schema)
    return joined.select(*kept, "size", "parts").mapInArrow(released(task), schema)
