"""A tree of all beginnings of conversations, kept as flat arrays behind minimal perfect hashes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import WORD, column, cut, written

#: Turns of a conversation that are summed in one go; a longer conversation is several such stretches.
STRETCH = 4096
#: Rows whose nodes share a table of slots: the memory of a task.
SHARD_ROWS = 1 << 18
KEY = ["key1", "key2"]
GOLDEN = 0x9E3779B97F4A7C15


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """A hash of 128-bit keys (rows of two unsigned numbers), another one for each level."""
    x = keys[:, 0] + (keys[:, 1] ^ np.uint64((level + 1) * GOLDEN % (1 << 64)))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class SlotTable:
    """A slot from 0 to n - 1 for each of n distinct keys, without gaps, and the keys in the order of their slots.

    Level by level, the keys that are left are hashed into twice as many places; those that meet no other key there have found
    theirs, and the others go on to the next level. The slot is the number of places taken before. A slot is verified by the key
    that is kept there: a key that is not in the table has none.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []  # places taken, slot of the first key after each, how many
        left, used = keys, 0
        while len(left):
            size = 2 * len(left)
            place = (mixed(left, len(self.levels)) % np.uint64(size)).astype(np.int64)
            taken = np.bincount(place, minlength=size) == 1
            before = used + np.cumsum(taken) - taken
            self.levels.append((taken, before, size))
            used += int(taken.sum())
            left = left[~taken[place]]
            if len(self.levels) > 200:
                raise ValueError("keys of a table of slots are not distinct")
        self.keys = np.zeros((len(keys), 2), np.uint64)
        slots = self.unverified(keys)
        self.keys[slots] = keys
        if len(np.unique(slots)) != len(keys):
            raise ValueError("two keys have one slot")

    def unverified(self, keys: np.ndarray) -> np.ndarray:
        slots = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (taken, before, size) in enumerate(self.levels):
            place = (mixed(keys[open_], level) % np.uint64(size)).astype(np.int64)
            found = taken[place]
            slots[open_[found]] = before[place[found]]
            open_ = open_[~found]
        return slots

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for one that is not in the table."""
        slots = self.unverified(keys)
        known = slots >= 0
        known[known] = (self.keys[slots[known]] == keys[known]).all(axis=1)
        return np.where(known, slots, -1)


def subtree_sums(
    keys: np.ndarray, parents: np.ndarray, depth: np.ndarray, values: np.ndarray, stretch: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, and for each the sum of ``values`` (a column each) over the rows of its subtree, down to the end of its
    stretch of depths: what lies below is part of the values already.

    Values are scattered into one array by the slot of their key; then the deepest nodes are added to their parents' slots,
    and so on up to the top of the stretch.
    """
    table = SlotTable(np.unique(keys, axis=0))
    slots = table.slots(keys)
    n = len(table.keys)
    sums = np.zeros((n, values.shape[1]), np.int64)
    np.add.at(sums, slots, values)
    parent_slot, depths = np.full(n, -1, np.int64), np.zeros(n, np.int64)
    parent_slot[slots], depths[slots] = table.slots(parents), depth
    parent_slot[depths % stretch == 0] = -1
    order = np.argsort(-depths, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depths[order])) + 1):
        up = level[parent_slot[level] >= 0]
        np.add.at(sums, parent_slot[up], sums[up])
    return table.keys, sums


def shards(batches: Iterable[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Runs of batches with about ``most`` rows, that end where a stretch of a conversation ends."""
    some: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        if n >= most:
            conv, stretch = batch.column("conv_id").to_numpy(), batch.column("stretch").to_numpy()
            last = some[-1]
            same = (conv == last.column("conv_id")[-1].as_py()) & (stretch == last.column("stretch")[-1].as_py())
            cut_at = len(same) if same.all() else int(np.argmin(same))
            if cut_at:
                some.append(batch.slice(0, cut_at))
            if cut_at < batch.num_rows:
                yield pa.Table.from_batches(some)
                some, n = [], 0
                batch = batch.slice(cut_at)
            else:
                continue
        if batch.num_rows:
            some.append(batch)
            n += batch.num_rows
    if some:
        yield pa.Table.from_batches(some)


def partial_sums(batches: Iterable[pa.RecordBatch], most: int, stretch: int) -> Iterator[pa.RecordBatch]:
    for table in shards(batches, most):
        pair = lambda a, b: np.stack([table[c].to_numpy().view(np.uint64) for c in (a, b)], axis=1)  # noqa: B023, E731
        values = np.stack([table[c].to_numpy() for c in ("leaf", "saved")], axis=1)
        keys, sums = subtree_sums(pair("key1", "key2"), pair("parent1", "parent2"), table["depth"].to_numpy(), values, stretch)
        for start in range(0, len(keys), 50_000):
            part = slice(start, start + 50_000)
            arrays = [keys[part, 0].view(np.int64), keys[part, 1].view(np.int64), sums[part, 0], sums[part, 1]]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], ["key1", "key2", "n_leaves", "saved_tokens"])


def turn_hashes(role: Column, text: Column) -> list[Column]:
    """128 bits of a turn; the length keeps role and text apart."""
    digest = F.md5(F.concat_ws(":", F.length(role), role, text))
    return [F.xxhash64(digest, F.lit(1)).alias("h1"), F.xxhash64(digest, F.lit(2)).alias("h2")]


def numbered_turns(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 1), h1, h2, n_words: the turns of each conversation in order. Rows are dealt out by ranges of
    their order, and a place is the difference of two row numbers, so that no task has to hold a whole conversation."""
    order = ["conv_id", "turn", "role", "opening"]
    text, role = F.coalesce(column(rows, "text").cast("string"), F.lit("")), F.coalesce(column(rows, "role").cast("string"), F.lit(""))
    turns = rows.select(
        column(rows, "conv_id").cast("long").alias("conv_id"), column(rows, "turn").cast("long").alias("turn"), role.alias("role"),
        F.left(text, F.lit(32)).alias("opening"), *turn_hashes(role, text),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
    ).where("conv_id IS NOT NULL")
    ranges = turns.repartitionByRange(*order).sortWithinPartitions(*order, "h1", "h2")
    # Row numbers below are only right if nothing runs again in another order: hence the cut.
    placed = cut(ranges.select("conv_id", "h1", "h2", "n_words", F.monotonically_increasing_id().alias("row")))
    task, in_task = F.shiftright("row", 33), F.col("row").bitwiseAND((1 << 33) - 1)
    # One row per task.
    sizes = placed.groupBy(task.alias("task")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    sizes = sizes.select("task", before.alias("before"))
    numbered = placed.withColumn("task", task).join(F.broadcast(sizes), "task")
    return numbered.select("conv_id", (F.col("before") + in_task).alias("number"), "h1", "h2", "n_words")


def with_beginnings(turns: DataFrame, borrowed: Column, source: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first ``borrowed`` turns (0 to ``most``) are those of the conversation ``source``; both are
    expressions of conv_id. Two tables: conversations (conv_id, length) and their turns (conv_id, depth, h1, h2, n_words)."""
    known = turns.groupBy("conv_id").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    known = known.select("conv_id", "first", "n", borrowed.alias("wanted"), source.alias("source"))
    sizes = known.select(F.col("conv_id").alias("source"), F.least("n", F.lit(most)).alias("there"))
    # Many conversations may share a source, but each of them is one row here.
    known = written(
        known.join(sizes, "source", "left").withColumn("k", F.least("wanted", F.coalesce("there", F.lit(0).cast("long"))))
    )
    length = F.col("k") + F.greatest(F.lit(0).cast("long"), F.col("n") - F.col("wanted"))
    placed = turns.join(known, "conv_id").withColumn("place", F.col("number") - F.col("first") + 1)
    what = ["h1", "h2", "n_words"]
    own = placed.where("place > wanted").select("conv_id", (F.col("k") + F.col("place") - F.col("wanted")).alias("depth"), *what)
    first = placed.where(F.col("place") <= most).select(F.col("conv_id").alias("source"), F.col("place").alias("depth"), *what)
    taken = known.where("k > 0").select("conv_id", "source", F.explode(F.sequence(F.lit(1).cast("long"), "k")).alias("depth"))
    begun = taken.join(first, ["source", "depth"]).select("conv_id", "depth", *what)
    return known.select("conv_id", length.alias("length")), own.unionByName(begun)


def prefixes(turns: DataFrame) -> DataFrame:
    """The turns with the digest of all turns up to each: key1, key2, and that of its parent, parent1, parent2.

    A turn counts by a hash of itself and its depth, and a digest is the exclusive or of these: it can be taken over stretches of
    ``STRETCH`` turns and then over the stretches, so that no task has to hold a whole conversation.
    """
    salted = turns.select(
        "conv_id", "depth", "n_words", F.floor(F.col("depth") / STRETCH).alias("stretch"),
        *[F.xxhash64("h1", "h2", "depth", F.lit(i)).alias(f"x{i}") for i in (1, 2)],
    )
    upto = Window.partitionBy("conv_id", "stretch").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = salted.select("*", *[F.expr(f"bit_xor(x{i})").over(upto).alias(f"p{i}") for i in (1, 2)])
    stretches = salted.groupBy("conv_id", "stretch").agg(*[F.expr(f"bit_xor(x{i})").alias(f"t{i}") for i in (1, 2)])
    earlier = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = stretches.select("conv_id", "stretch", *[F.expr(f"bit_xor(t{i})").over(earlier).alias(f"c{i}") for i in (1, 2)])
    carried = carried.where("stretch > 0")
    found = inner.join(carried, ["conv_id", "stretch"], "left")
    for i in (1, 2):
        found = found.withColumn(f"key{i}", F.col(f"p{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0).cast("long"))))
        found = found.withColumn(f"parent{i}", F.col(f"key{i}").bitwiseXOR(F.col(f"x{i}")))
    return found.select("conv_id", "depth", "stretch", "n_words", *KEY, "parent1", "parent2")


def prefix_tree(conversations: DataFrame, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All nodes, and where conversations end (conv_id, key1, key2). A node has key1, key2, conv_id (its least member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens.

    Distinct digests are enumerated with their counts; digests that agree must agree in depth, parent and words as well, or the
    job ends with an error. The least member owns a node. Then shards of conversations find the sums over subtrees: every row goes to
    the shard of its conversation, a node's own words and leaf only to that of its owner. A shard gives its nodes slots, scatters the
    values into flat arrays and adds them up along the parents' slots, deepest first. What shards find for a node is added up: each
    node has one owner, so nothing is counted twice, and a shard may be any set of stretches of conversations. What lies
    below the end of a stretch is carried to its last turn.
    """
    rows = prefixes(turns)
    zero = F.lit(0).cast("long")
    roots = conversations.select(
        "conv_id", zero.alias("depth"), zero.alias("stretch"), zero.alias("n_words"), *[zero.alias(c) for c in (*KEY, "parent1", "parent2")]
    )
    rows = written(rows.unionByName(roots))
    checked = ["depth", "n_words", "parent1", "parent2"]
    same = [F.max(c) == F.min(c) for c in checked]
    nodes = rows.groupBy(*KEY).agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("owner"), *[F.min(c).alias(c) for c in checked],
        F.assert_true(same[0] & same[1] & same[2] & same[3], "two beginnings have one digest").alias("checked"),
    )
    nodes = nodes.where("checked IS NULL").drop("checked")
    children = nodes.where("depth > 0").groupBy(F.col("parent1").alias("key1"), F.col("parent2").alias("key2"))
    nodes = written(nodes.join(children.agg(F.count("*").alias("n_children")), KEY, "left").withColumn("n_children", F.coalesce("n_children", zero)))

    owned = nodes.select(
        F.col("owner").alias("conv_id"), "depth", (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("n_words")).alias("saved"),
    )
    valued = rows.drop("n_words").join(owned, ["conv_id", "depth"], "left")
    valued = valued.select("conv_id", "depth", "stretch", *KEY, "parent1", "parent2", *[F.coalesce(c, zero).alias(c) for c in ("leaf", "saved")])
    # Conversations of more than one stretch: the sums of later ones belong to the last turn of each.
    totals = valued.groupBy("conv_id", "stretch").agg(
        F.max("depth").alias("depth"), F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved")
    )
    later = Window.partitionBy("conv_id").orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        "conv_id", "depth", "stretch", F.sum("leaf").over(later).alias("more_leaf"), F.sum("saved").over(later).alias("more_saved")
    ).where("more_leaf IS NOT NULL")
    carried = carried.select("conv_id", "depth", "more_leaf", "more_saved")
    valued = valued.join(carried, ["conv_id", "depth"], "left")
    for name in ("leaf", "saved"):
        valued = valued.withColumn(name, F.col(name) + F.coalesce(f"more_{name}", zero))
    valued = valued.drop("more_leaf", "more_saved").repartition("conv_id", "stretch").sortWithinPartitions("conv_id", "stretch")
    most, stretch = SHARD_ROWS, STRETCH

    def sums(batches):
        yield from partial_sums(batches, most, stretch)

    parts = valued.mapInArrow(sums, "key1 bigint, key2 bigint, n_leaves bigint, saved_tokens bigint")
    below = parts.groupBy(*KEY).agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    owners = nodes.where("n_children > 0").select(
        F.col("key1").alias("parent1"), F.col("key2").alias("parent2"), F.col("owner").alias("parent_conv_id")
    )
    found = nodes.join(below, KEY).join(owners, ["parent1", "parent2"], "left").select(
        *KEY, F.col("owner").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.col("parent_conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens",
    )
    lengths = conversations.select("conv_id", F.col("length").alias("depth"))
    return found, lengths.join(rows.select("conv_id", "depth", *KEY), ["conv_id", "depth"]).select("conv_id", *KEY)
