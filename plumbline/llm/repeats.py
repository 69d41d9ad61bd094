"""Repeated byte strings: longest previous and next factors in suffix order, and their removal."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut, documents, released, slices, written
from plumbline.llm.components import SALTS

GRAM = 64  # bytes of an anchor
SEGMENT = 1 << 18
LOW = np.uint64((1 << 20) - 1)
MOST_IN_A_TASK = 2_048
BASE = 0x9E3779B97F4A7C15
VALUES = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and BASE ** -i modulo 2 ** 64."""
    if not _powers or len(_powers[0]) < n:
        most = max(n, SEGMENT + 4096)
        _powers[:] = [
            np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(most - 1, b, np.uint64)]))
            for b in (np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64)))
        ]
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """From which the hash of any substring follows: of [a, b) it is (p[b] - p[a]) * BASE ** a."""
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(VALUES[raw] * powers(len(raw))[1], out=sums[1:])
    return sums


def zones(raw: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor's hash, zone's hash, zone's start, anchor's offset in it, windows) of a text's zones.

    Each window of ``least`` bytes has an anchor: of the strings of ``GRAM`` bytes in it the one with the least hash, the first of
    equals. That depends on the window's bytes alone, so equal windows have equal anchors at equal offsets. A zone is all
    bytes of a run of windows with the same anchor.
    """
    width = least - GRAM + 1
    for begin in range(0, max(len(raw) - least + 1, 0), SEGMENT):
        part = raw[begin : begin + SEGMENT + least - 1]
        sums, (up, _) = prefix_sums(part), powers(len(part) + 1)
        grams = mix((sums[GRAM:] - sums[:-GRAM]) * up[: len(part) - GRAM + 1])
        best = (grams & ~LOW) | np.arange(len(grams), dtype=np.uint64)
        span = 1
        while span * 2 <= width:
            best, span = np.minimum(best[:-span], best[span:]), span * 2
        if span < width:
            best = np.minimum(best[: len(best) - (width - span)], best[width - span :])
        anchor = (best & LOW).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
        end = np.append(first[1:], len(anchor)) - 1 + least
        anchor = anchor[first]
        whole = mix((sums[end] - sums[first]) * up[first] + (end - first).astype(np.uint64))
        yield grams[anchor], whole, first + begin, anchor - first, end - first - least + 1


def text_zones(docs: DataFrame, least: int) -> DataFrame:
    """h, z, doc_id, key, place: the zones of all texts; place packs start, anchor's offset and number of windows."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found: list[list[np.ndarray]] = [[] for _ in range(5)]
                keys = zip(part.column("doc_id").to_pylist(), part.column("key").to_pylist(), strict=True)
                for (doc_id, key), text in zip(keys, part.column("text").cast(pa.binary()).to_pylist(), strict=True):
                    for h, z, start, offset, n in zones(np.frombuffer(text, np.uint8), least):
                        place = start << 20 | offset << 10 | n
                        ids = np.full(len(h), doc_id if doc_id is not None else -(1 << 63), np.int64)
                        for held, values in zip(found, (h.view(np.int64), z.view(np.int64), ids, np.full(len(h), key), place), strict=True):
                            held.append(values)
                if found[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(c)) for c in found], ["h", "z", "doc_id", "key", "place"]
                    )

    schema = "h long, z long, doc_id long, key long, place long"
    return docs.select("doc_id", "key", "text").mapInArrow(released(task), schema)


def nearest_smaller(position: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each suffix, in suffix order, the length that it has in common with the nearest suffix before it in that order whose
    position is smaller; 0 if there is none. ``lcp[i]`` is the length that suffix i has in common with suffix i - 1.

    All candidates move at once: as long as a suffix's candidate has a greater position, the candidate's own one takes its place,
    since all between the two have greater positions still.
    """
    n = len(position)
    candidate, common = np.arange(-1, n - 1), lcp.copy()
    common[:1] = 0
    open_ = np.arange(n)
    while len(open_):
        at = candidate[open_]
        open_ = open_[(at >= 0) & (position[at] > position[open_])]
        at = candidate[open_]
        # Both are read before either is written: a candidate may move in the same step.
        jump, shared = candidate[at], np.minimum(common[open_], common[at])
        candidate[open_], common[open_] = jump, shared
    return np.where(candidate >= 0, common, 0)


def longest_factors(position: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Longest previous and longest next factor of each suffix, in suffix order: the greatest length that it has in common with a
    suffix of a smaller (greater) position. It is shared with the nearest such suffix before or after it in suffix order:
    previous and next smaller values of the positions."""
    backwards = np.append(0, lcp[:0:-1])
    both = lambda order: np.maximum(
        nearest_smaller(order, lcp), nearest_smaller(order[::-1], backwards)[::-1]
    )
    return both(position), both(-position)


def suffix_factors(groups: np.ndarray, suffixes: np.ndarray, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``longest_factors`` of suffixes, as they come, among those of the same group.

    suffixes: (n, length) bytes, the first ``length`` of each suffix, which bounds the factors; position: where they start in the
    corpus, all different.
    """
    n, length = suffixes.shape
    ranked = np.empty((n, length + 8), np.uint8)
    ranked[:, :8] = groups.astype(">u8").view(np.uint8).reshape(n, 8)
    ranked[:, 8:] = suffixes
    rank = np.argsort(ranked.view(f"S{length + 8}").ravel(), kind="stable")
    in_order = ranked[rank]
    differ = in_order[1:] != in_order[:-1]
    lcp = np.zeros(n, np.int64)
    lcp[1:] = np.where(differ.any(axis=1), np.maximum(differ.argmax(axis=1) - 8, 0), length)
    previous, following = np.empty(n, np.int64), np.empty(n, np.int64)
    previous[rank], following[rank] = longest_factors(position[rank], lcp)
    return previous, following


def repeated_spans(docs: DataFrame, least: int, keep_first: bool, unique: bool) -> DataFrame:
    """key, begin, end: parts of texts to remove, in bytes. docs: doc_id, key, text; if not ``unique``, rows may share a key, and
    then share their text.

    First by zones: those that share their anchor with another zone anywhere are looked at, and equal zones are repeats as a
    whole. Then, for anchors with several kinds of zones, one zone of each kind (its first) is resolved window by window among
    the others of its anchor: these are the edges of repeated passages.
    """
    found = text_zones(docs, least)
    # Written before they are joined, the smaller sides are dealt out right below the join, where a frequent key can be split.
    shared = cut(found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    found = written(found.join(shared, "h"))
    first = F.min(F.struct("doc_id", "key", "place")).alias("first")
    kinds = written(found.groupBy("h", "z").agg(F.count("*").alias("n"), first))
    again = F.col("n") > 1
    if keep_first:
        again &= F.struct("doc_id", "key", "place") != F.col("first")
    whole = found.join(kinds.where("n > 1"), ["h", "z"]).where(again).select(
        "key",
        F.shiftright("place", 20).alias("begin"),
        (F.shiftright("place", 20) + F.col("place").bitwiseAND(1023) + (least - 1)).alias("end"),
    )

    # Rows with one key are one text here: it must not be found to repeat itself.
    docs = docs if unique else docs.dropDuplicates(["key"])
    several = cut(kinds.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    edges = kinds.join(several, "h").select("h", "kinds", "first.key", "first.place")
    few = edge_windows(docs, edges.where(F.col("kinds") <= MOST_IN_A_TASK), least)
    few = few.repartition("h").sortWithinPartitions("h").mapInArrow(
        released(lambda batches: resolve(batches, least, keep_first)), "key long, begin long, end long"
    )
    if several.where(F.col("kinds") > MOST_IN_A_TASK).isEmpty():
        return whole.union(few)
    many = edge_windows(docs, edges.where(F.col("kinds") > MOST_IN_A_TASK), least)
    many = many.mapInArrow(
        lambda batches: window_hashes(batches, least), "h long, offset int, a long, doc_id long, key long, begin long"
    )
    same = ["h", "offset", "a"]
    first = F.min(F.struct("doc_id", "begin", "key")).alias("first")
    counts = many.groupBy(*same, F.pmod("a", F.lit(SALTS))).agg(F.count("*").alias("n"), first).where("n > 1")
    many = many.join(counts.select(*same, "first"), same)
    if keep_first:
        many = many.where(F.struct("doc_id", "begin", "key") != F.col("first"))
    many = many.select("key", "begin", (F.col("begin") + least).alias("end"))
    return whole.union(few).union(many)


def edge_windows(docs: DataFrame, edges: DataFrame, least: int) -> DataFrame:
    """h, doc_id, key, start, offset, n, zone: the bytes of zones, fetched from their documents."""
    wanted = edges.groupBy("key").agg(F.collect_list(F.struct("h", "place")).alias("edges"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                edges = part.column("edges")
                counts = pc.list_value_length(edges).to_numpy()
                flat = edges.flatten()
                h, place = flat.field("h").to_numpy(), flat.field("place").to_numpy()
                start, n = place >> 20, place & 1023
                row = np.repeat(np.arange(len(counts)), counts)
                texts = part.column("text").cast(pa.binary()).to_pylist()
                zone = [texts[r][a:b] for r, a, b in zip(row.tolist(), start.tolist(), (start + n + least - 1).tolist(), strict=True)]
                ids, keys = pc.fill_null(part.column("doc_id"), -(1 << 63)).to_numpy()[row], part.column("key").to_numpy()[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (h, ids, keys, start, (place >> 10 & 1023).astype(np.int32), n.astype(np.int32))]
                    + [pa.array(zone, pa.binary())],
                    ["h", "doc_id", "key", "start", "offset", "n", "zone"],
                )

    schema = "h long, doc_id long, key long, start long, offset int, n int, zone binary"
    # With all columns of docs, so that dealing them out is the same step as for the removal, and done once.
    return docs.join(wanted, "key").mapInArrow(released(task), schema)


def spread(batch: pa.RecordBatch, least: int) -> tuple[np.ndarray, ...]:
    """(row, window's start in its zone, window's start in the bytes of all zones), and these bytes."""
    n = batch.column("n").to_numpy().astype(np.int64)
    zones = np.frombuffer(b"".join(batch.column("zone").to_pylist()), np.uint8)
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    begins = np.cumsum(n + least - 1) - (n + least - 1)
    return row, at, begins[row] + at, zones


def resolve(batches: Iterator[pa.RecordBatch], least: int, keep_first: bool) -> Iterator[pa.RecordBatch]:
    """Spans of windows that are found in another zone of the same anchor. Rows come in order of anchors; those of one never
    span more than ``MOST_IN_A_TASK``."""
    held: pa.RecordBatch | None = None
    for batch in batches:
        for start in range(0, batch.num_rows, 1024):
            part = batch.slice(start, 1024)
            if held is not None:
                part = pa.concat_batches([held, part])
            h = part.column("h").to_numpy()
            at = int(np.searchsorted(h, h[-1]))  # the last anchor's rows may go on
            if at:
                yield from resolved(part.slice(0, at), least, keep_first)
            held = part.slice(at)
    if held is not None and held.num_rows:
        yield from resolved(held, least, keep_first)


def resolved(rows: pa.RecordBatch, least: int, keep_first: bool) -> Iterator[pa.RecordBatch]:
    h = rows.column("h").to_numpy()
    bounds = np.flatnonzero(np.append(True, h[1:] != h[:-1])).tolist() + [len(h)]
    begin = 0
    for k in range(1, len(bounds)):
        if k + 1 < len(bounds) and bounds[k + 1] - bounds[begin] < 512:
            continue
        part = rows.slice(bounds[begin], bounds[k] - bounds[begin])
        begin = k
        row, at, byte, zones = spread(part, least)
        offset = part.column("offset").to_numpy()[row] - at
        groups = np.unique(part.column("h").to_numpy(), return_inverse=True)[1][row] * 2048 + offset
        ids, start = part.column("doc_id").to_numpy(), part.column("start").to_numpy()
        position = np.lexsort((at, start[row], part.column("key").to_numpy()[row], ids[row]))
        order = np.empty(len(row), np.int64)
        order[position] = np.arange(len(row))
        previous, following = np.zeros(len(row), np.int64), np.zeros(len(row), np.int64)
        by_group = np.argsort(groups, kind="stable")
        cuts = [0]
        edges = np.flatnonzero(np.append(groups[by_group][1:] != groups[by_group][:-1], True)) + 1
        for edge in edges.tolist():  # whole groups, about 20,000 windows at a time
            if edge - cuts[-1] >= 20_000 or edge == len(row):
                cuts.append(edge)
        windows = np.lib.stride_tricks.sliding_window_view(zones, least)
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            some = by_group[a:b]
            previous[some], following[some] = suffix_factors(groups[some], windows[byte[some]], order[some])
        gone = previous >= least if keep_first else np.maximum(previous, following) >= least
        hit = np.flatnonzero(gone)
        if not len(hit):
            continue
        breaks = np.append(True, (row[hit][1:] != row[hit][:-1]) | (at[hit][1:] != at[hit][:-1] + 1))
        first, last = hit[breaks], hit[np.append(breaks[1:], True)]
        yield pa.RecordBatch.from_arrays(
            [part.column("key").take(pa.array(row[first])), pa.array(start[row[first]] + at[first]),
             pa.array(start[row[last]] + at[last] + least)],
            ["key", "begin", "end"],
        )


def window_hashes(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """One row per window, with a hash of its bytes, for anchors with more kinds of zones than one task is to hold."""
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):
            part = batch.slice(begin, 256)
            row, at, byte, zones = spread(part, least)
            sums, (up, _) = prefix_sums(zones), powers(len(zones) + 1)
            a = mix((sums[byte + least] - sums[byte]) * up[byte])
            column = lambda name: part.column(name).to_numpy()[row]  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (column("h"), (column("offset") - at).astype(np.int32), a.view(np.int64), column("doc_id"),
                                       column("key"), column("start") + at)],
                ["h", "offset", "a", "doc_id", "key", "begin"],
            )


def remove_repeats(
    docs: DataFrame,
    least: int = 200,
    keep_first: bool = True,
    whole_characters: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
    **more: str,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (array of begin and end, in bytes, maximal and in order), kept (binary: the
    remaining bytes), and the columns named in ``more``.

    Texts are UTF-8 bytes; a null text is empty. Removed is each byte that lies in a string of ``least`` bytes which also starts
    elsewhere, in another document or the same one, overlaps included: at an earlier place if ``keep_first`` (so the first copy
    stays; documents are in order of doc_id, null first), else at any other. With ``whole_characters`` spans shrink to whole
    characters, so that what is left is UTF-8. Matches never cross documents, and are judged on the
    input. Rows that agree in doc_id and text count as copies of each other, but where the first copy stays, it stays in all
    of them. An empty table gives no rows.

    Suffixes are needed in order up to ``least`` bytes only, and only where they can match: see ``zones``. Copies are counted
    before anything is shuffled by them and joins on them can be split, so no passage, however frequent, meets in one task.
    """
    if not GRAM < least <= 1000:
        raise ValueError(f"repeats are of {GRAM + 1} to 1000 bytes")
    rows = documents(docs, doc_id, text, **more)
    ids = rows.groupBy("doc_id").count()
    unique = ids.where("count > 1 OR doc_id IS NULL").isEmpty()
    if unique:
        key = F.coalesce("doc_id", F.lit(0))  # never null, and says so
    else:
        key = F.xxhash64("doc_id", "text")
    rows = rows.withColumn("text", F.coalesce("text", F.lit(""))).withColumn("key", key)
    spans = repeated_spans(rows, least, keep_first, unique)
    spans = spans.groupBy("key").agg(F.collect_list(F.struct("begin", "end")).alias("found"))
    names = ["doc_id", *more]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sizes, spans, kept = [], [], []
                texts, found = part.column("text").cast(pa.binary()).to_pylist(), part.column("found")
                for i, raw in enumerate(texts):
                    pairs = merged(found[i])
                    if whole_characters:
                        pairs = [pair for pair in (characters(raw, *pair) for pair in pairs) if pair[0] < pair[1]]
                    sizes.append(len(raw))
                    spans.append([{"begin": a, "end": b} for a, b in pairs])
                    edges = [0, *[x for pair in pairs for x in pair], len(raw)]
                    kept.append(b"".join([raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]))
                kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(name) for name in names], pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                    [*names, "n_bytes", "spans", "kept"],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*names).schema)
    schema = f"{fields}, n_bytes long, spans array<struct<begin: long, end: long>>, kept binary"
    return rows.join(spans, "key", "left").mapInArrow(released(task), schema)


def characters(raw: bytes, begin: int, end: int) -> tuple[int, int]:
    """The part of a span that is whole characters."""
    while begin < end and raw[begin] & 0xC0 == 0x80:
        begin += 1
    while begin < end < len(raw) and raw[end] & 0xC0 == 0x80:
        end -= 1
    return begin, end


def merged(found: pa.ListScalar) -> list[tuple[int, int]]:
    """Spans that touch or overlap, as one."""
    if not found.is_valid:
        return []
    begin, end = found.values.field("begin").to_numpy(), found.values.field("end").to_numpy()
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.append(True, begin[1:] > reach[:-1])
    return list(zip(begin[new].tolist(), reach[np.append(new[1:], True)].tolist(), strict=True))
