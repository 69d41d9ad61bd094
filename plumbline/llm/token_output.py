"""Best-fit-decreasing packing of token ids into the rows of id matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from plumbline.llm.common import documents, slices
from plumbline.llm.tokens import encoder

SCHEMA = (
    "sequence_id long, n_tokens int, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, "
    "ids binary, positions binary"
)
ARROW = pa.schema(
    [("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
     ("starts", pa.list_(pa.int64())), ("cu_seqlens", pa.list_(pa.int32())), ("ids", pa.binary()),
     ("positions", pa.binary())]
)


class CapacityTree:
    """Segment tree over free capacities 0 to ``width``: which capacities any open row has."""

    def __init__(self, width: int):
        self.leaves = 1 << width.bit_length()
        self.used = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(width + 1)]

    def add(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        node = capacity + self.leaves
        while node:
            self.used[node] += 1
            node >>= 1

    def take(self, size: int) -> tuple[int, int] | None:
        """Removes the row with the least capacity of at least ``size``; None if there is none."""
        node = size + self.leaves
        if not self.used[node]:
            # Up to the first ancestor with something to the right, then down to its leftmost leaf.
            while node > 1 and (node & 1 or not self.used[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                if not self.used[node]:
                    node += 1
        capacity = node - self.leaves
        while node:
            self.used[node] -= 1
            node >>= 1
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(sizes: list[int], width: int) -> list[list[int]]:
    """Indexes of the pieces in each row: the largest piece first, each into the fullest row it fits."""
    tree, rows = CapacityTree(width), []
    for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[piece]
        found = None if size == width else tree.take(size)
        if found is None:
            found = width, len(rows)
            rows.append([])
        capacity, row = found
        rows[row].append(piece)
        if capacity > size:
            tree.add(capacity - size, row)
    return rows


def token_matrices(
    docs: DataFrame,
    tokenizer: str,
    width: int = 1024,
    end_id: int = 50256,
    pad_id: int = 50256,
    batch_tokens: int = 1 << 21,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per packed sequence of at most ``width`` tokens.

    ``ids`` is a row of the id matrix: ``width`` little-endian numbers, 16-bit if the vocabulary allows and
    32-bit otherwise, filled up with ``pad_id`` after ``n_tokens``. ``cu_seqlens`` has the cumulative lengths
    of the segments, from 0 to ``n_tokens``; ``positions`` (little-endian, unsigned 32-bit) counts from 0 again
    at each of them, and in the padding. ``doc_ids`` and ``starts`` say which document a segment is from and
    at which of its ids it begins.

    A document is the ids of its text and then ``end_id`` (a null or empty text: that id alone). Overlong
    documents are split into segments of ``width`` and a rest, so no id is lost. Best fit decreasing runs over
    batches of about ``batch_tokens`` ids of one input partition: memory is bounded, nothing is shuffled, and
    a batch is thousands of rows, so its last rows weigh little. Repeated rows are documents of their own.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        kind = np.dtype("<u2" if max(own.vocabulary - 1, end_id, pad_id) < 1 << 16 else "<u4")
        end, padding = (np.array(i, "<u4").tobytes() for i in ([end_id], [pad_id] * width))
        first = TaskContext.get().partitionId() << 40
        count = 0
        pieces: list[tuple[int, int, bytes]] = []  # document, its ids before the piece, ids

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal count
            rows = best_fit_decreasing([len(ids) // 4 for _, _, ids in pieces], width)
            for begin in range(0, len(rows), 1024):
                some = rows[begin : begin + 1024]
                parts = [[pieces[i] for i in row] for row in some]
                bounds = [np.cumsum([0, *[len(p[2]) // 4 for p in row]]).astype(np.int32) for row in parts]
                used = np.array([b[-1] for b in bounds])
                raw = b"".join([
                    x for row, n in zip(parts, used.tolist(), strict=True) for x in (*[p[2] for p in row], padding[n * 4 :])
                ])
                ids = np.frombuffer(raw, "<u4").astype(kind)
                # Positions count up from the last start before them: of a segment, or of the padding.
                starts = np.concatenate([b[b < width] + i * width for i, b in enumerate(bounds)])
                lengths = np.diff(np.append(starts, len(ids)))
                positions = np.arange(len(ids), dtype="<u4") - np.repeat(starts.astype("<u4"), lengths)
                lists = lambda values, kind: pa.array(values, pa.list_(kind))
                fixed = lambda values: pa.FixedSizeBinaryArray.from_buffers(
                    pa.binary(values.itemsize * width), len(some), [None, pa.py_buffer(values.tobytes())]
                ).cast(pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(first + count, first + count + len(some))),
                        pa.array(used.astype(np.int32)),
                        lists([[p[0] for p in row] for row in parts], pa.int64()),
                        lists([[p[1] for p in row] for row in parts], pa.int64()),
                        lists(bounds, pa.int32()),
                        fixed(ids),
                        fixed(positions),
                    ],
                    schema=ARROW,
                )
                count += len(some)
            pieces.clear()

        held = 0
        for batch in batches:
            for part in slices(batch):
                keys = part.column("doc_id").to_pylist()
                for key, ids in zip(keys, own.encode(part.column("text").to_pylist()), strict=True):
                    ids += end
                    pieces += [(key, at // 4, ids[at : at + 4 * width]) for at in range(0, len(ids), 4 * width)]
                    held += len(ids) // 4
                if held >= batch_tokens:
                    yield from packed()
                    held = 0
        if pieces:
            yield from packed()

    return documents(docs, doc_id, text).mapInArrow(task, SCHEMA)
