"""Sum-of-squares online packing: documents into windows of a fixed width.

A window's level is the number of tokens in it. Each document, as it comes, goes on top of the level for
which the sum of the squared numbers of partly filled windows, level by level, becomes smallest; a new
window is level 0. Equal levels thus stay rare, and the windows left open at the end few.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from plumbline.llm.common import documents, released, slices
from plumbline.llm.tokens import encoder

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
     ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
)


class Levels:
    """The open windows by level: how many there are (``count``), and which."""

    def __init__(self, width: int):
        self.width = width
        self.count = np.zeros(width + 1, np.int64)
        self.windows: list[list] = [[] for _ in range(width + 1)]

    def choose(self, size: int) -> int:
        """The level whose window takes a piece of that size; the fullest of equals."""
        below = self.count[: self.width + 1 - size]
        # Half the growth of the sum of squares; new and filled-up windows each change one count only.
        growth = 2 * (self.count[size:] - below)
        growth[0] -= 1
        growth[-1] -= 1
        usable = below > 0
        usable[0] = True
        growth[~usable] = np.iinfo(np.int64).max
        return len(growth) - 1 - int(np.argmin(growth[::-1]))

    def place(self, piece, size: int) -> list | None:
        """Puts the piece into a window; returns the window if that fills it."""
        level = self.choose(size)
        window = self.windows[level].pop() if level else []
        if level:
            self.count[level] -= 1
        window.append(piece)
        if level + size == self.width:
            return window
        self.count[level + size] += 1
        self.windows[level + size].append(window)
        return None

    def rest(self) -> list:
        """The pieces of all open windows, the fullest first."""
        return [piece for some in reversed(self.windows) for window in some for piece in window]


def cut_up(pieces: list, width: int) -> Iterator[list]:
    """The pieces one after another in full windows, cut where a window ends. What is left at last fills
    windows whose sizes are powers of two, so nothing is padded."""
    left = sum(len(piece[2]) // 4 for piece in pieces)
    space, window = 0, []
    for doc_id, start, ids, total in pieces:
        at, n = 0, len(ids) // 4
        while at < n:
            if not space:
                space = width if left >= width else 1 << (left.bit_length() - 1)
            take = min(space, n - at)
            window.append((doc_id, start + at, ids[at * 4 : (at + take) * 4], total))
            at, space, left = at + take, space - take, left - take
            if not space:
                yield window
                window = []


def pack_documents(
    docs: DataFrame, tokenizer: str, width: int = 1024, end_id: int = 0, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per piece of a document: its ids, and where it lies.

    A document is the ids of its text and then ``end_id``; a null or empty text is that id alone. Longer
    documents are cut into full windows and a rest of less than ``width``, which sum-of-squares packing
    places. Windows still open when a task's rows end are taken apart, and their pieces cut to fill windows
    up (``cut_up``). Rows need not be unique; each is a document of its own.

    Each task packs the rows of its own input partition, so nothing is shuffled and only the open windows
    are held. Windows are numbered by partition, so a task that runs again gives the same rows if its
    input comes in the same order, as from files.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, levels = encoder(tokenizer).encode, Levels(width)
        end = np.array([end_id], "<u4").tobytes()
        number = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []

        def lay(window: list) -> int:
            at = 0
            for key, start, ids, total in window:
                rows.append((key, start, len(ids) // 4, ids, total, number, at))
                at += len(ids) // 4
            return number + 1

        def taken() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True))
            rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(values, kind.type) for values, kind in zip(columns, ARROW, strict=True)], schema=ARROW
            )

        for batch in batches:
            for part in slices(batch, most=1 << 20):
                keys = part.column("doc_id").to_pylist()
                for key, ids in zip(keys, encode(part.column("text").to_pylist()), strict=True):
                    ids += end
                    total = len(ids) // 4
                    whole = total - total % width
                    for at in range(0, whole, width):
                        number = lay([(key, at, ids[at * 4 : (at + width) * 4], total)])
                    if total > whole:
                        full = levels.place((key, whole, ids[whole * 4 :], total), total - whole)
                        if full:
                            number = lay(full)
                if rows:
                    yield taken()
        for window in cut_up(levels.rest(), width):
            number = lay(window)
        if rows:
            yield taken()

    return documents(docs, doc_id, text).mapInArrow(released(task), SCHEMA)
