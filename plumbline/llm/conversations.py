"""Broken conversations and their cheapest repair, derived in lightest order from an agenda."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from plumbline.llm.common import column, written

WHITE = " \t\n\x0b\f\r"
#: States of ``(s?(ua)+)?``: nothing yet, after s, after u, after a; and where each initial leads.
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = (
    {"s": SYSTEM, "u": USER},
    {"u": USER},
    {"a": ASSISTANT},
    {"u": USER},
)
GOALS = (START, ASSISTANT)
NAMES = {"s": "system", "u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
#: Faults of a row; the first that applies counts.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
LEGAL = {"su", "ua", "au"}
#: A piece of a conversation has at most so many rows, and so many bytes unless it is one row.
PIECE_ROWS, PIECE_BYTES = 512, 4 << 20

ITEMS = "array<struct<start: int, end: int, cost: bigint, audit: string>>"
TURNS = "array<struct<role: string, text: string>>"
PIECES = f"""conv_id bigint, piece bigint, whole boolean, blank bigint, duplicate bigint, truncated bigint, illegal bigint,
    first_initial string, last_initial string, first_turn bigint, last_turn bigint, n_turns bigint, items {ITEMS}, turns {TURNS}"""
SUMMARY = """conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint,
    audit string, pieces array<struct<piece: bigint, start: int, audit: string>>"""


def lightest(rows: Sequence[tuple[str, int]], start: int, goals: Sequence[int], every: bool = False) -> dict[int, tuple[int, str]]:
    """The cheapest edits that lead from the state ``start`` over all rows (initial, fault) to one of ``goals``, by their end:
    the single lightest, or with ``every`` the lightest of each.

    An item (rows read, state) is derived from another by one edit. Its weight is (cost, audit); an edit adds to the cost
    and appends a letter, so that a weight never becomes less, and of two weights of an item the lesser stays the lesser
    (no audit of an item is the beginning of another of the same cost: it would have read fewer rows). So the least weight on the
    agenda is final for its item, and the first goal that is popped is the lightest derivation.
    """
    agenda = [(0, "", 0, start)]
    final: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str]] = {}
    while agenda:
        cost, audit, i, state = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final.add((i, state))
        steps = STEPS[state]
        if i == len(rows):
            if state in goals:
                found[state] = (cost, audit)
                if not every or len(found) == len(goals):
                    break
        else:
            initial, fault = rows[i]
            heapq.heappush(agenda, (cost + DELETE_COST, audit + DELETE, i + 1, state))
            if fault in (SOUND, TRUNCATED):
                kept = cost + (TRUNCATED_COST if fault == TRUNCATED else 0)
                if initial in steps:
                    heapq.heappush(agenda, (kept, audit + KEEP, i + 1, steps[initial]))
                for role in "ua":
                    if role in steps:
                        heapq.heappush(agenda, (kept + REROLE_COST, audit + REROLE, i + 1, steps[role]))
        for role in "ua":
            if role in steps:
                heapq.heappush(agenda, (cost + INSERT_COST, audit + INSERT, i, steps[role]))
    return found


def edited(roles: Sequence[str], start: int, audit: str) -> Iterator[tuple[str, int | None]]:
    """The repaired turns: role and the row whose text it has (None: empty). The state says what an edit's role must be: only
    kept rows can be a system turn, so that users and assistants alternate."""
    state, i = start, 0
    for edit in audit:
        if edit == DELETE:
            i += 1
            continue
        initial = roles[i][:1] if edit == KEEP else "a" if state == USER else "u"
        yield (roles[i] if edit == KEEP else NAMES[initial]), (None if edit == INSERT else i)
        state = STEPS[state][initial]
        i += edit != INSERT


@dataclass
class Piece:
    """Rows of one conversation that follow each other."""

    conv_id: int | None
    number: int
    turns: list[int | None] = field(default_factory=list)
    roles: list[str] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    faults: list[int] = field(default_factory=list)
    size: int = 0

    def full(self, more: int) -> bool:
        return len(self.roles) >= PIECE_ROWS or bool(self.roles) and self.size + more > PIECE_BYTES

    def row(self, whole: bool) -> dict:
        initials = [role[:1] for role in self.roles]
        rows = list(zip(initials, self.faults, strict=True))
        known = [t for t in self.turns if t is not None]
        counted = {
            "conv_id": self.conv_id, "piece": self.number, "whole": whole, "blank": self.faults.count(BLANK),
            "duplicate": self.faults.count(DUPLICATE), "truncated": self.faults.count(TRUNCATED),
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials[:-1], initials[1:], strict=True)),
            "first_initial": initials[0], "last_initial": initials[-1], "first_turn": known[0] if known else None,
            "last_turn": known[-1] if known else None, "n_turns": len(set(known)),
        }
        texts = list(zip(self.roles, self.texts, strict=True))
        if whole:
            ((end, (cost, audit)),) = lightest(rows, START, GOALS).items()
            items = [(START, end, cost, audit)]
            texts = [(role, "" if i is None else self.texts[i]) for role, i in edited(self.roles, START, audit)]
        else:
            items = [
                (start, end, cost, audit)
                for start in range(len(STEPS))
                for end, (cost, audit) in lightest(rows, start, range(len(STEPS)), every=True).items()
            ]
        counted["items"] = [dict(zip(("start", "end", "cost", "audit"), item, strict=True)) for item in items]
        counted["turns"] = [{"role": role, "text": text} for role, text in texts]
        return counted


def arrow_schema(schema: str) -> pa.Schema:
    """The Arrow form of a Spark schema text; only the driver can make it."""
    return to_arrow_schema(StructType.fromDDL(schema))


def piece_rows(batches: Iterable[pa.RecordBatch], task: int) -> Iterator[dict]:
    """Pieces of sorted rows. A conversation at either end of a task may have more rows in another one, and one that does not fit
    in a piece has several: such pieces are not whole."""
    piece, number, before = None, task << 32, None
    repeated, first = True, True  # whether the piece is a conversation's first, and whether it is the task's first
    for batch in batches:
        for names in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault")), strict=True):
            conv_id, turn, role, text, fault = names
            size = 4 * len(text)
            other = piece is None or piece.conv_id != conv_id
            if other or piece.full(size):
                if piece is not None:
                    yield piece.row(whole=other and not first and not repeated)
                    first = first and not other
                    repeated = not other
                else:
                    repeated = False
                number += 1
                piece = Piece(conv_id, number)
            if fault in (SOUND, TRUNCATED) and before == names[:4]:
                fault = DUPLICATE  # the same row again
            before = names[:4]
            piece.turns.append(turn)
            piece.roles.append(role)
            piece.texts.append(text)
            piece.faults.append(fault)
            piece.size += size
    if piece is not None:
        yield piece.row(whole=False)


def in_batches(rows: Iterable[dict], schema: pa.Schema, most: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows, or as few as have ``PIECE_BYTES`` of text."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += sum(4 * len(t["text"]) + 8 for t in row.get("turns") or ())
        if len(some) >= most or size >= PIECE_BYTES:
            yield pa.RecordBatch.from_pylist(some, schema)
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)


class Fold:
    """The pieces of one conversation, in order: the lightest edits up to here for each state."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.settled: list[tuple[int, int, str]] = []  # pieces on which all states agree: number, state before, audit
        self.cost = 0
        self.states: dict[int, tuple[int, list[tuple[int, int, str]]]] = {START: (0, [])}
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "n_turns"), 0)
        self.initial: str | None = None
        self.least = self.last = None

    def add(self, row: dict) -> None:
        """Two items that meet in a state are one longer item; of those with one end the lightest stays."""
        options: dict[int, list] = {}
        for item in row["items"]:
            if item["start"] in self.states:
                cost, path = self.states[item["start"]]
                path = [*path, (row["piece"], item["start"], item["audit"])]
                options.setdefault(item["end"], []).append((cost + item["cost"], path))
        self.states = {end: min(some, key=lambda x: (x[0], "".join(a for _, _, a in x[1]))) for end, some in options.items()}
        while len({path[0] for _, path in self.states.values()} if all(p for _, p in self.states.values()) else ()) == 1:
            for _, path in self.states.values():
                agreed = path.pop(0)
            self.settled.append(agreed)
        for name in self.counts:
            self.counts[name] += row[name]
        if self.initial is not None:
            self.counts["illegal"] += self.initial + row["first_initial"] not in LEGAL
        self.initial = row["last_initial"]
        if row["first_turn"] is not None:
            self.counts["n_turns"] -= self.last is not None and self.last == row["first_turn"]
            self.least = row["first_turn"] if self.least is None else self.least
            self.last = row["last_turn"]

    def summary(self) -> dict:
        ends = [self.states[goal] for goal in GOALS if goal in self.states]
        cost, path = min(ends, key=lambda x: (x[0], "".join(a for _, _, a in x[1])))
        pieces = [*self.settled, *path]
        return {
            "conv_id": self.conv_id, "gaps": 0 if self.least is None else self.last - self.least + 1 - self.counts["n_turns"],
            **{name: self.counts[name] for name in ("blank", "duplicate", "truncated", "illegal")}, "cost": cost,
            "audit": "".join(a for _, _, a in pieces),
            "pieces": [dict(zip(("piece", "start", "audit"), p, strict=True)) for p in pieces],
        }


def folded(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    now = None
    for batch in batches:
        for row in batch.to_pylist():
            if now is None or now.conv_id != row["conv_id"]:
                if now is not None:
                    yield now.summary()
                now = Fold(row["conv_id"])
            now.add(row)
    if now is not None:
        yield now.summary()


def faults(text: Column, again: Column) -> Column:
    """Blank, duplicate, or truncated: the last character that is no white space is none of ``.!?``."""
    bare = F.rtrim(text, F.lit(WHITE))
    return (
        F.when(bare == "", BLANK).when(again, DUPLICATE).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(SOUND)
    )


def ordered_pieces(rows: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) in order, as pieces of conversations with their lightest edits."""
    key = F.md5(F.concat_ws(":", F.length("role"), "role", "text"))
    rows = rows.withColumn("key", key)
    # Rows whose role and text occurred in an earlier turn. Counted per task before anything moves, and texts stay where they are;
    # only what occurs in several turns is kept. Null turns come first.
    place = F.struct("turn")
    first = rows.groupBy("conv_id", "key").agg(F.min(place).alias("least"), F.max(place).alias("most")).where("least <> most")
    again = first.select(F.col("conv_id").alias("conv"), F.col("key").alias("same"), "least")
    rows = rows.join(again, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("key") == F.col("same")), "left")
    earlier = F.coalesce(F.col("least") < place, F.lit(False))
    rows = rows.select("conv_id", "turn", "role", "text", faults(F.col("text"), earlier).alias("fault"))
    # Ranges of the whole order: the rows of a long conversation are dealt to as many tasks as they need.
    order = ["conv_id", "turn", "role", "opening"]
    ranges = rows.withColumn("opening", F.left("text", F.lit(32))).repartitionByRange(*order)
    ranges = ranges.sortWithinPartitions(*order, "text").drop("opening")
    schema = arrow_schema(PIECES)

    def pieces(batches):
        yield from in_batches(piece_rows(batches, TaskContext.get().partitionId()), schema)

    return ranges.mapInArrow(pieces, PIECES)


def repair_conversations(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The faults and the cheapest repair of each conversation, as two tables: a summary per conversation (conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit), and the repaired turns in pieces (conv_id, piece, last, turns: role and text).
    The pieces of a conversation follow each other by ``piece``; ``last`` says that it has no other piece.

    ``rows`` has conv_id, turn, role, text, and is read in the order of turn (nulls first), then role and text. A null role or
    text is one space; a null conv_id is a conversation as well. Blank rows have no character but ASCII white space,
    duplicates the role and text of an earlier row, truncated ones do not end in ``.``, ``!`` or ``?``; the first of these counts.
    ``gaps`` are the turns missing between the least and greatest, ``illegal`` the neighbours whose roles' initials aren't su, ua or
    au. Edits are Keep (0), Rerole to user or assistant (2), Delete (3, required for blank rows and duplicates) and Insert of an
    empty user or assistant turn (2); a truncated row that stays costs 1 more. They must give initials ``(s?(ua)+)?``; of the
    cheapest, the audit (their initials in order) that is least in ASCII is taken. A role without a first letter can't be kept.
    Repeated rows are duplicates of each other, ties are equal rows, an empty table gives two empty ones, and other columns of
    the input are not used, whatever their name.

    Rows are dealt out by ranges of their order, so that a conversation of any length is spread over tasks. A task cuts its rows
    into pieces of up to 512. Where a conversation is one piece, its repair is found there. Otherwise each piece gives the lightest
    edits from every state of the grammar to every other: 16 short rows' worth for 512, which are put together in order. The
    pieces are kept in the shared folder.
    """
    plain = rows.select(
        column(rows, "conv_id").cast("long").alias("conv_id"), column(rows, "turn").cast("long").alias("turn"),
        *[F.coalesce(column(rows, name).cast("string"), F.lit(" ")).alias(name) for name in ("role", "text")],
    )
    pieces = written(ordered_pieces(plain))
    whole, parts = pieces.where("whole"), pieces.where("NOT whole")
    counts = ["conv_id", "blank", "duplicate", "truncated", "illegal"]
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("n_turns"), F.lit(0).cast("long")).alias("gaps")
    done = whole.select(*counts, gaps, F.col("items")[0]["cost"].alias("cost"), F.col("items")[0]["audit"].alias("audit"))

    schema = arrow_schema(SUMMARY)

    def together(batches):
        yield from in_batches(folded(batches), schema, most=1)

    short = parts.drop("turns", "whole").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    sums = written(short.mapInArrow(together, SUMMARY))
    summary = done.unionByName(sums.drop("pieces"))

    chosen = sums.select(F.size("pieces").alias("n"), F.inline("pieces")).withColumnRenamed("piece", "number")
    met = parts.select("conv_id", "piece", "turns").join(chosen, F.col("piece") == F.col("number"))
    result = f"conv_id bigint, piece bigint, last boolean, turns {TURNS}"
    result_schema = arrow_schema(result)

    def apply(batches):
        def changed():
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    roles = [t["role"] for t in row["turns"]]
                    turns = [
                        {"role": role, "text": "" if at is None else row["turns"][at]["text"]}
                        for role, at in edited(roles, row["start"], row["audit"])
                    ]
                    yield {"conv_id": row["conv_id"], "piece": row["piece"], "last": row["n"] == 1, "turns": turns}

        yield from in_batches(changed(), result_schema)

    turns = whole.select("conv_id", "piece", F.lit(True).alias("last"), "turns")
    return summary, turns.unionByName(met.select("conv_id", "piece", "n", "start", "audit", "turns").mapInArrow(apply, result))
