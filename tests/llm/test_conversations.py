import itertools
import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import DATA
from llm.brute_conversations import GRAMMAR, cheapest, repaired
from llm.conftest import CLASHING, rows
from plumbline.llm import conversations, queries

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def stored(folder, some):
    """The conversations as a table in a folder, with columns that clash with inner names."""
    ids, turns, roles, texts = zip(*some, strict=True) if some else ((), (), (), ())
    columns = {
        "conv_id": pa.array(ids, pa.int64()), "turn": pa.array(turns, pa.int64()), "role": pa.array(roles, pa.string()),
        "text": pa.array(texts, pa.string()),
    }
    columns |= {name: pa.array(["?"] * len(some), pa.string()) for name in [*CLASHING, "piece", "fault", "opening", "depth"]}
    pq.write_table(pa.table(columns), folder / "conversations.parquet")
    return str(folder)


def invented(rng, n, most=9):
    words = ["Yes.", "yes", "Why?", " ", "", "No!\n", "É", None, "it. ends", "\t.\n"]
    for conv_id in rng.sample([None, *range(n * 2)], n):
        for turn in range(rng.randrange(1, most)):
            turn = rng.choice([turn, turn, turn, turn + 3, None])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "sys", "", None, "Assistant"])
            yield conv_id, turn, role, " ".join(filter(None, (rng.choice(words), rng.choice(words)))) if rng.random() < 0.9 else None


def test_lightest_derivation_is_least_of_all():
    """Against every sequence of edits of up to three rows with up to three inserts."""
    rng = random.Random(3)
    for _ in range(300):
        some = [(rng.choice("suat "), rng.choice([0, 0, 1, 2, 3])) for _ in range(rng.randrange(4))]
        best = None
        for inserts in range(4):
            for spots in itertools.combinations_with_replacement(range(len(some) + 1), inserts):
                plan = sorted([(i, 1, None) for i in range(len(some))] + [(i, 0, "I") for i in spots], key=lambda x: x[:2])
                choices = [["I"] if e else ["D"] if some[i][1] in (1, 2) else ["D", "K", "R"] for i, _, e in plan]
                for edits in itertools.product(*choices):
                    cost = sum({"I": 2, "D": 3, "R": 2, "K": 0}[e] for e in edits)
                    cost += sum(e in "KR" and some[i][1] == 3 for e, (i, _, _) in zip(edits, plan))
                    audit = "".join(edits)
                    if best and (cost, audit) >= best:
                        continue
                    initials = [[some[i][0]] if e == "K" else "ua" for e, (i, _, _) in zip(edits, plan) if e != "D"]
                    if any(GRAMMAR.match("".join(x)) for x in itertools.product(*initials)):
                        best = (cost, audit)
        found = conversations.lightest(some, conversations.START, conversations.GOALS)
        assert list(found.values()) == [best]


def test_given_table(spark):
    given = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{DATA}/conversations.parquet'").fetchall()
    assert rows(queries.op11_conversation_repair(spark, DATA), *COLUMNS) == sorted(repaired(given), key=str)


@pytest.mark.parametrize("pieces", [512, 2])
def test_like_brute_force(spark, tmp_path, monkeypatch, pieces):
    """Also where a piece has two rows, so that repairs are put together from many."""
    monkeypatch.setattr(conversations, "PIECE_ROWS", pieces)
    some = list(invented(random.Random(5), 150))
    some += random.Random(6).sample(some, 40)  # repeated rows
    found = queries.op11_conversation_repair(spark, stored(tmp_path, some))
    assert rows(found, *COLUMNS) == sorted(repaired(some), key=str)


def test_one_conversation_over_many_tasks(spark, tmp_path):
    """Three thousand turns of one conversation, half of them without a turn, beside short ones."""
    rng = random.Random(8)
    some = list(invented(rng, 30))
    some += [
        (1000, rng.choice([None, i]), rng.choice(["user", "assistant"]), f"{rng.randrange(2000)} {rng.choice('.!?x')}")
        for i in range(3000)
    ]
    folder = stored(tmp_path, some)
    found = queries.op11_conversation_repair(spark, folder)
    assert rows(found, *COLUMNS) == sorted(repaired(some), key=str)
    pieces = conversations.repair_conversations(spark.read.parquet(f"{folder}/conversations.parquet"))[1]
    assert pieces.where("conv_id = 1000").count() > 5


def test_very_long_texts_and_empty_table(spark, tmp_path):
    long = "A sentence of a very long text. " * 200_000
    some = [(1, 0, "user", long), (1, 1, "assistant", long), (1, 2, "user", long), (2, 0, "assistant", "x" * 5_000_000)]
    (tmp_path / "a").mkdir()
    found = queries.op11_conversation_repair(spark, stored(tmp_path / "a", some))
    assert rows(found, *COLUMNS) == sorted(repaired(some), key=str)
    (tmp_path / "b").mkdir()
    assert queries.op11_conversation_repair(spark, stored(tmp_path / "b", [])).collect() == []


def test_turns_of_the_operator(spark, frame):
    some = [(1, 0, "assistant", "Hm."), (1, 1, "user", "Go on"), (1, 2, "assistant", "So be it.")]
    summary, turns = conversations.repair_conversations(frame("conv_id bigint, turn bigint, role string, text string", some))
    assert rows(summary, "conv_id", "truncated", "cost", "audit") == [(1, 1, 3, "IKKK")]
    ((pieces,),) = rows(turns, "turns")
    assert [tuple(t) for t in pieces] == [("user", ""), *[r[2:] for r in some]]
    assert cheapest([r[1:] for r in some], ["", "truncated", ""])[:2] == (3, "IKKK")
