import random

import duckdb
import numpy as np
import pytest
from conftest import DATA
from llm.brute_tree import tree
from llm.conftest import rows
from llm.test_conversations import invented, stored
from plumbline.llm import prefix_tree, queries

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def same(spark, folder, some):
    assert rows(queries.op13_prefix_tree(spark, folder), *COLUMNS) == sorted(tree(some), key=str)


def test_given_table(spark):
    same(spark, DATA, duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{DATA}/conversations.parquet'").fetchall())


def copied(rng, n):
    """Conversations of which many are copies or begin alike, a third of them the very same."""
    texts = ["Hello there.", "Why?", "", "a b\nc", "É é", None]
    known = [[(rng.choice(["user", "assistant", None]), rng.choice(texts)) for _ in range(7)] for _ in range(4)]
    for c in rng.sample(range(-60, 3 * n), n):
        some = known[0][:4] if c % 3 == 0 else rng.choice(known)[: rng.randrange(1, 8)]
        some = [t if rng.random() < 0.9 else (t[0], rng.choice(texts)) for t in some] if c % 3 else some
        for turn, (role, text) in enumerate(some):
            yield c, turn if turn or rng.random() < 0.8 else None, role, text


@pytest.mark.parametrize(("stretch", "shard"), [(4096, 1 << 18), (2, 5)])
def test_like_brute_force(spark, tmp_path, monkeypatch, stretch, shard):
    """Also with conversations of many stretches and shards of few rows."""
    monkeypatch.setattr(prefix_tree, "STRETCH", stretch)
    monkeypatch.setattr(prefix_tree, "SHARD_ROWS", shard)
    some = list(copied(random.Random(1), 200))
    some += [r for r in invented(random.Random(2), 60)]
    some += random.Random(3).sample(some, 50)  # repeated rows
    same(spark, stored(tmp_path, some), some)


def test_one_long_conversation(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(prefix_tree, "STRETCH", 500)
    rng = random.Random(4)
    some = [(20, i, "user", f"turn {rng.randrange(5)}") for i in range(4000)]
    some += [(c, i, r[2], r[3]) for c in (21, 22, 23, 40) for i, r in enumerate(some[: rng.randrange(400, 4000)])]
    some += [(20, None, "system", "long " * 500_000)]
    found = queries.op13_prefix_tree(spark, stored(tmp_path, some))
    expected = {}
    # The brute force keeps whole beginnings; here a node is known by depth and least member.
    nodes = {(r["conv_id"], r["depth"]): r for r in found.collect()}
    from llm.brute_tree import rebuilt

    turns = dict(rebuilt(some))
    for d in range(max(map(len, turns.values())) + 1):
        for c, own in turns.items():
            if len(own) >= d:
                expected.setdefault(d, {}).setdefault(hash(tuple(own[:d])), set()).add(c)
    assert len(nodes) == sum(map(len, expected.values()))
    assert all(nodes[min(m), d]["n_convs"] == len(m) for d, some in expected.items() for m in some.values())
    assert nodes[20, 0]["n_leaves"] == sum(r["n_children"] == 0 for r in nodes.values())


def test_no_turns_and_no_rows(spark, tmp_path):
    """Conversation 15 has only turns that are replaced, by those of a conversation that is not there."""
    some = [(c, 0, "user", "hi") for c in (15, 17, 38, 39)]
    (tmp_path / "a").mkdir()
    same(spark, stored(tmp_path / "a", some), some)
    (tmp_path / "b").mkdir()
    assert queries.op13_prefix_tree(spark, stored(tmp_path / "b", [])).collect() == []


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 7, 1000, 50_000):
        keys = rng.integers(0, 1 << 63, (n, 2)).astype(np.uint64)
        table = prefix_tree.SlotTable(keys)
        assert sorted(table.slots(keys)) == list(range(n))
        assert (table.slots(keys ^ np.uint64(1)) == -1).all()
    with pytest.raises(ValueError, match="distinct"):
        prefix_tree.SlotTable(np.ones((2, 2), np.uint64))
