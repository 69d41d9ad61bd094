import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from plumbline.llm import mixing


def test_targets():
    assert mixing.fill_up([100, 100, 100], [1, 2, 3], 3) == [50, 100, 150]
    assert mixing.fill_up([10, 1000], [3, 1], 3) == [30, 980]
    assert mixing.fill_up([0, 5], [1, 1], 3) == [0, 5] and mixing.fill_up([], [], 3) == []
    sizes, weights = [1, 2, 3, 500], [3.0, 2.0, 2.0, 1.0]
    targets = mixing.fill_up(sizes, weights, 3)
    assert targets == [3, 6, 9, 488] and sum(targets) == sum(sizes)


def test_permutations():
    for n in (1, 2, 3, 17, 64, 1000):
        for key in (0, 5, 1 << 45):
            assert sorted(mixing.permute(np.arange(n), n, key).tolist()) == list(range(n))
    assert mixing.permute(np.arange(1000), 1000, 1).tolist() != mixing.permute(np.arange(1000), 1000, 2).tolist()


def test_draws_have_the_right_sums():
    rng = np.random.default_rng(0)
    for _ in range(30):
        totals = rng.integers(0, 2000, rng.integers(1, 30))
        totals[0] += 1
        shards = int(rng.integers(1, 12))
        drawn = mixing.draw_shards(totals, shards, 7)
        assert (drawn.sum(0) == totals).all() and (drawn >= 0).all()
        assert drawn.sum(1).max() - drawn.sum(1).min() <= 1
    wide = mixing.draw_shards(np.array([5000, 5000]), 10, 7)
    assert len(set(wide[:, 0].tolist())) > 3  # draws, not quotas


def mixture(documents, rows, **how):
    mix = mixing.mix_sources(documents(rows), block_words=16, shard_slots=50, **how)
    return mix, mixing.taken_words(mix).collect()


def rows_of(n, seed=1):
    rng = np.random.default_rng(seed)
    rows = [(i, " ".join(f"{i}_{k}" for k in range(int(rng.integers(0, 90)))), "en", "hot" if i % 3 else f"s{i % 5}") for i in range(n)]
    return rows + [(n, None, "en", None), (n + 1, "", None, None), (n + 2, " \n", None, "s1"), (n + 3, "null source words here", "en", None)]


def test_words_come_near_their_targets(documents):
    rows = rows_of(400)
    mix, found = mixture(documents, rows)
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    by_source = defaultdict(list)
    for r in found:
        text = next(t for i, t, *_ in rows if i == r.doc_id)
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) and 0 <= r.taken <= 3 * r.size
        by_source[r.source].append(r)
    sizes = {s: sum(r.size for r in x) for s, x in by_source.items()}
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    targets = dict(zip(order, mixing.fill_up([sizes[s] for s in order], [1 + i % 3 for i in range(len(order))], 3), strict=True))
    for s, x in by_source.items():
        assert {r.source_size for r in x} == {sizes[s]} and all(r.target == pytest.approx(targets[s]) for r in x)
        assert abs(sum(r.taken for r in x) - targets[s]) <= max(32, 0.03 * targets[s])
    uses = Counter((r.place, r.block) for r in mix.slots.collect())
    for count in uses.values():
        assert count <= 3
    spread = defaultdict(set)
    for (place, _), count in uses.items():
        spread[place].add(count)
    assert all(max(x) - min(x) <= 1 for x in spread.values())


def test_small_sources_come_near_their_targets(documents):
    sizes = {"a": 1, "b": 20, "c": 130, "d": 300, "e": 50_000}
    rows = [(i, " ".join(["w"] * n), None, s) for i, (s, n) in enumerate(sizes.items())]
    for weights in (mixing.cycling_weights, lambda i: [500.0, 1.0, 2.0, 1.0, 200.0][i]):
        mix = mixing.mix_sources(documents(rows), weights)
        targets = mixing.fill_up(list(sizes.values()), [weights(i) for i in range(5)], 3)
        found = {r.source: r.taken for r in mixing.taken_words(mix).collect()}
        for (s, n), target in zip(sizes.items(), targets, strict=True):
            blocks = -(-n // 128)
            assert abs(found[s] - target) <= n / blocks / 2 + 3 and 0 < found[s] <= 3 * n
            if target == 3 * n:
                assert found[s] == target
        assert max(r.uses for r in mix.blocks.collect()) <= 3
        words = mix.pieces.groupBy("source", "block").sum("n_words").collect()
        assert all(sizes[r[0]] // -(-sizes[r[0]] // 128) <= r[2] <= 128 for r in words)


def test_reruns_agree_for_any_partitions(documents):
    runs = []
    for n in (1, 7):
        df = documents(rows_of(150)).repartition(n)
        runs.append(sorted((r.doc_id, r.taken) for r in mixing.taken_words(mixing.mix_sources(df, block_words=16)).collect()))
    assert runs[0] == runs[1]


def test_texts_are_what_was_taken(documents):
    rows = rows_of(150)
    mix = mixing.mix_sources(documents(rows), block_words=16, keep_text=True, c0="lang", c1="key")
    taken = {r.doc_id: r.taken for r in mixing.taken_words(mix).collect()}
    words = Counter()
    for r in mixing.mixed_texts(mix).collect():
        own = next(t for i, t, *_ in rows if i == r.doc_id)
        assert r.text in own and r.text.strip() and r.c1 == "?"
        words[r.doc_id] += len(r.text.split())
    assert {i: n for i, n in taken.items() if n} == dict(words)


def test_repeated_rows_small_sources_and_nothing(documents):
    _, found = mixture(documents, [(1, "a b c", None, "x")] * 6 + [(2, "d " * 100, None, "y")])
    assert Counter(r.doc_id for r in found) == {1: 6, 2: 1}
    assert all(r.taken <= 3 * r.size for r in found)
    for rows in ([], [(1, None)], [(1, ""), (1, "")]):
        _, found = mixture(documents, rows)
        assert [r.taken for r in found] == [0] * len(rows)
        assert mixing.mixed_texts(mixing.mix_sources(documents(rows), keep_text=True)).count() == 0
