import re

import numpy as np
import xxhash
from plumbline.llm import simhash
from plumbline.llm.components import connected_components
from pyspark.sql import functions as F


def slow_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def groups(ids, linked):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


TEXTS = [
    None, "", " \n\t", "one", "one two", "ONE two", "one two three", "one two three four", "É é\u00a0x y z w", "a b c " * 300, "A B C " * 300,
    "x" * 100_000, "long " * 30_000, "nul \x00 byte", "i j k l m n o p q r s", "i j k l m n o p q r s", "i j k l m n o p q r t",
]


def check(df, texts):
    found = {r.doc_id: r for r in simhash.near_duplicates(df).collect()}
    prints = {i: slow_fingerprint(t) for i, t in texts.items()}
    ids = sorted(texts)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 2]
    want = groups(ids, links)
    assert {i: r.fingerprint % (1 << 64) for i, r in found.items()} == prints
    assert {i: r.component_id for i, r in found.items()} == want


def test_edge_texts(documents):
    check(documents(list(enumerate(TEXTS))), dict(enumerate(TEXTS)))


def test_documents(sf_documents):
    check(sf_documents, {r.doc_id: r.text for r in sf_documents.collect()})


def test_repeated_rows_null_ids_and_nothing(documents):
    found = simhash.near_duplicates(documents([(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (None, None)])).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in found) == [(0, 0), (0, 5), (5, 5), (5, 5)]
    assert simhash.near_duplicates(documents([])).count() == 0


def test_bit_slices_by_brute_force():
    rng = np.random.default_rng(4)
    for width, radius in ((1, 0), (1, 2), (1, 3), (4, 40), (4, 48)):
        values = rng.integers(0, 1 << 63, (6, width), dtype=np.uint64)[rng.integers(0, 6, 150)]
        flips = np.packbits(rng.random((150, width * 64)) < radius / (64 * width * 2 + 1), axis=1).view(np.uint64)
        values, keys = values ^ flips, np.sort(rng.integers(0, 3, 150))
        got = {(a, b) for i, j in simhash.near_in_runs(keys, values, radius) for a, b in zip(i.tolist(), j.tolist(), strict=True)}
        distance = np.bitwise_count(values[:, None] ^ values[None]).sum(2)
        want = {(a, b) for a in range(150) for b in range(a + 1, 150) if keys[a] == keys[b] and distance[a, b] <= radius}
        assert got == want and want


def test_components_of_a_path_a_star_and_loops(spark, frame):
    edges = [(i, i + 1) for i in range(0, 120)] + [(1000, i) for i in range(1001, 1400)] + [(7000, 7000), (None, 3), (1399, 1400), (1400, 1399)]
    rng = np.random.default_rng(2)
    rng.shuffle(edges)
    found = {r.node: r.component for r in connected_components(frame("u long, v long", [tuple(e) for e in edges])).collect()}
    assert found == {i: 0 for i in range(121)} | {i: 1000 for i in range(1000, 1401)}
    assert connected_components(frame("u long, v long", [])).count() == 0


def test_one_of_each_component_stays(spark, documents):
    """Repeated rows, rows with one doc_id, null ids and texts; all columns come back, whatever their names."""
    long = " ".join(f"w{i}" for i in range(3000))
    rows = [
        (5, long, "en", "a"), (3, long + " end", "en", "b"), (3, long + " end", "en", "b"), (None, "alone in the world", "de", None),
        (7, None, None, None), (6, "", "x", None), (8, "two words", "en", "a"), (8, "two words", "en", "b"), (8, "other words here", "en", "a"),
    ]
    docs = documents(rows)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id, r.text, r.lang) for r in kept.collect()), key=str)
    assert found == sorted(
        [(3, long + " end", "en"), (None, "alone in the world", "de"), (6, "", "x"), (8, "two words", "en"), (8, "other words here", "en")],
        key=str,
    )
    assert simhash.one_of_each(documents([])).count() == 0


def test_one_of_each_on_given_documents(sf_documents):
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(sf_documents).collect()}
    assert sorted(r.doc_id for r in simhash.one_of_each(sf_documents).collect()) == sorted(set(found.values()))
