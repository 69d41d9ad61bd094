from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from llm.test_quality import words
from llm.test_simhash import groups, slow_fingerprint
from llm.test_tokens import ids as token_ids


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The documents, and what each stage made of them."""
    rng = np.random.default_rng(9)
    passage = words(rng, 60)
    rows, clean = [], [words(rng, int(rng.integers(60, 300))) for _ in range(260)]
    for i, text in enumerate(clean):
        if i < 20:
            text = f"{text[:200]} {passage} {text[200:]}"
        rows.append((i, text))
        if i % 6 == 0:
            copy = text.split()
            copy[len(copy) // 2] = "edited"
            rows += [(1000 + i, text), (2000 + i, " ".join(copy))]
    junk = {3000: " ".join(f"{w}###" for w in clean[0].split()), 3001: "short", 3002: None, 3003: "", 3004: "again and " * 90}
    rows += list(junk.items()) + [rows[7], rows[30]]  # repeated rows
    folder = tmp_path_factory.mktemp("pipeline")
    table = pa.table({
        "doc_id": pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string()),
        "lang": pa.array(["en"] * len(rows)), "source": pa.array([None if r[0] % 7 == 0 else f"s{r[0] % 4}" for r in rows], pa.string()),
        "n_chars": pa.array([len(r[1] or "") for r in rows], pa.int64()), "key": pa.array(["k"] * len(rows)),
    })
    pq.write_table(table, folder / "documents.parquet")
    docs = [spark.read.parquet(str(folder / "documents.parquet"))]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs[-1], str(folder)).write.parquet(str(folder / f"stage{i}"))
        docs.append(spark.read.parquet(str(folder / f"stage{i}")))
    return [df.collect() for df in docs], [df.columns for df in docs], junk, passage, folder


def test_columns_stay(stages):
    rows, columns, *_ = stages
    assert all(sorted(c) == sorted(columns[0]) for c in columns[:-1])
    for stage in rows[1:-1]:
        assert all(r.n_chars == len(r.text) and r.key == "k" and r.lang == "en" for r in stage)


def test_quality_removes_junk_alone(stages):
    rows, _, junk, *_ = stages
    assert {r.doc_id for r in rows[0]} - {r.doc_id for r in rows[1]} == set(junk)


def test_one_of_each_group_stays(stages):
    rows, *_ = stages
    prints = {r.doc_id: slow_fingerprint(r.text) for r in rows[1]}
    assert len(prints) < len(rows[1])  # some rows are repeated
    ids = sorted(prints)
    first = groups(ids, [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 2])
    assert sorted(r.doc_id for r in rows[2]) == sorted({first[i] for i in prints})


def test_repeats_keep_their_first_copy(stages):
    rows, _, _, passage, _ = stages
    assert len(rows[3]) == len(rows[2])
    assert [r.doc_id for r in rows[3] if passage in r.text] == [min(r.doc_id for r in rows[2] if passage in r.text)]
    with_it = {r.doc_id for r in rows[2] if passage in r.text}
    before = {r.doc_id: r.text for r in rows[2]}
    assert len(with_it) > 10
    for r in rows[3]:
        if r.doc_id >= 2000 and r.doc_id - 2000 in before:  # an edited copy: both halves occur earlier, but for its edge
            assert len(r.text) < len(before[r.doc_id]) / 2 or len(before[r.doc_id]) < 800
        elif r.doc_id not in with_it:
            assert r.text == before[r.doc_id]


def test_mix_takes_from_the_texts(stages):
    rows, *_ = stages
    before = {r.doc_id: r for r in rows[3]}
    words = Counter()
    for r in rows[4]:
        assert r.text in before[r.doc_id].text and r.source == before[r.doc_id].source
        words[r.doc_id] += len(r.text.split())
    assert all(n <= 3 * len(before[i].text.split()) for i, n in words.items())
    total = sum(len(r.text.split()) for r in rows[3])
    assert 0.95 * total < sum(words.values()) < 1.05 * total


def test_packing_is_lossless(stages):
    rows, *_ = stages
    windows = defaultdict(int)
    for r in rows[5]:
        windows[r.sequence_id] += r.length
    assert sum(windows.values()) == sum(len(token_ids(r.text)) + 1 for r in rows[4])
    assert all(n == 1024 or n & (n - 1) == 0 for n in windows.values())


def test_run(spark, stages):
    rows, *_, folder = stages
    found = corpus_pipeline.run(spark, str(folder)).collect()
    assert sum(r.length for r in found) == sum(r.length for r in rows[5])


def test_nothing(spark, stages):
    *_, folder = stages
    docs = spark.read.parquet(str(folder / "documents.parquet")).limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(folder))
        assert docs.count() == 0
    assert corpus_pipeline.packed_sequences(spark, docs, str(folder)).count() == 0
