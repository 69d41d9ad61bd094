import subprocess
import sys

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from plumbline.llm import packing, token_output, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
REFERENCE = Tokenizer.from_file(PATH)
EDGES = [
    None, "", " ", "a", "  two  spaces ", "line\nbreak. Next\n\nline", "tab\t x\u00a0y \u3000z", "<|endoftext|> in <|endoftext|>text",
    "don't we'll I'M", "é è ßü ñ", "漢字 仮名", "x" * 5000, "word " * 3000, "a.\nB, c.\n", "1,2.3 4;5", "\x1c odd \x85 space", "🙂 🙂🙂",
]


def ids(text):
    return REFERENCE.encode(text or "", add_special_tokens=False).ids


def decoded(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_encoder_is_the_tokenizer(sf_documents):
    texts = EDGES + [r.text for r in sf_documents.collect()]
    assert [decoded(x) for x in tokens.encoder(PATH).encode(texts)] == [ids(t) for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab é\n\t.,'<|> 1\u00a0ß#Z"), max_size=40), max_size=4))
def test_encoder_on_any_text(texts):
    assert [decoded(x) for x in tokens.encoder(PATH).encode(texts)] == [ids(t) for t in texts]


def test_encoder_on_letters_of_all_planes():
    """Every 37th character, after, between and before what may be merged with it."""
    letters = [chr(c) for c in range(1, 0x110000, 37) if not 0xD800 <= c <= 0xDFFF]
    texts = [f"a{c}1{c}{c} {c}b. {c}\n{c}'s  {c}" for c in letters]
    assert [decoded(x) for x in tokens.encoder(PATH).encode(texts)] == [ids(t) for t in texts]


def test_long_runs_take_linear_time():
    texts = ["x" * 300_000, " " * 300_000, "ab1" * 100_000, "é" * 100_000]
    assert [decoded(x) for x in tokens.encoder(PATH).encode(texts)] == [ids(t) for t in texts]


def test_other_vocabularies_are_encoded_as_they_are():
    path = public_tokenizers.path("word_bpe_49k.json")
    own, reference = tokens.Encoder(path), Tokenizer.from_file(path)
    assert own.fast is None and tokens.encoder(PATH).fast is not None
    texts = [t for t in EDGES if t]
    assert [decoded(x) for x in own.encode(texts)] == [reference.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("texts", [EDGES, [], ["same text"] * 40])
def test_packing_is_lossless(documents, texts):
    found = packing.pack_documents(documents(list(enumerate(texts))), PATH, width=64).collect()
    pieces, windows = {}, {}
    for r in found:
        assert len(r.ids) == 4 * r.length and 0 < r.length <= 64
        pieces.setdefault(r.doc_id, []).append((r.start, decoded(r.ids), r.doc_tokens))
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(range(len(texts)))
    for i, text in enumerate(texts):
        joined = [x for start, own, _ in sorted(pieces[i]) for x in own]
        assert joined == [*ids(text), 0]
        assert {total for _, _, total in pieces[i]} == {len(joined)}
    for window in windows.values():
        filled = 0
        for offset, length in sorted(window):
            assert offset == filled
            filled += length
        assert filled == 64 or filled & (filled - 1) == 0


def test_repeated_rows_are_packed_each(documents):
    found = packing.pack_documents(documents([(1, "some text")] * 5 + [(None, None)]), PATH).collect()
    assert sum(r.length for r in found if r.doc_id == 1) == 5 * (len(ids("some text")) + 1)
    assert sum(r.length for r in found if r.doc_id is None) == 1


def squares(levels):
    return int((levels.count**2).sum())


def test_level_choice_minimises_squares():
    rng = np.random.default_rng(0)
    levels = packing.Levels(32)
    for size in rng.integers(1, 32, 400).tolist():
        costs = {}
        for level in range(0, 33 - size):
            if level and not levels.count[level]:
                continue
            after = levels.count.copy()
            after[level] -= level > 0
            if level + size < 32:
                after[level + size] += 1
            costs[level] = int((after**2).sum())
        assert costs[levels.choose(size)] == min(costs.values())
        levels.place(("piece", size), size)
        assert levels.count[0] == levels.count[32] == 0


@pytest.mark.parametrize("texts", [EDGES, [], ["same text"] * 40])
def test_matrices_are_lossless(documents, texts):
    found = token_output.token_matrices(documents(list(enumerate(texts))), PATH, width=48, batch_tokens=500).collect()
    got = {i: {} for i in range(len(texts))}
    for r in found:
        row, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u4")
        assert len(row) == len(places) == 48 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert (row[r.n_tokens :] == 50256).all() and places[r.n_tokens :].tolist() == list(range(48 - r.n_tokens))
        for doc, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            got[doc][start] = row[a:b].tolist()
            assert places[a:b].tolist() == list(range(b - a))
    for i, text in enumerate(texts):
        assert [x for start in sorted(got[i]) for x in got[i][start]] == [*ids(text), 50256]
    assert len({r.sequence_id for r in found}) == len(found)


def test_best_fit_decreasing_by_brute_force():
    rng = np.random.default_rng(1)
    for width in (1, 7, 64, 100):
        sizes = rng.integers(1, width + 1, 200).tolist()
        rows = token_output.best_fit_decreasing(sizes, width)
        free, slow = [], []
        for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
            fits = [k for k, room in enumerate(free) if room >= sizes[i]]
            if fits:
                least = min(free[k] for k in fits)
                k = max(k for k in fits if free[k] == least)
            else:
                k = len(free)
                free.append(width)
                slow.append([])
            free[k] -= sizes[i]
            slow[k].append(i)
        assert sorted(sum(sizes[i] for i in row) for row in rows) == sorted(width - room for room in free)
        assert sorted(i for row in rows for i in row) == list(range(len(sizes)))


HELD = """
import re
import types
import pyarrow as pa
import public_tokenizers
from plumbline.llm import packing
from pathlib import Path

def held():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024

packing.TaskContext = types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0))
packing.documents = lambda docs, *names: types.SimpleNamespace(mapInArrow=lambda task, schema: task)
task = packing.pack_documents(None, public_tokenizers.path("byte_bpe_50k.json"))

def batches():
    for k in range(3):
        texts = [f"word {i * 7919 % 10007} of {i} " * (20 + i % 300) for i in range(k, 9000 + k)]
        yield pa.RecordBatch.from_arrays([pa.array(range(9000)), pa.array(texts)], ["doc_id", "text"])

list(task(pa.RecordBatch.from_arrays([pa.array([i]), pa.array(["a b"])], ["doc_id", "text"]) for i in range(2)))
before = held()
rows = sum(out.num_rows for out in task(batches()))
print(rows, round(held() - before))
"""


@pytest.mark.skipif(sys.platform != "linux", reason="memory is read from /proc")
def test_packing_gives_memory_back():
    """Spark keeps its Python workers; of some 80 MB that come in, a worker is not to hold on to much when its task is over."""
    done = subprocess.run([sys.executable, "-c", HELD], capture_output=True, text=True, check=True, timeout=300)
    rows, kept = map(int, done.stdout.split())
    assert rows > 27_000 and kept < 70


def test_tokenizers_is_loaded_for_texts_with_added_tokens_only():
    own = tokens.Encoder(PATH)
    assert own.vocabulary == max(REFERENCE.get_vocab(with_added_tokens=True).values()) + 1
    assert decoded(own.one("plain text")) == ids("plain text") and "tokenizer" not in vars(own)
    assert decoded(own.one("<|endoftext|> in text")) == ids("<|endoftext|> in text") and "tokenizer" in vars(own)
