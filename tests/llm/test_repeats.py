from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from plumbline.llm import repeats

RNG = np.random.default_rng(6)
PASSAGE = " ".join(f"p{i}" for i in RNG.integers(0, 9999, 120))


def noise(n):
    return "".join(chr(97 + x) for x in RNG.integers(0, 26, n))


TEXTS = [
    None, "", "short", "a" * 1000, "ab" * 400, "x" * 199, "y" * 200, "z" * 201, noise(300), "same " * 60, "same " * 60,
    noise(70) + PASSAGE + noise(90), noise(130) + PASSAGE, PASSAGE[:260] + noise(40), PASSAGE[100:310], PASSAGE[100:299], noise(50) + PASSAGE[37:400] + noise(400),
    PASSAGE + noise(10) + PASSAGE, "é" * 150, "ü" + "é" * 150, "nul \x00" * 80, "\x00" * 300, noise(20) + "é" * 120 + noise(20),
]


def slow(texts, least, keep_first):
    raw = [(t or "").encode() for t in texts]
    starts = defaultdict(list)
    for d, b in enumerate(raw):
        for i in range(len(b) - least + 1):
            starts[b[i : i + least]].append((d, i))
    out = {}
    for d, b in enumerate(raw):
        gone = bytearray(len(b))
        for i in range(len(b) - least + 1):
            places = starts[b[i : i + least]]
            if len(places) > 1 and not (keep_first and places[0] == (d, i)):
                gone[i : i + least] = b"\x01" * least
        out[d] = bytes(x for x, g in zip(b, gone, strict=True) if not g)
    return out


@pytest.mark.parametrize("keep_first", [True, False])
@pytest.mark.parametrize("most", [2_048, 1])
def test_by_brute_force(documents, monkeypatch, keep_first, most):
    monkeypatch.setattr(repeats, "MOST_IN_A_TASK", most)
    monkeypatch.setattr(repeats, "SEGMENT", 512)
    texts = TEXTS + [noise(40) + PASSAGE[50:400] + noise(i) for i in range(12)]
    found = repeats.remove_repeats(documents(list(enumerate(texts))), 200, keep_first).collect()
    want = slow(texts, 200, keep_first)
    assert {r.doc_id: bytes(r.kept) for r in found} == want
    for r in found:
        assert r.n_bytes == len((texts[r.doc_id] or "").encode())
        assert r.n_bytes - sum(s.end - s.begin for s in r.spans) == len(r.kept)
        assert all(a.end < b.begin for a, b in zip(r.spans, r.spans[1:], strict=False))


def test_other_lengths(documents):
    for least in (65, 120, 700):
        found = repeats.remove_repeats(documents(list(enumerate(TEXTS))), least, False).collect()
        assert {r.doc_id: bytes(r.kept) for r in found} == slow(TEXTS, least, False)
    with pytest.raises(ValueError):
        repeats.remove_repeats(documents([]), 64)


def test_documents(sf_documents):
    texts = {r.doc_id: r.text for r in sf_documents.collect()}
    assert sorted(texts) == list(range(len(texts)))
    for keep_first in (True, False):
        found = repeats.remove_repeats(sf_documents, keep_first=keep_first)
        assert {r.doc_id: bytes(r.kept) for r in found.collect()} == slow([texts[i] for i in range(len(texts))], 200, keep_first)


def test_repeated_rows_null_ids_other_columns_and_nothing(documents):
    one = noise(300)
    df = documents([(1, one), (1, one), (None, one), (2, noise(300))])
    found = repeats.remove_repeats(df, keep_first=False, c0="key", c1="n_chars").collect()
    assert Counter((r.doc_id, len(r.kept), r.c0, r.c1) for r in found) == {(1, 0, "?", 300): 2, (None, 0, "?", 300): 1, (2, 300, "?", 300): 1}
    found = repeats.remove_repeats(df, keep_first=True).collect()
    assert Counter((r.doc_id, len(r.kept)) for r in found) == {(1, 0): 2, (None, 300): 1, (2, 300): 1}
    assert repeats.remove_repeats(documents([])).count() == 0


def test_whole_characters(documents):
    texts = ["a" + "é" * 200, "é" * 199 + "b", "日本語" * 60 + "x", "y" + "日本語" * 60]
    found = repeats.remove_repeats(documents(list(enumerate(texts))), keep_first=False, whole_characters=True).collect()
    for r in found:
        assert bytes(r.kept).decode() is not None and len(r.kept) < len(texts[r.doc_id].encode())


def test_anchors_depend_on_the_window_alone():
    raw = np.frombuffer((noise(900) + "ab" * 300).encode(), np.uint8)
    of = {}
    for h, _, start, offset, n in repeats.zones(raw, 200):
        for values in zip(h.tolist(), start.tolist(), offset.tolist(), n.tolist(), strict=True):
            for s in range(values[3]):
                of[values[1] + s] = (values[0], values[2] - s)
    assert sorted(of) == list(range(len(raw) - 199))
    for i in range(0, len(raw) - 199, 53):
        h, _, _, offset, n = next(repeats.zones(raw[i : i + 200].copy(), 200))
        assert (int(h[0]), int(offset[0]), n.tolist()) == (*of[i], [1])


def test_merged():
    spans = pa.array([[{"begin": 5, "end": 9}, {"begin": 0, "end": 2}, {"begin": 9, "end": 12}, {"begin": 6, "end": 7}]])
    assert repeats.merged(spans[0]) == [(0, 2), (5, 12)]


def test_longest_factors_by_brute_force():
    """Suffixes of small texts, cut to 12 bytes, in two groups."""
    common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), len(a))
    for n in (0, 1, 2, 40, 300):
        raw = RNG.integers(0, 2, n + 12).astype(np.uint8)
        raw[n // 2 : n // 2 + 9] = 0
        suffixes = np.lib.stride_tricks.sliding_window_view(raw, 12)[:n]
        groups, position = RNG.integers(0, 2, n), RNG.permutation(n)
        previous, following = repeats.suffix_factors(groups, suffixes, position)
        texts = [s.tolist() for s in suffixes]
        for i in range(n):
            others = [j for j in range(n) if groups[j] == groups[i]]
            assert previous[i] == max([common(texts[i], texts[j]) for j in others if position[j] < position[i]], default=0)
            assert following[i] == max([common(texts[i], texts[j]) for j in others if position[j] > position[i]], default=0)


def test_first_copies_stay_in_repeated_rows(documents):
    """A passage inside of two texts, the first of which is there three times: it stays in all three."""
    passage = noise(300)
    one, two = noise(300) + passage + noise(150), noise(250) + passage + noise(220)
    found = repeats.remove_repeats(documents([(1, one), (2, two), (1, one), (1, one)]), keep_first=True).collect()
    assert Counter((r.doc_id, bytes(r.kept).decode()) for r in found) == {(1, one): 3, (2, two.replace(passage, "")): 1}
    found = repeats.remove_repeats(documents([(1, one), (2, two), (1, one)]), keep_first=False).collect()
    assert Counter((r.doc_id, bytes(r.kept).decode()) for r in found) == {(1, ""): 2, (2, two.replace(passage, "")): 1}
