import re
from collections import Counter

import numpy as np
import pytest
from plumbline.llm import quality
from pyspark.sql import functions as F

TEXTS = [
    None, "", " \n \t", "one", "a b c d e f g h", "a b c d e f g h " * 2, "a b c d e f g " * 9, "x\nx\n\nx \ny", "#*$%&|<> é ü", "w " * 50_000,
    "l" * 200_000, "a\x1cb   c　d", "\n\n", "A1 " * 30, "p q r s t u v w x " * 3 + "tail of the text",
]


def slow(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    marked = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            marked.update(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked)


@pytest.mark.parametrize("text", TEXTS)
def test_counts(text):
    assert quality.text_counts(text)[:5] == slow(text)


def test_counts_of_documents(sf_documents):
    for r in sf_documents.collect():
        assert quality.text_counts(r.text)[:5] == slow(r.text)


def test_chi_square():
    # Of tables of the chi-square distribution.
    for p, d, value in ((0.5, 2, 1.386), (0.95, 3, 7.815), (0.99, 7, 18.475), (0.999, 5, 20.515)):
        assert quality.chi_square_quantile(p, d) == pytest.approx(value, rel=0.02)


def words(rng, n, length=5):
    return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, max(1, int(rng.normal(length, 1))))) for _ in range(n))


def test_outliers_go_and_clean_documents_stay(documents):
    rng = np.random.default_rng(3)
    rows, bad = [], set()
    for i in range(900):
        lang, source = ["en", "de", None][i % 3], ["a", "b", None][i // 3 % 3]
        text = words(rng, int(rng.integers(20, 400)), 5 if lang != "de" else 9)
        if i % 10 == 0:
            bad.add(i)
            text = [" ".join(w + "###" for w in text.split()), text.upper() + "!", " | ".join(text.split()), " ".join(w for x in text.split() for w in [x] * 7)][i // 10 % 4]
        rows.append((i, text, lang, source))
    rows += [(1000, None, "en", "a"), (1001, "", None, None), (1002, "too short", "xx", "new"), (1003, words(rng, 30), "xx", "new")]
    found = {r.doc_id: r for r in quality.judge_quality(documents(rows), parent_rows=60).collect()}
    assert len(found) == len(rows)
    assert all(found[i].base_failed and not found[i].kept and found[i].distance is None for i in (1000, 1001, 1002))
    passed = {i for i, r in found.items() if not r.base_failed}
    assert {i for i in passed if not found[i].kept} == bad & passed
    for i, text, *_ in rows:
        own = slow(text)
        assert tuple(found[i][n] for n in quality.COUNTS) == own
        assert found[i].base_failed == (own[0] < 20 or 100 * own[4] > 30 * own[0])


def vectors_of(rows):
    """The statistics of texts and what they vary by, in numpy."""
    counts = np.array([quality.text_counts(text) for _, text, *_ in rows], float)
    words, chars, symbols, dup, repeated, lines, upper, digits, stutter, digit_words = counts.T
    x = np.column_stack([
        np.log(chars / words), np.sqrt(symbols / words), np.sqrt(dup / lines), np.sqrt(repeated / words), np.sqrt(upper / chars),
        np.sqrt(digits / chars), np.sqrt(stutter / words),
    ])
    number = np.maximum(digits / np.maximum(digit_words, 1), chars / words)
    v = np.column_stack([1 / words, 1 / words, 1 / lines, 16 / words, 1 / words, number / chars, 1 / words]) / 4
    return x, v


def far(x, mean, covariance):
    return np.array([(a - mean) @ np.linalg.inv(c) @ (a - mean) for a, c in zip(x, np.broadcast_to(covariance, (len(x), 7, 7)), strict=True)])


def low_median(x):
    return np.sort(x, 0)[(len(x) - 1) // 2]


def slow_estimate(x, v, share=0.75, steps=4):
    """The minimum covariance determinant of all rows in memory, ordered by exact distances."""
    middle, own = low_median(x), v.mean(0)
    spread = 1.4826 * low_median(abs(x - middle))
    turned = (x - middle) / np.sqrt(spread**2 + v)
    turned /= np.maximum(np.linalg.norm(turned, axis=1, keepdims=True), 1e-9)
    scale, found = np.sqrt(spread**2 + own), []
    spatial = turned.T @ turned * 7 / len(x) * np.outer(scale, scale)
    for mean, c in ((middle, np.diag(spread**2)), (x.mean(0), np.cov(x.T, bias=True)), (middle, spatial)):
        c = c + np.diag(own)
        for _ in range(steps):
            near = np.argsort(far(x, mean, c), kind="stable")[: int(np.ceil(share * len(x)))]
            mean, noise = x[near].mean(0), np.diag(v[near].mean(0))
            c = np.cov(x[near].T, bias=True) + noise
        found.append((np.linalg.det(c), mean, c, noise))
    _, mean, c, noise = min(found, key=lambda e: e[0])
    return len(x), mean, (c - noise) * max(1, low_median(far(x, mean, c)) / quality.chi_square_quantile(0.5, 7))


def slow_distances(rows, parent_rows):
    x, v = vectors_of(rows)
    out = np.zeros(len(rows))
    langs, pairs = [r[2] for r in rows], [r[2:] for r in rows]
    for pair in set(pairs):
        own = [i for i, p in enumerate(pairs) if p == pair]
        lang = [i for i, name in enumerate(langs) if name == pair[0]]
        _, mean, c = slow_estimate(x, v)
        for part in (lang, own):
            n, m, s = slow_estimate(x[part], v[part])
            w, off = n / (n + parent_rows), m - mean
            mean, c = w * m + (1 - w) * mean, w * s + (1 - w) * c + w * (1 - w) * np.outer(off, off)
        out[own] = far(x[own], mean, c + v[own][:, :, None] * np.eye(7))
    return out


def spoiled(rng, text, kind, part):
    """The text with a part of its words spoiled."""
    out = [
        {"digits": "".join(str(rng.integers(10)) for _ in w), "symbols": w + "#", "capitals": w.upper(), "stutter": w + " " + w}[kind]
        if rng.random() < part else w
        for w in text.split()
    ]
    return " ".join(out)


def test_verdicts_are_those_of_estimates_in_memory(documents):
    rng = np.random.default_rng(8)
    sure, rows = {}, []
    for i in range(720):
        lang, source = ["en", "en", "de"][i % 3], ["a", "b"][i // 3 % 2] if i % 60 else "rare"
        text = words(rng, int(rng.integers(100, 400)), 5 if lang == "en" else 8)
        if i % 12 == 5:
            kind, part = ["digits", "symbols", "capitals", "stutter"][i // 12 % 4], [0.02, 0.1, 0.4, 0.5][i // 48 % 4]
            text, sure[i] = spoiled(rng, text, kind, part), part >= 0.4
        rows.append((i, text, lang, source))
    found = {r.doc_id: r for r in quality.judge_quality(documents(rows), parent_rows=60).collect()}
    want, most = slow_distances(rows, 60), quality.chi_square_quantile(1 - 1e-6, 7)
    close = 0
    for i, distance in enumerate(want):
        assert found[i].distance == pytest.approx(distance, rel=0.3, abs=0.5)  # whole classes are taken up to the share
        if 0.8 < distance / most < 1.25:
            close += 1
        else:
            assert found[i].kept == (distance <= most)
    assert close < 0.02 * len(rows)
    assert all(not found[i].kept for i, bad in sure.items() if bad)  # 40 % of digits, symbols, capitals go
    assert all(found[i].kept for i in range(len(rows)) if i not in sure)


def test_estimates_withstand_a_third_of_outliers(spark):
    rng = np.random.default_rng(5)
    covariance = np.array([[1.0, 0.6, 0.0], [0.6, 1.0, 0.2], [0.0, 0.2, 0.5]])
    clean, far = rng.multivariate_normal([0, 5, -3], covariance, 4000), rng.normal(30, 0.3, (1500, 3))
    df = spark.createDataFrame([("p", *map(float, x)) for x in np.vstack([clean, far])], "part string, x0 double, x1 double, x2 double")
    found = quality.robust_estimates(df, [0.01] * 3, 0.6, 6).first()
    assert np.allclose(found["mean"], [0, 5, -3], atol=0.15)
    shape = np.linalg.inv(np.array(found["inverse"]).reshape(3, 3))
    scale = np.trace(shape) / np.trace(covariance)  # the median is that of all rows, outliers included
    assert 0.9 < scale < 1.8 and np.allclose(shape / scale, covariance, atol=0.1)


def test_repeated_rows_and_nothing(documents):
    found = quality.judge_quality(documents([(1, "a b")] * 3)).collect()
    assert [(r.doc_id, r.n_words, r.kept) for r in found] == [(1, 2, False)] * 3
    assert quality.judge_quality(documents([])).count() == 0


def test_reruns_agree(sf_documents):
    runs = [sorted(map(tuple, quality.judge_quality(sf_documents.repartition(n)).drop("distance").collect())) for n in (2, 5)]
    assert runs[0] == runs[1]


def test_labelled_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = quality.judge_quality(docs).join(labels, "doc_id").where(~F.col("base_failed"))
    counts = {(r.quality, r.kept): r["count"] for r in found.groupBy("quality", "kept").count().collect()}
    assert counts.get((1, False), 0) == 0 and counts.get((0, True), 0) <= 0.05 * counts[0, False]
