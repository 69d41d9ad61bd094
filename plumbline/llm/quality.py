"""Quality rules: text statistics, and robust multivariate outliers among them."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import cut, documents, released, slices, written
from plumbline.llm.components import SALTS

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_lines", "n_upper", "n_digits", "n_stutter", "n_digit_words"]
#: Classes of bytes: 1 white space, 2 symbols, 3 A-Z, 4 digits, 5 continuation of a character.
BYTES = np.zeros(256, np.uint8)
BYTES[[0x20, *range(0x09, 0x0E)]] = 1
BYTES[list(b"#*$%&|<>")] = 2
BYTES[list(range(ord("A"), ord("Z") + 1))] = 3
BYTES[list(range(ord("0"), ord("9") + 1))] = 4
BYTES[0x80:0xC0] = 5
WINDOW = 8
WEIGHTS = np.random.default_rng(3).integers(1, 1 << 62, WINDOW, dtype=np.int64) * 2 + 1


def repeated_words(words: list[bytes], hashes: np.ndarray) -> int:
    """How many words lie in 8-word windows that are found twice or more, the first included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    sums = sum(hashes[i : i + n] * WEIGHTS[i] for i in range(WINDOW))
    order = np.argsort(sums, kind="stable")
    again = np.flatnonzero(sums[order[1:]] == sums[order[:-1]])
    if not len(again):
        return 0
    # Equal windows have equal sums; whether equal sums are equal windows is looked up.
    seen: dict[tuple, int] = {}
    inside = np.zeros(len(words) + 1, np.int64)
    for at in np.unique(np.concatenate([order[again], order[again + 1]])).tolist():
        window = tuple(words[at : at + WINDOW])
        first = seen.setdefault(window, at)
        if first != at:
            for begin in (first, at):
                inside[begin] += 1
                inside[begin + WINDOW] -= 1
    return int((np.cumsum(inside) > 0).sum())


def text_counts(text: str | None) -> tuple[int, ...]:
    """``COUNTS`` and ``MORE`` of a whole text."""
    raw = (text or "").encode()
    words = raw.split()
    classes = BYTES[np.frombuffer(raw, np.uint8)]
    kinds = np.bincount(classes, minlength=6).tolist()
    digit_words = len(np.unique(np.cumsum(classes == 1)[classes == 4])) if kinds[4] else 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return (
        len(words), len(raw) - kinds[1] - kinds[5], kinds[2], len(lines) - len(set(lines)),
        repeated_words(words, hashes),
        len(lines), kinds[3], kinds[4], int((hashes[1:] == hashes[:-1]).sum()), digit_words,
    )


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, key (XXH64 of doc_id and text), lang, source, and the counts of each text."""
    names, ids = [*COUNTS, *MORE], ["doc_id", "key", "lang", "source"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = np.array([text_counts(t) for t in part.column("text").to_pylist()], np.int64)
                columns = [*[part.column(name) for name in ids], *map(pa.array, rows.T.copy())]
                yield pa.RecordBatch.from_arrays(columns, [*ids, *names])

    schema = "doc_id long, key long, lang string, source string, " + ", ".join(f"{name} long" for name in names)
    rows = docs.withColumn("key", F.xxhash64("doc_id", "text")).select(*ids, "text")
    return rows.mapInArrow(released(task), schema)


def features() -> list[tuple[Column, Column]]:
    """Transformed statistics, and what each varies by in a text as long as this one by chance alone: shares by their square
    root, the mean length of words by its logarithm.

    The square root of a share of n things that come independently has the variance 1 / (4 n). So have, about, logarithms of mean
    word lengths. Symbols, capitals and stuttered words are taken to come a word at a time, duplicate lines a line at a time, digits
    in the words they are in, and repeated words in no less than a window of 8 in two places.
    """
    words, chars, lines = (F.greatest(name, F.lit(1)) for name in ("n_words", "word_chars", "n_lines"))
    share = lambda part, whole: F.sqrt(F.col(part) / whole)
    by_chance = lambda n: 1 / (F.lit(4.0) * n)
    a_number = F.greatest(F.col("n_digits") / F.greatest("n_digit_words", F.lit(1)), chars / words)
    return [
        (F.log(chars / words), by_chance(words)),
        (share("n_symbols", words), by_chance(words)),
        (share("n_dup_lines", lines), by_chance(lines)),
        (share("n_repeat_words", words), by_chance(words / (2 * WINDOW))),
        (share("n_upper", chars), by_chance(words)),
        (share("n_digits", chars), by_chance(chars / a_number)),
        (share("n_stutter", words), by_chance(words)),
    ]


def chi_square_quantile(p: float, d: int) -> float:
    """By Wilson and Hilferty."""
    low, high = -9.0, 9.0
    for _ in range(80):
        z = (low + high) / 2
        low, high = (z, high) if math.erfc(-z / math.sqrt(2)) / 2 < p else (low, z)
    return d * (1 - 2 / (9 * d) + low * math.sqrt(2 / (9 * d))) ** 3


def robust_estimates(
    rows: DataFrame, scales: list[float] | None, share: float, steps: int, step_width: float = 1 / 64
) -> DataFrame:
    """Minimum-covariance-determinant estimates of the columns x0, x1, ... per ``part``: part, n, mean, covariance, inverse.

    Concentration starts from three estimates: medians with median deviations, means with covariances of all rows, and medians
    with covariances of spatial signs. Each step takes the ``share`` of the rows that are nearest by Mahalanobis distance and
    estimates mean and covariance from them alone, which never raises the determinant; of the three ends, the one with the
    least determinant counts. A step is one aggregate: rows are summed by class of distance (64 to a factor of e), so that whole
    classes are taken up to the share. Only sums are shuffled: Spark sees the size of the estimates, which are written, and they
    bring an ``id`` of their own to sum by, so that rows never need to lie where a join by ``part`` puts them. At last covariances are scaled so that the median of all
    rows' distances, by these same estimates, is that of a chi-square distribution (never down).

    Where rows agree, covariances are singular. So distances here are by the covariance plus the mean of what the rows
    vary by anyway: the columns v0, v1, ... (variances), or the square of ``scales`` if given. ``inverse`` is of that sum, ``covariance``
    is without it.
    """
    d = len([name for name in rows.columns if name.startswith("x")]) if scales is None else len(scales)
    names, chance = [f"x{i}" for i in range(d)], [f"v{i}" for i in range(d)]
    if scales is not None:
        rows = rows.withColumns({v: F.lit(float(scale) ** 2) for v, scale in zip(chance, scales, strict=True)})
    products = [(i, j) for i in range(d) for j in range(i, d)]
    moments = [F.count("*").alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(names)]]
    moments += [F.sum(F.col(names[i]) * F.col(names[j])).alias(f"q{i}_{j}") for i, j in products]
    moments += [F.sum(v).alias(v) for v in chance]
    centre = "id string, part string, mean array<double>, spread array<double>"
    estimate = "id string, part string, start int, n long, mean array<double>, covariance array<double>, inverse array<double>, size double"

    def square(sums: pd.DataFrame) -> np.ndarray:
        full = np.zeros((d, d))
        for i, j in products:
            full[i, j] = full[j, i] = sums[f"q{i}_{j}"].sum()
        return full

    def row(part: str, start: int, n: int, mean: np.ndarray, covariance: np.ndarray, own: np.ndarray) -> dict:
        regular = covariance + np.diag(own)
        return {
            "id": f"{start} {part}", "part": part, "start": start, "n": n, "mean": mean, "covariance": covariance.ravel(),
            "inverse": np.linalg.inv(regular).ravel(), "size": float(np.linalg.slogdet(regular)[1]),
        }

    def of_sums(near: pd.DataFrame, n_all: int, start: int) -> dict:
        n, part = near["n"].sum(), near["id"].iloc[0].split(" ", 1)[1]
        mean = np.array([near[f"s{i}"].sum() / n for i in range(d)])
        own = np.array([near[v].sum() / n for v in chance])
        return row(part, start, n_all, mean, square(near) / n - np.outer(mean, mean), own)

    def medians(pdf: pd.DataFrame) -> pd.DataFrame:
        mean, spread = np.zeros(d), np.zeros(d)
        for i, group in pdf.groupby("i"):
            value, n = group["class"].to_numpy() * step_width, group["n"].to_numpy()

            def median(x: np.ndarray, n: np.ndarray = n) -> float:
                order = np.argsort(x, kind="stable")
                return float(x[order][np.searchsorted(np.cumsum(n[order]), n.sum() / 2)])

            mean[i] = median(value)
            spread[i] = 1.4826 * median(np.abs(value - mean[i]))
        part = pdf["part"].iloc[0]
        return pd.DataFrame([{"id": f"0 {part}", "part": part, "mean": mean, "spread": spread}])

    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(x).alias("x")) for i, x in enumerate(names)]))
    classes = rows.select("part", pairs.alias("p")).groupBy(
        "part", F.col("p.i").alias("i"), F.floor(F.col("p.x") / step_width).alias("class")
    )
    centres = written(classes.agg(F.count("*").alias("n")).groupBy("part").applyInPandas(medians, centre))

    # The direction of each row from the medians, in units of the median deviations, or of chance where these are less.
    off = [(F.col(names[i]) - F.col("mean")[i]) / F.sqrt(F.pow(F.col("spread")[i], 2) + F.col(chance[i])) for i in range(d)]
    length = F.greatest(F.sqrt(sum((x * x for x in off), F.lit(0.0))), F.lit(1e-9))
    signs = [F.sum(off[i] * off[j] / (length * length)).alias(f"u{i}_{j}") for i, j in products]
    at_first = rows.join(centres, "part").groupBy("id", "mean", "spread").agg(*moments, *signs)

    def starts(pdf: pd.DataFrame) -> pd.DataFrame:
        n = int(pdf["n"].iloc[0])
        part, mean, spread = pdf["id"].iloc[0].split(" ", 1)[1], np.array(pdf["mean"].iloc[0]), np.array(pdf["spread"].iloc[0])
        own = np.array([pdf[v].iloc[0] / n for v in chance])
        scale = np.sqrt(spread**2 + own)
        turned = square(pdf[[f"u{i}_{j}" for i, j in products]].rename(columns=lambda name: "q" + name[1:])) * d / n
        return pd.DataFrame([
            row(part, 0, n, mean, np.diag(spread**2), own),
            of_sums(pdf, n, 1),
            row(part, 2, n, mean, turned * np.outer(scale, scale), own),
        ])

    def concentrate(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("class")
        up_to = pdf["n"].cumsum().to_numpy()
        near = pdf.iloc[: int(np.searchsorted(up_to, share * up_to[-1])) + 1]
        return pd.DataFrame([of_sums(near, int(up_to[-1]), int(pdf["id"].iloc[0].split(" ", 1)[0]))])

    def scaled(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("class")
        up_to, first = pdf["k"].cumsum().to_numpy(), pdf.iloc[0]
        middle = math.exp(first["class"] / 64 if len(pdf) == 1 else pdf["class"].iloc[np.searchsorted(up_to, up_to[-1] / 2)] / 64)
        factor = max(1.0, middle / chi_square_quantile(0.5, d))
        names = ("covariance", factor), ("inverse", 1 / factor)
        return pd.DataFrame([{"part": first["part"], "n": first["n"], "mean": first["mean"]} | {k: np.array(first[k]) * f for k, f in names}])

    of_class = F.floor(F.log(F.col("distance") + 1e-9) * 64).alias("class")
    now = written(at_first.groupBy("id").applyInPandas(starts, estimate))
    for _ in range(steps):
        near = with_distance(rows, now, d).groupBy("id", of_class).agg(*moments)
        now = written(near.groupBy("id").applyInPandas(concentrate, estimate))
    # Ends that agree but for rounding are one; the first of them counts.
    best = now.groupBy("part").agg(F.min_by(F.struct("id", "n", "mean", "covariance", "inverse"), F.struct(F.round("size", 6), "start")).alias("e"))
    best = written(best.select("part", "e.*"))
    counts = with_distance(rows, best, d).groupBy("id", of_class).agg(F.count("*").alias("k"))
    result = "part string, n long, mean array<double>, covariance array<double>, inverse array<double>"
    return cut(counts.join(best, "id").groupBy("id").applyInPandas(scaled, result))


def with_distance(rows: DataFrame, estimates: DataFrame, d: int) -> DataFrame:
    """The rows with ``distance``, the squared Mahalanobis distance by their part's estimates (each ``id`` of them)."""
    off = [F.col(f"x{i}") - F.col("mean")[i] for i in range(d)]
    total = sum(
        (off[i] * off[j] * F.col("inverse")[i * d + j] * (1 if i == j else 2) for i in range(d) for j in range(i, d)), F.lit(0.0)
    )
    joined = rows.join(estimates.select("id", "part", "mean", "inverse"), "part")
    return joined.withColumn("distance", F.greatest(total, F.lit(0.0)))


def mixed_estimates(groups: DataFrame, estimates: DataFrame, parents: list[str], parent_rows: float) -> DataFrame:
    """For each of the ``groups``, whose columns ``parents`` name parts from the widest to its own, the mean and covariance of a
    mixture: a part of n rows weighs n, what surrounds it ``parent_rows``. So estimates pass from the one to the other without a
    jump, and what lies between a part and its surroundings widens the covariance."""
    joined = groups
    for i, name in enumerate(parents):
        one = estimates.select(F.col("part").alias(name), F.struct("n", "mean", "covariance").alias(f"e{i}"))
        joined = joined.join(one, name)

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            means, covariances = [], []
            for found in zip(*(frame[f"e{i}"] for i in range(len(parents))), strict=True):
                mean = covariance = None
                for e in found:
                    own = np.array(e["mean"])
                    spread = np.array(e["covariance"]).reshape(len(own), -1)
                    if mean is not None:
                        w, off = e["n"] / (e["n"] + parent_rows), own - mean
                        spread = w * spread + (1 - w) * covariance + w * (1 - w) * np.outer(off, off)
                        own = w * own + (1 - w) * mean
                    mean, covariance = own, spread
                means.append(mean)
                covariances.append(covariance.ravel())
            yield pd.DataFrame({"part": frame[parents[-1]], "mean": means, "covariance": covariances})

    names = [f"e{i}" for i in range(len(parents))]
    return joined.select(parents[-1], *names).mapInPandas(task, "part string, mean array<double>, covariance array<double>")


def own_distances(rows: DataFrame, d: int) -> DataFrame:
    """The rows with ``distance``: the squared Mahalanobis distance by ``covariance`` plus what each row itself varies by."""
    drop = {"mean", "covariance", *[f"{c}{i}" for c in "xv" for i in range(d)]}
    kept = [name for name in rows.columns if name not in drop]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            numbers = lambda c: np.column_stack([batch.column(f"{c}{i}").to_numpy() for i in range(d)]).reshape(n, d)
            off = numbers("x") - batch.column("mean").flatten().to_numpy().reshape(n, d)
            spread = batch.column("covariance").flatten().to_numpy().reshape(n, d, d) + numbers("v")[:, :, None] * np.eye(d)
            distance = np.einsum("ni,ni->n", off, np.linalg.solve(spread, off[:, :, None])[:, :, 0])
            columns = [*[batch.column(name) for name in kept], pa.array(np.maximum(distance, 0.0))]
            yield pa.RecordBatch.from_arrays(columns, [*kept, "distance"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema)
    return rows.mapInArrow(task, f"{schema}, distance double")


def judge_quality(
    docs: DataFrame,
    share: float = 0.75,
    steps: int = 4,
    confidence: float = 1 - 1e-6,
    parent_rows: int = 200,
    least_words: int = 20,
    most_repeated: int = 30,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """One row per document: doc_id, key, ``COUNTS``, base_failed, kept, distance.

    Documents with fewer than ``least_words`` words, or over ``most_repeated`` percent of words in repeated 8-word windows, fail the
    base rules. Of the others, transformed statistics (``features``) are held against robust estimates of their language
    and source. A text varies by those, and by chance the more, the shorter it is: both covariances are added. Where the
    squared Mahalanobis distance by their sum exceeds the chi-square quantile of ``confidence``, the text is rejected. Estimates
    are from all documents that pass the base rules. That of a language and source is mixed with that of the language, which weighs
    as much as ``parent_rows`` documents, and that in turn with the estimate of all; so small groups lean on their surroundings
    and no size changes the rule. Null languages and sources are groups of their own. Null and empty texts have 0 words
    and fail; their ``distance`` is null. Repeated rows each get their row and count as often as they come; an empty
    table gives no rows. Texts with equal statistics, language and source have equal verdicts.
    """
    found = documents(docs, doc_id, text, lang=lang, source=source)
    found = found.withColumns({name: F.col(name).cast("string") for name in ("lang", "source")})
    found = cut(statistics(found))
    found = found.withColumn(
        "base_failed", (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    )
    columns = features()
    d = len(columns)
    named = lambda *names: F.to_json(F.struct(*[F.col(n) for n in names]))
    levels = {"all_of_them": F.lit(""), "of_lang": named("lang"), "of_pair": named("lang", "source")}
    rows = cut(found.where(~F.col("base_failed")).select(
        "doc_id", "key", *COUNTS, "base_failed", *[part.alias(name) for name, part in levels.items()],
        *[x.alias(f"x{i}") for i, (x, _) in enumerate(columns)], *[v.alias(f"v{i}") for i, (_, v) in enumerate(columns)],
    ))
    numbers = [f"{c}{i}" for c in "xv" for i in range(d)]
    estimates = robust_estimates(rows.select(F.explode(F.array(*levels)).alias("part"), *numbers), None, share, steps)
    groups = rows.groupBy(*levels).agg(F.count("*").alias("n"))
    final = written(mixed_estimates(groups, estimates, list(levels), parent_rows))
    # Grouped by a second key too, so that it is dealt out again right below the join and a frequent pair can be split.
    final = final.groupBy("part", F.pmod(F.xxhash64("part"), F.lit(SALTS))).agg(
        F.first("mean").alias("mean"), F.first("covariance").alias("covariance")
    )
    most = chi_square_quantile(confidence, d)
    joined = rows.withColumnRenamed("of_pair", "part").join(final.select("part", "mean", "covariance"), "part")
    judged = own_distances(joined.drop("part", "all_of_them", "of_lang"), d).withColumn("kept", F.col("distance") <= most)
    names = ["doc_id", "key", *COUNTS, "base_failed", "kept", "distance"]
    failed = found.where("base_failed").withColumns({"kept": F.lit(False), "distance": F.lit(None).cast("double")})
    return judged.select(*names).unionByName(failed.select(*names))
