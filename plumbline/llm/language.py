"""Language identification by bit-sliced Bloom filters of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import cut, documents, slices
from plumbline.llm.mixing import scramble

UNKNOWN = "und"
GRAM = 3  # characters, the space before and after a word included
AT_ONCE = 64  # languages whose grams are collected together
MOST_LANGUAGES = 1_000


def grams(text: str) -> np.ndarray:
    """Hashes of the 3-character runs of the lower-cased text, with all that is no letter as one space between words."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4")
    letters = is_letter(points)
    points = np.where(letters, points, np.uint32(32))
    points = points[letters | np.append(True, letters[:-1])].astype(np.uint64)  # one space a gap
    if len(points) < GRAM:
        return np.empty(0, np.uint64)
    return scramble((points[:-2] << np.uint64(42)) | (points[1:-1] << np.uint64(21)) | points[2:])


def _letter_table() -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[[i for i in range(0x110000) if chr(i).isalpha()]] = True
    return table


_letters: list[np.ndarray] = []


def is_letter(points: np.ndarray) -> np.ndarray:
    if not _letters:
        _letters.append(_letter_table())
    return _letters[0][points]


@dataclass(frozen=True)
class LanguageFilters:
    """Bloom filters of all languages, sliced by bit: row p of ``bits`` holds bit p of each, 64 languages a column. What a
    gram's rows have in common is the mask of all languages that contain it."""

    languages: list[str]
    bits: np.ndarray
    false_share: np.ndarray
    prior: int
    hashes: int

    def masks(self, found: np.ndarray) -> np.ndarray:
        common = self.bits[place(found, 0, len(self.bits))]
        for i in range(1, self.hashes):
            common = common & self.bits[place(found, i, len(self.bits))]
        return common

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language whose filter contains most grams of the text, beyond those it would contain by chance, and their
        share. ``und`` and 0 without letters or without any language; the most frequent language and 0 if none has any."""
        found = grams(text) if text else np.empty(0, np.uint64)
        if not len(found) or not self.languages:
            return UNKNOWN, 0.0
        masks = self.masks(found)
        bits = np.unpackbits(masks.view(np.uint8).reshape(len(found), -1), axis=1, bitorder="little")
        hits = bits[:, : len(self.languages)].sum(0, dtype=np.int64)
        true = (hits - len(found) * self.false_share) / (1 - self.false_share)
        best = int(np.argmax(true))
        if true[best] <= 0:
            return self.languages[self.prior], 0.0
        return self.languages[best], float(min(1.0, true[best] / len(found)))


def place(found: np.ndarray, i: int, slots: int) -> np.ndarray:
    return (scramble(found + np.uint64(i)) % np.uint64(slots)).astype(np.int64)


def learn_filters(
    docs: DataFrame,
    learn_from: Column | None = None,
    most_documents: int = 2_000,
    most_grams: int = 20_000,
    share: float = 0.2,
    bits_a_gram: int = 12,
    hashes: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> LanguageFilters:
    """Filters from documents with a language, those that ``learn_from`` accepts.

    About ``most_documents`` of each language are learned from, chosen by a hash of their id (all, if there are no more). A language
    contains a gram if the gram's share among its grams is at least ``share`` of the gram's largest share in any language and it
    is in two of its documents (if more than one is learned from); of more than ``most_grams``, the most frequent. So the size of the model is bounded by the
    number of languages (at most 1,000), and does not grow with the input. Rows with a null text or language teach nothing.
    """
    rows = documents(docs if learn_from is None else docs.where(learn_from), doc_id, text, lang=lang)
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL").withColumn("lang", F.col("lang").cast("string"))
    counts = sorted(tuple(r) for r in rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect())
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    languages = [name for name, _ in counts]
    if not languages:
        return LanguageFilters([], np.zeros((1, 1), np.uint64), np.zeros(0), 0, hashes)
    chance = F.when(F.lit(False), F.lit(0.0))
    for name, n in counts:
        chance = chance.when(F.col("lang") == name, min(1.0, most_documents / n))
    draw = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.where(draw < chance).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                names = np.array(part.column("lang").to_pylist(), object)
                texts = part.column("text").to_pylist()
                for name in set(names):
                    each = [grams(t) for t, own in zip(texts, names, strict=True) if own == name]
                    found, n = np.unique(np.concatenate(each), return_counts=True)
                    held, in_docs = np.unique(np.concatenate([np.unique(g) for g in each]), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(n), pa.array(in_docs)],
                        ["lang", "gram", "n", "docs"],
                    )

    by_gram = cut(
        chosen.mapInArrow(count, "lang string, gram long, n long, docs long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .where((F.col("docs") > 1) | F.col("lang").isin([name for name, n in counts if n == 1]))
    )
    totals = {r["lang"]: r["n"] for r in by_gram.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    rate = F.lit(None).cast("double")
    for name, n in totals.items():
        rate = F.when(F.col("lang") == name, F.col("n") / n).otherwise(rate)
    rated = by_gram.withColumn("rate", rate)
    largest = rated.groupBy("gram").agg(F.collect_list(F.struct("lang", "rate")).alias("of"), F.max("rate").alias("top"))
    own = largest.select("gram", "top", F.explode("of").alias("x")).where(F.col("x.rate") >= share * F.col("top"))
    rank = F.row_number().over(Window.partitionBy("x.lang").orderBy(F.desc("x.rate"), "gram"))
    ranked = cut(own.select(F.col("x.lang").alias("lang"), "gram", rank.alias("rank")).where(F.col("rank") <= most_grams))
    # A gram has a row a language at most; what is collected at once is bounded by most_grams for each of a few languages.
    bits = np.zeros((max(64, bits_a_gram * most_grams), -(-len(languages) // 64)), np.uint64)
    for start in range(0, len(languages), AT_ONCE):
        some = languages[start : start + AT_ONCE]
        taken = ranked.where(F.col("lang").isin(some)).select("lang", "gram").toArrow()
        names, found = taken.column("lang").to_numpy(), taken.column("gram").to_numpy().view(np.uint64)
        for i, name in enumerate(some, start):
            for k in range(hashes):
                bits[place(found[names == name], k, len(bits)), i // 64] |= np.uint64(1) << np.uint64(i % 64)
    spread = np.unpackbits(bits.view(np.uint8), axis=1, bitorder="little")[:, : len(languages)]
    false_share = np.minimum(spread.mean(0) ** hashes, 0.99)
    return LanguageFilters(languages, bits, false_share, int(np.argmax([n for _, n in counts])), hashes)


def predict_language(docs: DataFrame, filters: LanguageFilters, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score.

    The whole text is read, and nothing else of the document. Null, empty and letterless texts are ``und`` with score 0.
    Repeated rows each get their row; ties go to the first language in order."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found = [filters.predict(t) for t in part.column("text").to_pylist()]
                names, scores = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

    return documents(docs, doc_id, text).mapInArrow(task, "doc_id long, lang_pred string, score double")
