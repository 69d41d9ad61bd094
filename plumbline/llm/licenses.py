"""License notices in texts: word grams vote for diagonals of templates, and neighbouring diagonals make a span."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import column, documents
from plumbline.llm.url_filters import ascii_lower

#: Words of texts in any case: digits, ASCII letters and everything beyond ASCII.
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Template positions are broadcast up to this many characters in all; beyond it the join shuffles them.
BROADCAST_CHARACTERS = 4_000_000
#: Of this many words of a template, one may be missing or inserted without ending a span.
WORDS_PER_SHIFT = 10
DOCUMENT = ["doc_id", "digest", "n_words"]


def gram_hash(words: list[Column]) -> Column:
    """Hash of a gram in any case. ``lower`` changes more than A-Z, so that it is only good for finding candidates."""
    return F.xxhash64(F.lit(len(words)), *[F.lower(word) for word in words])


def template_grams(templates: DataFrame, gram: int) -> DataFrame:
    """One row per template and place: template (its digest), label, exact, length in words, width, at, hash, gram. ``width`` is
    the number of words of the gram: ``gram``, or all words of a shorter template. Templates without a word or label are left out."""
    words = F.regexp_extract_all(ascii_lower(column(templates, "phrase")), F.lit(ANY_CASE_WORD), F.lit(0))
    parsed = templates.select(
        column(templates, "label").alias("label"), F.coalesce(column(templates, "exact"), F.lit(False)).alias("exact"),
        words.alias("words"),
    ).where("size(words) > 0 AND label IS NOT NULL").distinct()
    width = F.least(F.size("words"), F.lit(gram))
    placed = parsed.select(
        F.md5(F.concat_ws(" ", "label", F.col("exact").cast("string"), F.array_join("words", " "))).alias("template"),
        "label", "exact", F.size("words").alias("length"), width.alias("width"), "words",
        F.explode(F.sequence(F.lit(0), F.size("words") - width)).alias("at"),
    )
    hashes = F.coalesce(*[
        F.when(F.col("width") == k, gram_hash([F.get("words", F.col("at") + i) for i in range(k)])) for k in range(1, gram + 1)
    ])
    text = F.array_join(F.slice("words", F.col("at") + 1, F.col("width")), " ")
    return placed.select("template", "label", "exact", "length", "width", "at", hashes.alias("hash"), text.alias("gram"))


def find_notices(docs: DataFrame, templates: DataFrame, gram: int = 3, share: float = 0.8) -> DataFrame:
    """Spans of texts that agree with a template, and one row without a template per document, all with doc_id, digest (MD5 of
    the text), n_words, copies (the number of rows with that doc_id and text), template, label, exact, length (words of the
    template), covered (words of it that the span has), first_word, end_word, found.

    ``templates`` has columns label, phrase and exact. Every run of ``gram`` words of a text (of fewer, where a template is
    shorter) meets the templates' grams by hash and is confirmed word by word. What agrees is a vote for the diagonal, the
    difference of the places in text and template. Diagonals no further apart than a tenth of the template's words are one
    span, so that missing and inserted words do no harm; those of exact templates are never merged. ``found`` says that the
    span is verified: it covers ``share`` of the template's words (an exact template: all of them) in a stretch of text that
    is longer than the template by no more than those words allow.

    A null text is an empty one. Repeated rows are counted once, as copies; ties can't occur. An empty table gives an empty
    result; without templates, documents have only their row without one. No other column of the input is used, whatever its name.

    Templates are broadcast while they have up to ``BROADCAST_CHARACTERS``. Texts are never shuffled: only votes are, and one
    row per document, both counted per task before they move. A notice that a third of all documents hold is so many
    votes of different documents, hence of different keys.
    """
    grams = template_grams(templates, gram)
    # The widths are at most `gram` numbers.
    widths, characters = grams.agg(F.sort_array(F.collect_set("width")), F.sum(F.length("gram") + 96)).first()
    grams = F.broadcast(grams) if (characters or 0) <= BROADCAST_CHARACTERS else grams

    texts = documents(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    words = texts.select(
        "doc_id", F.md5("text").alias("digest"),
        F.regexp_extract_all("text", F.lit(ANY_CASE_WORD), F.lit(0)).alias("words"),
    ).select("*", F.size("words").cast("long").alias("n_words"))
    names = [f"w{i}" for i in range(max(widths, default=1))]
    shifted = F.arrays_zip(*[F.slice("words", i + 1, F.greatest(F.size("words"), F.lit(1))).alias(n) for i, n in enumerate(names)])
    placed = words.select(
        *DOCUMENT, F.posexplode_outer(shifted).alias("place", "word")
    ).select(*DOCUMENT, F.coalesce("place", F.lit(0)).alias("place"), *[F.col(f"word.{n}").alias(n) for n in names])
    # Width 0 is the document's own row, which no gram meets.
    entries = F.array(
        F.struct(F.lit(0).alias("k"), F.lit(None).cast("long").alias("hash")),
        *[
            F.struct(F.lit(k).alias("k"), F.when(F.col(names[k - 1]).isNotNull(), gram_hash([F.col(n) for n in names[:k]])).alias("hash"))
            for k in widths
        ],
    )
    votes = placed.select("*", F.inline(entries)).where("hash IS NOT NULL OR k = 0 AND place = 0").join(grams, "hash", "left")
    own = F.coalesce(*[F.when(F.col("k") == k, ascii_lower(F.concat_ws(" ", *names[:k]))) for k in widths], F.lit(""))
    votes = votes.where((F.col("k") == 0) | (F.col("gram") == own))
    kinds = ["template", "label", "exact", "length", "width"]
    diagonal = (F.col("place") - F.col("at")).alias("diagonal")
    votes = votes.groupBy(*DOCUMENT, *kinds, diagonal, "at").agg(F.count("*").alias("copies"))

    # From here on all is grouped by document, and so shuffled once more at most.
    by_document = Window.partitionBy(*DOCUMENT)
    in_order = by_document.orderBy("template", "diagonal", "at")
    shift = F.when(F.col("exact"), 0).otherwise(F.floor(F.col("length") / WORDS_PER_SHIFT))
    starts = F.when(
        F.lag("template").over(in_order).eqNullSafe(F.col("template")) & (F.col("diagonal") - F.lag("diagonal").over(in_order) <= shift), 0
    ).otherwise(1)
    spans = votes.withColumn("starts", starts).withColumn("span", F.sum("starts").over(in_order))
    in_span = Window.partitionBy(*DOCUMENT, "span").orderBy("at", "diagonal")
    # A word of the template counts once, also where grams overlap or diagonals share it.
    covers = F.least("width", F.coalesce(F.lead("at").over(in_span) - F.col("at"), F.col("width")))
    spans = (
        spans.withColumn("covers", covers)
        .groupBy(*DOCUMENT, "span", *kinds)
        .agg(
            F.max("copies").alias("copies"),
            F.sum("covers").alias("covered"),
            F.min(F.col("diagonal") + F.col("at")).cast("long").alias("first_word"),
            F.max(F.col("diagonal") + F.col("at") + F.col("width")).cast("long").alias("end_word"),
        )
    )
    least = F.when(F.col("exact"), F.col("length")).otherwise(F.ceil(F.col("length") * share))
    longest = F.col("length") + shift * F.lit(2)
    fits = (F.col("covered") >= least) & (F.col("end_word") - F.col("first_word") <= longest)
    return spans.drop("span", "width").withColumn("found", fits)


def label_documents(docs: DataFrame, templates: DataFrame, gram: int = 3, share: float = 0.8) -> DataFrame:
    """One row per document: doc_id, n_words, n_base (places of exact templates), first_word, last_word (least and greatest start
    of them), base_labels (of exact templates), labels (of all verified spans; both sorted and joined by commas), score (the
    greatest share of a template's words in one of the spans, 0 without any).

    See ``find_notices`` for nulls, empty and long texts, repeated rows, empty tables and names of columns; a repeated row comes
    back as often as it is there. Places that overlap are all counted; places of two labels with one start are two.
    """
    spans = find_notices(docs, templates, gram, share)
    base = F.col("found") & F.col("exact")
    joined = lambda which: F.array_join(F.sort_array(F.collect_set(F.when(which, F.col("label")))), ",")
    found = spans.groupBy(*DOCUMENT).agg(
        F.max(F.when(F.col("template").isNull(), F.col("copies"))).alias("copies"),
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("first_word"))).alias("first_word"),
        F.max(F.when(base, F.col("first_word"))).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("found")).alias("labels"),
        F.least(F.lit(1.0), F.coalesce(F.max(F.col("covered") / F.col("length")), F.lit(0.0))).alias("score"),
    )
    return found.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"),
    ).drop("copy")
