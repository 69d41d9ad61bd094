import numpy as np
from plumbline.llm import language
from pyspark.sql import functions as F


def test_grams_of_short_texts():
    assert len(language.grams("a")) == 1 and len(language.grams("a, b!")) == 3
    assert language.grams("Ab").tolist() == language.grams("..aB\n").tolist()
    assert len(language.grams("")) == len(language.grams("12 34")) == 0


def test_masks_hold_every_language_of_a_gram():
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 1 << 62, 300).astype(np.uint64) for _ in range(70)]  # more languages than bits in a number
    bits = np.zeros((4_096, 2), np.uint64)
    for i, some in enumerate(sets):
        for k in range(2):
            bits[language.place(some, k, len(bits)), i // 64] |= np.uint64(1) << np.uint64(i % 64)
    filters = language.LanguageFilters([str(i) for i in range(70)], bits, np.zeros(70), 0, 2)
    for i, some in enumerate(sets):
        assert (filters.masks(some)[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).all()


def test_edge_texts_and_many_languages(documents):
    rows = []
    for i in range(70):
        letters = [chr(0x4E00 + 50 * i + k) for k in range(50)]
        rows += [(i * 10 + k, "".join(letters), f"l{i:02}", "s") for k in range(3)]
    filters = language.learn_filters(documents(rows))
    assert len(filters.languages) == 70
    asked = [(i, "".join(chr(0x4E00 + 50 * i + k) for k in range(5, 30)), None, None) for i in range(70)]
    edges = [(900, None), (901, ""), (902, " 12 ?!\n"), (903, "x"), (904, "y" * 100_000), (None, "abc")]
    found = {r.doc_id: r for r in language.predict_language(documents(asked + edges), filters).collect()}
    assert [found[i].lang_pred for i in range(70)] == [f"l{i:02}" for i in range(70)]
    assert {(found[i].lang_pred, found[i].score) for i in (900, 901, 902)} == {("und", 0.0)}
    assert found[903].lang_pred == found[904].lang_pred == "l00" and found[None].score == 0
    assert all(0 <= r.score <= 1 for r in found.values())


def brute_predictions(learned, texts, share=0.2):
    """Predictions from exact sets of grams instead of filters: the language that has most of a text's grams."""
    counts = {}
    for name in sorted({lang for _, lang in learned}):
        own = [language.grams(t).tolist() for t, lang in learned if lang == name]
        held = {g: sum(g in some for some in map(set, own)) for g in {g for some in own for g in some}}
        n = {g: sum(some.count(g) for some in own) for g in held if held[g] > 1 or len(own) == 1}
        counts[name] = {g: x / sum(n.values()) for g, x in n.items()}
    top = {}
    for rates in counts.values():
        for g, rate in rates.items():
            top[g] = max(top.get(g, 0), rate)
    sets = {name: {g for g, rate in rates.items() if rate >= share * top[g]} for name, rates in counts.items()}
    return [[sum(g in some for g in language.grams(t).tolist()) for some in sets.values()] for t in texts], list(sets)


def test_predictions_by_brute_force(documents):
    """Where exact sets of grams clearly prefer a language, the filters do too; one language has a single document."""
    rng = np.random.default_rng(4)
    alphabets = {"a": "abcdefgh", "b": "efghijkl", "c": "ijklmnop", "d": "mnopqrst"}
    text = lambda name, n: " ".join("".join(rng.choice(list(alphabets[name]), 5)) for _ in range(n))
    learned = [(text(name, 60), name) for name in "abc" for _ in range(30)] + [(text("d", 900), "d")]
    asked = [text(name, 40) for name in "abcd" for _ in range(25)]
    filters = language.learn_filters(documents([(i, t, lang, "s") for i, (t, lang) in enumerate(learned)]))
    found = {r.doc_id: r for r in language.predict_language(documents(list(enumerate(asked))), filters).collect()}
    votes, names = brute_predictions(learned, asked)
    clear = 0
    for i, row in enumerate(votes):
        best, second = sorted(row, reverse=True)[:2]
        if best > 1.2 * second:
            clear += 1
            assert found[i].lang_pred == names[row.index(best)]
    assert clear > 80 and {r.lang_pred for r in found.values()} == set("abcd")


def test_nothing_to_learn_from(documents):
    for rows in ([], [(1, None, "en", None), (2, "text", None, None)]):
        filters = language.learn_filters(documents(rows))
        found = language.predict_language(documents([(1, "text"), (1, "text")]), filters).collect()
        assert [(r.lang_pred, r.score) for r in found] == [("und", 0.0)] * 2


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    filters = language.learn_filters(docs, ~held_out)
    found = language.predict_language(docs, filters).join(docs.where(held_out).select("doc_id", "lang"), "doc_id")
    right, n = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right > 0.98
