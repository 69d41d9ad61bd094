import random
import re

from llm.conftest import rows
from plumbline.llm import licenses, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
COLUMNS = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def base(doc_id, text):
    """The base columns, by looking at every place of every phrase."""
    words = WORD.findall(lowered(text))
    found = [
        (place, label)
        for label, phrase, exact in queries.LICENSE_TEMPLATES
        if exact
        for place in range(len(words))
        if words[place : place + len(phrase.split())] == phrase.split()
    ]
    places, labels = [p for p, _ in found], ",".join(sorted({label for _, label in found}))
    return doc_id, len(words), len(found), min(places, default=None), max(places, default=None), labels


def labelled(spark, docs):
    return licenses.label_documents(docs, queries.license_templates(spark))


def test_base_like_brute_force(spark, documents):
    rng = random.Random(7)
    some = ["MIT", "mit", "License", "license", "licence", "Apache", "General", "public", "PUBLIC", "the", "É", "K", "x", "2"]
    gaps = [" ", "-", "\n", ", ", "@", "_", " "]
    texts = [
        "".join(w for _ in range(rng.randrange(40)) for w in (rng.choice(some), rng.choice(gaps))) for _ in range(300)
    ]
    docs = list(enumerate(texts))
    found = labelled(spark, documents(docs))
    assert rows(found, *COLUMNS[:6]) == sorted((base(*d) for d in docs), key=str)


def test_edges(spark, documents):
    """Null and empty texts, repeated rows, a null doc_id, a very long text, and names that clash (from the fixture)."""
    docs = [
        (1, None), (2, ""), (3, "MIT License"), (3, "MIT License"), (None, "the Apache-License!"), (4, "---"),
        (5, "word " * 300_000 + "general public license"), (3, "another text"),
    ]
    found = labelled(spark, documents(docs))
    assert rows(found, *COLUMNS[:6]) == sorted((base(*d) for d in docs), key=str)
    assert labelled(spark, documents([])).count() == 0
    none = licenses.label_documents(documents(docs), queries.license_templates(spark).limit(0))
    assert rows(none, "doc_id", "n_base", "labels", "score") == sorted(((d, 0, "", 0.0) for d, _ in docs), key=str)


def test_notices_with_changed_words(spark, documents):
    phrase = next(p for label, p, exact in queries.LICENSE_TEMPLATES if label == "mit" and not exact).split()
    whole = " ".join(phrase)
    missing = " ".join(phrase[:9] + phrase[10:])
    more = " ".join(phrase[:9] + ["quite"] + phrase[9:])
    half = " ".join(phrase[: len(phrase) // 2])
    # Every gram of the notice, but each in another place.
    scattered = " ... ".join(" ".join(phrase[i : i + 3]) + " and so on" for i in reversed(range(len(phrase) - 2)))
    docs = [(1, "x y " + whole.upper()), (2, missing), (3, more + " z"), (4, half), (5, scattered), (6, "no notice at all")]
    found = {r["doc_id"]: r for r in labelled(spark, documents(docs)).collect()}
    assert [found[i]["labels"] for i in range(1, 7)] == ["mit", "mit", "mit", "", "", ""]
    assert found[1]["score"] == 1.0 and 0.4 < found[4]["score"] < 0.6 and found[6]["score"] == 0.0
    spans = licenses.find_notices(documents(docs), queries.license_templates(spark)).where("found")
    assert rows(spans, "doc_id", "first_word", "end_word") == [
        (1, 2, 2 + len(phrase)), (2, 0, len(phrase) - 1), (3, 0, len(phrase) + 1)
    ]


def test_two_notices_of_a_kind_are_two_spans(spark, documents):
    line = "licensed under cc by-nc 4.0."
    spans = licenses.find_notices(documents([(1, f"{line} {line}")]), queries.license_templates(spark)).where("found")
    assert rows(spans, "label", "first_word") == [("cc-by-nc", 0), ("cc-by-nc", 7)]


def test_templates_beyond_the_broadcast_bound(spark, documents, monkeypatch):
    docs = documents([(i, "Released under the MIT License.") for i in range(50)])
    monkeypatch.setattr(licenses, "BROADCAST_CHARACTERS", 0)
    assert {r[0] for r in labelled(spark, docs).select("labels").collect()} == {"mit"}


def test_no_python_and_no_cross_join(spark, documents):
    plan = labelled(spark, documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
