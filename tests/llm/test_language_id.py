import random

import numpy as np

from noticeloom.llm import language_id as L

from .samples import documents, prose, rows


def test_held_out_texts_are_told_apart(spark):
    rng = random.Random(5)
    data = [(i, prose(rng, lang, rng.randint(8, 60)), lang, "a") for i, lang in enumerate(["en", "de"] * 60)]
    docs = documents(spark, data)
    model = L.train(docs.filter("doc_id < 80"))
    found = L.identify(docs.filter("doc_id >= 80").select("doc_id", "text", "lang"), model).collect()
    assert len(found) == 40
    assert all(r["lang_pred"] == r["lang"] and 0.5 < r["score"] <= 1 for r in found)


def test_texts_without_letters_and_null(spark):
    docs = documents(spark)
    model = L.train(docs)
    found = {r["doc_id"]: r for r in L.identify(docs.drop("score"), model).filter("doc_id is not null").collect()}
    for i in (120, 121, 122, 123):
        assert (found[i]["lang_pred"], found[i]["score"]) == ("und", 0.0)
    assert found[124]["lang_pred"] == "de"
    kept = L.keep_known(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == len(rows()) - 4


def test_no_training_rows(spark):
    docs = documents(spark)
    nothing = L.train(documents(spark, []))
    assert {r["lang_pred"] for r in L.identify(docs, nothing).collect()} == {"und"}
    assert L.identify(documents(spark, []), L.train(docs)).count() == 0


def brute_scores(text, languages, matrix):
    """The same sums one n-gram at a time."""
    sums = matrix[-1].copy()
    for n in L.ORDERS:
        for at in range(len(text) - n + 1):
            (_, found), = [x for x in L._buckets(L._codes(text[at : at + n])) if x[0] == n]
            sums += matrix[found[0]]
    odds = np.exp(sums - sums.max())
    return languages[int(sums.argmax())], odds.max() / odds.sum()


def test_batches_and_slices_add_up(monkeypatch):
    rng = random.Random(2)
    matrix = np.log(np.random.default_rng(1).random(((1 << L.BUCKET_BITS) + 1, 3)))
    texts = ["a", "ab", None, "", "Straße ß", "x" * 50, "".join(rng.choice("abcdé ") for _ in range(300))]
    monkeypatch.setattr(L, "SLICE", 20)
    monkeypatch.setattr(L, "BATCH_CHARS", 30)
    names, scores = L.score_batch(texts, ["p", "q", "r"], matrix)
    for text, name, score in zip(texts, names, scores):
        if text:
            want = brute_scores(text.lower(), ["p", "q", "r"], matrix)
            assert name == want[0] and abs(score - want[1]) < 1e-9
        else:
            assert (name, score) == ("und", 0.0)
