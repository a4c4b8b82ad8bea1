"""Language identification: codes, decoding, held-out accuracy, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roster.llm.language_id import LanguageModel, codewords, fit_languages, identify, only_letters, text_features
from tests.llm.conftest import ODD


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(corpus):
    return fit_languages(corpus, F.crc32(F.col("doc_id").cast("string")) % 4 != 2)


def test_held_out_accuracy(corpus, model):
    rows = identify(corpus, model).join(corpus.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 100 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_and_ids_are_no_input(corpus, model):
    other = corpus.select((F.col("doc_id") + 5).alias("doc_id"), "text", F.lit("xx").alias("lang"))
    a, b = identify(corpus, model).collect(), identify(other, model).collect()
    assert [(r.lang_pred, r.score) for r in a] == [(r.lang_pred, r.score) for r in b]


@pytest.mark.parametrize("languages", [2, 3, 4, 6, 7, 30])
def test_codewords_are_far_apart_and_every_bit_splits(languages):
    code = codewords(languages).astype(int)
    distances = (code[:, None, :] != code[None, :, :]).sum(axis=2)[~np.eye(languages, dtype=bool)]
    assert (np.abs(code.sum(axis=0)) < languages).all()
    if languages <= 6:
        assert code.shape[1] == 2 ** (languages - 1) - 1 and distances.min() == distances.max() == 2 ** (languages - 2)
    else:
        assert distances.min() >= code.shape[1] // 5


def test_decoding_by_brute_force():
    """The loss of every codeword, bit by bit; one wrong bit of a code is outvoted."""
    pick, languages = np.random.default_rng(1), ["a", "b", "c", "d"]
    code = codewords(4)
    trust = pick.uniform(0.5, 2, code.shape[1])
    weights = pick.normal(size=(1 << 16, code.shape[1])).astype(np.float32)
    model = LanguageModel(languages, code, weights, pick.normal(size=code.shape[1]), trust)
    for text in ("some words", "x", "ganz andere Wörter", "ñandú " * 50):
        f = text_features(only_letters(text))
        outputs = [sum(float(weights[i, b]) for i in f) / len(f) ** 0.5 + model.intercepts[b] for b in range(code.shape[1])]
        losses = [sum(t * max(0, 1 - c * o) for t, c, o in zip(trust, row, outputs)) / trust.sum() for row in code]
        order = np.argsort(losses)
        found = model.predict(text, 0.1)
        assert found[0] == languages[order[0]]
        assert found[2] == (losses[order[1]] - losses[order[0]] < 0.1)
    flat = LanguageModel(languages, code, np.zeros_like(weights), 2.0 * code[2] * np.where(np.arange(7) == 3, -1, 1), np.ones(7))
    assert flat.predict("any", 0.1)[0] == "c"


def test_letters():
    assert only_letters("A1b_c  Ü") == " a b c ü " and only_letters("漢字!") == " 漢字 "
    assert only_letters("12 ²½ _!") == only_letters(None) == only_letters("") == ""


def test_odd_rows(odd, none, model):
    rows = identify(odd, model).collect()
    found = {str(r.doc_id): r for r in rows}
    assert len(rows) == len(ODD)
    for i in ("1", "2", "3", "7", "9"):
        assert (found[i].lang_pred, found[i].score, found[i].ambiguous) == ("und", 0.0, True)
    assert found["5"].lang_pred in model.languages and found["None"].lang_pred in model.languages
    assert identify(none, model).collect() == []


def test_few_languages(spark, odd):
    nothing = fit_languages(odd, F.lit(False))
    assert {r.lang_pred for r in identify(odd, nothing).collect()} == {"und"}
    one = fit_languages(odd.withColumn("lang", F.when(F.col("doc_id") > 4, "xx")), F.lit(True))
    assert {r.lang_pred for r in identify(odd, one).collect()} == {"und", "xx"}
    # A language of which no learned text has a letter is known, but is never taken before the others.
    rows = [(1, "abc abc", "p"), (2, "xyz xyz", "q"), (3, "123", "r"), (4, None, "s"), (5, "abc", None)]
    three = fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True))
    assert three.languages == ["p", "q", "r"] and three.predict("abcabc", 0.1)[0] == "p"


def test_a_thousand_languages(spark):
    """More languages mean fewer texts of each, and no error; each has words of its own."""
    rows = [(k * 3 + i, f"{w} {w}" * 3, f"l{k:04d}") for k in range(1000) for i, w in enumerate([f"{chr(0x4E00 + k)}{chr(0x5E00 + k)}"] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_languages(docs, F.lit(True), total=1000)
    assert len(model.languages) == 1000 and model.code.shape == (1000, 150)
    found = [model.predict(text, 0.1)[0] == lang for _, text, lang in rows[::31]]
    assert np.mean(found) > 0.9


def test_a_third_of_all_rows_with_one_id(spark, corpus):
    """Repeated rows are learned from once, and one of each reaches the driver."""
    from roster.llm import language_id

    hot = corpus.where("doc_id = 1").select("doc_id", "text", "lang")
    copies = hot.crossJoin(spark.range(500)).drop("id")
    docs = corpus.select("doc_id", "text", "lang").unionByName(copies)
    seen, real = [], language_id.fit
    language_id.fit = lambda languages, features, classes: seen.append((languages, features, classes)) or real(languages, features, classes)
    try:
        fit_languages(docs, F.lit(True), sample=20), fit_languages(corpus, F.lit(True), sample=20)
    finally:
        language_id.fit = real
    assert [len(s[1]) for s in seen] == [80, 80]
    assert all((a == b).all() for a, b in zip(seen[0][1], seen[1][1])) and (seen[0][2] == seen[1][2]).all()
