"""Word models against counting and smoothing by hand."""

import re
from collections import Counter, defaultdict
from math import log2

import pyarrow as pa
import pytest

from roster.llm.queries import op10_lm_scoring
from roster.llm.word_scoring import asked_grams, count_words, dealing, marked_blocks, score_by_words, words
from tests.llm.conftest import ODD, SF


def tokens(text):
    return re.findall(r"[a-z0-9\u0080-߿]+|[ࠀ-\U0010ffff]|[!-/:-@\[-`{-~]", (text or "").lower())


def model(texts, vocabulary):
    pairs = Counter(p for t in texts for p in zip([None, *tokens(t)], tokens(t)))
    single, after = Counter(), defaultdict(Counter)
    for (a, b), n in pairs.items():
        single[b] += n
        after[a][b] += n
    size, kinds = sum(single.values()), len(single)

    def loss(a, b):
        chance = (single[b] + (kinds + 1) / (vocabulary + 1)) / (size + kinds + 1)
        seen = sum(after[a].values())
        return -log2((after[a][b] + len(after[a]) * chance) / (seen + len(after[a])) if seen else chance)

    return loss


def expected(rows, chosen):
    vocabulary = len({w for _, t in rows for w in tokens(t)})
    target, background = model([t for i, t in rows if i in chosen], vocabulary), model([t for _, t in rows], vocabulary)
    out = []
    for i, t in rows:
        own = list(zip([None, *tokens(t)], tokens(t)))
        means = [sum(m(*p) for p in own) / len(own) if own else None for m in (target, background)]
        out.append((str(i), len(own), *means))
    return sorted(out, key=str)


def same(found, want):
    found = sorted([(str(r.doc_id), r.n_tokens, r.loss_target, r.loss_background) for r in found], key=str)
    assert [f[:2] for f in found] == [w[:2] for w in want]
    for f, w in zip(found, want):
        assert f[2:] == (None, None) if w[1] == 0 else f[2:] == pytest.approx(w[2:])


def test_words():
    texts = ["Ab ab, AB", None, "ÉTÉ été Привет привет", "日本 日a 😀😀", " \n"]
    found, before, places = words(pa.array(texts, pa.string()))
    assert (places[1:] - places[:-1]).tolist() == [4, 0, 4, 6, 0] == [len(tokens(t)) for t in texts]
    assert found[0] == found[1] == found[3] != found[2] and found[4] == found[5] and found[6] == found[7] != found[4]
    assert found[8] == found[10] and found[12] == found[13] and before[places[2]] == before[0] == 1


@pytest.mark.parametrize("block_bytes", [1, 300, 1 << 23])
def test_scores(spark, docs, block_bytes):
    rows = [(i, f"the cat {i % 3} sat. On the mat {i}, été 日本") for i in range(12)] + [(None, "the cat"), (3, "the dog"), (40, ""), (41, None)]
    targets = spark.createDataFrame([(i,) for i in (0, 3, 3, 6, None, 99)], "doc_id long")
    same(score_by_words(docs(*rows), targets, block_bytes).collect(), expected(rows, {0, 3, 6}))


def test_other_scripts_are_told_apart(spark, docs):
    rows = docs(*[(i, "кошка сидит дома " * 5) for i in range(5)], *[(10 + i, "собака лежит тихо " * 5) for i in range(5)])
    targets = spark.createDataFrame([(i,) for i in range(4)], "doc_id long")
    scores = {r.doc_id: r.score for r in score_by_words(rows, targets).collect()}
    assert scores[4] < 0 < scores[10]


def test_counts_grow_with_the_corpus(spark, docs):
    targets = spark.createDataFrame([], "doc_id long")
    sizes = [count_words(asked_grams(marked_blocks(docs(*[(i, f"word{i} next{i}") for i in range(n)]), targets))).count() for n in (10, 50)]
    assert sizes == [41, 201]


def test_odd_rows(spark, odd, none):
    nobody = spark.createDataFrame([], "doc_id long")
    same(score_by_words(odd, nobody).collect(), expected(ODD, set()))
    assert score_by_words(none, nobody).collect() == []


def test_the_query(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    same(op10_lm_scoring(spark, SF).collect(), expected(rows, {r.doc_id for r in labels if r.quality == 1 and r.toxic == 0}))


@pytest.mark.parametrize("piece", [1, 3])
def test_frequent_words_are_dealt_to_several_buckets(spark, docs, piece):
    rows = [(i, f"the a{i} the b{i % 7} of the a{i % 5}, the the") for i in range(40)]
    targets = spark.createDataFrame([(i,) for i in range(0, 40, 3)], "doc_id long")
    blocks = marked_blocks(docs(*rows), targets, 200)
    assert max(dealing(blocks, piece).pieces) > 40 // piece
    same(score_by_words(docs(*rows), targets, 200, piece).collect(), expected(rows, set(range(0, 40, 3))))
