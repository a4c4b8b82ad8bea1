"""Decontamination: canonical words, slots, spans, and a plain search as the reference."""

import re

import numpy as np
import pytest

from roster.llm.decontamination import NAME, NUMBER, RUN, UNIT, WINDOW, WORD, Index, drop_leaks, find_leaks, templates
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.001"
ITEM = "Tom had 12 apples and gave Mary 5 of them before Tom walked 3 km to the market with Mary"


def words(text):
    raw = text.encode()
    found = templates(np.frombuffer(raw, np.uint8), np.array([0, len(raw)], np.int64))
    return [(raw[a:b].decode(), int(k)) for a, b, k in zip(found.starts, found.ends, found.kind)]


def matches(doc, item=ITEM):
    raw = doc.encode()
    return [hit[2:] for hit in Index([(1, item)]).found(templates(np.frombuffer(raw, np.uint8), np.array([0, len(raw)], np.int64)))]


def test_kinds_of_words():
    assert words("He met Ann in 1,200.5 m. Then twelve km, Élan! USA a-b École it's 3kg m") == [
        ("He", WORD), ("met", WORD), ("Ann", NAME), ("in", WORD), ("1,200.5", NUMBER), ("m", UNIT), ("Then", WORD),
        ("twelve", NUMBER), ("km", UNIT), ("Élan", NAME), ("USA", WORD), ("a", WORD), ("b", WORD), ("École", NAME),
        ("it", WORD), ("s", WORD), ("3", NUMBER), ("kg", UNIT), ("m", WORD),
    ]
    assert words("") == [] and words("... !") == []


def test_capitals_fold_to_one_word():
    a, b = (templates(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])) for t in ("éa ÀB ×", "ÉA àb ×"))
    assert (a.value == b.value).all()


def test_other_values_are_the_same_question():
    assert matches("Yesterday: " + ITEM + "!") == [(1, 20, True)]
    assert matches("So Bob had 30 apples and gave Alice 7 of them before Bob walked 9 miles to the market with Alice") == [(2, 19, False)]
    assert matches(ITEM.upper()) == []


@pytest.mark.parametrize(
    "doc",
    [
        # Tom would be two people, two people would be one, and 12 words are too few.
        "So Bob had 30 apples and gave Alice 7 of them before Carl had a walk",
        "So Bob had 30 apples and gave Bob 7 of them before Bob had a walk",
        "So Bob had 30 apples and gave Alice 7 of them before Bob",
        "nothing of that kind",
    ],
)
def test_what_does_not_correspond_is_no_match(doc):
    assert matches(doc) == []


def test_a_number_stands_for_one_number():
    item = "add 5 to the sum and then take 5 from the result of it and stop"
    assert matches("add 7 to the sum and then take 7 from the result of it and stop", item) == [(0, 16, False)]
    # The match begins behind the first number, where nothing contradicts any more.
    assert matches("add 7 to the sum and then take 8 from the result of it and stop", item) == [(2, 14, False)]


def plain_search(docs, items):
    """Pairs where RUN words of an item, or all of a shorter one, stand in a document word for word."""

    def plain(text):
        return [w for w in re.findall(r"[a-zß-öø-ÿ]+|[0-9]+", (text or "").lower())]

    found = set()
    for i, text in docs:
        line = " " + " ".join(plain(text)) + " "
        for j, item in items:
            own = plain(item)
            n = min(RUN, len(own) - 1)
            if len(own) >= WINDOW and any(" " + " ".join(own[a : a + n]) + " " in line for a in range(len(own) - n + 1)):
                found.add((i, j))
    return found


def test_whole_table(spark, documents):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    hits = find_leaks(documents, benchmark).collect()
    texts = {r.doc_id: (r.text or "") for r in documents.collect()}
    want = plain_search(texts.items(), [(r.item_id, r.text) for r in benchmark.collect()])
    assert {(h.doc_id, h.item_id) for h in hits} == want and want
    for h in hits:
        assert h.exact and h.n_words >= RUN and 0 <= h.start < h.end <= len(texts[h.doc_id].encode())
    kept = drop_leaks(documents, benchmark)
    assert {r.doc_id for r in kept.collect()} == set(texts) - {i for i, _ in want}


def test_blocks_of_the_benchmark_give_the_same(spark, documents):
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole, parts = (sorted(map(tuple, find_leaks(documents, benchmark, size).collect())) for size in (1 << 20, 2000))
    assert whole == parts
    assert drop_leaks(documents, benchmark, 2000).count() == drop_leaks(documents, benchmark).count()


def test_odd_rows(spark, odd, none):
    items = [(1, None), (2, ""), (3, "too short"), (4, "1 2 3 4 5 6 7 8 9 10 11 12 13 14"), (7, ITEM), (6, ITEM), (None, "a b c d e f g h i j")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    assert find_leaks(odd, benchmark).collect() == [] and drop_leaks(odd, benchmark).count() == len(ODD)
    planted = odd.selectExpr("* except (text)", f"if(doc_id = 4, '{ITEM} and more', text) AS text").select(*odd.columns)
    hits = find_leaks(planted, benchmark).collect()
    assert [(h.doc_id, h.item_id, h.start, h.end) for h in hits] == [(4, 6, 0, len(ITEM))] * 3
    kept = drop_leaks(planted, benchmark)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 3
    assert find_leaks(none, benchmark).collect() == [] and drop_leaks(none, benchmark).collect() == []
    assert find_leaks(odd, benchmark.limit(0)).collect() == [] and drop_leaks(odd, benchmark.limit(0)).count() == len(ODD)


def leaks(doc, item=ITEM):
    raw = doc.encode()
    return [hit[2:] for hit in Index([(1, item)]).leaks(templates(np.frombuffer(raw, np.uint8), np.array([0, len(raw)], np.int64)))]


TOLD = "Tom had 12 apples in a bag. Mary took 5 of them home. Then Tom sold 3 of the others to Mary for 2 dollars"


@pytest.mark.parametrize("item", [ITEM, TOLD])
def test_copies_in_other_cases_and_without_stops(item):
    n = len(words(item))
    for copy in (item.lower(), item.upper(), item.title(), item.replace(".", ","), item.replace(".", "")):
        assert leaks(copy, item) == [(0, n, True)]


def test_names_that_begin_sentences_may_be_others():
    renamed = TOLD.replace("Tom", "Bob").replace("Mary", "Ann")
    assert leaks(renamed, TOLD) == [(0, 25, False)]
    assert leaks(renamed.replace(".", " ").replace("5", "7"), TOLD) == [(0, 25, False)]
    # One name for two people, and too few words on either side of it.
    assert leaks("Bob had 9 apples in a bag. Bob took 5 of them home", TOLD) == []


def test_a_copy_without_its_stops():
    item = "She had six. He ate two. They met Ann. It was late. You saw Bob. We ran home. All was well"
    assert leaks(item.replace(".", ""), item) == [(0, 21, True)]
    assert leaks("So " + item.replace(".", "").replace("Ann", "Eve").replace("six", "ten"), item) == [(1, 21, False)]


def test_leaks_in_a_table(spark, docs):
    benchmark = spark.createDataFrame([(1, ITEM), (2, TOLD)], "item_id long, text string")
    rows = docs((1, ITEM.lower()), (2, "x " + ITEM.upper()), (3, TOLD.replace("Tom", "Bob").replace("Mary", "Ann")), (4, "clean"))
    assert sorted((h.doc_id, h.item_id, h.exact) for h in find_leaks(rows, benchmark).collect()) == [(1, 1, True), (2, 1, True), (3, 2, False)]
    assert [r.doc_id for r in drop_leaks(rows, benchmark).collect()] == [4]


DENSE = "12 + 7 = 19, 30 - 4 = 26, 8 * 9 = 72, 5 kg 6 m, Ann Bob Carl"


def test_items_of_few_plain_words_are_found_by_their_exact_words():
    n = len(words(DENSE))
    assert leaks("see " + DENSE.lower() + " there", DENSE) == [(1, n, True)]
    assert leaks(DENSE.replace("19", "20").replace("26", "25").replace("72", "71"), DENSE) == []
    assert leaks(" ".join(str(i) for i in range(3, 40)), " ".join(str(i) for i in range(10, 30))) == [(7, 20, True)]


def test_items_shorter_than_a_window_are_found_whole():
    assert leaks("so what is 2 plus TWO then", "What is 2 plus two?") == [(1, 5, True)]
    assert leaks("what is 3 plus two", "What is 2 plus two?") == [] and leaks("what is 2 plus", "What is 2 plus two?") == []
    assert leaks("one", "?!") == [] == leaks("", "One")
    assert leaks("one", "One") == [(0, 1, True)]


def test_short_items_do_not_cross_texts(spark, docs):
    benchmark = spark.createDataFrame([(1, "big red ball"), (2, "1 2 3 4 5 6 7 8 9")], "item_id long, text string")
    rows = docs((1, "a big"), (2, "red ball"), (3, "a Big, red ball"), (4, "0 1 2 3 4 5 6 7 8 9"), (5, "0 1 2 3 4 5 6 8 8 9"))
    assert sorted((h.doc_id, h.item_id) for h in find_leaks(rows, benchmark).collect()) == [(3, 1), (4, 2)]
