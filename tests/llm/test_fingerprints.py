"""Fingerprints: the tree by hand, equality, likeness, the next document, and a plan without Python."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from roster.llm.fingerprints import differing_sections, likeness, with_fingerprints, with_next
from roster.llm.queries import op9_fingerprints
from tests.llm.conftest import ODD

SF = "/root/testdata/sf0.001"


def by_hand(text):
    def md5(s):
        return hashlib.md5(s.encode()).hexdigest()

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()

    sections, current = [], []
    for line in text.split("\n"):
        current.append([md5(s) for s in re.split(r"(?<=[.!?])(?=[ \t\n\x0b\f\r])", line)])
        if current[-1][-1][-1] in "01":
            sections.append(current)
            current = []
    if current:
        sections.append(current)
    nodes = [sha("/".join(sha(".".join(paragraph)) for paragraph in section)) for section in sections]
    short = "|".join("/".join(".".join(leaf[:16] for leaf in p) for p in s) for s in sections)
    return sha("|".join(nodes)) + ":" + short


def test_trees_of_a_table(documents):
    for r in with_fingerprints(documents, fingerprint="text").collect():
        assert r.fingerprint == by_hand(r.text)


def printed(docs, *texts):
    rows = with_fingerprints(docs(*enumerate(texts)), fingerprint="text")
    return {r.doc_id: r.fingerprint for r in rows.collect()}


def test_equal_texts_only(docs):
    found = printed(docs, "a. b\nc", "a. b\nc", "a.  b\nc", "a. b\n\nc", "a. b\nc\n", "", None, " ", "a. b\rc", "a.", "a")
    assert found[0] == found[1] and found[5] == found[6]
    assert len(set(found.values())) == 9


def test_likeness_and_the_place_of_an_edit(spark, docs):
    lines = [f"Paragraph {i} says something. And something else {i}." for i in range(60)]
    edited = list(lines)
    edited[20] = "This one is new."
    rows = with_fingerprints(docs((0, "\n".join(lines))).withColumn("other", F.lit("\n".join(edited))), a="text", b="other")
    r = rows.select(
        likeness(F.col("a"), F.col("b")).alias("near"),
        likeness(F.col("a"), F.col("a")).alias("same"),
        differing_sections(F.col("a"), F.col("b")).alias("where"),
        F.split(F.substring_index("a", ":", -1), r"\|").alias("sections"),
    ).first()
    assert r.same == 1.0 and r.near == pytest.approx(2 * 118 / (120 + 119))
    # The edit lies in one section, unless it moved that section's end.
    assert len(r.where) == 1 or (len(r.where) == 2 and r.where[1] == r.where[0] + 1)
    before = sum(section.count("/") + 1 for section in r.sections[: r.where[0]])
    assert before <= 20 < before + sum(r.sections[i].count("/") + 1 for i in r.where)


def expected_next(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0]), reverse=True)
    return sorted((str(i), t or "", order[(k + 1) % len(order)][1] or "") for k, (i, t) in enumerate(order))


@pytest.mark.parametrize("bucket_bytes", [1, 100, 1 << 25])
def test_the_next_document(docs, bucket_bytes):
    rows = [(i * i * 7 - 300, f"text {i}") for i in range(300)] + [(None, "last"), (10**15, "first")]
    found = with_next(docs(*rows), bucket_bytes).collect()
    assert sorted((str(r.doc_id), r.text, r.next_text) for r in found) == expected_next(rows)


def test_odd_rows(odd, none):
    found = with_next(odd).collect()
    assert sorted((str(r.doc_id), r.text) for r in found) == sorted((str(i), t or "") for i, t in ODD)
    texts = {str(r.doc_id): r.next_text for r in found if r.doc_id != 4}
    assert texts["1"] == "minus three is an id too" and texts["-3"] == "the text without an id is here" and texts["None"] == "."
    assert sorted(r.next_text for r in found if r.doc_id == 5) in [["another one"], ["one"]]
    assert with_next(none).collect() == [] and with_fingerprints(none, fingerprint="text").collect() == []


def test_a_single_document_is_its_own_next(docs):
    assert [r.next_text for r in with_next(docs((5, "alone"))).collect()] == ["alone"]


def test_the_query(spark, documents):
    rows = {r.doc_id: r for r in op9_fingerprints(spark, SF).collect()}
    texts = {r.doc_id: r.text for r in documents.collect()}
    ids = sorted(texts, reverse=True)
    for place, i in enumerate(ids):
        text, following = texts[i], texts[ids[(place + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        r = rows[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (by_hand(text), by_hand(edited))
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert sum(r.near_edited for r in rows.values()) > 5 * sum(r.near_next for r in rows.values())


def test_no_python_on_the_way(spark):
    plan = op9_fingerprints(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Scan ExistingRDD", plan)
    # Texts are shuffled once.
    assert plan.count("Exchange hashpartitioning") == 1
