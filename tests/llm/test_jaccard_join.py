"""The Jaccard join against brute force over all pairs."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from roster.llm.graph import components
from roster.llm.jaccard_join import SetTree, bands_for, keep_first, overlap, similar_documents
from tests.llm.conftest import ODD


def shingles(text, words):
    raw = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    for sign in b"\t\n\x0b\x0c\r":
        raw = raw.replace(bytes([sign]), b" ")
    found = [w for w in raw.split(b" ") if w]
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1)))


def expected(rows, words, percent):
    """{row number: (set size, smallest id reached)} over all pairs."""
    sets = [shingles(text, words) for _, text in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= percent * (len(a) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return Counter((rows[i][0], len(s), least.get(find(i))) for i, s in enumerate(sets))


def assert_brute_force(df, words, percent, **how):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in similar_documents(df, words, percent, **how).collect())
    assert got == expected(rows, words, percent)


def near_copies(seed, groups=12):
    pick, rows = random.Random(seed), []
    for _ in range(groups):
        base = [pick.choice("abcdefghijklmnop") + str(pick.randint(0, 9)) for _ in range(pick.randint(1, 120))]
        for _ in range(pick.randint(1, 9)):
            copy = list(base)
            for _ in range(pick.randint(0, 5)):
                copy[pick.randrange(len(copy))] = pick.choice(["X", "new", "b3"])
            rows.append((len(rows) * 37 % 1009, pick.choice([" ", "\n", " \t"]).join(copy)))
    return rows


@pytest.mark.parametrize("words, percent", [(4, 85), (2, 60)])
def test_near_copies(docs, words, percent):
    assert_brute_force(docs(*near_copies(words)), words, percent)


def test_whole_table(documents):
    assert_brute_force(documents, 4, 85)


def test_large_families_go_by_one_member_and_blocks(docs):
    assert_brute_force(docs(*near_copies(9, 5)), 3, 50, family_bytes=2000)


def test_odd_rows(odd, none):
    assert_brute_force(odd, 5, 80)
    assert similar_documents(none).collect() == [] and keep_first(none).collect() == []
    kept = keep_first(odd)
    assert kept.columns == odd.columns
    texts = Counter((r.doc_id, r.text) for r in kept.collect())
    # The longer text is nearly the shorter one; a repeated row stays once; everything else stays.
    assert texts == Counter({row: 1 for row in ODD if row[0] != 6})


def test_one_document_of_each_group_stays(docs):
    rows = near_copies(4)
    kept = [r.doc_id for r in keep_first(docs(*rows), 5, 80).collect()]
    assert sorted(kept) == sorted({c for (_, _, c) in expected(rows, 5, 80)})


def test_the_tree_finds_what_all_pairs_give():
    pick = np.random.default_rng(3)
    for percent in (30, 60, 85, 100):
        base = np.unique(pick.integers(0, 1 << 60, 300, dtype=np.uint64))
        sets = [np.unique(pick.choice(base, pick.integers(1, 120))) for _ in range(70)] + [base[:50], base[:50], base[:59]]
        groups = SetTree(sets, percent).join()
        links = defaultdict(set)
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                common, union = overlap(a, b)
                assert (common, union) == (len(set(a) & set(b)), len(set(a) | set(b)))
                if 100 * common >= percent * union:
                    links[i].add(j)
        for i in range(len(sets)):
            reached, todo = {i}, [i]
            while todo:
                new = links[todo.pop()] - reached
                reached |= new
                todo += new
            assert {j for j in range(len(sets)) if groups[j] == groups[i]} == reached


def test_bands_miss_less_than_once_in_a_trillion():
    for percent in (50, 80, 85, 99):
        assert (1 - (percent / 100) ** 4) ** bands_for(percent) <= 1e-12


def test_components(spark):
    pick = random.Random(1)
    edges = [(pick.randint(0, 300), pick.randint(0, 300)) for _ in range(160)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5)]
    parent = {n: n for e in edges for n in e}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in parent if find(n) != n}
