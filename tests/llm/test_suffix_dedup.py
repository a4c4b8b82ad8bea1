"""Suffix arrays and the removal of repeated strings, against brute force."""

import hashlib
import random

import numpy as np
import pytest

from roster.llm.suffix_array import DEPTH, common_prefixes, packed_words, suffix_array
from roster.llm.suffix_dedup import LENGTH, Limits, drop_repeats, fragments, repeats_report
from tests.llm.conftest import LONG, ODD


def test_suffix_array_and_common_prefixes():
    pick = np.random.default_rng(0)
    for _ in range(150):
        parts, base = [], pick.integers(1, 4, 200)
        for _ in range(pick.integers(1, 8)):
            start = pick.integers(0, 150)
            part = base[start : start + pick.integers(1, 50)].copy()
            if pick.random() < 0.5:
                part[pick.integers(0, len(part))] = pick.integers(1, 257)
            if pick.random() < 0.2:
                part[:] = 2
            parts += [part, [0]]
        symbols = np.concatenate(parts).astype(np.uint16)
        words = packed_words(symbols)
        order = suffix_array(symbols, words)
        assert sorted(order) == list(range(len(symbols)))
        texts = [(symbols.tolist()[i:] + [0] * DEPTH)[:DEPTH] for i in order]
        assert all(a <= b for a, b in zip(texts, texts[1:]))
        for a, b, common in zip(texts, texts[1:], common_prefixes(order, words)[1:]):
            assert common == next((i for i in range(DEPTH) if a[i] != b[i]), DEPTH)


def expected(rows):
    """{(id, text): (bytes, removed, spans, digest)}; windows are looked up in the order of (id, text hash)."""
    seen, result = set(), {}
    for key, raw in rows:
        covered, last, new = bytearray(len(raw)), 0, []
        for at in range(len(raw) - LENGTH + 1):
            window = raw[at : at + LENGTH]
            if window in seen:
                start = max(at, last)
                covered[start : at + LENGTH] = b"\x01" * (at + LENGTH - start)
                last = at + LENGTH
            else:
                seen.add(window)
        kept = bytes(b for b, c in zip(raw, covered) if not c)
        runs = sum(1 for i, c in enumerate(covered) if c and (i == 0 or not covered[i - 1]))
        result[key] = (len(raw), sum(covered), runs, hashlib.sha256(kept).hexdigest())
    return result


def reported(df, *limits):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats_report(df, *limits).collect()}


def assert_brute_force(df, *limits):
    rows = sorted((r.doc_id, (r.text or "").encode()) for r in df.select("doc_id", "text").collect())
    assert reported(df, *limits) == expected(rows)


def test_whole_table(documents):
    assert_brute_force(documents)


def mixture(seed, n=60):
    """Texts that share passages in all ways: whole, in part, across characters, next to each other, in themselves."""
    pick = random.Random(seed)
    letters = "abcdé漢 " if seed % 2 else "ab"
    passages = ["".join(pick.choice(letters) for _ in range(pick.randint(90, 260))) for _ in range(6)]
    passages += ["a" * 150, "xy" * 120, passages[0][:101], passages[1][:99]]
    rows = []
    for i in range(n):
        parts = [pick.choice(passages)[pick.randint(0, 20) :] for _ in range(pick.randint(0, 5))]
        parts += ["".join(pick.choice(letters) for _ in range(pick.randint(0, 300))) for _ in range(pick.randint(0, 2))]
        pick.shuffle(parts)
        rows.append((i * 7 % n, pick.choice(["", " "]).join(parts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_mixtures(docs, seed):
    assert_brute_force(docs(*mixture(seed)))


@pytest.mark.parametrize("seed", [3, 4])
def test_small_pieces_groups_and_buckets(docs, seed):
    """Every limit is met many times: long texts in pieces, several flushes, several buckets."""
    limits = Limits(piece=150, flush=5, bucket_bytes=500, sorted_bytes=300, cut_bytes=400, sample=8, common=2)
    assert_brute_force(docs(*mixture(seed)), limits)


def test_common_lines_are_no_anchor_where_something_else_is(documents):
    data = np.frombuffer((b"q" * 40 + b"a line that everybody has on the page " + b"r" * 60) * 3, np.uint8)
    offsets = np.array([0, len(data)], np.int64)
    nothing, everything = np.zeros(1 << 24, bool), np.ones(1 << 24, bool)
    for common in (nothing, everything):
        found = fragments(data, offsets, common)
        assert found["start"][0] == 0 and int(found["start"][-1]) + int(found["more"][-1]) + LENGTH == len(data)
        assert (found["start"][1:] == found["start"][:-1] + found["more"][:-1] + 1).all()


def test_odd_rows(odd, none):
    report = [r for r in repeats_report(odd).collect()]
    assert sorted(((r.doc_id, r.n_bytes) for r in report), key=str) == sorted(((i, len((t or "").encode())) for i, t in ODD), key=str)
    by_id = {r.doc_id: r for r in report}
    want = expected([(5, LONG.encode()), (6, (LONG + " more").encode())])
    assert all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[i] for i, r in by_id.items() if i in want)
    assert repeats_report(none).collect() == [] and drop_repeats(none).collect() == []
    assert drop_repeats(odd).columns == odd.columns


def test_texts_are_cut_by_whole_characters(docs):
    shared = "".join(c for c in random.Random(8).choices("éèàbc", k=120))
    # é, è and à begin with one byte, so the repeated string ends within the letter behind the shared ones.
    rows = docs((1, "x" + shared + "é"), (2, "y" + shared + "è tail"), (3, "é" + shared[1:] + "à"), (4, None))
    cut = {r.doc_id: (r.text, r.source, r._spans) for r in drop_repeats(rows).collect()}
    assert cut[1][0] == "x" + shared + "é" and cut[2][0] == "yè tail" and cut[4] == (None, "x", "x")
    assert cut[3][0] in ("éà", "à")


def test_repeated_rows_are_one_document(docs):
    text = "".join(random.Random(5).choices("abc ", k=400))
    rows = repeats_report(docs((1, text), (1, text), (2, text))).collect()
    assert sorted((r.doc_id, r.n_removed) for r in rows) == [(1, 0), (1, 0), (2, 400)]
