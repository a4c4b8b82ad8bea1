"""Token alignment against plain loops over the tokens of the contract's files."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from roster.llm.queries import PAIR
from roster.llm.token_alignment import ByteTokenizer, align_documents, align_ends, gallop
from roster.llm.tokens import _byte_characters
from tests.llm.conftest import LONG

SPECIAL = [(20, "a <|endoftext|> b <s> c </s> <unk> <0x41>"), (21, "low ▁ line"), (22, "  two  blanks \r\n tabs\t\t"), (23, "é ﬁ     x"), (24, None)]


@pytest.fixture(scope="module")
def plain():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PAIR.pieces)
    byte_of = {c: b for b, c in enumerate(_byte_characters())}

    def tokens(text):
        a = [(i, bytes(byte_of[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = []
        for i in second.encode(text):
            piece = second.id_to_piece(i)
            b.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
        return a, b

    return tokens


def spans(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((at, at + len(raw), i))
        at += len(raw)
    return out


def expected(rows, tokens):
    found, counts = [], Counter()
    for doc_id, text in rows:
        a, b = tokens(text) if text else ([], [])
        raw = f" {text}".encode()
        if not text or any(b"".join(t for _, t in side) != raw for side in (a, b)):
            found.append((doc_id, 0, 0, 0, None, ""))
            continue
        a, b = spans(a), spans(b)
        links, start = [], 0
        for s, e, i in a:
            while b[start][1] <= s:
                start += 1
            k = start
            while k < len(b) and b[k][0] < e:
                links.append((i, b[k][2]))
                k += 1
        groups, x, y = [], 0, 0
        for end in sorted({e for _, e, _ in a} & {e for _, e, _ in b}):
            left, right = [], []
            while x < len(a) and a[x][1] <= end:
                left.append(str(a[x][2]))
                x += 1
            while y < len(b) and b[y][1] <= end:
                right.append(str(b[y][2]))
                y += 1
            groups.append(",".join(left) + "|" + ",".join(right))
        counts.update(set(links))
        found.append((doc_id, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    highest = Counter()
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    out = []
    for doc_id, n_a, n_b, n_groups, links, digest in found:
        links = links or []
        best = sum(counts[x] == highest[x[0]] for x in links)
        out.append((doc_id, n_a, n_b, n_groups, len(links), best, sum(counts[x] for x in links), digest))
    return Counter(out)


def assert_expected(df, tokens, **how):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    got = align_documents(df, PAIR, **how)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == expected(rows, tokens)


@pytest.mark.parametrize("block_bytes", [1, 20_000, 16 << 20])
def test_whole_table(documents, plain, block_bytes):
    assert_expected(documents, plain, block_bytes=block_bytes)


def test_odd_rows(odd, docs, plain):
    assert_expected(odd.unionByName(docs(*SPECIAL)), plain)
    texts = [text for _, text in SPECIAL if text]
    assert all(plain(t)[0] for t in texts)


def test_empty_table(none):
    assert align_documents(none, PAIR).collect() == []


def test_ranks_give_the_ids_of_the_other_file(documents):
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    texts = [r.text for r in documents.collect() if r.text] + [t for _, t in SPECIAL if t] + [LONG, "٠ ١٢ Ⅷ ² \U0001f469‍\U0001f680"]
    ids = [e.ids for e in first.encode_batch([f" {t}" for t in texts], add_special_tokens=False)]
    assert [i.tolist() for i in ByteTokenizer(PAIR.ranks, PAIR.pattern).encode(texts)] == ids


def test_gallop_is_a_search():
    pick = np.random.default_rng(3)
    for n in (1, 2, 7, 400):
        among = np.unique(pick.integers(0, 1000, n))
        keys = np.sort(pick.integers(0, among[-1] + 1, 50))
        guess = pick.integers(0, len(among), 50)
        assert (gallop(keys, among, guess) == np.searchsorted(among, keys)).all()


def test_links_are_one_for_each_part():
    pick = random.Random(4)
    for _ in range(50):
        total = pick.randint(1, 60)
        short, long = sorted((sorted({*pick.choices(range(1, total + 1), k=pick.randint(0, 20)), total}) for _ in range(2)), key=len)
        found = align_ends(np.array(short), np.array(long), np.zeros(len(short), np.int64))
        ends = sorted({*short, *long})
        assert found.first.tolist() == [sum(e < x for e in short) for x in ends]
        assert found.second.tolist() == [sum(e < x for e in long) for x in ends]
        assert [e for e, c in zip(short, found.first_common) if c] == sorted({*short} & {*long})
