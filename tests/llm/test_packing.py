"""Packing and token files: lossless, gapless, tight, and as the tokenizer encodes."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from roster.llm import token_output
from roster.llm.packing import RoomTree, best_fit, pack_documents
from roster.llm.token_output import read_pieces, read_sequences, write_tokens
from roster.llm.tokens import tokenizer
from tests.llm.conftest import ODD

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


def encoded(texts):
    raw = [(t or "").encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    return tokenizer(PATH).encode(np.frombuffer(b"".join(raw), np.uint8), offsets, 2)


def test_ids_are_those_of_the_tokenizer(plain):
    pick = random.Random(2)
    parts = """a B é É ß ẞ İ ı <| |> <|endoftext|> <|ENDOFTEXT|> 's 'LL ' ’ 1 ² ½ Ⅷ Σ ς 漢 é . , !! $ _ - ª µ ÿ Ÿ × ÷ ǅ 😀
    the Thing don't 3.14 x_y ́""".split() + list(" \n\t\x0b\x0c\r\x1c\x1f\x85\xa0　​﻿‍\xad\x00\x7f")
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 12))) for _ in range(4000)] + [None, ""]
    for text, ids in zip(texts, encoded(texts)):
        assert plain.encode(text or "", add_special_tokens=False).ids + [2] == ids.tolist(), repr(text)


def test_the_tree_finds_the_tightest_window():
    pick, tree, rooms = random.Random(3), RoomTree(64), []
    for _ in range(3000):
        if pick.random() < 0.5:
            room = pick.randint(1, 64)
            tree.add(room, len(rooms))
            rooms.append(room)
        else:
            need = pick.randint(1, 64)
            left = [r for r in rooms if r is not None and r >= need]
            found = tree.take(need)
            assert (found and found[0]) == (min(left) if left else None)
            if found:
                assert rooms[found[1]] == found[0]
                rooms[found[1]] = None


def assert_packed(lengths, sequences, window):
    pieces = {}
    for sequence in sequences:
        assert 0 < sequence.length <= window and sequence.length == sum(n for _, _, n in sequence.pieces)
        for document, start, length in sequence.pieces:
            assert length > 0
            pieces.setdefault(document, []).append((start, length))
    for document, length in enumerate(lengths):
        at = 0
        for start, n in sorted(pieces.pop(document, [])):
            assert start == at
            at += n
        assert at == length
    assert not pieces


def test_best_fit():
    pick = random.Random(1)
    for _ in range(150):
        sizes = [1, 2, 5, 63, 64, 65, 128, 200, pick.randint(1, 30), pick.randint(1, 300)]
        lengths = [pick.choice(sizes) for _ in range(pick.randint(0, 120))]
        sequences = best_fit(lengths, 64, least_gap=4)
        assert_packed(lengths, sequences, 64)
        padding = sum(64 - s.length for s in sequences if s.length & (s.length - 1))
        assert padding <= 3 * len(sequences)
    # Decreasing best fit: 40 and 24 fill one window, 33 and 31 the other; nothing is cut.
    tight = best_fit([24, 31, 33, 40], 64, least_gap=1)
    assert [[n for _, _, n in s.pieces] for s in tight] == [[40, 24], [33, 31]]


def test_pieces_of_a_table(documents, plain):
    rows = pack_documents(documents, PATH, 2).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert_rows(rows, texts, plain, 4096)
    filled = {}
    for r in rows:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    padding = sum(4096 - n for n in filled.values() if n & (n - 1))
    assert padding <= 0.01 * sum(filled.values())


def assert_rows(rows, texts, plain, window):
    whole = {i: plain.encode(t or "", add_special_tokens=False).ids + [2] for i, t in texts.items()}
    places, pieces = {}, {}
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert ids == whole[r.doc_id][r.start : r.start + r.length] and r.doc_tokens == len(whole[r.doc_id])
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
    for found, end in [(v, None) for v in places.values()] + [(v, len(whole[i])) for i, v in pieces.items()]:
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
        assert at <= window if end is None else at == end
    assert set(pieces) == set(texts)


def test_groups_are_bounded(documents, plain):
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert_rows(pack_documents(documents, PATH, 2, window=256, group_tokens=3000).collect(), texts, plain, 256)


def test_odd_rows(odd, none, plain):
    rows = pack_documents(odd, PATH, 2).collect()
    assert sorted(str(r.doc_id) for r in rows if r.start == 0) == sorted(str(i) for i, _ in ODD)
    assert sum(r.length for r in rows) == sum(len(plain.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ODD)
    assert {r.doc_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert pack_documents(none, PATH, 2).collect() == []


def test_token_files_give_the_documents_back(spark, documents, plain, tmp_path):
    path = str(tmp_path / "tokens")
    write_tokens(documents, path, PATH, 2)
    whole = {r.doc_id: plain.encode(r.text, add_special_tokens=False).ids + [2] for r in documents.collect()}
    back = {}
    for r in read_pieces(spark, path).orderBy("doc_id", "start").collect():
        ids = back.setdefault(r.doc_id, [])
        assert len(ids) == r.start and r.length == len(r.ids) // 2
        ids += np.frombuffer(bytes(r.ids), "<u2").tolist()
    assert back == whole


def test_matrices_lengths_and_resets(spark, documents, tmp_path):
    path = str(tmp_path / "tokens")
    write_tokens(documents, path, PATH, 2, pad=7, block=5)
    blocks = spark.read.schema(token_output.BLOCKS).parquet(path).collect()
    assert max(b.sequences for b in blocks) == 5
    for b in blocks:
        matrix = np.frombuffer(bytes(b.ids), "<u2").reshape(b.sequences, b.width)
        positions = np.arange(matrix.size)
        restarts = np.array(b.position_resets)
        positions -= restarts[np.searchsorted(restarts, positions, side="right") - 1]
        for row, position, ends in zip(matrix, positions.reshape(matrix.shape), b.cu_seqlens):
            assert ends[0] == 0 and ends[-1] <= b.width and (row[ends[-1] :] == 7).all()
            want = np.concatenate([np.arange(n) for n in np.diff([*ends, b.width])])
            assert (position == want).all()
    sequences = read_sequences(spark, path).collect()
    assert len({r.sequence_id for r in sequences}) == len(sequences) == sum(b.sequences for b in blocks)
    assert all(len(r.ids) == 2 * r.cu_seqlens[-1] for r in sequences)


def test_token_files_of_odd_rows(spark, odd, none, tmp_path):
    write_tokens(odd, str(tmp_path / "odd"), PATH, 2)
    pieces = read_pieces(spark, str(tmp_path / "odd")).collect()
    assert sorted(str(r.doc_id) for r in pieces if r.start == 0) == sorted(str(i) for i, _ in ODD)
    assert {zlib.crc32(bytes(r.ids)) for r in pieces if r.doc_id in (1, 2)} == {zlib.crc32(b"\x02\x00")}
    write_tokens(none, str(tmp_path / "none"), PATH, 2)
    assert read_sequences(spark, str(tmp_path / "none")).collect() == []
