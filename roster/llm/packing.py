"""Packing: documents into windows of tokens by best-fit decreasing.

A document longer than a window is first cut into full windows. What is left of each document, longest
first, goes to the open window with the least room that still holds it; a segment tree indexed by
remaining room finds that window. At the end, the emptiest windows are dealt out to the gaps of the
others, and the one window left over is cut into lengths that are powers of two.

A task packs what it reads in groups of ``GROUP_TOKENS`` tokens, so nothing is shuffled and memory is
bounded (a longer document makes a larger group). Sequences are numbered by partition.

Defined results: NULL and empty texts are the end id alone; rows with equal ids are packed as separate
documents; an empty table gives no piece. Extra columns are not carried.
"""

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from roster.llm.batches import slices, text_bytes
from roster.llm.tokens import tokenizer

WINDOW = 4096
GROUP_TOKENS = 1 << 23
LEAST_GAP = 32  # a smaller gap is padded instead of filled by cutting a document
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


class RoomTree:
    """Open windows by remaining room; a segment tree finds the least room that is enough."""

    def __init__(self, most: int):
        self._leaves = 1 << most.bit_length()
        self._open = [0] * (2 * self._leaves)
        self._at: list[list[int]] = [[] for _ in range(most + 1)]

    def add(self, room: int, window: int) -> None:
        self._at[room].append(window)
        self._count(room, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, window) with the least room of ``need`` or more."""
        node = self._leaves + need
        while not self._open[node]:
            while node & 1:  # a right child, or the root's side: go up to where a right sibling exists
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self._leaves:
            node *= 2
            if not self._open[node]:
                node += 1
        room = node - self._leaves
        self._count(room, -1)
        return room, self._at[room].pop()

    def _count(self, room: int, by: int) -> None:
        node = self._leaves + room
        while node:
            self._open[node] += by
            node >>= 1


@dataclass
class Sequence:
    """Pieces (document, start, length) in a window, one after the other."""

    pieces: list[tuple[int, int, int]] = field(default_factory=list)
    length: int = 0

    def add(self, document: int, start: int, length: int) -> None:
        self.pieces.append((document, start, length))
        self.length += length


def best_fit(lengths: list[int], window: int = WINDOW, least_gap: int = LEAST_GAP) -> list[Sequence]:
    """Sequences of at most ``window`` tokens that hold every document, in whole or in pieces."""
    done, rest = [], []
    for document, length in enumerate(lengths):
        full = length - length % window
        for start in range(0, full, window):
            done.append(Sequence([(document, start, window)], window))
        if length > full:
            rest.append((length - full, document, full))
    rest.sort(key=lambda item: (-item[0], item[1]))
    open_windows, rooms = [], RoomTree(window)
    for length, document, start in rest:
        room, place = rooms.take(length) or (window, len(open_windows))
        if place == len(open_windows):
            open_windows.append(Sequence())
        open_windows[place].add(document, start, length)
        if room > length:
            rooms.add(room - length, place)
    return done + _closed(open_windows, window, least_gap)


def _closed(sequences: list[Sequence], window: int, least_gap: int) -> list[Sequence]:
    ready = [s for s in sequences if window - s.length < least_gap]
    others = sorted((s for s in sequences if window - s.length >= least_gap), key=lambda s: s.length)
    first, last = 0, len(others) - 1
    while first < last:
        giver, taker = others[first], others[last]
        while giver.pieces and taker.length < window:
            document, start, length = giver.pieces.pop()
            moved = min(length, window - taker.length)
            taker.add(document, start, moved)
            giver.length -= length
            if moved < length:
                giver.add(document, start + moved, length - moved)
        first += not giver.pieces
        last -= taker.length == window
    kept = [s for s in others if s.length]
    ready += [s for s in kept if s.length == window]
    for left in (s for s in kept if s.length < window):
        ready += _powers_of_two(left)
    return ready


def _powers_of_two(sequence: Sequence) -> list[Sequence]:
    cut, pieces = [], sequence.pieces[::-1]
    for bit in reversed(range(sequence.length.bit_length())):
        size = 1 << bit
        if sequence.length & size:
            part = Sequence()
            while part.length < size:
                document, start, length = pieces.pop()
                taken = min(length, size - part.length)
                part.add(document, start, taken)
                if taken < length:
                    pieces.append((document, start + taken, length - taken))
            cut.append(part)
    return cut


def packed_groups(batches, path: str, end: int, window: int, group_tokens: int = GROUP_TOKENS):
    """For each group of documents a task reads: ids of the documents, their tokens, and the sequences."""
    encode = tokenizer(path).encode
    ids, tokens, held = [], [], 0
    for part in slices(batches, "text", 1 << 20):
        ids += part.column("doc_id").to_pylist()
        for found in encode(*text_bytes(part.column("text")), end):
            tokens.append(found)
            held += len(found)
        if held >= group_tokens:
            yield ids, tokens, best_fit([len(t) for t in tokens], window)
            ids, tokens, held = [], [], 0
    if ids:
        yield ids, tokens, best_fit([len(t) for t in tokens], window)


def first_sequence() -> int:
    """Sequences of one partition are numbered from here."""
    return TaskContext.get().partitionId() << 36


def pack_documents(
    docs: DataFrame, path: str, end: int, window: int = WINDOW, group_tokens: int = GROUP_TOKENS
) -> DataFrame:
    """One row per piece, with its ids as unsigned little-endian 32-bit integers."""

    def packed(batches):
        number, rows, size = first_sequence(), [], 0
        for ids, tokens, sequences in packed_groups(batches, path, end, window, group_tokens):
            for sequence in sequences:
                offset = 0
                for document, start, length in sequence.pieces:
                    whole = tokens[document]
                    piece = whole[start : start + length].astype("<u4").tobytes()
                    rows.append((ids[document], start, length, len(whole), number, offset, piece))
                    offset += length
                    size += len(piece)
                number += 1
                if size > 1 << 22:
                    yield _pieces(rows)
                    rows, size = [], 0
        if rows:
            yield _pieces(rows)

    return docs.select("doc_id", "text").mapInArrow(packed, PIECES)


def _pieces(rows) -> pa.RecordBatch:
    names = [field.split()[0] for field in PIECES.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)], names)
