"""Word shingles of texts as sorted 64-bit hashes.

Words are runs of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return, with
A-Z in lower case. A text with fewer words than a shingle takes is one shingle of all its words; a text
without words has none.
"""

from functools import lru_cache

import numpy as np

from roster.llm.batches import mixed

_BASE = 0x9E3779B97F4A7C15
_KEPT = 9 << 16
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_GAP = np.zeros(256, bool)
_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def _new_powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.multiply.accumulate(powers)


@lru_cache(maxsize=4)
def _kept_powers(base: int) -> np.ndarray:
    return _new_powers(base, _KEPT)


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; those that most texts need are kept by the worker."""
    return _kept_powers(base)[:n] if n <= _KEPT else _new_powers(base, n)


class SpanHasher:
    """64-bit hashes of values[start:end], equal for equal contents anywhere. ``base`` is any odd number."""

    def __init__(self, values: np.ndarray, base: int = _BASE):
        n = len(values)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * _powers(base, n), out=self._sums[1:])
        self._back = _powers(pow(base, -1, 1 << 64), n + 1)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self._sums[ends] - self._sums[starts]) * self._back[starts])

    def windows(self, width: int) -> np.ndarray:
        """The hash of the window that begins at each value."""
        n = max(0, len(self._sums) - width)
        return mixed((self._sums[width : width + n] - self._sums[:n]) * self._back[:n])


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return SpanHasher(values)(starts, ends)


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the words of texts laid one after the other begin and end, and the offsets of the texts among them."""
    inside = ~_GAP[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets[:-1]] = True
    begins = inside & (first[:-1] | np.concatenate([[True], ~inside[:-1]])[: len(data)])
    starts = np.flatnonzero(begins)
    last = np.zeros(len(data) + 1, bool)
    last[offsets[1:]] = True
    finishes = inside & (last[1:] | np.concatenate([~inside[1:], [True]])[: len(data)])
    ends = np.flatnonzero(finishes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def lower_case(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the offsets of the texts among them."""
    starts, ends, places = word_spans(data, offsets)
    return span_hashes(lower_case(data), starts, ends), places


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """For each text its distinct shingles of ``words`` words, ascending."""
    hashes, places = word_hashes(data, offsets)
    runs = combined(hashes, words)
    sets = []
    for a, b in zip(places, places[1:]):
        if b - a >= words:
            sets.append(np.unique(runs[a : b - words + 1]))
        elif b > a:
            short = mixed(combined(hashes[a:b], int(b - a)) + np.uint64(b - a))
            sets.append(short[:1])
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def combined(hashes: np.ndarray, words: int) -> np.ndarray:
    """One hash for each run of ``words`` hashes."""
    n = len(hashes) - words + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    runs = hashes[:n].copy()
    for i in range(1, words):
        runs = mixed(runs) + hashes[i : i + n]
    return mixed(runs)
