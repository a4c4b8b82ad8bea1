"""Suffix arrays by two-stage sorting, and common prefixes of neighbours, up to a bounded depth.

Suffixes that are smaller than their successors are sorted directly. All others are induced: buckets of
suffixes with one first symbol are finished in ascending order, and each finished bucket puts the
predecessors of its suffixes, in its own order, at the head of their buckets.

Order and common prefixes are exact up to ``DEPTH`` symbols; suffixes that agree that far come in any order.
"""

import numpy as np

BITS = 9  # of a symbol: 0 parts texts, byte b is b + 1
PACKED = 7  # symbols in a 64-bit word
DEPTH = 105  # 15 words


def packed_words(symbols: np.ndarray) -> np.ndarray:
    """For each position the next ``PACKED`` symbols as one number; zeros follow the end, ``DEPTH`` of them."""
    n = len(symbols)
    padded = np.zeros(n + DEPTH + PACKED, np.uint64)
    padded[:n] = symbols
    words = np.zeros(n + DEPTH, np.uint64)
    for i in range(PACKED):
        words = (words << np.uint64(BITS)) | padded[i : i + len(words)]
    return words


def smaller_than_successor(symbols: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one that begins a symbol later; the last counts as smaller."""
    n = len(symbols)
    changes = np.flatnonzero(symbols[1:] != symbols[:-1])
    rises = np.append(symbols[changes] < symbols[changes + 1], True)
    return rises[np.searchsorted(changes, np.arange(n))]


def _first_slots(keys: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """For each key of a sorted array the slot of the first equal one."""
    begins = np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]])
    return slots[begins][np.cumsum(begins) - 1]


def _sorted_directly(places: np.ndarray, words: np.ndarray) -> np.ndarray:
    """``places`` in the order of their suffixes, by words at growing depth among those still equal."""
    order = np.argsort(words[places])
    places = places[order]
    # A group of equal suffixes is known by the slot where it begins, so groups keep their order when they part.
    group = _first_slots(words[places], np.arange(len(places)))
    for depth in range(PACKED, DEPTH, PACKED):
        alike = group[1:] == group[:-1]
        tied = np.flatnonzero(np.concatenate([alike, [False]]) | np.concatenate([[False], alike]))
        if not len(tied):
            break
        keys = words[places[tied] + depth]
        by_key = np.argsort(keys)
        ranks = np.empty(len(tied), np.int64)
        ordered = keys[by_key]
        ranks[by_key] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        both = (group[tied] << np.int64(32)) | ranks
        by_both = np.argsort(both)
        places[tied] = places[tied][by_both]
        group[tied] = _first_slots(both[by_both], tied)
    return places


def suffix_array(symbols: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order. ``symbols`` ends with 0, which no other 0 precedes directly."""
    small = smaller_than_successor(symbols)
    direct = _sorted_directly(np.flatnonzero(small), words)
    heads = symbols[direct]
    present = np.flatnonzero(np.bincount(symbols, minlength=1))
    bounds = np.searchsorted(heads, np.append(present, present[-1] + 1 if len(present) else 0))
    pending: dict[int, list[np.ndarray]] = {int(s): [] for s in present}
    done = []
    for i, symbol in enumerate(present):
        induced = []
        fresh = np.concatenate([np.zeros(0, np.int64), *pending.pop(int(symbol))])
        while len(fresh):  # a run of one symbol hangs on its end
            induced.append(fresh)
            before = fresh[fresh > 0] - 1
            fresh = before[symbols[before] == symbol]
        bucket = np.concatenate([*induced, direct[bounds[i] : bounds[i + 1]]])
        done.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[symbols[before] > symbol]
        if len(before):
            by_symbol = np.argsort(symbols[before], kind="stable")
            before = before[by_symbol]
            cuts = np.flatnonzero(np.diff(symbols[before])) + 1
            for part in np.split(before, cuts):
                pending[int(symbols[part[0]])].append(part)
    return np.concatenate(done) if done else np.zeros(0, np.int64)


def common_prefixes(order: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Symbols that each suffix of ``order`` has in common with the one before it, at most ``DEPTH``; 0 for the first."""
    common = np.zeros(len(order), np.int64)
    alike = np.arange(1, len(order))
    for depth in range(0, DEPTH, PACKED):
        if not len(alike):
            break
        differ = words[order[alike] + depth] ^ words[order[alike - 1] + depth]
        equal = differ == 0
        parted = differ[~equal]
        zeros = PACKED * BITS - 1 - np.floor(np.log2(parted.astype(np.float64))).astype(np.int64)
        exact = parted >> (np.uint64(PACKED * BITS) - np.minimum(zeros, PACKED * BITS - 1).astype(np.uint64)) != 0
        zeros -= exact  # rounding up to the next power of two hides one bit
        common[alike[~equal]] = depth + zeros // BITS
        alike = alike[equal]
    common[alike] = DEPTH
    return common
