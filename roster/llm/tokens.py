"""Token ids of texts by a ``tokenizers`` file, each different piece of words in a batch encoded once."""

from array import array
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

from roster.llm.words import lower_case, span_hashes, word_spans

KNOWN_PIECES = 250_000
# Kinds of bytes: digits stand alone, letters and other signs in runs.
_LETTER, _DIGIT, _SIGN = 1, 2, 3
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[ord("a") : ord("z") + 1] = _LETTER
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[0x80:] = _LETTER
# Bytes of words that are left to the tokenizer as they are: all but printable ASCII, and the apostrophe.
_ODD = np.ones(256, bool)
_ODD[0x20:0x7F] = False
_ODD[ord("'")] = True


def _byte_characters() -> list[str]:
    """The character that byte-level models use for each byte: itself if printable, else one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


def _latin_letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the first byte of a Latin-1 letter is, and where the second byte of a capital one is."""
    first = np.zeros(len(data), bool)
    first[:-1] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)
    capital = np.zeros(len(data), bool)
    capital[1:] = first[:-1] & (data[1:] <= 0x9E)
    return first, capital


class WordTokenizer:
    """Ids of texts for a byte-level tokenizer that lower-cases and drops white space, so that words can be encoded apart.

    Words are parted at ASCII white space, other kinds of it are left to the tokenizer. Plain words, of
    printable ASCII and Latin-1 letters, are parted further as the tokenizer does: runs of letters, single
    digits, runs of other signs. A text that may hold a special token is encoded as a whole. What is known
    of pieces is thrown away when it grows too large.
    """

    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self.dtype = np.dtype("<u2" if self._tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._bytes = _byte_characters()
        self._known: dict[int, bytes] = {}

    def encode(self, data: np.ndarray, offsets: np.ndarray, end: int) -> list[np.ndarray]:
        """The ids of each text and the id ``end`` after them."""
        lower, starts, ends, odd, places = self._cut(data, offsets)
        # A piece of an odd word must not pass for the same bytes as a plain piece.
        hashes = span_hashes(lower, starts, ends) ^ odd.astype(np.uint64)
        pieces, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        ids = self._encoded(pieces, starts[first], ends[first], odd[first], lower.tobytes())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(ids), self.dtype)
        counts = sizes[which]
        upto = np.concatenate([[0], np.cumsum(counts)])
        begins = (np.cumsum(sizes) - sizes)[which]
        tokens = flat[np.repeat(begins - upto[:-1], counts) + np.arange(upto[-1])]
        tail = np.array([end], self.dtype)
        cuts, raw = upto[places].tolist(), data.tobytes()
        return [
            np.concatenate([self._whole(raw[a:b]) if raw.find(b"<|", a, b) >= 0 else tokens[c:d], tail])
            for a, b, c, d in zip(offsets[:-1].tolist(), offsets[1:].tolist(), cuts, cuts[1:])
        ]

    @staticmethod
    def _cut(data: np.ndarray, offsets: np.ndarray):
        """Bytes in lower case, begin and end of pieces, whether they are odd words, and offsets of texts among pieces."""
        starts, ends, places = word_spans(data, offsets)
        latin, capital = _latin_letters(data)
        odd = _ODD[data]
        odd[latin] = False
        odd[1:][latin[:-1]] = False
        upto = np.concatenate([[0], np.cumsum(odd, dtype=np.int32)])
        odd_word = upto[ends] != upto[starts]
        lower = lower_case(data)
        lower[capital] += 32
        kind = _KIND[lower]
        edge = np.zeros(len(data) + 1, bool)
        edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        inside = np.zeros(len(data) + 1, np.int8)
        plain = ~odd_word
        inside[starts[plain]] += 1
        inside[ends[plain]] -= 1
        edge &= np.cumsum(inside, dtype=np.int8).astype(bool)
        edge[starts] = True
        begins = np.flatnonzero(edge)
        word = np.searchsorted(starts, begins, side="right") - 1
        stops = np.append(begins[1:], len(data))
        return lower, begins, np.minimum(stops, ends[word]), odd_word[word], np.searchsorted(begins, offsets)

    def _encoded(self, pieces: np.ndarray, starts: np.ndarray, ends: np.ndarray, odd: np.ndarray, lower: bytes) -> list[bytes]:
        if len(self._known) > KNOWN_PIECES:
            self._known.clear()
        names = pieces.tolist()
        ids = list(map(self._known.get, names))
        for i in [i for i, found in enumerate(ids) if found is None]:
            text = lower[starts[i] : ends[i]].decode("utf-8", "replace")
            if odd[i]:
                ids[i] = self._ids(self._tokenizer.encode(text, add_special_tokens=False).ids)
            else:
                mapped = text if text.isascii() else "".join([self._bytes[b] for b in text.encode()])
                ids[i] = self._ids([token.id for token in self._model.tokenize(mapped)])
            self._known[names[i]] = ids[i]
        return ids

    def _ids(self, ids: list[int]) -> bytes:
        return array(self.dtype.char, ids).tobytes()

    def _whole(self, raw: bytes) -> np.ndarray:
        return np.array(self._tokenizer.encode(raw.decode("utf-8", "replace"), add_special_tokens=False).ids, self.dtype)


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)
