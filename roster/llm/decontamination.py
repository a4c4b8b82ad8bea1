"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, names and units are replaced by typed placeholders, all other words are
kept in lower case. Windows of ``WINDOW`` words of the benchmark are joined by hash with those of the documents,
in three views of the words: as templates; as open templates, in which a word that may be a name is matched
both as a name and as itself; and as they are, in lower case, with all values. From each hit the match is extended word by word along its diagonal, and the values behind
the placeholders must correspond: a number, name or unit of the item always stands for the same value of
the document, and different names for different ones. So a question asked again with other numbers or
names is found, and one that merely has the same form in places is not.

An item is found in a document where ``RUN`` words in a row match, or all of a shorter item but its first
word (which a sentence's beginning may turn from a word into a name). An item of fewer than ``WINDOW`` words is
found where all its words stand in a row as they are. Values may differ only where a window of ``WINDOW`` words
has ``LEAST_WORDS`` plain ones; anything else is found by its exact words, without regard to capitals.

- A number is a run of digits, with points or commas between them, or one of ``NUMBER_WORDS``.
- A unit is one of ``UNITS`` behind a number.
- A name begins with a capital, goes on in small letters, and does not begin a sentence. What begins a sentence
  so, and what is a name elsewhere in its text, may be one.

Defined results: NULL, empty texts and items without a word contain and match nothing; equal items are reported once, under the smallest id;
rows with equal ids are judged each by its own text; an empty benchmark finds nothing.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roster.llm.batches import mixed, slices, text_bytes
from roster.llm.words import combined, span_hashes

WINDOW = 8
LEAST_WORDS = 4
RUN = 13
BLOCK_BYTES = 16 << 20  # of benchmark text that is broadcast at once
WORD, NUMBER, NAME, UNIT = 0, 1, 2, 3
TEMPLATE, OPEN, PLAIN = 0, 1, 2
_CHUNK = 1 << 14

# Number words and units, in English.
NUMBER_WORDS = """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen
seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion""".split()
UNITS = """mm cm m km in ft yd mi mg g kg lb lbs oz ml l gal s sec min h hr hrs kmh mph hz khz mhz ghz w kw v a k c f pa kpa
meter meters metre metres kilometer kilometers mile miles inch inches foot feet yard yards gram grams kilogram kilograms
pound pounds ounce ounces liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week
weeks month months year years percent dollar dollars cent cents euro euros degree degrees""".split()

_LETTER = np.zeros(256, bool)
_LETTER[[c for c in range(128) if chr(c).isalpha()]] = True
_LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_SENTENCE_END = np.zeros(256, bool)
_SENTENCE_END[[ord(c) for c in ".!?:;\n\r"]] = True


def _hashes_of(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    return np.sort(span_hashes(data, np.concatenate([[0], ends[:-1]]), ends))


@dataclass(frozen=True)
class Templates:
    """Words of texts one after the other; ``texts`` are the offsets of the texts among them."""

    template: np.ndarray
    value: np.ndarray
    kind: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    texts: np.ndarray
    maybe_name: np.ndarray

    def _inside(self, width: int) -> np.ndarray:
        """Words at which ``width`` words of one text begin."""
        left = np.repeat(self.texts[1:], self.texts[1:] - self.texts[:-1]) - np.arange(len(self.starts))
        return np.flatnonzero(left >= width)

    def runs(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all runs of ``width`` words as they are."""
        at = self._inside(width)
        return at, combined(self.value, width)[at]

    def windows(self, view: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words, hashes and numbers of plain words of all windows; several for one place if words may be names."""
        if view == PLAIN:
            at, hashes = self.runs(WINDOW)
            return at, hashes, np.full(len(at), WINDOW)
        every = self._inside(WINDOW)
        plain = np.concatenate([[0], np.cumsum(self.kind == WORD)])
        if view == TEMPLATE:
            return every, combined(self.template, WINDOW)[every], plain[every + WINDOW] - plain[every]
        both = self.maybe_name & (self.kind == WORD)
        found = [self._choices(every[a : a + _CHUNK], both) for a in range(0, max(1, len(every)), _CHUNK)]
        return tuple(np.concatenate(parts) for parts in zip(*found))

    def _choices(self, at: np.ndarray, both: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, plain = np.zeros(len(at), np.uint64), np.zeros(len(at), np.int64)
        for i in range(WINDOW):
            two = both[at + i]
            words = np.concatenate([self.template[at + i], np.full(int(two.sum()), NAME, np.uint64)])
            counted = np.concatenate([self.kind[at + i] == WORD, np.zeros(int(two.sum()), bool)])
            at, hashes, plain = (np.concatenate([x, x[two]]) for x in (at, hashes, plain))
            hashes = mixed(hashes) + words
            plain += counted
        return at, mixed(hashes), plain


def templates(data: np.ndarray, offsets: np.ndarray) -> Templates:
    n = len(data)
    digit, letter = _DIGIT[data], _LETTER[data]
    if n > 2:
        joins = ((data[1:-1] == ord(".")) | (data[1:-1] == ord(","))) & digit[:-2] & digit[2:]
        digit[1:-1] |= joins
    kind = digit + 2 * letter
    edge = np.ones(n + 1, bool)
    edge[1:n] = kind[1:] != kind[:-1]
    edge[offsets] = True
    bounds = np.flatnonzero(edge) if n else np.zeros(1, np.int64)
    starts, ends = bounds[:-1], bounds[1:]
    some = kind[starts] > 0
    starts, ends = starts[some], ends[some]
    texts = np.searchsorted(starts, offsets)
    lower, capital = _lower(data)
    value = span_hashes(lower, starts, ends)
    kinds = np.where(kind[starts] == 1, NUMBER, WORD)
    kinds[np.isin(value, _NUMBERS)] = NUMBER
    sentences = np.concatenate([[0], np.cumsum(_SENTENCE_END[data])])
    begins = np.ones(len(starts), bool)
    begins[1:] = sentences[starts[1:]] != sentences[ends[:-1]]
    begins[texts[:-1][texts[:-1] < len(starts)]] = True
    capitals = np.concatenate([[0], np.cumsum(capital)])
    named = (capital[starts] if len(starts) else np.zeros(0, bool)) & (capitals[ends] - capitals[starts] == 1) & (ends - starts > 1)
    kinds[named & ~begins & (kinds == WORD)] = NAME
    behind = np.zeros(len(starts), bool)
    behind[1:] = kinds[:-1] == NUMBER
    behind[texts[:-1][texts[:-1] < len(starts)]] = False
    kinds[behind & (kinds == WORD) & np.isin(value, _UNITS)] = UNIT
    own = mixed(value) + np.repeat(np.arange(len(texts) - 1), texts[1:] - texts[:-1]).astype(np.uint64)
    maybe_name = (kinds == NAME) | (kinds == WORD) & (named | np.isin(own, own[kinds == NAME]))
    return Templates(np.where(kinds == WORD, value, kinds.astype(np.uint64)), value, kinds, starts, ends, texts, maybe_name)


def _lower(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Small letters, and where a capital begins: ASCII and the Latin-1 letters behind the byte C3."""
    capital = (data >= ord("A")) & (data <= ord("Z"))
    lower = np.where(capital, data + 32, data).astype(np.uint8)
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    lower[second] += 32
    capital[:-1] |= second[1:]
    return lower, capital


_NUMBERS, _UNITS = _hashes_of(NUMBER_WORDS), _hashes_of(UNITS)


class _Hashes:
    """Places by hash."""

    def __init__(self, places: np.ndarray, hashes: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        self.places, self.hashes = places[order], hashes[order]
        bits = max(16, int(8 * len(hashes)).bit_length())
        self.mask = np.uint64((1 << min(bits, 23)) - 1)
        self.maybe = np.zeros(int(self.mask) + 1, bool)
        self.maybe[(self.hashes & self.mask).astype(np.int64)] = True

    def hits(self, at: np.ndarray, hashes: np.ndarray):
        """(at, place) of equal hashes, by ``at``."""
        likely = np.flatnonzero(self.maybe[(hashes & self.mask).astype(np.int64)])
        at, hashes = at[likely], hashes[likely]
        low, high = (np.searchsorted(self.hashes, hashes, side) for side in ("left", "right"))
        for i in np.argsort(at, kind="stable"):
            for place in self.places[low[i] : high[i]]:
                yield int(at[i]), int(place)


class Index:
    """Windows of benchmark items by hash, in each view, and items of fewer words as a whole."""

    def __init__(self, items: list[tuple[int, str]]):
        self.ids = [item for item, _ in items]
        texts = [text.encode() for _, text in items]
        self.words = templates(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64))
        self.views = {}
        for view in (TEMPLATE, OPEN, PLAIN):
            at, hashes, plain = self.words.windows(view)
            some = plain >= LEAST_WORDS
            self.views[view] = _Hashes(at[some], hashes[some])
        sizes = self.words.texts[1:] - self.words.texts[:-1]
        self.short = {}
        for width in sorted(set(sizes[(sizes > 0) & (sizes < WINDOW)].tolist())):
            at, hashes = self.words.runs(width)
            whole = np.isin(at, self.words.texts[:-1][sizes == width])
            self.short[width] = _Hashes(at[whole], hashes[whole])

    def leaks(self, docs: Templates) -> list[tuple[int, int, int, int, int]]:
        """As ``found``, in whichever view a match is longest, and with items of fewer than ``WINDOW`` words."""
        best: dict[tuple[int, int], tuple[int, int, bool]] = {}
        for view in (PLAIN, OPEN, TEMPLATE):
            for text, item, *run in self.found(docs, view):
                if run[1] > best.get((text, item), (0, 0, False))[1]:
                    best[text, item] = tuple(run)
        for width, hashes in self.short.items():
            for at, place in hashes.hits(*docs.runs(width)):
                best.setdefault((self._text(docs, at), self._text(self.words, place)), (at, width, True))
        return [(text, item, *run) for (text, item), run in best.items()]

    def found(self, docs: Templates, view: int = TEMPLATE) -> list[tuple[int, int, int, int, int]]:
        """(text, item, first word, words, whether all values are equal): the longest match of each item in each text."""
        best: dict[tuple[int, int], tuple[int, int, bool]] = {}
        reached: dict[tuple[int, int, int], int] = {}
        for at, place in self.views[view].hits(*docs.windows(view)[:2]):
            text, item = self._text(docs, at), self._text(self.words, place)
            diagonal = (text, item, at - place)
            if reached.get(diagonal, -1) > at:
                continue
            first, last = self._extended(docs, text, item, at, place, view)
            reached[diagonal] = last
            run = self._consistent(docs, first, last, at - place, view)
            size = int(self.words.texts[item + 1] - self.words.texts[item])
            if run[1] >= min(RUN, size - 1) and run[1] > best.get((text, item), (0, 0, False))[1]:
                best[text, item] = run
        return [(text, item, *run) for (text, item), run in best.items()]

    @staticmethod
    def _text(words: Templates, at: int) -> int:
        return int(np.searchsorted(words.texts, at, "right")) - 1

    def _extended(self, docs: Templates, text: int, item: int, at: int, place: int, view: int) -> tuple[int, int]:
        shift = at - place
        low = max(int(docs.texts[text]), int(self.words.texts[item]) + shift)
        high = min(int(docs.texts[text + 1]), int(self.words.texts[item + 1]) + shift)
        ours, theirs = slice(low, high), slice(low - shift, high - shift)
        same = docs.value[ours] == self.words.value[theirs] if view != TEMPLATE else np.zeros(high - low, bool)
        if view != PLAIN:
            same |= docs.template[ours] == self.words.template[theirs]
        if view == OPEN:
            same |= docs.maybe_name[ours] & self.words.maybe_name[theirs]
        differ = np.flatnonzero(~same) + low
        after = int(np.searchsorted(differ, at))
        return int(differ[after - 1]) + 1 if after else low, int(differ[after]) if after < len(differ) else high

    def _consistent(self, docs: Templates, first: int, last: int, shift: int, view: int) -> tuple[int, int, bool]:
        """The longest stretch in which values correspond: its first word, its words, and whether they are equal."""
        if view == PLAIN:
            return first, last - first, True
        best, start = (first, 0, True), first
        forth: dict[tuple, tuple] = {}  # value of the item -> value of the document, and where last seen
        back: dict[tuple, tuple] = {}
        for at in range(first, last):
            kind = int(docs.kind[at])
            if view == OPEN and (docs.maybe_name[at] or self.words.maybe_name[at - shift]):
                kind = NAME
            if kind != WORD:
                ours, theirs = int(docs.value[at]), int(self.words.value[at - shift])
                known, seen = forth.get((kind, theirs), (ours, -1))
                if known != ours:
                    start = max(start, seen + 1)
                forth[kind, theirs] = (ours, at)
                if kind == NAME:
                    known, seen = back.get(ours, (theirs, -1))
                    if known != theirs:
                        start = max(start, seen + 1)
                    back[ours] = (theirs, at)
            if at + 1 - start > best[1]:
                best = (start, at + 1 - start, True)
        begin, size, _ = best
        equal = bool((docs.value[begin : begin + size] == self.words.value[begin - shift : begin + size - shift]).all())
        return begin, size, equal


def _blocks(benchmark: DataFrame, block_bytes: int):
    """Indexes of all distinct benchmark texts, each over about ``block_bytes`` of text."""
    texts = benchmark.where(F.col("text").isNotNull()).groupBy("text").agg(F.min("item_id").alias("item_id"))
    size = texts.agg(F.sum(F.octet_length("text").cast("long")).alias("size")).first()["size"] or 0
    blocks = -(-size // block_bytes)
    for block in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).collect()
        yield Index(sorted(((row.item_id, row.text) for row in rows), key=lambda x: (x[0] is not None, x[0], x[1])))


def find_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and item found in it: where, in bytes, how many words, and whether word for word."""
    schema = "doc_id long, item_id long, start long, end long, n_words long, exact boolean"
    every = docs.sparkSession.createDataFrame([], schema)
    for index in _blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def leaks(batches, shared=shared):
            index = shared.value
            for part in slices(batches, "text"):
                data, offsets = text_bytes(part.column("text"))
                words = templates(data, offsets)
                ids = part.column("doc_id")
                rows = [
                    (ids[t].as_py(), index.ids[i], int(words.starts[a] - offsets[t]), int(words.ends[a + n - 1] - offsets[t]), n, equal)
                    for t, i, a, n, equal in index.leaks(words)
                ]
                if rows:
                    kinds = [pa.int64()] * 5 + [pa.bool_()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], ["doc_id", "item_id", "start", "end", "n_words", "exact"])

        every = every.unionByName(docs.select("doc_id", "text").mapInArrow(leaks, schema))
    return every


def drop_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, with all their columns."""
    for index in _blocks(benchmark, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def clean(batches, shared=shared):
            for part in slices(batches, "text"):
                keep = np.ones(part.num_rows, bool)
                keep[[hit[0] for hit in shared.value.leaks(templates(*text_bytes(part.column("text"))))]] = False
                yield part.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
