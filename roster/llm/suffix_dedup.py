"""Suffix-array dedup: remove every byte of a string of ``LENGTH`` bytes that occurs earlier in the corpus.

1. Texts are cut into fragments. Each window of ``LENGTH`` bytes has an anchor, the gram of ``GRAM`` bytes in it
   with the smallest hash; a fragment is a run of windows with one anchor. Equal windows have equal anchors
   wherever they occur, so what is equal meets under one anchor. Grams found in many documents of a sample
   count as largest, so that common lines are anchors only where a window holds nothing else; the sample
   spreads the load and changes no result.
2. Anchors are dealt into buckets. Of fragments with equal hashes (128 bits in all) only the first is kept,
   all others are repeats as a whole. A task does this for what it reads before anything is shuffled.
3. Fragments that differ but share an anchor are dealt into buckets again, now with their bytes. In each
   bucket a suffix array is built over them by two-stage sorting; suffixes in a row with common prefixes of
   ``LENGTH`` or more are one string, and all but its first place are repeats.
4. The repeats of a document are gathered and its bytes cut.

Earlier means a smaller ``doc_id``, then a smaller text hash, then an earlier byte of the same document.

Defined results: NULL and short texts have no repeats; a NULL id comes last; rows equal in id and text are one
document, whose result appears for each; overlapping repeats count. Where a text is cut for further use, a
character is kept unless all of its bytes repeat.
"""

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roster.llm.batches import mixed, slices, text_bytes, unused
from roster.llm.suffix_array import common_prefixes, packed_words, suffix_array
from roster.llm.words import SpanHasher
from roster.session import freeze

LENGTH = 100
GRAM = 24
BUCKETS_A_TASK = 4  # at least, so that tasks get even shares
_SLOTS = 24  # bits of a gram's hash that tell common ones
_SECOND_BASE = 0xD6E8FEB86659FD93
_LAST = (1 << 63) - 1

_DOC = np.dtype([("id", "<i8"), ("mark", "<i8")])
_ANCHOR = np.dtype([("key", "<u8"), ("print", "<u8"), ("doc", "<u4"), ("start", "<u4"), ("more", "u1")])
_SPAN = np.dtype([("start", "<u4"), ("length", "<u4")])
_WANTED = np.dtype([("key", "<u8"), ("start", "<u4"), ("length", "<u4")])


@dataclass(frozen=True)
class Limits:
    """Sizes that bound memory and spread load; no result depends on them."""

    piece: int = 1 << 19  # bytes of one long text that are searched at once
    flush: int = 1 << 18  # fragments that a task gathers before it deals them out
    bucket_bytes: int = 64 << 20  # of text whose anchors make one bucket
    sorted_bytes: int = 1 << 20  # of fragments in one suffix array
    cut_bytes: int = 8 << 20  # of fragments that a task cuts before it deals them out
    sample: int = 2048  # documents that tell common grams
    common: int = 8  # documents of the sample that make a gram common


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values, in time linear in their number."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    forth = np.minimum.accumulate(padded.reshape(blocks, width), axis=1).reshape(-1)
    back = np.minimum.accumulate(padded.reshape(blocks, width)[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], forth[width - 1 : width - 1 + n])


def fragments(data: np.ndarray, offsets: np.ndarray, common: np.ndarray) -> np.ndarray:
    """(key, print, doc, start, more) of the fragments of texts; a fragment has ``LENGTH + more`` bytes."""
    if len(data) < LENGTH:
        return np.zeros(0, _ANCHOR)
    hasher = SpanHasher(data)
    grams = hasher.windows(GRAM)
    ranks = grams >> np.uint64(1)
    ranks[common[(grams >> np.uint64(64 - _SLOTS)).astype(np.int64)]] |= np.uint64(1 << 63)
    places = np.arange(len(grams), dtype=np.uint64)
    bits = np.uint64(max(1, int(len(grams)).bit_length()))
    least = _window_minima((ranks >> bits << bits) | places, LENGTH - GRAM + 1)
    anchors = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    valid = np.zeros(len(anchors) + 1, bool)
    doc = np.zeros(len(anchors), np.int32)
    begins = np.zeros(len(anchors) + 1, bool)
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        if b - a >= LENGTH:
            valid[a : b - LENGTH + 1] = True
            doc[a : b - LENGTH + 1] = i
            begins[a] = True
    new = begins[:-1].copy()
    new[1:] |= anchors[1:] != anchors[:-1]
    starts = np.flatnonzero(new & valid[:-1])
    ends = np.empty(len(starts), np.int64)
    if len(starts):
        stops = np.flatnonzero(~valid)  # there is one behind the last window
        ends[:-1] = starts[1:]
        ends[-1] = len(anchors)
        ends = np.minimum(ends, stops[np.searchsorted(stops, starts)])
    found = np.zeros(len(starts), _ANCHOR)
    found["key"] = grams[anchors[starts]]
    found["print"] = SpanHasher(data, _SECOND_BASE)(starts, ends + LENGTH - 1)
    found["doc"] = doc[starts]
    found["start"] = starts - offsets[:-1][doc[starts]]
    found["more"] = ends - starts - 1
    return found


def _common_grams(docs: DataFrame, limits: Limits) -> np.ndarray:
    """Slots of gram hashes that some documents of a bounded sample hold. One task counts the sample."""
    n = docs.count()
    share = min(1.0, limits.sample / max(1, n))
    sample = docs.where(F.pmod(F.xxhash64("id", "mark"), F.lit(1 << 30)) < int(share * (1 << 30)))

    def counted(batches):
        counts = np.zeros(1 << _SLOTS, np.uint16)
        for part in slices(batches, "text"):
            data, offsets = text_bytes(part.column("text"))
            for a, b in zip(offsets, offsets[1:]):
                grams = SpanHasher(data[a:b]).windows(GRAM)
                counts[np.unique(grams >> np.uint64(64 - _SLOTS)).astype(np.int64)] += 1
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(counts >= limits.common).tobytes()], pa.binary())], ["common"])

    found = sample.select("text").repartition(1).mapInArrow(counted, "common binary").first()
    packed = np.frombuffer(found.common, np.uint8) if found else np.zeros(1 << _SLOTS - 3, np.uint8)
    return np.unpackbits(packed).astype(bool)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed value, each column of a record array by itself."""
    parts = []
    for array in arrays:
        columns = [array[name] for name in array.dtype.names] if array.dtype.names else [array]
        parts.append(np.array([len(array)], "<i8").tobytes())
        parts += [np.ascontiguousarray(c).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpacked(value: bytes, *kinds: np.dtype) -> list[np.ndarray]:
    data, at, arrays = zstandard.ZstdDecompressor().decompress(value), 0, []
    for kind in kinds:
        n = int(np.frombuffer(data, "<i8", 1, at)[0])
        at += 8
        array = np.zeros(n, kind)
        for name in kind.names or [None]:
            column = kind[name] if name else kind
            read = np.frombuffer(data, column, n, at)
            at += n * column.itemsize
            if name:
                array[name] = read
            else:
                array = read
        arrays.append(array)
    return arrays


class _Dealer:
    """Gathers fragments of a task and deals them to buckets, each equal fragment once."""

    def __init__(self, buckets: int):
        self.buckets, self.docs, self.found, self.held = buckets, [], [], 0

    def add(self, docs: np.ndarray, found: np.ndarray) -> None:
        found = found.copy()
        found["doc"] += sum(map(len, self.docs))
        self.docs.append(docs)
        self.found.append(found)
        self.held += len(found)

    def flush(self):
        if not self.held:
            self.docs = []
            return
        docs, found = np.concatenate(self.docs), np.concatenate(self.found)
        self.docs, self.found, self.held = [], [], 0
        first, repeats = _first_places(docs, found)
        bucket = (mixed(found["key"]) % np.uint64(self.buckets)).astype(np.int64)
        bucket[repeats] = mixed(docs["id"][found["doc"][repeats]].view(np.uint64)) % np.uint64(self.buckets)
        is_first = np.zeros(len(found), bool)
        is_first[first] = True
        dealt = np.concatenate([first, repeats])  # not what repeats a row of the table in the same place
        order = dealt[np.argsort(bucket[dealt], kind="stable")]
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            own, again = found[part[is_first[part]]], found[part[~is_first[part]]]
            yield int(bucket[part[0]]), _packed(*_local(docs, own), *_local(docs, again))


def _local(docs: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The documents that are mentioned, and the fragments with places among those instead."""
    used, places = np.unique(found["doc"], return_inverse=True)
    found = found.copy()
    found["doc"] = places
    return docs[used], found


def _order_of(docs: np.ndarray) -> np.ndarray:
    """A number for each document that rises with (id, mark) and is shared by equal ones."""
    order = np.lexsort((docs["mark"], docs["id"]))
    ordered = docs[order]
    new = np.concatenate([np.zeros(min(1, len(docs)), bool), ordered[1:] != ordered[:-1]])
    ranks = np.empty(len(docs), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def _first_places(docs: np.ndarray, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of fragments with equal key and print: the one in the first place, and those in later places."""
    place = (_order_of(docs)[found["doc"]] << np.int64(32)) | found["start"].astype(np.int64)
    order = np.lexsort((place, found["print"], found["key"]))
    keys, prints, places = found["key"][order], found["print"][order], place[order]
    new = np.ones(len(order), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (prints[1:] != prints[:-1])
    heads = np.flatnonzero(new)
    later = places != places[heads][np.cumsum(new) - 1] if len(order) else new
    return order[heads], order[later]


def _merged(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that touch or overlap as one."""
    if not len(starts):
        return starts, lengths
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order].astype(np.int64), np.maximum.accumulate((starts + lengths)[order].astype(np.int64))
    new = np.concatenate([[True], starts[1:] > ends[:-1]])
    heads = np.flatnonzero(new)
    return starts[heads], ends[np.append(heads[1:] - 1, len(ends) - 1)] - starts[heads]


def _rows_of(docs: np.ndarray, repeats: np.ndarray, wanted: np.ndarray) -> pa.RecordBatch:
    """One row for each document: its repeats as spans, and the fragments of it that must be sorted."""
    # Documents are laid out far from each other on one line, so that spans merge within each.
    apart = repeats["doc"].astype(np.int64) << np.int64(33)
    starts, lengths = _merged(apart + repeats["start"].astype(np.int64), repeats["more"].astype(np.int64) + LENGTH)
    spans = np.zeros(len(starts), _SPAN)
    spans["start"], spans["length"] = starts & ((1 << 33) - 1), lengths
    wanted = wanted[np.argsort(wanted["doc"], kind="stable")]
    more = np.zeros(len(wanted), _WANTED)
    more["key"], more["start"], more["length"] = wanted["key"], wanted["start"], wanted["more"].astype(np.int64) + LENGTH
    span_docs = starts >> np.int64(33)
    used = np.unique(np.concatenate([span_docs, wanted["doc"].astype(np.int64)]))
    columns = [pa.array(docs["id"][used]), pa.array(docs["mark"][used])]
    columns += [_binaries(spans, np.searchsorted(span_docs, used)), _binaries(more, np.searchsorted(wanted["doc"], used))]
    return pa.RecordBatch.from_arrays(columns, ["id", "mark", "spans", "wanted"])


def _binaries(rows: np.ndarray, begins: np.ndarray) -> pa.Array:
    """A binary column of runs of ``rows``, each from its begin to the next."""
    offsets = (np.append(begins, len(rows)) * rows.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(rows.tobytes())])


def _by_bucket(batches):
    """Values of a task sorted by bucket, all of one bucket together."""
    held, current = [], None
    for batch in batches:
        for bucket, value in zip(batch.column("bucket").to_pylist(), batch.column("value").to_pylist()):
            if held and bucket != current:
                yield held
                held = []
            current = bucket
            held.append(value)
    if held:
        yield held


def _stacked(docs: list[np.ndarray], found: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    before = np.cumsum([0] + [len(d) for d in docs])
    moved = []
    for shift, rows in zip(before, found):
        rows = rows.copy()
        rows["doc"] += np.uint32(shift)
        moved.append(rows)
    return np.concatenate(docs), np.concatenate(moved)


def _judged(values: list[bytes]):
    """One bucket of anchors: later equal fragments are repeats, unequal ones under one anchor are wanted."""
    parts = [_unpacked(value, _DOC, _ANCHOR, _DOC, _ANCHOR) for value in values]
    docs, found = _stacked([p[0] for p in parts], [p[1] for p in parts])
    known_docs, known = _stacked([p[2] for p in parts], [p[3] for p in parts])
    first, later = _first_places(docs, found)
    keys = found["key"][first]
    alike = keys[1:] == keys[:-1]
    shared = np.concatenate([alike, [False]]) | np.concatenate([[False], alike]) if len(keys) else np.zeros(0, bool)
    every, again = _stacked([docs, known_docs], [found[later], known])
    return _rows_of(every, again, found[first[shared]])


def _pieces(data: np.ndarray, offsets: np.ndarray, piece: int):
    """(texts, offsets, place of the first text, byte at which it begins): long texts in overlapping pieces."""
    if len(data) <= 2 * piece:
        yield data, offsets, 0, 0
        return
    for i, (a, b) in enumerate(zip(offsets, offsets[1:])):
        for start in range(int(a), max(int(a) + 1, int(b) - LENGTH + 1), piece):
            end = min(int(b), start + piece + LENGTH - 1)
            yield data[start:end], np.array([0, end - start], np.int64), i, start - int(a)


def _marked(docs: DataFrame) -> DataFrame:
    """``id`` and ``mark``, never NULL: a NULL id is the largest, ``mark`` is a hash of the text."""
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(_LAST)).cast("long").alias("id"), F.xxhash64("text").alias("mark"), "text")


def find_repeats(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(id, mark, spans, wanted): for each document, in several rows, repeats and fragments to be sorted."""
    rows = _marked(docs)
    size = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("size")).first()["size"] or 0
    buckets = max(BUCKETS_A_TASK * _tasks(docs), size // limits.bucket_bytes)
    shared = docs.sparkSession.sparkContext.broadcast(_common_grams(rows, limits))

    def dealt(batches):
        dealer = _Dealer(buckets)
        for part in slices(batches, "text", limits.piece):
            ids = np.zeros(part.num_rows, _DOC)
            ids["id"], ids["mark"] = part.column("id").to_numpy(), part.column("mark").to_numpy()
            for data, offsets, first, start in _pieces(*text_bytes(part.column("text")), limits.piece):
                found = fragments(data, offsets, shared.value)
                found["start"] += np.uint32(start)
                dealer.add(ids[first : first + len(offsets) - 1], found)
            if dealer.held >= limits.flush:
                yield from _dealt_rows(dealer)
        yield from _dealt_rows(dealer)

    def judged(batches):
        for values in _by_bucket(batches):
            yield _judged(values)

    anchors = rows.select("id", "mark", "text").mapInArrow(dealt, "bucket long, value binary")
    together = anchors.repartition(_tasks(docs), "bucket").sortWithinPartitions("bucket")
    return together.mapInArrow(judged, "id long, mark long, spans binary, wanted binary")


def _tasks(docs: DataFrame) -> int:
    return int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _dealt_rows(dealer: _Dealer):
    for bucket, value in dealer.flush():
        yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([value], pa.binary())], ["bucket", "value"])


def _cut_out(batches, buckets: int, cut_bytes: int):
    """Wanted fragments with their bytes, dealt by anchor."""
    docs, found, texts, held = [], [], [], 0

    def flush():
        ids, rows = np.concatenate(docs), np.concatenate(found)
        bucket = (mixed(rows["key"]) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1):
            places = np.zeros(len(part), _SPAN)
            places["start"], places["length"] = rows["start"][part], rows["length"][part]
            data = np.frombuffer(b"".join([texts[i] for i in part]), np.uint8)
            value = _packed(ids[part], places, data)
            yield pa.RecordBatch.from_arrays([pa.array([int(bucket[part[0]])], pa.int64()), pa.array([value], pa.binary())], ["bucket", "value"])

    for part in slices(batches, "text"):
        data, offsets = text_bytes(part.column("text"))
        blob = data.tobytes()
        for i, lists in enumerate(part.column("wanted").to_pylist()):
            wanted = np.frombuffer(b"".join(lists or []), _WANTED)
            if not len(wanted):
                continue
            ids = np.zeros(len(wanted), _DOC)
            ids["id"], ids["mark"] = part.column("id")[i].as_py(), part.column("mark")[i].as_py()
            docs.append(ids)
            found.append(wanted)
            base = int(offsets[i])
            texts += [blob[base + s : base + s + n] for s, n in zip(wanted["start"].tolist(), wanted["length"].tolist())]
            held += int(wanted["length"].sum())
        if held > cut_bytes:
            yield from flush()
            docs, found, texts, held = [], [], [], 0
    if held:
        yield from flush()


def repeated_windows(docs: np.ndarray, places: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fragment, byte in it) of each window that is in an earlier place too, by a suffix array of all fragments."""
    lengths = places["length"].astype(np.int64)
    ends = np.cumsum(lengths + 1)
    symbols = np.zeros(int(ends[-1]), np.uint16)
    owner = np.repeat(np.arange(len(places)), lengths + 1)
    inside = np.ones(len(symbols), bool)
    inside[ends - 1] = False
    symbols[inside] = data.astype(np.uint16) + 1
    words = packed_words(symbols)
    order = suffix_array(symbols, words)
    whole = ends[owner] - 1 - np.arange(len(symbols)) >= LENGTH
    order = order[whole[order]]
    alike = common_prefixes(order, words) >= LENGTH
    place = (_order_of(docs)[owner[order]] << np.int64(32)) | (places["start"].astype(np.int64) - (ends - lengths - 1))[owner[order]] + order
    heads = np.flatnonzero(~alike)
    earliest = np.minimum.reduceat(place, heads)[np.cumsum(~alike) - 1]
    again = np.sort(order[place > earliest])
    return owner[again], again - (ends - lengths - 1)[owner[again]]


def _sorted_spans(values: list[bytes]):
    """One bucket of fragments: the spans that its repeated windows cover, by document."""
    parts = [_unpacked(value, _DOC, _SPAN, np.dtype("u1")) for value in values]
    docs, places, data = (np.concatenate([p[i] for p in parts]) for i in range(3))
    owner, at = repeated_windows(docs, places, data)
    again = np.zeros(len(owner), _ANCHOR)
    again["start"] = places["start"][owner] + at
    order = np.lexsort((docs["mark"], docs["id"]))
    ordered = docs[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    ranks = np.empty(len(docs), np.int64)
    ranks[order] = np.cumsum(new) - 1
    again["doc"] = ranks[owner]
    return _rows_of(ordered[new], again, np.zeros(0, _ANCHOR))


def with_repeats(docs: DataFrame, limits: Limits = Limits()) -> tuple[DataFrame, str]:
    """All columns of ``docs`` and one more, whose name is given: packed (start, length) of repeated bytes."""
    id_, mark, spans, more_spans, fragments_wanted = unused(docs.columns, "_id", "_mark", "_spans", "_more", "_wanted")
    found = freeze(find_repeats(docs, limits), "repeats")
    wanted_bytes = F.octet_length("wanted").cast("long") * (LENGTH + 40) / _WANTED.itemsize
    buckets = max(BUCKETS_A_TASK * _tasks(docs), int((found.agg(F.sum(wanted_bytes).alias("size")).first()["size"] or 0) // limits.sorted_bytes))
    keyed = docs.withColumns({id_: F.coalesce("doc_id", F.lit(_LAST)).cast("long"), mark: F.xxhash64("text")})
    by_doc = found.groupBy(F.col("id").alias(id_), F.col("mark").alias(mark)).agg(
        F.collect_list("spans").alias(spans), F.collect_list("wanted").alias(fragments_wanted)
    )
    cut = keyed.join(by_doc, [id_, mark], "left")

    def dealt(batches):
        yield from _cut_out(batches, buckets, limits.cut_bytes)

    def sorted_spans(batches):
        for values in _by_bucket(batches):
            yield _sorted_spans(values)

    texts = cut.select(F.col(id_).alias("id"), F.col(mark).alias("mark"), "text", F.col(fragments_wanted).alias("wanted"))
    cut_out = texts.mapInArrow(dealt, "bucket long, value binary")
    together = cut_out.repartition(_tasks(docs), "bucket").sortWithinPartitions("bucket")
    more = together.mapInArrow(sorted_spans, "id long, mark long, spans binary, wanted binary")
    more = more.groupBy(F.col("id").alias(id_), F.col("mark").alias(mark)).agg(F.collect_list("spans").alias(more_spans))
    none = F.array().cast("array<binary>")
    both = F.concat(F.coalesce(spans, none), F.coalesce(more_spans, none)).alias(spans)
    return cut.join(more, [id_, mark], "left").select(*docs.columns, both), spans


def _spans_of(lists: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    spans = np.frombuffer(b"".join(lists), _SPAN)
    return _merged(spans["start"].astype(np.int64), spans["length"].astype(np.int64))


def repeats_report(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and ``spans`` (start, end) of every row."""

    found, spans_column = with_repeats(docs.select("doc_id", "text"), limits)

    def reported(batches):
        for part in slices(batches, "text"):
            data, offsets = text_bytes(part.column("text"))
            rows = []
            for a, b, lists in zip(offsets, offsets[1:], part.column(spans_column).to_pylist()):
                starts, lengths = _spans_of(lists)
                kept = _without(data[a:b], starts, lengths)
                pairs = [[int(s), int(s + n)] for s, n in zip(starts, lengths)]
                rows.append((int(b - a), int(lengths.sum()), len(starts), hashlib.sha256(kept.tobytes()).hexdigest(), pairs))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())))
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), *columns], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<array<long>>"
    return found.mapInArrow(reported, schema)


def _without(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    if not len(starts):
        return data
    keep = np.ones(len(data), bool)
    for start, length in zip(starts, lengths):
        keep[start : start + length] = False
    return data[keep]


def drop_repeats(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """``docs`` with repeated bytes cut from ``text``, by whole characters; other columns as they are."""
    names = docs.columns
    found, spans_column = with_repeats(docs, limits)

    def cut(batches):
        for part in slices(batches, "text"):
            data, offsets = text_bytes(part.column("text"))
            texts = []
            for a, b, lists, null in zip(offsets, offsets[1:], part.column(spans_column).to_pylist(), part.column("text").is_null()):
                texts.append(None if null.as_py() else _without_characters(data[a:b], *_spans_of(lists)))
            columns = [pa.array(texts, pa.string()) if name == "text" else part.column(name) for name in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return found.mapInArrow(cut, docs.schema)


def _without_characters(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> str:
    further = np.append((data & 0xC0) == 0x80, False)
    trimmed = []
    for start, end in zip(starts.tolist(), (starts + lengths).tolist()):
        while start < end and further[start]:
            start += 1
        while end > start and further[end]:
            end -= 1
        trimmed.append((start, end - start))
    pairs = np.array(trimmed, np.int64).reshape(-1, 2)
    return _without(data, pairs[:, 0], pairs[:, 1]).tobytes().decode("utf-8", "replace")
