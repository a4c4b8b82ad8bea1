"""Cross-entropy difference of two word models, whose counts grow with the corpus.

A document's score is its mean loss per token under the model of a target minus that under the background
model, in bits: the lower, the more it is like the target. Tokens are words: runs of letters and digits in lower case, in
any script; a character of three or four bytes, as in scripts without blanks, and any other sign is a word of
its own. The models are of order 2, interpolated (Witten-Bell), over one vocabulary: all words of the
corpus and one for the unseen. Counts of all words and pairs of the corpus are taken, without a bound.

Rows are written down in blocks of about ``BLOCK_BYTES`` of text. Each block counts its distinct pairs and deals
them by their first word to buckets, packed. A bucket so has all that follows a word: it adds up the blocks, and
answers each with the corpus's counts in the order asked, so no key is sent back and a frequent pair is sent once
a block. What follows a word of more than ``PIECE`` tokens is dealt to several buckets by the second word; the block
adds their parts. The driver holds these words only: at most 2**20, as a piece grows with a corpus over 2**38 tokens.

Defined results: NULL and empty texts and texts of blanks have 0 tokens and NULL losses and score; a document
named several times as target counts once; rows with equal ids all count; without a target its model is uniform.
A document of the target is scored by a model that it is part of. Words are compared by 64-bit hashes, second
words of one first word by 48 bits of theirs.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roster.llm.batches import mixed, slices, text_bytes
from roster.llm.words import span_hashes
from roster.session import scratch_path

BLOCK_BYTES = 8 << 20
BUCKET_TOKENS = 3 << 20
PIECE = 1 << 18
MOST_TASKS = 1 << 16
# A text's begin as a context, and the second word of a row that stands for a word alone.
BEGIN, ALONE = np.uint64(1), np.uint64(0)
_BLANK, _WORD, _SIGN, _WIDE = 0, 1, 2, 3
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[:0x21] = _BLANK
_KIND[0x7F] = _BLANK
_KIND[[c for c in range(128) if chr(c).isalnum()]] = _WORD
_KIND[0x80:0xE0] = _WORD
_KIND[0xE0:] = _WIDE

_STORED = "block long, doc_id long, text string, target boolean, tokens long, words array<long>, times array<long>"
_DEALT = "bucket long, block long, heads binary, seconds binary, counts binary"
_TOTALS = ["size_background", "size_target", "kinds_background", "kinds_target"]
_ANSWERS = "bucket long, block long, counts binary, " + ", ".join(f"{name} long" for name in _TOTALS)
_COUNTS = "first long, second long, background long, target long, n_background long, n_target long, k_background long, k_target long"
SCORES = "doc_id long, n_tokens long, loss_target double, loss_background double, score double"


def words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, of the words before them, and the offsets of the texts among them."""
    data, offsets = text_bytes(pc.utf8_lower(column.cast(pa.string())))
    kind = _KIND[data]
    lead = data >= 0xE0
    for back in (1, 2, 3):
        size = 0xF0 if back == 3 else 0xE0
        kind[back:][data[: len(data) - back] >= size] = _WIDE
    begins = np.ones(len(data), bool)
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _SIGN) | lead[1:]
    begins[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.flatnonzero(begins)
    ends = np.concatenate([starts[1:], [len(data)]])[: len(starts)]
    some = kind[starts] != _BLANK
    starts, ends = starts[some], ends[some]
    found = np.maximum(span_hashes(data, starts, ends), np.uint64(2))
    places = np.searchsorted(starts, offsets)
    before = np.full(len(found), BEGIN)
    before[1:] = found[:-1]
    before[places[:-1][places[:-1] < len(found)]] = BEGIN
    return found, before, places


def _schema(fields: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "double": pa.float64()}
    kinds["array<long>"] = pa.list_(pa.int64())
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split() for field in fields.split(", "))])


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of counts in one compressed value, each in as few bytes a number as it needs."""
    small = [a.astype(np.min_scalar_type(int(a.max(initial=0)))) for a in arrays]
    sizes = np.array([x for a in small for x in (a.itemsize, len(a))], np.int64)
    return zstandard.ZstdCompressor(level=1).compress(b"".join([sizes.tobytes(), *(a.tobytes() for a in small)]))


def _unpacked(value: bytes, n: int) -> list[np.ndarray]:
    data, at, arrays = zstandard.ZstdDecompressor().decompress(value), 16 * n, []
    for size, count in np.frombuffer(data, np.int64, 2 * n).reshape(n, 2).tolist():
        arrays.append(np.frombuffer(data, f"<u{size}", count, at).astype(np.int64))
        at += size * count
    return arrays


def _added(groups: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(groups, values, n).astype(np.int64)


def _key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(mixed(first) + second)


def _runs(values: np.ndarray) -> np.ndarray:
    """True where a sorted value differs from the one before it."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return new


def _in_blocks(block_bytes: int):
    def block_row(number: int, held: list[np.ndarray]) -> pa.RecordBatch:
        tokens = np.concatenate(held)
        found, times = np.unique(tokens, return_counts=True)
        some = times << 20 >= len(tokens)  # a word of more tokens than a piece has this share in one block at least
        row = dict(block=number, tokens=len(tokens), words=found[some].astype(np.int64), times=times[some])
        return pa.RecordBatch.from_pylist([row], _schema(_STORED))

    def blocks(batches):
        number, size, held = TaskContext.get().partitionId() << 32, 0, []
        for part in slices(batches, "text"):
            n = part.num_rows
            size += part.column("text").nbytes
            found, before, _ = words(part.column("text"))
            held += [found, before[before == BEGIN]]
            columns = [pa.array(np.full(n, number)), *part.columns, *(pa.nulls(n, f.type) for f in list(_schema(_STORED))[-3:])]
            yield pa.RecordBatch.from_arrays(columns, schema=_schema(_STORED))
            if size >= block_bytes:
                yield block_row(number, held)
                number, size, held = number + 1, 0, []
        if held:
            yield block_row(number, held)

    return blocks


def marked_blocks(docs: DataFrame, targets: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every row with its block and whether it is a target, written down so that a row's block stands; and a row of words for each block."""
    spark = docs.sparkSession
    marks = targets.select("doc_id").where(F.col("doc_id").isNotNull()).distinct().withColumn("target", F.lit(True))
    rows = docs.select(F.col("doc_id").cast("long"), "text").join(marks.hint("merge"), "doc_id", "left")
    rows = rows.select("doc_id", "text", F.col("target").isNotNull().alias("target"))
    path = scratch_path(spark, "blocks")
    rows.mapInArrow(_in_blocks(block_bytes), _STORED).write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


class Dealing(NamedTuple):
    """How pairs are dealt: the number of buckets, and into how many pieces the pairs of frequent first words are cut."""

    buckets: int
    frequent: np.ndarray
    pieces: np.ndarray

    def pieces_of(self, first: np.ndarray) -> np.ndarray:
        pieces = np.ones(len(first), np.int64)
        if len(self.frequent):
            at = np.minimum(np.searchsorted(self.frequent, first), len(self.frequent) - 1)
            pieces = np.where(self.frequent[at] == first, self.pieces[at], pieces)
        return pieces

    def bucket(self, first: np.ndarray, piece: np.ndarray) -> np.ndarray:
        return (mixed(mixed(first) + piece.astype(np.uint64)) % np.uint64(self.buckets)).astype(np.int64)

    @property
    def tasks(self) -> int:
        return min(max(64, self.buckets // 4), MOST_TASKS)


def dealing(blocks: DataFrame, piece: int = PIECE) -> Dealing:
    rows = blocks.where(F.col("words").isNotNull())
    total = rows.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("n")).first().n
    piece = max(piece, total >> 20)
    named = rows.select("tokens", F.explode(F.arrays_zip("words", "times")).alias("x")).select("tokens", "x.words", "x.times")
    often = named.where(F.col("times") * F.lit(float(total)) >= F.col("tokens") * F.lit(float(piece)))
    found = often.groupBy("words").agg(F.sum("times").alias("n")).where(F.col("n") > piece).collect()
    hot = np.array([r.words for r in found], np.int64).astype(np.uint64)
    order = np.argsort(hot)
    pieces = np.array([-(-r.n // piece) for r in found], np.int64)
    return Dealing(max(64, total // BUCKET_TOKENS), hot[order], pieces[order])


class _Block:
    """The distinct pairs of a block and the words in them (heads), as they are dealt to buckets.

    An entry is a head in one of its buckets; its first bucket also takes the head's own counts. Entries
    are in the order of bucket and head, pairs (by ``order``) in that of their entries.
    """

    def __init__(self, before: np.ndarray, found: np.ndarray, inside: np.ndarray, deal: Dealing):
        key = _key(before, found)
        order = np.argsort(key)
        new = _runs(key[order])
        self.pair_of_token = np.empty(len(key), np.int64)
        self.pair_of_token[order] = np.cumsum(new) - 1
        chosen = order[new]
        first, self.second = before[chosen], found[chosen]
        n = len(chosen)
        self.every, self.target = np.bincount(self.pair_of_token, minlength=n), _added(self.pair_of_token, inside, n)
        self.heads = np.union1d(first, self.second)
        self.first_head, self.second_head = np.searchsorted(self.heads, first), np.searchsorted(self.heads, self.second)
        size = len(self.heads)
        pieces = deal.pieces_of(self.heads)
        more = np.repeat(np.arange(size), pieces - 1)
        piece = 1 + np.arange(len(more)) - np.repeat(np.cumsum(pieces - 1) - (pieces - 1), pieces - 1)
        home = deal.bucket(self.heads, np.zeros(size, np.int64))
        codes = np.unique(np.concatenate([home * size + np.arange(size), deal.bucket(self.heads[more], piece) * size + more]))
        self.entry_bucket, self.entry_head = codes // max(1, size), codes % max(1, size)
        self.own = home[self.entry_head] == self.entry_bucket
        cut = (self.second % pieces[self.first_head].astype(np.uint64)).astype(np.int64)
        entry = np.searchsorted(codes, deal.bucket(first, cut) * size + self.first_head)
        self.order = np.lexsort((key[chosen], entry))
        self.pairs_of_entry = np.bincount(entry, minlength=len(codes))

    def rows(self, number: int) -> Iterator[dict]:
        size = len(self.heads)
        alone = [np.where(self.own, _added(self.second_head, v, size)[self.entry_head], 0) for v in (self.every, self.target)]
        ends = np.concatenate([[0], np.cumsum(self.pairs_of_entry)])
        starts = np.flatnonzero(_runs(self.entry_bucket))
        for a, b in zip(starts, [*starts[1:], len(self.entry_bucket)]):
            pairs = self.order[ends[a] : ends[b]]
            yield dict(
                bucket=int(self.entry_bucket[a]),
                block=number,
                heads=self.heads[self.entry_head[a:b]].tobytes(),
                seconds=self.second[pairs].view(np.uint8).reshape(-1, 8)[:, :6].tobytes(),
                counts=_packed(*(v[a:b] for v in alone), self.pairs_of_entry[a:b], self.every[pairs], self.target[pairs]),
            )

    def answered(self, answers: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The corpus's counts of each head (its own, n and k, in both models) and of each pair, from the answers in the order of buckets."""
        parts = list(zip(*(_unpacked(a, 8) for a in answers)))
        heads = [_added(self.entry_head, np.concatenate(p), len(self.heads)) for p in parts[:6]]
        pairs = []
        for p in parts[6:]:
            values = np.empty(len(self.order), np.int64)
            values[self.order] = np.concatenate(p)
            pairs.append(values)
        return heads, pairs


def _asking(deal: Dealing):
    def asked(batches):
        held, number = [], None

        def rows():
            before, found, inside = (np.concatenate(x) for x in zip(*held))
            block = _Block(before, found, inside, deal)
            yield pa.RecordBatch.from_pylist(list(block.rows(number)), _schema(_DEALT))

        for part in slices(batches, "text"):
            ids = part.column("block").to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1), len(ids)]
            for a, b in zip(cuts, cuts[1:]):
                if held and number != ids[a]:
                    yield from rows()
                    held = []
                number = int(ids[a])
                own = part.slice(a, b - a)
                found, before, places = words(own.column("text"))
                inside = np.repeat(own.column("target").to_numpy(zero_copy_only=False).astype(np.int8), places[1:] - places[:-1])
                held.append((before, found, inside))
        if held:
            yield from rows()

    return asked


def asked_grams(blocks: DataFrame, deal: Dealing | None = None) -> DataFrame:
    """The distinct pairs of each block with their counts, a row for each bucket."""
    deal = deal or dealing(blocks)
    texts = blocks.where(F.col("words").isNull()).select("block", "text", "target")
    return texts.mapInArrow(_asking(deal), _DEALT).repartition(deal.tasks, "bucket")


class _Bucket:
    """The sums of what all blocks deal to one bucket."""

    def __init__(self, dealt: pa.Table):
        self.blocks = dealt.column("block").to_pylist()
        heads = [np.frombuffer(x, np.uint64) for x in dealt.column("heads").to_pylist()]
        seconds = [np.frombuffer(x, np.uint8).reshape(-1, 6) for x in dealt.column("seconds").to_pylist()]
        self.entry_ends, self.pair_ends = np.cumsum([len(h) for h in heads]), np.cumsum([len(s) for s in seconds])
        counts = zip(*(_unpacked(x, 5) for x in dealt.column("counts").to_pylist()))
        every, target, runs, pair_every, pair_target = (np.concatenate(c) for c in counts)
        self.heads, self.head_of_entry = np.unique(np.concatenate(heads), return_inverse=True)
        size = len(self.heads)
        second = np.zeros((len(pair_every), 8), np.uint8)
        second[:, :6] = np.concatenate(seconds)
        second = second.view(np.uint64).reshape(-1)
        first = np.repeat(self.head_of_entry, runs)
        key = _key(self.heads[first], second)
        order = np.argsort(key)
        new = _runs(key[order])
        self.place = np.empty(len(key), np.int64)
        self.place[order] = np.cumsum(new) - 1
        self.first, self.second = first[order[new]], second[order[new]]
        self.pairs = [_added(self.place, v, len(self.first)) for v in (pair_every, pair_target)]
        own = [_added(self.head_of_entry, v, size) for v in (every, target)]
        n = [_added(self.first, v, size) for v in self.pairs]
        k = [_added(self.first, v > 0, size) for v in self.pairs]
        self.of_heads = [*own, *n, *k]


def _answering(dealt: pa.Table) -> pa.Table:
    """For each block what it asked for, in its order; and the bucket's share of the totals."""
    bucket = _Bucket(dealt)
    number = dealt.column("bucket")[0].as_py()
    sizes, kinds = [int(v.sum()) for v in bucket.of_heads[:2]], [int((v > 0).sum()) for v in bucket.of_heads[:2]]
    rows = [dict(bucket=number, **dict(zip(_TOTALS, sizes + kinds)))]
    entry, pair = 0, 0
    for block, entries, pairs in zip(bucket.blocks, bucket.entry_ends, bucket.pair_ends):
        heads, places = bucket.head_of_entry[entry:entries], bucket.place[pair:pairs]
        counts = _packed(*(v[heads] for v in bucket.of_heads), *(v[places] for v in bucket.pairs))
        rows.append(dict(bucket=number, block=block, counts=counts))
        entry, pair = entries, pairs
    return pa.Table.from_pylist(rows, _schema(_ANSWERS))


def _counting(dealt: pa.Table) -> pa.Table:
    bucket = _Bucket(dealt)
    none = np.zeros(len(bucket.first), np.int64)
    first = np.concatenate([bucket.heads, bucket.heads[bucket.first]]).astype(np.int64)
    second = np.concatenate([np.full(len(bucket.heads), ALONE), bucket.second]).astype(np.int64)
    counts = [np.concatenate([h, p]) for h, p in zip(bucket.of_heads, [*bucket.pairs, *[none] * 4])]
    return pa.Table.from_arrays([pa.array(c) for c in (first, second, *counts)], schema=_schema(_COUNTS))


def count_words(asked: DataFrame) -> DataFrame:
    """Counts of all pairs, and of words alone (``second`` is 0) also as contexts: n, how often; k, before how many words.

    For looking into a model; scores are taken from the buckets themselves.
    """
    counts = asked.groupBy("bucket").applyInArrow(_counting, _COUNTS)
    names = [field.split()[0] for field in _COUNTS.split(", ")]
    return counts.groupBy(*names[:2]).agg(*[F.sum(name).alias(name) for name in names[2:]])


def _losses(pair, word, context, kinds, size: int, vocabulary: int) -> np.ndarray:
    """Bits of each pair, from the counts of it, its word and its context in one model."""
    seen, different = context
    chance = (word + (kinds + 1) / (vocabulary + 1)) / (size + kinds + 1)
    chance = np.where(seen > 0, (pair + different * chance) / np.maximum(seen + different, 1), chance)
    return -np.log2(chance)


def score_by_words(docs: DataFrame, targets: DataFrame, block_bytes: int = BLOCK_BYTES, piece: int = PIECE) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``loss_target``, ``loss_background`` and ``score`` of every row."""
    spark = docs.sparkSession
    blocks = marked_blocks(docs, targets, block_bytes)
    deal = dealing(blocks, piece)
    path = scratch_path(spark, "answers")
    asked_grams(blocks, deal).groupBy("bucket").applyInArrow(_answering, _ANSWERS).write.parquet(path)
    answers = spark.read.parquet(path)
    total = answers.where(F.col("block").isNull()).agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in _TOTALS]).first().asDict()
    schema = _schema(SCORES)

    def scored(texts: pa.Table, answers: pa.Table) -> pa.Table:
        parts = [words(part.column("text")) for part in slices(texts.select(["text"]).to_batches(), "text")]
        n = np.concatenate([places[1:] - places[:-1] for _, _, places in parts])
        found, before = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        some, means = np.flatnonzero(n), [np.zeros(len(n)), np.zeros(len(n))]
        if len(some):
            block = _Block(before, found, np.zeros(len(found), np.int8), deal)
            heads, pairs = block.answered(answers.sort_by("bucket").column("counts").to_pylist())
            for i, m in ((0, "target"), (1, "background")):
                own, seen, different, pair = heads[1 - i], heads[3 - i], heads[5 - i], pairs[1 - i]
                context = seen[block.first_head], different[block.first_head]
                kinds, size = total[f"kinds_{m}"], total[f"size_{m}"]
                bits = _losses(pair, own[block.second_head], context, kinds, size, total["kinds_background"])
                starts = (np.cumsum(n) - n)[some]
                means[i][some] = np.add.reduceat(bits[block.pair_of_token], starts) / n[some]
        columns = [pa.array(v, mask=n == 0) for v in (*means, means[0] - means[1])]
        ids = texts.column("doc_id").combine_chunks().cast(pa.int64())
        return pa.Table.from_arrays([ids, pa.array(n), *columns], schema=schema)

    texts = blocks.where(F.col("words").isNull()).select("block", "doc_id", "text").repartition(deal.tasks, "block")
    asked = answers.where(F.col("block").isNotNull()).select("block", "bucket", "counts").repartition(deal.tasks, "block")
    return texts.groupBy("block").cogroup(asked.groupBy("block")).applyInArrow(scored, SCORES)
