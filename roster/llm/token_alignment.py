"""Align the tokens of two tokenizers over the same bytes.

Both tokenizers cut the bytes of a text, with one space before it, into tokens. A place where a token of
either ends is a common boundary; common boundaries cut both rows of tokens into groups. Two tokens are
linked when their byte ranges overlap.

1. The common boundaries of a text are found by a galloping intersection: every end in the shorter list is
   looked for in the longer one, from a guess in steps that double, then by halving the range found. The rank
   of an end among the others gives the overlaps: differences of ranks are the ranges of linked tokens.
2. Texts are taken in blocks. A block names each pair of ids that its texts link once, with the number of texts;
   these numbers are summed by Spark, and the most frequent partner of each id of the first tokenizer is found.
3. The sums go back to the blocks that named the pair, where the links of each text are counted.

Nothing is broadcast, and a task holds one block. A pair that all blocks have is one row for each of them.

Defined results: a text that is NULL or empty has no tokens, nor has one whose tokens of either tokenizer do
not spell its bytes; its numbers are 0 and its digest is ''. Rows with equal ids are rows of their own, and
each counts as a document. A NULL id stays NULL. Extra columns are not carried.
"""

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roster.llm.batches import slices
from roster.session import freeze

BLOCK_BYTES = 16 << 20

_STORED = """block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,
    links binary, pairs array<long>, seen array<long>"""
_COUNTED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Spelling:
    """The bytes of every id."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self._begins = np.cumsum(self.sizes) - self.sizes
        self._flat = np.frombuffer(b"".join(tokens), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        upto = np.cumsum(sizes)
        total = int(upto[-1]) if len(upto) else 0
        return self._flat[np.repeat(self._begins[ids] - upto + sizes, sizes) + np.arange(total)]


class ByteTokenizer:
    """Byte-level pair encoding, from a file of ranks; texts begin with a space. Names of special tokens are text."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self._encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.spelling = Spelling(tokens)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        encode = self._encoding.encode_to_numpy
        return [encode(f" {text}", allowed_special=set(), disallowed_special=()).astype(np.int64) for text in texts]


class PieceTokenizer:
    """Pieces with byte fallback, from a model file that puts the space before a text itself."""

    def __init__(self, path: str):
        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self._model.get_piece_size())
        self.spelling = Spelling([self._bytes(i) for i in ids])

    def _bytes(self, i: int) -> bytes:
        piece = self._model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self._model.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, np.int64) for ids in self._model.encode(texts, num_threads=1)]


class Pair(NamedTuple):
    """What names the two tokenizers: files and the pattern of the first."""

    ranks: str
    pattern: str
    pieces: str


@lru_cache(maxsize=2)
def _tokenizers(pair: Pair) -> tuple[ByteTokenizer, PieceTokenizer]:
    return ByteTokenizer(pair.ranks, pair.pattern), PieceTokenizer(pair.pieces)


@lru_cache(maxsize=2)
def _names(pair: Pair) -> list[bytes]:
    """Every id as decimal, followed by a comma, by a bar, and by a semicolon."""
    n = max(len(t.spelling.sizes) for t in _tokenizers(pair))
    return [b"%d%b" % (i, sign) for sign in (b",", b"|", b";") for i in range(n)]


def gallop(keys: np.ndarray, among: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each key the first place in the ascending ``among`` that is not below it, looked for from ``guess`` on."""
    n = len(among)
    low, high = guess - 1, guess.copy()  # below low all are smaller, from high on none is
    for end, sign in ((low, -1), (high, 1)):
        step = 1
        while True:
            inside = np.flatnonzero((end >= 0) & (end < n))
            away = inside[(among[end[inside]] >= keys[inside]) if sign < 0 else (among[end[inside]] < keys[inside])]
            if not len(away):
                break
            (high if sign < 0 else low)[away] = end[away]
            end[away] += sign * step
            step *= 2
    low, high = np.maximum(low, -1), np.minimum(high, n)
    while len(wide := np.flatnonzero(high - low > 1)):
        middle = (low[wide] + high[wide]) // 2
        small = among[middle] < keys[wide]
        low[wide[small]] = middle[small]
        high[wide[~small]] = middle[~small]
    return high


class Alignment(NamedTuple):
    """Of two ascending lists of ends: the linked tokens in order, and which tokens end at a common boundary."""

    first: np.ndarray
    second: np.ndarray
    first_common: np.ndarray
    second_common: np.ndarray


def align_ends(short: np.ndarray, long: np.ndarray, guess: np.ndarray) -> Alignment:
    """Both lists end at the same place."""
    rank = gallop(short, long, guess)
    common = long[rank] == short
    hit = np.zeros(len(long), bool)
    hit[rank[common]] = True
    back = np.cumsum(np.bincount(rank, minlength=len(long))) - hit  # ends in the short list below each one in the long list
    alone = np.flatnonzero(~hit)
    alone_before = np.cumsum(~hit) - ~hit
    at_short = np.arange(len(short)) + alone_before[rank]
    at_long = back[alone] + alone_before[alone]
    first, second = (np.empty(len(short) + len(alone), np.int64) for _ in range(2))
    first[at_short], second[at_short] = np.arange(len(short)), rank
    first[at_long], second[at_long] = back[alone], alone
    return Alignment(first, second, common, hit)


class _Texts(NamedTuple):
    """Ids of several texts one after the other, and how many each has."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray


def _encoded(texts: list[str], pair: Pair) -> tuple[_Texts, np.ndarray]:
    """The tokens of the texts that both tokenizers spell as they are, and which texts these are."""
    first, second = _tokenizers(pair)
    ids = [first.encode(texts), second.encode(texts)]
    raw = [f" {text}".encode() for text in texts]
    sizes = np.array([len(r) for r in raw])
    right = np.ones(len(texts), bool)
    for tokenizer, found in zip((first, second), ids):
        spelled = [tokenizer.spelling.spell(i) for i in found]
        right &= np.array([len(s) for s in spelled]) == sizes
        right &= np.array([s.tobytes() == r for s, r in zip(spelled, raw)])
    kept = np.flatnonzero(right)
    a, b = ([found[i] for i in kept] for found in ids)
    counts = [np.array([len(x) for x in found], np.int64) for found in (a, b)]
    return _Texts(*(np.concatenate([np.zeros(0, np.int64), *found]) for found in (a, b)), *counts), kept


def _starts(counts: np.ndarray) -> np.ndarray:
    return np.cumsum(counts) - counts


def _guess(n_short: np.ndarray, n_long: np.ndarray) -> np.ndarray:
    """As far into a text's longer list as the place is into its shorter one."""
    place = np.arange(n_short.sum()) - np.repeat(_starts(n_short), n_short)
    return np.repeat(_starts(n_long), n_short) + place * np.repeat(n_long, n_short) // np.maximum(np.repeat(n_short, n_short), 1)


def _aligned(texts: _Texts, pair: Pair) -> Alignment:
    """``first`` are tokens of the first tokenizer; in every text the shorter list drives the search."""
    tokenizers = _tokenizers(pair)
    sizes = [t.spelling.sizes[ids] for t, ids in zip(tokenizers, (texts.a, texts.b))]
    ends = [np.cumsum(s) for s in sizes]
    parts, order = [], []
    for swapped in (False, True):
        mine = (texts.n_b < texts.n_a) == swapped
        counts = (texts.n_a * mine, texts.n_b * mine)
        at = [np.flatnonzero(np.repeat(mine, n)) for n in (texts.n_a, texts.n_b)]
        if not len(at[0]):
            continue
        s, l = (1, 0) if swapped else (0, 1)
        found = align_ends(ends[s][at[s]], ends[l][at[l]], _guess(counts[s], counts[l]))
        if swapped:
            found = Alignment(found.second, found.first, found.second_common, found.first_common)
        parts.append((at, found))
    common = [np.zeros(len(e), bool) for e in ends]
    for at, found in parts:
        common[0][at[0]], common[1][at[1]] = found.first_common, found.second_common
        order.append((at[0][found.first], at[1][found.second]))
    first, second = (np.concatenate([np.zeros(0, np.int64), *(o[i] for o in order)]) for i in (0, 1))
    if len(order) > 1:
        sorted_ = np.argsort(first, kind="stable")
        first, second = first[sorted_], second[sorted_]
    return Alignment(first, second, *common)


def _digests(texts: _Texts, found: Alignment, pair: Pair) -> list[str]:
    """The groups of each text as ``a1,a2|b1;a3|b2``, hashed."""
    names = _names(pair)
    n = len(names) // 3
    a_group, b_group = (np.cumsum(c) - c for c in (found.first_common, found.second_common))
    b_starts = np.concatenate([[0], np.flatnonzero(found.second_common) + 1])
    a_ends = np.flatnonzero(found.first_common) + 1
    codes = np.empty(len(texts.a) + len(texts.b), np.int64)
    codes[np.arange(len(texts.a)) + b_starts[a_group]] = texts.a + n * found.first_common
    codes[np.arange(len(texts.b)) + a_ends[b_group]] = texts.b + 2 * n * found.second_common
    ends = np.cumsum(texts.n_a + texts.n_b).tolist()
    digests = []
    for start, end in zip([0, *ends], ends):
        text = b"".join(map(names.__getitem__, codes[start:end].tolist()))
        digests.append(hashlib.sha256(text[:-1]).hexdigest())
    return digests


def _width(pair: Pair) -> int:
    """A pair of ids is the first one times this, plus the second one."""
    return len(_tokenizers(pair)[1].spelling.sizes)


def align_texts(texts: list[str | None], pair: Pair) -> list[tuple[int, int, int, str, np.ndarray] | None]:
    """For each text the numbers of tokens and groups, the digest of the groups, and the pairs of ids it links, in order."""
    filled = [i for i, text in enumerate(texts) if text]
    out: list = [None] * len(texts)
    encoded, kept = _encoded([texts[i] for i in filled], pair)
    if not len(kept):
        return out
    found = _aligned(encoded, pair)
    codes = encoded.a[found.first] * _width(pair) + encoded.b[found.second]
    a_starts, a_ends = _starts(encoded.n_a), np.cumsum(encoded.n_a)
    bounds = np.searchsorted(found.first, np.append(a_starts, len(encoded.a)))
    upto = np.concatenate([[0], np.cumsum(found.first_common)])
    groups = upto[a_ends] - upto[a_starts]
    digests = _digests(encoded, found, pair)
    for k, i in enumerate(kept):
        links = codes[bounds[k] : bounds[k + 1]]
        out[filled[i]] = (int(encoded.n_a[k]), int(encoded.n_b[k]), int(groups[k]), digests[k], links)
    return out


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The counts of equal pairs summed."""
    pairs, where = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    return pairs, np.bincount(where, np.concatenate([s for _, s in parts]), len(pairs)).astype(np.int64)


def _alignments(docs: DataFrame, pair: Pair, block_bytes: int) -> DataFrame:
    """A row for each text, and for each block a row of the pairs it links with their numbers of texts."""

    def stored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, size = TaskContext.get().partitionId() << 32, [], 0
        for part in slices(batches, "text"):
            texts = part.column("text").to_pylist()
            aligned = align_texts(texts, pair)
            yield _rows(block, part.column("doc_id"), aligned)
            links = [a[4] for a in aligned if a]
            if links:
                texts_of = np.repeat(np.arange(len(links)), [len(x) for x in links])
                held.append(_distinct(texts_of, np.concatenate(links)))
                if len(held) > 64:
                    held = [_added(held)]
            size += part.column("text").nbytes
            if size >= block_bytes:
                yield from _pair_rows(block, held)
                block, held, size = block + 1, [], 0
        yield from _pair_rows(block, held)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(stored, _STORED)


def _distinct(texts_of: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair with the number of texts that have it."""
    pairs, where = np.unique(codes, return_inverse=True)
    once = np.unique(texts_of * len(pairs) + where)
    return pairs, np.bincount(once % len(pairs), minlength=len(pairs))


def _rows(block: int, doc_ids: pa.Array, aligned: list) -> pa.RecordBatch:
    n = len(aligned)
    numbers = [[a[i] if a else 0 for a in aligned] for i in range(3)]
    links = [a[4] if a else np.zeros(0, np.int64) for a in aligned]
    packed = [x.astype("<u4" if not len(x) or x.max() >> 32 == 0 else "<u8") for x in links]
    columns = [
        pa.array([block] * n, pa.int64()),
        doc_ids,
        *(pa.array(values, pa.int64()) for values in (*numbers, [len(x) for x in links])),
        pa.array([a[3] if a else "" for a in aligned], pa.string()),
        pa.array([x.tobytes() for x in packed], pa.binary()),
        pa.nulls(n, pa.list_(pa.int64())),
        pa.nulls(n, pa.list_(pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, _field_names(_STORED))


def _pair_rows(block: int, held: list) -> Iterator[pa.RecordBatch]:
    if not held:
        return
    pairs, seen = _added(held)
    texts = [pa.nulls(1, t) for t in (pa.int64(),) * 5 + (pa.string(), pa.binary())]
    lists = [pa.array([values], pa.list_(pa.int64())) for values in (pairs, seen)]
    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *texts[:5], *texts[5:], *lists], _field_names(_STORED))


def _field_names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(",")]


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, the answers to a block before its texts."""
    block = None
    for batch in batches:
        blocks, asked = batch.column("block").to_pylist(), batch.column("pairs")
        out: list[list] = [[] for _ in range(8)]
        given = list(zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links"))))
        digests, links = batch.column("groups_sha256"), batch.column("links")
        for i in range(batch.num_rows):
            if asked[i].is_valid:
                pairs, counts, best = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("pairs", "counts", "best"))
                order = np.argsort(pairs)
                block, pairs, counts, best = blocks[i], pairs[order], counts[order], best[order]
                continue
            n_links, chosen, total = given[i][4], 0, 0
            if n_links:
                assert block == blocks[i], f"block {blocks[i]} has no counts"
                raw = links[i].as_buffer()
                at = np.searchsorted(pairs, np.frombuffer(raw, f"<u{raw.size // n_links}").astype(np.int64))
                chosen, total = int(best[at].sum()), int(counts[at].sum())
            for column, value in zip(out, (*given[i], chosen, total, digests[i].as_py())):
                column.append(value)
        if out[0]:
            types = [pa.int64()] * 7 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], _field_names(_COUNTED))


def align_documents(docs: DataFrame, pair: Pair, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row for each document: tokens, groups and links, and how frequent its links are in the corpus.

    The count of a pair of ids is the number of documents that link it. ``n_best`` are the links to the
    partner with which an id of the first tokenizer has its highest count, ``count_sum`` is the sum over links.
    """
    width = _width(pair)
    stored = freeze(_alignments(docs, pair, block_bytes), "alignments")
    named = F.explode(F.arrays_zip("pairs", "seen")).alias("x")
    asked = stored.where(F.col("pairs").isNotNull()).select("block", named).select("block", "x.pairs", "x.seen")
    first = F.expr(f"pairs div {width}L").alias("first")
    summed = freeze(asked.groupBy("pairs").agg(F.sum("seen").alias("count")).select("pairs", first, "count"), "pair-counts")
    highest = summed.groupBy("first").agg(F.max("count").alias("highest"))
    known = summed.join(highest, "first").select("pairs", "count", (F.col("count") == F.col("highest")).alias("best"))
    answer = F.collect_list(F.struct("pairs", "count", "best")).alias("x")
    answers = asked.join(freeze(known, "known-pairs"), "pairs").groupBy("block").agg(answer)
    answers = answers.select("block", F.lit(0).alias("kind"), "x.pairs", F.col("x.count").alias("counts"), "x.best")
    texts = stored.where(F.col("pairs").isNull()).drop("pairs", "seen").withColumn("kind", F.lit(1))
    both = answers.unionByName(texts, allowMissingColumns=True)
    return both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(_counted, _COUNTED)
