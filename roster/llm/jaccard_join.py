"""N-gram Jaccard self-join by signature trees.

Two texts are linked when their sets of word shingles have at least ``percent`` per cent in common.

1. Equal sets are one class, however many texts have them; all that follows works on classes.
2. Classes that may be similar are brought together: each has ``bands`` keys made of ``ROWS`` minimum hashes,
   classes that share a key are one family, and families are closed over shared keys. The number of bands
   is such that a link is missed with a chance below ``MISS``.
3. In a family a tree is built over the sets. A node holds the OR of its sets' token bitmaps and the range
   of their sizes. Pairs of nodes are visited from the top; a pair is left when its sizes are too far apart,
   when the bits in common allow too small an overlap, or when all its sets are connected already. Pairs of
   sets that are left are compared exactly.
4. A family too large for one task is first compared with one of its members. Sets linked to that member
   are connected; by the triangle inequality of the Jaccard distance they can only link to the others if
   they are far enough from it. What is left is joined in blocks, two at a time.

Defined results: NULL and wordless texts have an empty set and are linked with nothing; rows with equal ids
are told apart by their text; a NULL id is smaller than no other, and if all ids of a component are NULL so
is its component id. Extra columns are not carried.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roster.llm.batches import slices, text_bytes, unused
from roster.llm.graph import components
from roster.llm.words import shingle_sets
from roster.session import freeze

WORDS, PERCENT = 5, 80
ROWS, MISS = 4, 1e-12
FANOUT = 8
FAMILY_BYTES = 48 << 20  # of sets that one task joins at once
_LAST = (1 << 63) - 1  # stands for a NULL id


def bands_for(percent: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - (percent / 100) ** ROWS))


def _multipliers(bands: int) -> np.ndarray:
    return np.random.default_rng(5).integers(0, 1 << 31, bands * ROWS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _band_keys(tokens: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    halves = (tokens >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(multipliers), np.uint32(0xFFFFFFFF))
    for start in range(0, len(halves), 512):
        scrambled = halves[start : start + 512, None] * multipliers[None, :]
        np.minimum(least, scrambled.min(axis=0), out=least)
    rows = np.ascontiguousarray(least.reshape(-1, ROWS))
    return np.array([xxhash.xxh3_64_intdigest(row.tobytes(), band) for band, row in enumerate(rows)], np.uint64).view(np.int64)


def _marked(docs: DataFrame) -> DataFrame:
    """``id`` and ``mark`` tell rows apart: a NULL id is the largest, ``mark`` is a hash of the text."""
    return docs.select("doc_id", F.coalesce("doc_id", F.lit(_LAST)).cast("long").alias("id"), F.xxhash64("text").alias("mark"), "text")


def sketches(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """For each row the size of its set, a digest of it, and its band keys; no digest for an empty set."""
    multipliers = _multipliers(bands_for(percent))

    def sketched(batches):
        for part in slices(batches, "text"):
            sets = shingle_sets(*text_bytes(part.column("text")), words)
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            known: dict[bytes, np.ndarray] = {}
            for s, digest in zip(sets, digests):
                if digest is not None and digest not in known:
                    known[digest] = _band_keys(s, multipliers)
            keys = [known.get(digest) for digest in digests]
            columns = [part.column(c) for c in ("doc_id", "id", "mark")]
            columns += [pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "id", "mark", "n", "digest", "keys"])

    rows = _marked(docs).withColumn("doc_id", F.col("doc_id").cast("long"))
    return rows.mapInArrow(sketched, "doc_id long, id long, mark long, n long, digest binary, keys array<long>")


class SetTree:
    """A signature tree over sets of tokens, joined with itself into connected groups."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        order = sorted(range(len(sets)), key=lambda i: (sets[i][:3].tolist(), len(sets[i])))
        self.sets = [sets[i] for i in order]
        self.place = order
        self.parent = list(range(len(sets)))
        bits = 1 << max(8, min(16, (2 * max(map(len, sets))).bit_length()))
        self.leaves = [self._leaf(i, bits) for i in range(len(sets))]
        level = self.leaves
        while len(level) > 1:
            level = [_Node(level[i : i + FANOUT]) for i in range(0, len(level), FANOUT)]
        self.root = level[0]

    def _leaf(self, i: int, bits: int) -> "_Node":
        marks = np.zeros(bits, bool)
        marks[(self.sets[i] & np.uint64(bits - 1)).astype(np.int64)] = True
        size = len(self.sets[i])
        bitmap = int.from_bytes(np.packbits(marks).tobytes(), "big")
        return _Node((), bitmap, size, size, size - bitmap.bit_count(), i)

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self) -> list[int]:
        """For each set, in the order given, a number that connected sets share."""
        stack = [(self.root, self.root)]
        while stack:
            a, b = stack.pop()
            if self._hopeless(a, b) or self._connected(a, b):
                continue
            if a is b:
                pairs = [(x, y) for i, x in enumerate(a.children) for y in a.children[i:]]
                stack += sorted(pairs, key=lambda p: p[0] is p[1])  # inside first, so more is connected later
            elif a.children or b.children:
                if a.children and (not b.children or a.height >= b.height):
                    stack += [(x, b) for x in a.children]
                else:
                    stack += [(a, y) for y in b.children]
            elif self._similar(a.leaf, b.leaf):
                self.parent[self.find(a.leaf)] = self.find(b.leaf)
        groups = [0] * len(self.sets)
        for i, given in enumerate(self.place):
            groups[given] = self.find(i)
        return groups

    def _hopeless(self, a: "_Node", b: "_Node") -> bool:
        if a is b:
            return not a.children
        if 100 * a.most < self.percent * b.least or 100 * b.most < self.percent * a.least:
            return True
        overlap = min(a.most, b.most, min(a.hidden, b.hidden) + (a.bitmap & b.bitmap).bit_count())
        return (100 + self.percent) * overlap < self.percent * (a.least + b.least)

    def _connected(self, a: "_Node", b: "_Node") -> bool:
        return self._whole(a) and self._whole(b) and self.find(a.leaf) == self.find(b.leaf)

    def _whole(self, node: "_Node") -> bool:
        if not node.whole:
            root = self.find(node.leaf)
            node.whole = all(self._whole(x) and self.find(x.leaf) == root for x in node.children)
        return node.whole

    def _similar(self, i: int, j: int) -> bool:
        common, union = overlap(self.sets[i], self.sets[j])
        return 100 * common >= self.percent * union


class _Node:
    """``hidden``: the most elements of a set beyond its number of bits, so that many may share a bit unseen."""

    __slots__ = ("children", "bitmap", "least", "most", "hidden", "leaf", "height", "whole")

    def __init__(self, children, bitmap=0, least=0, most=0, hidden=0, leaf=-1):
        self.children, self.whole, self.height = children, not children, 0
        self.bitmap, self.least, self.most, self.hidden, self.leaf = bitmap, least, most, hidden, leaf
        if children:
            for child in children:
                self.bitmap |= child.bitmap
            self.least, self.most = min(c.least for c in children), max(c.most for c in children)
            self.hidden, self.leaf = max(c.hidden for c in children), children[0].leaf
            self.height = 1 + children[0].height


def overlap(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two ascending sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return common, len(a) + len(b) - common


def _groups(batches, key: str):
    """Rows of batches sorted by ``key``, one list for each value."""
    held, current = [], None
    for batch in batches:
        for row in batch.to_pylist():
            if held and row[key] != current:
                yield held
                held = []
            current = row[key]
            held.append(row)
    if held:
        yield held


def _joined(sets: DataFrame, key: str, percent: int) -> DataFrame:
    """(digest, root digest) of the sets of each ``key``, one tree for each."""

    def joined(batches):
        digests, roots = [], []
        for rows in _groups(batches, key):
            rows = list({row["digest"]: row for row in rows}.values())
            tree = SetTree([np.frombuffer(row["tokens"], np.uint64) for row in rows], percent)
            first: dict[int, bytes] = {}
            for row, group in sorted(zip(rows, tree.join()), key=lambda x: x[0]["digest"]):
                digests.append(row["digest"])
                roots.append(first.setdefault(group, row["digest"]))
            if len(digests) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(roots, pa.binary())], ["a", "b"])
                digests, roots = [], []
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(roots, pa.binary())], ["a", "b"])

    sorted_sets = sets.select(key, "digest", "tokens").repartition(key).sortWithinPartitions(key)
    return sorted_sets.mapInArrow(joined, "a binary, b binary")


def _large_links(sets: DataFrame, percent: int, family_bytes: int) -> DataFrame:
    """Links within families larger than one task takes: through one member, then in pairs of blocks."""
    center = sets.groupBy("family").agg(F.min("digest").alias("digest"))
    centers = sets.join(center, ["family", "digest"], "left_semi")
    centers = centers.select("family", F.col("digest").alias("center"), F.col("tokens").alias("center_tokens")).dropDuplicates(["family"])

    def measured(batches):
        for part in batches:
            pairs = zip(part.column("tokens").to_pylist(), part.column("center_tokens").to_pylist())
            found = [overlap(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)) for a, b in pairs]
            linked = pa.array([100 * common >= percent * union for common, union in found], pa.bool_())
            away = pa.array([1 - common / union for common, union in found], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [*(part.column(c) for c in ("family", "digest", "tokens", "center")), linked, away],
                ["family", "digest", "tokens", "center", "linked", "away"],
            )

    near = sets.select("family", "digest", "tokens").join(centers, "family")
    near = near.mapInArrow(measured, "family long, digest binary, tokens binary, center binary, linked boolean, away double")
    near = freeze(near, "large-families")
    nearest = freeze(near.where(~F.col("linked")).groupBy("family").agg(F.min("away").alias("ring")), "nearest")
    reach = 1 - percent / 100 + 1e-9
    left = near.join(nearest, "family").where(~F.col("linked") | (F.col("away") >= F.col("ring") - reach))
    sizes = left.groupBy("family").agg((F.sum(F.octet_length("tokens")) / (family_bytes / 2)).alias("x"))
    blocks = F.ceil("x").cast("int")
    dealt = left.join(freeze(sizes.select("family", blocks.alias("blocks")), "sizes"), "family")
    own = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = dealt.withColumn("own", own).withColumn("other", other)
    key = F.xxhash64("family", F.least("own", "other"), F.greatest("own", "other"))
    blocked = _joined(paired.withColumn("pair", key), "pair", percent)
    return blocked.unionByName(near.where("linked").select(F.col("digest").alias("a"), F.col("center").alias("b")))


def similar_documents(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, family_bytes: int = FAMILY_BYTES) -> DataFrame:
    """``doc_id``, ``mark``, ``n_shingles``, ``component_id`` and ``first`` of every row.

    ``component_id`` is the smallest id that links reach; ``first`` marks the rows of a component that
    equal its first one (smallest id, then text hash).
    """
    rows = freeze(sketches(docs, words, percent), "sketches")
    classes = rows.where(F.col("digest").isNotNull()).groupBy("digest")
    classes = freeze(classes.agg(F.min(F.struct("id", "mark")).alias("head"), F.max("n").alias("n"), F.first("keys").alias("keys")), "classes")
    node = F.conv(F.substring(F.hex("digest"), 1, 15), 16, 10).cast("long").alias("node")
    keyed = classes.select(node, F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("least"), F.count("*").alias("count")).where(F.col("count") > 1)
    shared = freeze(shared, "shared-keys")  # so that Spark can split the classes of a frequent key
    edges = keyed.join(shared, "key").select(F.col("node").alias("a"), F.col("least").alias("b"))
    family_of = components(edges)
    roots = family_of.select("root").distinct().select(F.col("root").alias("node"), "root")
    family_of = family_of.unionByName(roots).select("node", F.col("root").alias("family"))
    members = freeze(classes.select("digest", "head", "n", node).join(family_of, "node").drop("node"), "families")
    large = members.groupBy("family").agg(F.sum("n").alias("size")).where(F.col("size") * 8 > family_bytes).select("family")
    large = freeze(large, "large-families")
    sets = freeze(_sets(docs, members, words), "sets")
    labels = _joined(sets.join(large, "family", "left_anti"), "family", percent)
    if not large.isEmpty():
        found = components(_large_links(sets.join(large, "family", "left_semi"), percent, family_bytes))
        labels = labels.unionByName(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    labelled = classes.select("digest", "head").join(labels.select(F.col("a").alias("digest"), F.col("b").alias("group")), "digest", "left")
    labelled = labelled.withColumn("group", F.coalesce("group", "digest"))
    heads = freeze(labelled.groupBy("group").agg(F.min("head").alias("lead")), "heads")
    named = labelled.join(heads, "group").select("digest", "lead")
    alone = F.struct("id", "mark")
    done = rows.drop("keys").join(named, "digest", "left").withColumn("lead", F.coalesce("lead", alone))
    return done.select(
        "doc_id",
        "mark",
        F.col("n").alias("n_shingles"),
        F.nullif("lead.id", F.lit(_LAST)).alias("component_id"),
        (F.col("lead") == alone).alias("first"),
    )


def _sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """The sets of the members of families, each from one text that has it."""

    def made(batches):
        for part in slices(batches, "text"):
            sets = shingle_sets(*text_bytes(part.column("text")), words)
            tokens = pa.array([s.tobytes() for s in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("family"), part.column("digest"), tokens], ["family", "digest", "tokens"])

    wanted = members.select("family", "digest", F.col("head.id").alias("id"), F.col("head.mark").alias("mark"))
    texts = _marked(docs).select("id", "mark", "text").join(wanted, ["id", "mark"])
    return texts.select("family", "digest", "text").mapInArrow(made, "family long, digest binary, tokens binary")


def keep_first(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component of similar documents, with all its columns.

    Of rows equal in id and text, which differ in other columns at most, any one stays.
    """
    doc_id, mark = unused(docs.columns, "_id", "_mark")
    keep = similar_documents(docs, words, percent).where("first").select(F.col("doc_id").alias(doc_id), F.col("mark").alias(mark))
    same = F.col("doc_id").eqNullSafe(F.col(doc_id)) & (F.xxhash64("text") == F.col(mark))
    kept = docs.join(keep.distinct(), same).drop(doc_id, mark)
    return kept.dropDuplicates(["doc_id", "text"])
