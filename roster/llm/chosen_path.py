"""Near duplicates by chosen paths: a set similarity join that meets on minwise tokens.

Two texts are linked when their sets of word shingles have at least ``percent`` per cent in common.

1. Equal sets are one class. A class has ``COORDINATES`` minwise tokens, each the least of its tokens under a hash
   of its own, kept by 16 bits, and a sketch of four bits of each.
2. A tree has the coordinates in an order of its own and ``PATHS`` paths from its root, which share no coordinate. A path
   ends, after the number of coordinates that ``length_of_paths`` says, in a node: the classes that agree in all of
   these. So a class is in ``TREES * PATHS`` nodes whatever the size of the table, and all but the nodes of near
   copies hold it alone. A pair at the threshold that meets in no node has a chance below ``MISS``.
3. Every class of a node is paired with the node's least class, equal pairs of several nodes are one, and those that may be
   similar by sketches and sizes are confirmed on the full sets. This connects nearly all that is linked, and there are
   no more pairs than rows in nodes.
4. A node is looked at again if its classes are not all connected then. A class outside of the node's largest component is
   compared with all of the node, and the members of that component are not compared with each other; the classes that
   are similar by sketches to one of another component are brought together with their sets, until they are connected.
   Only links leave a node, and a pair that meets in several nodes is confirmed in the first of them alone, as
   every class knows all its nodes. What one task compares is bounded: large nodes are dealt into blocks.

No link is counted that is not confirmed on full sets, and a pair that no path brings together is the only loss.

Defined results: NULL and wordless texts have an empty set and are linked with nothing; rows with equal ids
are told apart by their text; a NULL id is the component of its rows only if no other id is in it. ``kept`` says
that a row has the id of its component. Extra columns are not carried.
"""

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roster.llm.batches import mixed, slices, text_bytes
from roster.llm.graph import components
from roster.llm.words import shingle_sets
from roster.session import freeze

WORDS, PERCENT = 5, 80
TREES, PATHS, COORDINATES, MISS = 6, 11, 128, 1e-6
SMALL = 512
_LAST = (1 << 63) - 1  # stands for a NULL id
_SIGMAS = 5.5
_NIBBLES = np.uint64(0x1111111111111111)


def _multipliers() -> np.ndarray:
    return np.random.default_rng(13).integers(0, 1 << 31, COORDINATES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minwise(tokens: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """The least token under each hash, by its last 16 bits."""
    least = np.full(len(multipliers), np.uint32(0xFFFFFFFF))
    halves = (tokens >> np.uint64(32)).astype(np.uint32)
    for start in range(0, len(halves), 512):
        np.minimum(least, (halves[start : start + 512, None] * multipliers).min(axis=0), out=least)
    return least.astype(np.uint16)


def sketch(minima: np.ndarray) -> bytes:
    """The four last bits of each minwise token."""
    four = (minima & 15).astype(np.uint8)
    return (four[0::2] | four[1::2] << 4).tobytes()


def chance_of_miss(similarity: float, length: int) -> float:
    """The chance that a pair agrees on no path of so many coordinates, over the number of coordinates it agrees in."""

    def apart(agreeing: int) -> float:
        return (1 - math.comb(agreeing, length) / math.comb(COORDINATES, length)) ** (TREES * PATHS)

    def share(agreeing: int) -> float:
        return math.comb(COORDINATES, agreeing) * similarity**agreeing * (1 - similarity) ** (COORDINATES - agreeing)

    return sum(share(agreeing) * apart(agreeing) for agreeing in range(COORDINATES + 1))


def length_of_paths(percent: int) -> int:
    """As many coordinates as a pair at the threshold bears; the longer a path, the fewer others meet there."""
    fits = [n for n in range(1, COORDINATES // PATHS + 1) if chance_of_miss(percent / 100, n) < MISS]
    return max(fits, default=1)


def _paths(length: int) -> np.ndarray:
    """The coordinates of each path, one row for each."""
    trees = [np.random.default_rng([17, tree]).permutation(COORDINATES)[: PATHS * length] for tree in range(TREES)]
    return np.concatenate(trees).reshape(-1, length)


def nodes_of(minima: np.ndarray, paths: np.ndarray) -> np.ndarray:
    """The nodes of each class, in which its paths end; ``minima`` has one row for each class."""
    nodes = np.broadcast_to(np.arange(1, len(paths) + 1, dtype=np.uint64), (len(minima), len(paths)))
    for coordinates in paths.T:
        nodes = mixed(nodes + minima[:, coordinates].astype(np.uint64))
    return nodes.view(np.int64)


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """In how many coordinates sketches differ; each is a row of 64-bit words."""
    x = a ^ b
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    return np.bitwise_count(x & _NIBBLES).sum(axis=-1, dtype=np.int32)


def most_differing(percent: int) -> int:
    """In so many coordinates at most differ the sketches of a pair at the threshold, but for a chance of about 1 in 10**7."""
    away = (1 - percent / 100) * 15 / 16
    return int(COORDINATES * away + _SIGMAS * np.sqrt(COORDINATES * away * (1 - away)))


def _marked(docs: DataFrame) -> DataFrame:
    """``id`` and ``mark`` tell rows apart: a NULL id is the largest, ``mark`` is a hash of the text."""
    ids = F.col("doc_id").cast("long")
    return docs.select(ids.alias("doc_id"), F.coalesce(ids, F.lit(_LAST)).alias("id"), F.xxhash64("text").alias("mark"), "text")


def sketched(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """For each row the size of its set, a digest of it, its nodes and its sketch; no digest for an empty set."""
    multipliers, paths = _multipliers(), _paths(length_of_paths(percent))

    def made(batches):
        for part in slices(batches, "text"):
            sets = shingle_sets(*text_bytes(part.column("text")), words)
            digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            known = {d: s for d, s in zip(digests, sets) if d is not None}
            minima = {d: minwise(s, multipliers) for d, s in known.items()}
            nodes = {d: nodes_of(m[None], paths)[0] for d, m in minima.items()}
            columns = [part.column(c) for c in ("doc_id", "id", "mark")]
            columns += [
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array([None if d is None else nodes[d] for d in digests], pa.list_(pa.int64())),
                pa.array([None if d is None else sketch(minima[d]) for d in digests], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "id", "mark", "n", "digest", "nodes", "bits"])

    schema = "doc_id long, id long, mark long, n long, digest binary, nodes array<long>, bits binary"
    return _marked(docs).mapInArrow(made, schema)


def overlap(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two ascending sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return common, len(a) + len(b) - common


def _sets(wanted: DataFrame, docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """(digest, tokens): the full sets of the wanted classes, made from one text of each."""
    heads = classes.join(wanted, "digest", "left_semi").select("digest", "head.id", "head.mark")

    def made(batches):
        for part in slices(batches, "text"):
            sets = shingle_sets(*text_bytes(part.column("text")), words)
            yield pa.RecordBatch.from_arrays([part.column("digest"), pa.array([s.tobytes() for s in sets], pa.binary())], ["digest", "tokens"])

    texts = _marked(docs).select("id", "mark", "text").join(heads, ["id", "mark"]).dropDuplicates(["digest"])
    return freeze(texts.select("digest", "text").mapInArrow(made, "digest binary, tokens binary"), "sets")


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of the pairs (bin, a, b), with the sizes of intersection and union of the full sets.

    A set is sent once to each bin that has pairs of it, however many; a pair of several bins is measured in one.
    """
    chosen = freeze(pairs.groupBy("a", "b").agg(F.min("bin").alias("bin")), "pairs")
    members = chosen.select("bin", F.col("a").alias("digest")).union(chosen.select("bin", "b")).distinct()
    rows = members.join(sets, "digest").withColumn("pair", F.lit(False)).unionByName(chosen.withColumn("pair", F.lit(True)), allowMissingColumns=True)

    def measured(batches):
        current, held = None, {}
        for part in batches:
            found = []
            for b, pair, digest, tokens, x, y in zip(*(part.column(c) for c in ("bin", "pair", "digest", "tokens", "a", "b"))):
                if b != current:
                    current, held = b, {}
                if pair.as_py():
                    found.append((x.as_py(), y.as_py(), *overlap(held[x.as_py()], held[y.as_py()])))
                else:
                    held[digest.as_py()] = np.frombuffer(tokens.as_py(), np.uint64)
            types = [pa.binary(), pa.binary(), pa.int64(), pa.int64()]
            columns = zip(*found) if found else [[] for _ in types]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["a", "b", "common", "joint"])

    dealt = rows.repartition("bin").sortWithinPartitions("bin", "pair")
    return freeze(dealt.mapInArrow(measured, "a binary, b binary, common long, joint long"), "measured")


def _linked(percent: int) -> Column:
    return 100 * F.col("common") >= percent * F.col("joint")


def candidates(bits: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of one node that may be similar, by sketches and sizes, and in how many coordinates they differ; the nearest first."""
    limit, found = most_differing(percent), []
    for i in range(0, len(bits), 64):
        away = differing(bits[i : i + 64, None], bits[None, i:])
        x, y = np.nonzero(away <= limit)
        later = y > x
        found.append(np.stack([x[later] + i, y[later] + i, away[x[later], y[later]]]))
    a, b, away = np.concatenate(found, axis=1)
    least, most = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
    fits = np.flatnonzero(100 * least >= percent * most)
    order = fits[np.argsort(away[fits], kind="stable")]
    return a[order], b[order], away[order]


def _forest(a: np.ndarray, b: np.ndarray, labels: np.ndarray, holds) -> list[int]:
    """The first pairs, in the order given, that hold and connect things of different labels."""
    parent, kept = list(range(int(labels.max()) + 1)), []
    label = labels.tolist()

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        i, j = find(label[x]), find(label[y])
        if i != j and holds(x, y):
            parent[i] = j
            kept.append(k)
            if len(kept) == len(parent) - 1:
                break
    return kept


def _pair_batches(bin: int, pairs: list[tuple[bytes, bytes]]):
    for start in range(0, len(pairs), 10_000):
        some = pairs[start : start + 10_000]
        two = [pa.array([p[i] for p in some], pa.binary()) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array([bin] * len(some), pa.int64()), *two], ["bin", "a", "b"])


def _may_be_similar(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b), as digests, of the pairs of classes (x, y) that sketches and sizes allow to be linked; a is x."""
    limit = most_differing(percent)

    def allowed(batches):
        for part in batches:
            two = [np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint64).reshape(part.num_rows, COORDINATES // 16) for c in ("bits_x", "bits_y")]
            yield part.select(["a", "b"]).filter(pa.array(differing(*two) <= limit, pa.bool_()))

    for end in ("x", "y"):
        known = classes.select(_class().alias(end), *(F.col(c).alias(f"{c}_{end}") for c in ("digest", "n", "bits")))
        pairs = pairs.join(known, end)
    fits = 100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")
    ends = pairs.where(fits).select(F.col("digest_x").alias("a"), F.col("digest_y").alias("b"), "bits_x", "bits_y")
    return ends.mapInArrow(allowed, "a binary, b binary")


def _across(rows: dict, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The candidates of one bin of which one is asked about, and has another label, and the labels of all rows.

    Only those whose first common node is this one; two classes that are both asked about are paired once.
    """
    places: dict[bytes, int] = {}
    labels = np.array([places.setdefault(label, len(places)) for label in rows["label"]])
    bits = np.frombuffer(b"".join(rows["bits"]), np.uint64).reshape(len(labels), -1)
    a, b, _ = candidates(bits, np.array(rows["n"]), percent)
    asked, digests, nodes = np.array(rows["asked"]), np.array(rows["digest"], object), np.array(rows["nodes"])
    chosen = (labels[a] != labels[b]) & (asked[a] != asked[b])
    a, b = a[chosen], b[chosen]
    x, y = np.where(asked[a], a, b), np.where(asked[a], b, a)
    minor = labels != np.array([places.get(label, -1) for label in rows["main"]])
    once = ~minor[y] | (digests[x] < digests[y]).astype(bool)
    x, y = x[once], y[once]
    first = np.ones(len(x), bool)
    for start in range(0, len(x), 4096):
        part = slice(start, start + 4096)
        common = np.argmax(nodes[x[part]] == nodes[y[part]], axis=1)
        first[part] = nodes[x[part], common] == rows["node"][0]
    return x[first], y[first], labels


def _suspects(bins: DataFrame, percent: int) -> DataFrame:
    """(bin, digest) of the classes that have a pair to be confirmed in this bin."""

    def found(batches):
        for rows in _grouped(batches, "bin"):
            a, b, _ = _across(rows, percent)
            digests = sorted({rows["digest"][i] for i in np.union1d(a, b)})
            yield pa.RecordBatch.from_arrays([pa.array([rows["bin"][0]] * len(digests), pa.int64()), pa.array(digests, pa.binary())], ["bin", "digest"])

    return bins.repartition("bin").sortWithinPartitions("bin").mapInArrow(found, "bin long, digest binary")


def _confirmed(bins: DataFrame, percent: int) -> DataFrame:
    """(bin, a, b): links between labels of each bin, confirmed on the full sets, enough to connect what is linked."""

    def joined(batches):
        for rows in _grouped(batches, "bin"):
            a, b, labels = _across(rows, percent)
            digests, sets = rows["digest"], [np.frombuffer(t, np.uint64) for t in rows["tokens"]]

            def similar(x: int, y: int) -> bool:
                common, joint = overlap(sets[x], sets[y])
                return 100 * common >= percent * joint

            kept = _forest(a, b, labels, similar)
            yield from _pair_batches(rows["bin"][0], [(digests[a[k]], digests[b[k]]) for k in kept])

    return bins.repartition("bin").sortWithinPartitions("bin").mapInArrow(joined, "bin long, a binary, b binary")


def _grouped(batches, key: str):
    """The rows of each value of ``key`` as columns; batches are sorted by it."""
    held, current = None, None
    for batch in batches:
        columns = batch.to_pydict()
        keys = columns[key]
        start = 0
        for stop in [*(i for i in range(1, len(keys)) if keys[i] != keys[i - 1]), len(keys)]:
            if held is not None and keys[start] == current:
                for name, values in columns.items():
                    held[name] += values[start:stop]
            else:
                if held is not None:
                    yield held
                held, current = {name: values[start:stop] for name, values in columns.items()}, keys[start]
            start = stop
    if held is not None:
        yield held


def _class() -> Column:
    """A class as a number. Where two had the same one, both would be paired, and confirmed on their sets."""
    return F.xxhash64("digest")


def _shared_nodes(classes: DataFrame) -> DataFrame:
    """(node, class, least) for the classes of nodes that have more than one; ``least`` is the node's least class."""
    placed = classes.select(_class().alias("class"), F.explode("nodes").alias("node"))
    ends = placed.groupBy("node").agg(F.min("class").alias("least"), F.max("class").alias("most"))
    shared = freeze(ends.where(F.col("least") < F.col("most")).select("node", "least"), "shared-nodes")
    return freeze(placed.join(shared, "node"), "nodes")


def _dealt(paired: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), measured on full sets; a set is sent once for up to ``SMALL`` pairs that have it as ``a``."""
    counts = freeze(paired.groupBy("a").agg(F.ceil(F.count("*") / SMALL).alias("portions")), "portions")
    portion = F.pmod(F.xxhash64("b"), F.col("portions"))
    return _measured(paired.join(counts, "a").select(F.xxhash64("a", portion).alias("bin"), "a", "b"), sets)


def _open_bins(placed: DataFrame, labels: DataFrame) -> DataFrame:
    """(bin, node, digest, label, main, asked): what is still to be compared of nodes that are not connected.

    A class outside of a node's main component is asked about in bins with all blocks of the node, any other row
    is in its block's bins only. So rows grow with the square of what a node has outside of its main component alone.
    """
    labelled = placed.select("node", "class").join(labels.withColumn("class", _class()), "class").select("node", "digest", "label")
    labelled = freeze(labelled, "labelled")
    parts = labelled.groupBy("node", "label").agg(F.count("*").alias("size"))
    main = F.max(F.struct("size", "label"))
    nodes = parts.groupBy("node").agg(F.sum("size").alias("size"), main.getField("label").alias("main"), main.getField("size").alias("most"))
    # The two classes of a node have been compared already.
    nodes = nodes.where((F.col("size") > F.col("most")) & (F.col("size") > 2))
    half = max(1, SMALL // 2)
    blocks, chunks = F.ceil(F.col("size") / half).cast("int"), F.ceil((F.col("size") - F.col("most")) / half).cast("int")
    rows = labelled.join(freeze(nodes.select("node", "main", blocks.alias("blocks"), chunks.alias("chunks")), "open-nodes"), "node")

    def own(number: str) -> Column:
        return F.pmod(F.xxhash64("digest", F.lit(number)), F.col(number)).cast("int")

    def every(number: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(number) - 1))

    asked = rows.where(F.col("label") != F.col("main")).withColumn("chunk", own("chunks")).withColumn("block", every("blocks"))
    others = rows.withColumn("block", own("blocks")).withColumn("chunk", every("chunks"))
    both = asked.withColumn("asked", F.lit(True)).unionByName(others.withColumn("asked", F.lit(False)))
    return both.select(F.xxhash64("node", "block", "chunk").alias("bin"), "node", "digest", "label", "main", "asked")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``mark``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    ``component_id`` is the smallest id that links reach; ``mark`` is a hash of the text.
    """
    rows = freeze(sketched(docs, words, percent), "sketched")
    held = rows.where(F.col("digest").isNotNull()).groupBy("digest")
    first = [F.first(c).alias(c) for c in ("n", "nodes", "bits")]
    classes = freeze(held.agg(F.min(F.struct("id", "mark")).alias("head"), *first), "classes")
    placed = _shared_nodes(classes)
    stars = placed.where(F.col("class") != F.col("least")).select(F.col("least").alias("x"), F.col("class").alias("y")).distinct()
    paired = freeze(_may_be_similar(stars, classes, percent), "paired")
    sets = _sets(paired.select(F.col("a").alias("digest")).union(paired.select("b")).distinct(), docs, classes, words)
    links = _dealt(paired, sets, percent).where(_linked(percent)).select("a", "b")
    bins = _open_bins(placed, _labels(classes, links))
    bins = freeze(bins.join(classes.select("digest", "n", "nodes", "bits"), "digest"), "open")
    suspects = freeze(_suspects(bins, percent), "suspects")
    if not suspects.isEmpty():
        more = freeze(suspects.select("digest").distinct().join(sets, "digest", "left_anti"), "more")
        if not more.isEmpty():
            sets = sets.unionByName(_sets(more, docs, classes, words))
        again = bins.join(suspects, ["bin", "digest"], "left_semi").join(sets, "digest")
        links = links.unionByName(freeze(_confirmed(again, percent).select("a", "b"), "confirmed"))
    named = classes.select("digest", "head").join(_labels(classes, links), "digest")
    heads = freeze(named.groupBy("label").agg(F.min("head").alias("lead")), "heads")
    leads = named.select("digest", "label").join(heads, "label").select("digest", F.col("lead.id").alias("lead"))
    done = rows.select("doc_id", "id", "mark", "n", "digest").join(leads, "digest", "left")
    component = F.nullif(F.coalesce("lead", "id"), F.lit(_LAST))
    return done.select(
        "doc_id",
        "mark",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def _labels(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(digest, label); linked classes have one label."""
    roots = components(links).select(F.col("node").alias("digest"), "root")
    return classes.select("digest").join(roots, "digest", "left").select("digest", F.coalesce("root", "digest").alias("label"))
