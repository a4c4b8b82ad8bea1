"""Sharding by histogram sort.

Rows are ordered by (hash of the text, doc_id), so equal texts lie together. The places where shards
begin are found without sorting: probes are laid between known bounds, the exact bytes below each probe
are counted over all partitions, and the bounds are refined until every boundary is within a tolerance
of its ideal place, or no key lies between its bounds. Then the rows are exchanged once. The order goes
down to the id, so a group of equal texts is cut wherever a boundary falls in it.

Defined results: a row's size is the UTF-8 bytes of its text plus 8, for NULL just 8; a NULL id comes
before all others; rows with equal id and text have one key and share a shard; an empty table gives no
rows. Only ``doc_id`` and ``text`` are carried.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roster.session import freeze

TOLERANCE = 0.002  # of a shard's ideal bytes
PART_BYTES = 32 << 20
MOST_PARTS = 12_288
LEAST_PARTS_PER_SHARD = 4
PROBES = 16  # between the bounds of a boundary, in one pass
ROW_BYTES = 8
_LOWEST = -(1 << 63)


@dataclass(frozen=True)
class Keys:
    """Keys (hash, id) as integers, in the same order."""

    first_id: int
    ids: int

    def pair(self, key: int) -> tuple[int, int]:
        return key // self.ids + _LOWEST, key % self.ids + self.first_id

    @property
    def end(self) -> int:
        return self.ids << 64


def keyed(docs: DataFrame) -> DataFrame:
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(ROW_BYTES)
    return docs.select(
        "doc_id",
        "text",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"),
        F.coalesce("doc_id", F.lit(_LOWEST)).alias("id"),
        size.cast("long").alias("size"),
    )


def _parts_below(hashes: np.ndarray, ids: np.ndarray, probes: list[tuple[int, int]]) -> np.ndarray:
    """For each row the number of probes at or below its key."""
    heads = np.array([h for h, _ in probes], np.int64)
    tails = np.array([i for _, i in probes], np.int64)
    place = np.searchsorted(heads, hashes, side="right")
    tied = np.flatnonzero((place > 0) & (heads[np.maximum(place, 1) - 1] == hashes)) if len(heads) else []
    if len(tied):
        for head in np.unique(hashes[tied]):
            rows = tied[hashes[tied] == head]
            low, high = np.searchsorted(heads, head, "left"), np.searchsorted(heads, head, "right")
            place[rows] = low + np.searchsorted(tails[low:high], ids[rows], side="right")
    return place


def _histogram(rows: DataFrame, probes: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Exact bytes and rows below each probe."""

    def counted(batches):
        size, count = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for batch in batches:
            place = _parts_below(*(batch.column(c).to_numpy() for c in ("hash", "id")), probes)
            np.add.at(size, place, batch.column("size").to_numpy())
            count += np.bincount(place, minlength=len(probes) + 1)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(size[some]), pa.array(count[some])], ["part", "size", "count"])

    size, count = [0] * (len(probes) + 1), [0] * (len(probes) + 1)
    parts = rows.select("hash", "id", "size").mapInArrow(counted, "part long, size long, count long")
    for row in parts.groupBy("part").agg(F.sum("size").alias("size"), F.sum("count").alias("n")).collect():
        size[row.part], count[row.part] = row["size"], row.n
    return np.cumsum(size[:-1]).tolist(), np.cumsum(count[:-1]).tolist()


def find_splitters(rows: DataFrame, keys: Keys, total: int, parts: int, tolerance: float) -> list[int]:
    """Keys where parts 1, 2, ... begin, so that the bytes below are near ``total * part / parts``."""
    allowed = tolerance * total / parts
    bounds = {part: (0, 0, keys.end, total) for part in range(1, parts)}  # key and bytes below it, twice
    found = {}
    while bounds:
        wanted = set()
        for part, (low, below_low, high, below_high) in bounds.items():
            share = (total * part / parts - below_low) / max(1, below_high - below_low)
            guess = low + int((high - low) * min(max(share, 0.0), 1.0))
            wanted |= {low + (high - low) * i // (PROBES + 1) for i in range(1, PROBES + 1)} | {guess}
        wanted = sorted(wanted)
        below = dict(zip(wanted, _histogram(rows, [keys.pair(min(k, keys.end - 1)) for k in wanted])[0]))
        order = np.array([below[k] for k in wanted], np.int64)
        for part, (low, below_low, high, below_high) in list(bounds.items()):
            goal = total * part / parts
            at = int(np.searchsorted(order, goal, side="right"))
            if at and wanted[at - 1] > low:
                low, below_low = wanted[at - 1], int(order[at - 1])
            if at < len(wanted) and wanted[at] < high:
                high, below_high = wanted[at], int(order[at])
            gap, key = min((abs(below_low - goal), low), (abs(below_high - goal), high))
            if gap <= allowed or high - low <= 1:
                found[part] = key
                del bounds[part]
            else:
                bounds[part] = (low, below_low, high, below_high)
    return [found[part] for part in range(1, parts)]


def shard_documents(docs: DataFrame, shards: int, tolerance: float = TOLERANCE) -> DataFrame:
    """``doc_id``, ``text``, ``size``, ``shard`` and ``slot``: shards of near equal bytes, slots in key order.

    Each shard is made of parts of about ``PART_BYTES``, which are what is exchanged and sorted, so no task
    holds a whole shard.
    """
    narrow = freeze(keyed(docs).select("hash", "id", "size"), "shard-keys")
    facts = narrow.agg(F.count("*").alias("n"), F.sum("size").alias("size"), F.min("id").alias("low"), F.max("id").alias("high")).first()
    keys = Keys(facts.low or 0, (facts.high or 0) - (facts.low or 0) + 1)
    per_shard = min(max(LEAST_PARTS_PER_SHARD, (facts["size"] or 0) // (shards * PART_BYTES)), max(1, MOST_PARTS // shards))
    probes, before = [], [0]
    if facts.n:
        splitters = find_splitters(narrow, keys, facts["size"], shards * per_shard, tolerance / per_shard)
        probes = [keys.pair(min(k, keys.end - 1)) for k in np.maximum.accumulate(np.array(splitters, object))]
        before += _histogram(narrow, probes)[1]

    def parted(batches):
        for batch in batches:
            place = _parts_below(*(batch.column(c).to_numpy() for c in ("hash", "id")), probes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], [*batch.schema.names, "part"])

    rows = keyed(docs)
    placed = rows.mapInArrow(parted, f"{_schema(rows)}, part long")
    starts = [(part, part // per_shard, n - before[part // per_shard * per_shard]) for part, n in enumerate(before)]
    table = docs.sparkSession.createDataFrame(starts, "part long, shard int, start long")
    numbered = placed.withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy("hash", "id", "text")))
    return numbered.join(F.broadcast(table), "part").select(
        "doc_id", "text", "size", "shard", (F.col("start") + F.col("nth") - 1).alias("slot")
    )


def _schema(rows: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
