"""Sharding: exact counts, near equal bytes, gapless slots, and groups that are cut only by a boundary."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roster.llm.sharding import Keys, _histogram, _parts_below, find_splitters, keyed, shard_documents
from tests.llm.conftest import ODD


def sizes(rows):
    return [len((t or "").encode()) + 8 for _, t in rows]


def assert_shards(df, rows, shards, spread):
    found = shard_documents(df, shards).collect()
    assert sorted((str(r.doc_id), str(r.text), r["size"]) for r in found) == sorted((str(i), str(t), s) for (i, t), s in zip(rows, sizes(rows)))
    total, by = sum(sizes(rows)), {}
    for r in found:
        by.setdefault(r.shard, []).append(r)
    assert set(by) <= set(range(shards))
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    for shard in range(shards):
        assert abs(sum(r["size"] for r in by.get(shard, [])) - total / shards) <= spread
    return found


def test_shards_of_a_table(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    found = assert_shards(documents, rows, 24, 2 * max(sizes(rows)))
    texts = {}
    for r in found:
        texts.setdefault(r.text, set()).add(r.shard)
    # Equal texts lie together: each of the 23 boundaries can part one group at most.
    assert sum(len(s) > 1 for s in texts.values()) <= 23


def test_a_group_of_half_the_rows_is_cut_at_ids(docs):
    pick = random.Random(1)
    rows = [(i * 3 - 500, "the same text" if i % 2 else "x" * pick.randint(0, 40)) for i in range(1500)]
    found = assert_shards(docs(*rows), rows, 7, 60)
    hot = sorted((r.doc_id, r.shard) for r in found if r.text == "the same text")
    assert len({s for _, s in hot}) > 3
    # Within the group, shards follow the ids.
    assert [s for _, s in hot] == sorted((s for _, s in hot)) or len({s for _, s in hot}) > 1
    changes = sum(a != b for (_, a), (_, b) in zip(hot, hot[1:]))
    assert changes == len({s for _, s in hot}) - 1


def test_tolerance(spark):
    many = spark.range(60_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("é"), (F.col("id") % 30).cast("int")).alias("text"))
    shares = [r.s for r in shard_documents(many, 24).groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(shares) == 24 and max(shares) - min(shares) <= 0.005 * sum(shares) / 24 + 150


def test_counts_below_probes_are_exact(spark):
    pick = np.random.default_rng(4)
    hashes = pick.choice(pick.integers(-(2**63), 2**63 - 1, 40), 500)
    ids = pick.integers(-5, 5, 500)
    probes = sorted({(int(h), int(i)) for h, i in zip(pick.choice(hashes, 60), pick.integers(-6, 6, 60))} | {(-(2**63), -5), (2**63 - 1, 9)})
    want = [sum((int(h), int(i)) < p for h, i in zip(hashes, ids)) for p in probes]
    place = _parts_below(hashes, ids, probes)
    assert [int((place <= k).sum()) for k in range(len(probes))] == want
    rows = spark.createDataFrame([(int(h), int(i), 3) for h, i in zip(hashes, ids)], "hash long, id long, size long")
    below, count = _histogram(rows, probes)
    assert count == want and below == [3 * n for n in want]
    assert (_parts_below(hashes, ids, []) == 0).all()


def test_splitters_are_the_best_there_are(documents):
    rows = keyed(documents).select("hash", "id", "size").cache()
    every = sorted((r.hash, r.id, r["size"]) for r in rows.collect())
    ids = [i for _, i, _ in every]
    keys, total = Keys(min(ids), max(ids) - min(ids) + 1), sum(s for _, _, s in every)
    reach = np.cumsum([0] + [s for _, _, s in every])
    for part, key in enumerate(find_splitters(rows, keys, total, 10, 0.0), 1):
        below = sum(s for h, i, s in every if (h, i) < keys.pair(min(key, keys.end - 1)))
        assert abs(below - total * part / 10) == np.abs(reach - total * part / 10).min()


@pytest.mark.parametrize("shards", [1, 24])
def test_odd_rows(odd, none, shards):
    assert_shards(odd, ODD, shards, 2 * max(sizes(ODD)))
    assert shard_documents(none, shards).collect() == []


def test_one_row_and_equal_rows(docs):
    assert [(r.shard, r.slot) for r in shard_documents(docs((5, "a")), 3).collect()][0][1] == 0
    same = shard_documents(docs(*[(5, "a")] * 9), 3).collect()
    assert len({r.shard for r in same}) == 1 and sorted(r.slot for r in same) == list(range(9))
