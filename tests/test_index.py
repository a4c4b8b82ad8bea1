"""Looking people up through Bloom filters, and repairing only what was added."""

import random

import pytest
from pyspark.sql import functions as F

from roster.operators.merge import identity_hash, insert_new, insert_new_indexed, look_up
from roster.plans.load import repair, repair_incremental
from roster.sources.table import append_batch, create_table, read_table, replace_table


def filled(spark, root, licences, loads):
    for k, rows in enumerate(loads):
        append_batch(spark, root, create_table(spark, root), f"load {k}", licences(*rows))


def scanned_rows(df):
    """What the scan of a plan without exchanges gave to the filter above it."""
    df.collect()
    spark = df.sparkSession
    plan = df._jdf.queryExecution().executedPlan()
    leaf = spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(plan.collectLeaves()).get(0)
    return leaf.metrics().apply("numOutputRows").value()


def test_a_small_batch_reads_few_row_groups(spark, licences, batch, tmp_path):
    root = str(tmp_path / "t")
    for k in range(6):
        people = spark.range(k * 5000 + 1, k * 5000 + 5001).select("id").crossJoin(licences((0, "A", "a@x")).drop("id"))
        people = people.withColumn("full_name", F.concat(F.lit("P"), F.col("id").cast("string")))
        append_batch(spark, root, create_table(spark, root), f"load {k}", people.coalesce(1))
    stored = read_table(spark, root, indexed=True)
    asked = batch((1, "P7", "a@x"), (2, "P8", "b@x"), (3, "P12345", "a@x"), *[(i, f"New{i}", None) for i in range(4, 40)])
    found = look_up(stored, asked)
    assert sorted(r.full_name for r in found.collect()) == ["P12345", "P7"]
    # Of 30,000 rows in six row groups, two groups hold somebody; the filters let one in a hundred others through.
    assert scanned_rows(found) <= 15_000
    assert scanned_rows(look_up(stored, batch((1, "Nobody", None)))) <= 5_000
    fresh = insert_new_indexed(stored, asked)
    assert sorted(r.ordinal for r in fresh.collect()) == [2, *range(4, 40)]


@pytest.mark.parametrize("probed", [0, 3, 10_000])
def test_the_index_changes_no_result(spark, licences, batch, tmp_path, probed):
    pick, root = random.Random(probed), str(tmp_path / "t")
    person = lambda: (pick.choice(["A", "B", "C", "", None]), pick.choice(["a@x", "A@x", "", None]))
    filled(spark, root, licences, [[(k * 10 + i, *person()) for i in range(3)] for k in range(3)])
    asked = batch(*[(i, *person()) for i in range(12)])
    want = sorted(r.ordinal for r in insert_new(read_table(spark, root), asked).collect())
    got = insert_new_indexed(read_table(spark, root, indexed=True), asked, probed)
    assert sorted(r.ordinal for r in got.collect()) == want
    assert insert_new_indexed(read_table(spark, root, indexed=True), asked.limit(0), probed).collect() == []


def test_null_and_empty_have_one_hash(spark, licences):
    rows = licences((1, None, ""), (2, "", None), (3, "a", ""), (4, "", "a")).select("id", identity_hash().alias("h")).orderBy("id").collect()
    assert rows[0].h == rows[1].h and len({r.h for r in rows}) == 3


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_incremental_repair_equals_the_whole_one(spark, licences, tmp_path, seed):
    pick, roots, last = random.Random(seed), [str(tmp_path / n) for n in ("a", "b")], 0
    for step in range(6):
        rows = [(last + i + 1, pick.choice("ABCDE"), pick.choice(["a@x", "", None])) for i in range(pick.randint(0, 5))]
        last += len(rows)
        kind = pick.choice(["append", "append", "replace"])
        for root in roots:
            if kind == "replace" and step == 3:
                replace_table(spark, root, licences(*rows), f"replace {step}")
            else:
                append_batch(spark, root, create_table(spark, root), f"load {step}", licences(*rows))
        if pick.random() < 0.7:
            assert repair(spark, roots[0], f"repair {step}") == repair_incremental(spark, roots[1], f"repair {step}")
    repair(spark, roots[0], "last"), repair_incremental(spark, roots[1], "last")
    a, b = (sorted(tuple(r) for r in read_table(spark, root).collect()) for root in roots)
    assert a == b and len(a) > 3


def test_incremental_repair_reads_only_the_frontier(spark, licences, tmp_path, monkeypatch):
    root, asked = str(tmp_path / "t"), []
    filled(spark, root, licences, [[(1, "A", "a@x"), (2, "A", "a@x"), (3, "B", "b@x")]])
    assert repair_incremental(spark, root, "one") == 1
    filled(spark, root, licences, [[(4, "B", "b@x"), (5, "C", "c@x")]])

    def seen(stored, wanted, *how):
        asked.append(sorted(r.id for r in wanted.collect()))
        return look_up(stored, wanted, *how)

    monkeypatch.setattr("roster.plans.load.look_up", seen)
    assert repair_incremental(spark, root, "two") == 1 and asked == [[4, 5]]
    assert repair_incremental(spark, root, "three") == 0 and asked[1:] == [[]]
    assert sorted(r.id for r in read_table(spark, root).collect()) == [1, 3, 5]
