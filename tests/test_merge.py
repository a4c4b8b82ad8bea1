"""Keep-first, insert-only merge, ids and repair; the three rules for NULL and ''."""

import random

from pyspark.sql import functions as F

from roster.operators.dedupe import duplicate_ids, keep_first, repair_duplicates
from roster.operators.merge import assign_ids, insert_new, number_rows
from roster.plans.load import load_report
from roster.schema import IDENTITY


def people(df):
    return sorted(((r.full_name, r.business_email) for r in df.collect()), key=str)


def test_batch_keeps_the_first_row_and_groups_nulls(batch):
    rows = batch((5, "A", None), (3, "A", None), (4, "A", "a@x"), (9, "A", "A@x"), (1, "A", "a@x"), (7, None, None))
    kept = keep_first(rows, IDENTITY, ["ordinal"])
    assert sorted(r.ordinal for r in kept.collect()) == [1, 3, 7, 9]


def test_one_person_with_two_licence_classes_keeps_the_first(batch):
    rows = batch((1, "A", "a@x"), (2, "A", "a@x")).withColumn("license_type", F.col("license_number"))
    assert [r.license_type for r in keep_first(rows, IDENTITY, ["ordinal"]).collect()] == ["L1"]


def test_insert_treats_null_and_empty_as_equal(batch, licences):
    table = licences((1, "A", None), (2, "B", ""), (3, "C", "c@x"))
    rows = batch((1, "A", None), (2, "B", None), (3, "C", "C@x"), (4, "C", "c@x"), (5, None, None))
    assert people(insert_new(table, rows)) == [("C", "C@x"), (None, None)]


def test_insert_keeps_the_batch_columns(batch, licences):
    rows = batch((1, "A", "a@x"))
    assert insert_new(licences((1, "Z", None)), rows).columns == rows.columns


def test_insert_by_shuffle_equals_insert_by_broadcast(spark, batch, licences):
    table = licences(*[(i, f"P{i % 40}", [None, "", "e@x"][i % 3]) for i in range(200)])
    rows = batch(*[(i, f"P{i}", [None, "e@x"][i % 2]) for i in range(80)])
    small = people(insert_new(table, rows))
    for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "-1")
    try:
        assert people(insert_new(table, rows)) == small
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_repair_keeps_null_and_empty_apart(licences):
    table = licences((1, "A", None), (2, "A", None), (3, "A", ""), (4, "A", "a@x"), (5, "A", "a@x"))
    assert sorted(r.id for r in repair_duplicates(table).collect()) == [1, 3, 4]
    assert sorted(r.id for r in duplicate_ids(table).collect()) == [2, 5]


def test_repair_may_drop_the_checked_copy_and_is_idempotent(licences):
    once = repair_duplicates(licences((1, "A", "a@x", False), (2, "A", "a@x", True)))
    assert [(r.id, r.checked) for r in once.collect()] == [(1, False)]
    assert repair_duplicates(once).collect() == once.collect()


def test_numbers_follow_the_order(spark):
    keys = list(range(5000))
    random.Random(7).shuffle(keys)
    rows = spark.createDataFrame([(k * 3,) for k in keys], "k long").repartition(7)
    got = number_rows(rows, ["k"], "n", start=10).collect()
    assert sorted((r.n, r.k) for r in got) == [(i + 11, i * 3) for i in range(5000)]
    few = number_rows(rows, ["k"], "n", start=10, at_most=5000)
    assert sorted((r.n, r.k) for r in few.collect()) == [(i + 11, i * 3) for i in range(5000)]
    assert few.schema["n"].dataType.typeName() == "long"


def test_numbering_nothing(spark, batch):
    assert assign_ids(batch((1, "A", None)).limit(0), 5, ["ordinal"]).collect() == []


def test_load_report(licences):
    row = load_report(licences((1, "A", None)), licences((1, "A", None), (2, "B", None))).first()
    assert row.asDict() == {"rows_before": 1, "rows_after": 2, "rows_added": 1}


def test_a_hot_identity_is_reduced_before_the_shuffle(spark):
    """A third of all rows in one identity: each task passes on one of them."""
    rows = spark.range(0, 60_000, numPartitions=6).select(
        F.col("id").alias("ordinal"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.col("id").cast("string")).alias("full_name"),
        F.lit(None).cast("string").alias("business_email"),
    )
    kept = keep_first(rows, IDENTITY, ["ordinal"])
    assert kept.count() == 40_001
    assert kept.where("full_name = 'HOT'").first().ordinal == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial") > plan.index("hashpartitioning")
