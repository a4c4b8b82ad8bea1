"""A table in buckets: the same results as without, and no exchange of the table."""

import random
import uuid

import pytest

from roster.operators.dedupe import duplicate_ids
from roster.operators.merge import insert_new
from roster.session import freeze
from roster.sources.buckets import append_buckets, create_buckets, duplicate_ids_in_buckets, insert_new_in_buckets


@pytest.fixture
def people(spark, licences, tmp_path):
    """300 licences of 60 people, among them NULL and empty names, in a table of two portions; returns its name and the rows."""
    pick, name = random.Random(4), f"t{uuid.uuid4().hex}"
    rows = licences(*[(i, pick.choice([*"ABCDEFGHIJ", "", None]), pick.choice(["a@x", "A@x", "b@x", "", None])) for i in range(300)])
    create_buckets(spark, name, str(tmp_path / "it's"), buckets=4)
    append_buckets(rows.where("id % 3 = 0"), name)
    append_buckets(rows.where("id % 3 <> 0"), name)
    yield name, rows
    spark.sql(f"DROP TABLE {name}")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_repair_without_an_exchange(spark, people):
    name, rows = people
    found = duplicate_ids_in_buckets(spark.table(name))
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in duplicate_ids(rows).collect())
    assert "Exchange" not in plan(found) and "Bucketed: true" in plan(found)


def test_insert_deals_out_the_batch_only(spark, people, batch):
    name, rows = people
    pick = random.Random(5)
    asked = freeze(batch(*[(i, pick.choice(["A", "B", "new", "", None]), pick.choice(["a@x", "c@x", "", None])) for i in range(40)]), "batch")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = insert_new_in_buckets(spark.table(name), asked)
        text = plan(fresh)
        assert sorted(r.ordinal for r in fresh.collect()) == sorted(r.ordinal for r in insert_new(rows, asked).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert fresh.columns == asked.columns
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in text


def test_files_of_an_earlier_session_are_found(spark, people, tmp_path):
    name, rows = people
    create_buckets(spark, f"{name}_again", str(tmp_path / "it's"), buckets=4)
    assert spark.table(f"{name}_again").count() == rows.count()
    spark.sql(f"DROP TABLE {name}_again")
    assert spark.table(name).count() == rows.count()
