"""Snapshots of what is new, restored only with the content that was saved."""

import shutil

import pytest
from pyspark.sql import functions as F

from roster.schema import LICENCE
from roster.sources.snapshots import checksum, restore_table, save_table
from roster.sources.table import append_batch, create_table, read_table, replace_table


def content(df):
    return sorted(tuple(r) for r in df.collect())


def add(spark, root, name, rows):
    append_batch(spark, root, create_table(spark, root), name, rows)


def test_only_new_folders_are_copied(spark, licences, tmp_path):
    root, saved = str(tmp_path / "t"), str(tmp_path / "saved")
    assert save_table(spark, root, saved, "0") == 0
    add(spark, root, "one", licences((1, "A", "a@x"), (2, "B", "")))
    assert save_table(spark, root, saved, "1") == 1
    first = content(read_table(spark, root))
    add(spark, root, "two", licences((3, "C", None)))
    assert save_table(spark, root, saved, "2") == 1
    second = content(read_table(spark, root))
    replace_table(spark, root, licences((9, "Z", None)), "change")
    assert restore_table(spark, saved, "2", root) == 3 and content(read_table(spark, root)) == second
    assert restore_table(spark, saved, "1", root) == 2 and content(read_table(spark, root)) == first
    assert restore_table(spark, saved, "0", root) == 0 and content(read_table(spark, root)) == []
    with pytest.raises(ValueError, match="already"):
        save_table(spark, root, saved, "1")
    with pytest.raises(ValueError, match="no complete snapshot"):
        restore_table(spark, saved, "3", root)


def test_one_changed_cell_is_found(spark, licences, tmp_path):
    root, saved = str(tmp_path / "t"), tmp_path / "saved"
    add(spark, root, "one", licences((1, "A", "a@x"), (2, "B", "b@x")))
    save_table(spark, root, str(saved), "1")
    add(spark, root, "two", licences((3, "C", "c@x")))
    before = content(read_table(spark, root))
    (copy,) = (saved / "copies").iterdir()
    changed = spark.read.schema(LICENCE).parquet(str(copy)).withColumn("business_phone", F.when(F.col("id") == 2, "0").otherwise(F.col("business_phone")))
    changed.write.parquet(str(tmp_path / "changed"))
    shutil.copytree(tmp_path / "changed", copy, dirs_exist_ok=True, ignore=shutil.ignore_patterns("_*", ".*"))
    for part in copy.glob("part-*"):
        if not (tmp_path / "changed" / part.name).exists():
            part.unlink()
    assert spark.read.parquet(str(copy)).count() == 2
    with pytest.raises(RuntimeError, match="not what was saved"):
        restore_table(spark, str(saved), "1", root)
    assert content(read_table(spark, root)) == before


def test_checksums(spark, licences):
    rows = licences((1, "A", None), (2, None, "A"), (3, "B", ""), (3, "B", ""))
    same = licences((3, "B", ""), (2, None, "A"), (3, "B", ""), (1, "A", None)).repartition(3)
    assert checksum(rows).first() == checksum(same).first()
    others = [licences((1, None, "A"), (2, None, "A"), (3, "B", ""), (3, "B", "")), licences((1, "A", None), (2, None, "A"), (3, "B", "")),
              licences((1, "A", ""), (2, None, "A"), (3, "B", ""), (3, "B", "")), licences()]
    sums = [tuple(checksum(other).first())[1:] for other in [rows, *others]]
    assert len(set(sums)) == len(sums)
    assert tuple(checksum(licences()).first()) == (0, 0, 0)
