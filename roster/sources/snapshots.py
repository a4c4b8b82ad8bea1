"""Snapshots that copy only what is new, and are restored only if they still hold what was saved.

A row folder of a table never changes, so a snapshot copies the folders that no earlier one has. Its manifest names
the folders with a checksum of each: the number of rows and two sums of independent hashes of them, which do
not depend on their order but change with any cell. The manifest is written last; without it there is no snapshot.
"""

import uuid
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roster.schema import LICENCE
from roster.sources.table import create_table, read_folders, replace_table

_MANIFEST = "ts string, folder string, copy string, rows long, sum_a decimal(38,0), sum_b decimal(38,0)"


def _hash(seed: int) -> Column:
    # Spark's hash passes over a NULL, so whether a cell is one is hashed too.
    cells = [x for name in LICENCE.fieldNames() for x in (F.isnull(name), F.col(name))]
    return F.xxhash64(F.lit(seed), *cells).cast("decimal(38,0)")


def checksum(licences: DataFrame) -> DataFrame:
    """One row that equal bags of licences share: rows, sum_a and sum_b."""
    sums = [F.coalesce(F.sum(_hash(seed)), F.lit(0)).cast("decimal(38,0)").alias(name) for seed, name in ((1, "sum_a"), (2, "sum_b"))]
    return licences.agg(F.count("*").alias("rows"), *sums)


def _manifests(spark: SparkSession, saved: str) -> DataFrame:
    found = read_folders(spark, _MANIFEST, f"{saved}/manifests")
    return found if found is not None else spark.createDataFrame([], _MANIFEST)


def save_table(spark: SparkSession, root: str, saved: str, ts: str) -> int:
    """Save the table under a time stamp; returns how many folders had to be copied. An older time stamp is refused again."""
    state = create_table(spark, root)
    manifests = _manifests(spark, saved)
    if not manifests.where(F.col("ts") == ts).isEmpty():
        raise ValueError(f"there is a snapshot {ts} in {saved} already")
    folders = [c.folder for c in state.commits if c.rows]
    known = {row.folder: row for row in manifests.where(F.col("folder").isin(folders)).dropDuplicates(["folder"]).collect()}
    entries = [(ts, f, known[f].copy, known[f].rows, known[f].sum_a, known[f].sum_b) for f in folders if f in known]
    for folder in folders:
        if folder in known:
            continue
        copy = f"copies/{uuid.uuid4().hex}"
        spark.read.schema(LICENCE).parquet(f"{root}/{folder}").write.parquet(f"{saved}/{copy}")
        # The sums are those of the table's own rows, so a copy that went wrong is found when it is restored.
        entries.append((ts, folder, copy, *checksum(spark.read.schema(LICENCE).parquet(f"{root}/{folder}")).first()))
    if not entries:
        entries = [(ts, None, None, 0, Decimal(0), Decimal(0))]
    spark.createDataFrame(entries, _MANIFEST).coalesce(1).write.parquet(f"{saved}/manifests/{ts}-{uuid.uuid4().hex}")
    return len(folders) - len(known)


def restore_table(spark: SparkSession, saved: str, ts: str, root: str) -> int:
    """Replace the table by a snapshot, if each of its folders has the content that was saved; returns its rows."""
    entries = _manifests(spark, saved).where(F.col("ts") == ts).collect()
    if not entries:
        raise ValueError(f"there is no complete snapshot {ts} in {saved}")
    copies = [f"{saved}/{e.copy}" for e in entries if e.copy]
    for entry in entries:
        if entry.copy:
            found = checksum(spark.read.schema(LICENCE).parquet(f"{saved}/{entry.copy}")).first()
            if tuple(found) != (entry.rows, entry.sum_a, entry.sum_b):
                raise RuntimeError(f"{entry.copy} of the snapshot {ts} is not what was saved; the table is unchanged")
    rows = spark.read.schema(LICENCE).parquet(*copies) if copies else spark.createDataFrame([], LICENCE)
    total = sum(e.rows for e in entries)
    replace_table(spark, root, rows, f"restore-{ts}-{uuid.uuid4().hex}", restored=True, expected=total)
    return total
