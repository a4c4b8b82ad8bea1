"""Counts of stored rows by ranges of ids, kept with every folder and every change of status.

A folder of rows has beside it one row for each range of ids: how many licences, and how many of them are checked.
Changes of status by staff or by the send log are written together with what they change in these counts. So
tallies are a sum over a narrow table, and the rank of a row is found by sums along the ranges: no licence is
read for a page's numbers, and for its rows only those of a few ranges.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SPAN = 4096  # ids in a range

_COUNTS = "span long, rows long, checked long, last_id long"


def counts_of(folder: str) -> str:
    """Where the counts of a folder of rows are."""
    return folder.replace("rows/", "counts/", 1)


def span_of(name: str = "id"):
    return F.floor(F.col(name) / SPAN).cast("long")


def write_counts(licences: DataFrame, path: str) -> None:
    counts = licences.groupBy(span_of().alias("span")).agg(
        F.count("*").alias("rows"), F.count_if("checked").alias("checked"), F.max("id").alias("last_id")
    )
    counts.write.parquet(path)


def read_counts(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(_COUNTS).parquet(*paths) if paths else spark.createDataFrame([], _COUNTS)


def tallies(counts: DataFrame) -> DataFrame:
    """The three tallies of the viewer, from counts."""
    rows, checked = (F.coalesce(F.sum(c), F.lit(0)) for c in ("rows", "checked"))
    return counts.agg(rows.alias("count_all"), checked.alias("count_checked"), (rows - checked).alias("count_unchecked"))


def spans_of_slice(counts: DataFrame, status: str, start: int, size: int) -> DataFrame:
    """(span, before): the ranges that hold the ranks start .. start+size-1 of a status, and the rows of it before each.

    Ranges are summed in groups first, so no task gets more than the groups and the ranges of a few of them.
    """
    held = {"checked": F.col("checked"), "unchecked": F.col("rows") - F.col("checked")}.get(status, F.col("rows"))
    spans = counts.groupBy("span").agg(F.sum(held).alias("n")).where(F.col("n") > 0)
    spans = spans.withColumn("part", F.floor(F.col("span") / SPAN))
    parts = spans.groupBy("part").agg(F.sum("n").alias("part_n"))
    parts = parts.withColumn("part_before", _before("part_n", Window.orderBy("part")))
    touched = parts.where((F.col("part_before") < start + size) & (F.col("part_before") + F.col("part_n") > start))
    inside = spans.join(touched.drop("part_n"), "part")
    before = F.col("part_before") + _before("n", Window.partitionBy("part").orderBy("span"))
    placed = inside.withColumn("before", before)
    return placed.where((F.col("before") < start + size) & (F.col("before") + F.col("n") > start)).select("span", "before")


def _before(name: str, window):
    return F.coalesce(F.sum(name).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
