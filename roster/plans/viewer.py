"""The viewer on a stored table: numbers and pages from maintained counts, without a pass over the licences."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roster.operators.views import PAGE_SIZE, page_numbers, shown_columns, status_filter
from roster.sources.changes import maintained_counts, read_changes, with_changes
from roster.sources.counts import SPAN, spans_of_slice, tallies
from roster.sources.table import create_table, read_table


def stored_tallies(spark: SparkSession, root: str) -> DataFrame:
    """The tallies of the table with all changes."""
    return tallies(maintained_counts(spark, root))


def stored_page_info(spark: SparkSession, root: str, status: str = "all", page: object = 1, size: int = PAGE_SIZE) -> DataFrame:
    return page_numbers(stored_tallies(spark, root), status, page, size)


def stored_page(spark: SparkSession, root: str, status: str = "all", page: object = 1, size: int = PAGE_SIZE) -> DataFrame:
    """One page in id order, at any depth: ranges of ids are found by counts, and only their licences and changes are read."""
    state = create_table(spark, root)
    counts = maintained_counts(spark, root, state)
    start = (page_numbers(tallies(counts), status, page, size).first()["page"] - 1) * size
    # Each range has a row of the page, so there are at most as many as rows.
    spans = sorted((row.span, row.before) for row in spans_of_slice(counts, status, start, size).collect())
    licences = read_table(spark, root, state)
    if not spans:
        return shown_columns(licences.limit(0))
    ids = F.col("id").between(spans[0][0] * SPAN, (spans[-1][0] + 1) * SPAN - 1)
    rows = status_filter(with_changes(licences.where(ids), read_changes(spark, root).where(ids)), status)
    return shown_columns(rows.orderBy("id").offset(start - spans[0][1]).limit(size))
