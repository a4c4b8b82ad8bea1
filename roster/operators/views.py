"""What the viewer shows: tallies, status filter and pages."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roster.functions.predicates import has_status
from roster.functions.text import tel_link
from roster.operators.ranks import SHALLOW, slice_by_rank
from roster.schema import BATCH_COLUMNS

# Fixed value: rows on a page.
PAGE_SIZE = 50

_LARGEST_LONG = 2**63 - 1


def status_filter(licences: DataFrame, status: str) -> DataFrame:
    """Rows of a status: all, checked or unchecked. An unknown status means all."""
    predicate = has_status(status)
    return licences if predicate is None else licences.where(predicate)


def status_tallies(licences: DataFrame) -> DataFrame:
    """One row with the number of all, checked and unchecked licences, from one pass."""
    return licences.agg(
        F.count("*").alias("count_all"),
        F.count_if("checked").alias("count_checked"),
        F.count_if(~F.col("checked")).alias("count_unchecked"),
    )


def requested_page(page: object) -> int:
    """The page a caller asks for; what is not a number, or is below 1, means page 1."""
    try:
        return max(1, int(page))
    except (TypeError, ValueError, OverflowError):
        return 1


def _total(status: str) -> Column:
    known = status if status in ("all", "checked", "unchecked") else "all"
    return F.col(f"count_{known}")


def page_info(
    licences: DataFrame, status: str = "all", page: object = 1, size: int = PAGE_SIZE
) -> DataFrame:
    """One row: rows of the status, number of pages (at least 1) and the page within them."""
    return page_numbers(status_tallies(licences), status, page, size)


def page_numbers(tallies: DataFrame, status: str, page: object, size: int) -> DataFrame:
    """``page_info`` from the row of tallies."""
    pages = F.greatest(F.lit(1), F.expr(f"(total + {size - 1}) div {size}")).cast("long")
    wanted = requested_page(page)
    shown = F.least(F.lit(wanted), "total_pages") if wanted <= _LARGEST_LONG else F.col("total_pages")
    return (
        tallies.select(_total(status).alias("total"))
        .select("total", pages.alias("total_pages"))
        .select("total", "total_pages", shown.cast("long").alias("page"))
    )


def shown_columns(rows: DataFrame) -> DataFrame:
    """What a page shows of its rows, with the phone as a link."""
    return rows.select(*BATCH_COLUMNS, tel_link(F.col("business_phone")).alias("phone_href"))


def status_page(
    licences: DataFrame,
    status: str = "all",
    page: object = 1,
    size: int = PAGE_SIZE,
    shallow: int = SHALLOW,
) -> DataFrame:
    """One page in id order, with the phone as a link; a page beyond the last is the last one."""
    shown = page_info(licences, status, page, size).first()["page"]
    rows = slice_by_rank(status_filter(licences, status), (shown - 1) * size, size, shallow)
    return shown_columns(rows)
