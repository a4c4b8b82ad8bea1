"""Row predicates."""

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from roster.functions.text import upper_cell


def is_in_state(state_column: Column, state: str) -> Column:
    """The cleaned cell equals the state; a cheap test that it occurs at all rejects most rows."""
    return F.upper(state_column).contains(state) & (upper_cell(state_column) == state)


def has_class(class_column: Column, classes: Iterable[str]) -> Column:
    return upper_cell(class_column).isin(*classes)


def has_status(status: str) -> Column | None:
    """Predicate for a viewer status; None means every row, as does an unknown status."""
    return {"checked": F.col("checked"), "unchecked": ~F.col("checked")}.get(status)


def is_candidate() -> Column:
    """Not yet contacted, with an e-mail: neither NULL nor ''. One of blanks counts as an e-mail."""
    return ~F.col("checked") & (F.col("business_email") != "")
