"""Find rows by their rank along the id, at any depth, without gathering the rows before them."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roster.session import freeze

# Up to this rank a bounded top-k is cheap; beyond it the rank is found by counting.
SHALLOW = 10_000
_BUCKETS = 1024


def id_at_rank(ids: DataFrame, rank: int) -> int | None:
    """The id of the row with this zero-based rank, or None beyond the last row.

    Each round counts the rows in 1024 equal ranges of the id and goes on with the range that
    holds the rank: three rounds over the id column for 10^9 ids, four for 10^12. ``ids`` must be
    the same in every round, as a frozen frame is.
    """
    low, high, rows = ids.agg(F.min("id"), F.max("id"), F.count("id")).first()
    if rank >= rows:
        return None
    while low < high:
        width = -(-(high - low + 1) // _BUCKETS)
        bucket = F.expr(f"(id - {low}L) div {width}L")
        counts = (
            ids.where(F.col("id").between(low, high)).groupBy(bucket.alias("bucket")).count().collect()
        )
        for place, count in sorted((row["bucket"], row["count"]) for row in counts):
            if rank < count:
                low, high = low + place * width, min(high, low + (place + 1) * width - 1)
                break
            rank -= count
        else:
            raise RuntimeError("the ids changed while they were counted")
    return low


def slice_by_rank(df: DataFrame, start: int, size: int, shallow: int = SHALLOW) -> DataFrame:
    """The rows ranked start .. start+size-1 by id, in that order.

    First the ids of the slice's ends are found, from the columns that decide the ranks: near the
    beginning by a top-k, further on by counting over the ids, which are written down so that what
    they come from is evaluated once. Then the rows are fetched between these ids; the bounds reach
    the scan, so a table laid out by id opens a few row groups.
    """
    ids = df.select("id")
    if start + size > shallow:
        ids = freeze(ids, "ids")
        first = id_at_rank(ids, start) if size > 0 else None
        part = ids.where(F.col("id") >= first).orderBy("id") if first is not None else ids.limit(0)
    else:
        part = ids.orderBy("id").offset(start)
    first, last = part.limit(size).agg(F.min("id"), F.max("id")).first()
    return df.limit(0) if first is None else df.where(F.col("id").between(first, last)).orderBy("id").limit(size)
