"""Insert-only merge: find the new rows and give them ids."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roster.schema import IDENTITY, IDENTITY_HASH, LICENCE
from roster.session import freeze

# monotonically_increasing_id() holds the partition above this bit and the row below it.
_ROW_BITS = 33

# Up to this many rows, known beforehand, may be numbered by one task.
FEW_ROWS = 100_000


# Up to this many identities are looked up through the Bloom filters of the stored rows.
PROBED = 10_000


def identity_hash() -> Column:
    """A number that is equal for equal identities, with NULL and '' as one."""
    return F.xxhash64(*[F.coalesce(key, F.lit("")) for key in IDENTITY])


def look_up(stored: DataFrame, wanted: DataFrame, probed: int = PROBED) -> DataFrame:
    """The stored rows whose identity hash is among the wanted ones.

    A few hashes become a list in the scan's filter: Parquet asks each row group's Bloom filter for them and
    reads only the groups that may have one. Many are a semi join. ``stored`` has the hash as a column.
    """
    hashes = wanted.select(identity_hash().alias(IDENTITY_HASH)).distinct()
    few = [row[0] for row in hashes.limit(probed + 1).collect()]
    if len(few) > probed:
        return stored.join(hashes, IDENTITY_HASH, "left_semi")
    return stored.where(F.col(IDENTITY_HASH).isin(few)) if few else stored.limit(0)


def insert_new_indexed(stored: DataFrame, batch: DataFrame, probed: int = PROBED) -> DataFrame:
    """``insert_new`` for a batch that is small against the table: only row groups that may hold its people are read."""
    return insert_new(look_up(stored, batch, probed), batch)


def insert_new(target: DataFrame, batch: DataFrame, keys: Sequence[str] = IDENTITY) -> DataFrame:
    """Batch rows whose identity is not in the target yet; here NULL and '' are the same.

    The target is first cut to the identities that the batch asks for. Spark broadcasts the
    batch's keys for that when their size allows it, and then the target is scanned but never
    shuffled. Otherwise both sides are shuffled by key; the target's keys are made distinct
    before the shuffle, so an identity stored many times does not become a hot key.
    """
    names = [f"_{key}" for key in keys]
    match = [F.coalesce(F.col(key), F.lit("")).alias(name) for key, name in zip(keys, names)]
    keyed = batch.select("*", *match)
    known = target.select(*match).distinct().join(keyed.select(*names), names, "left_semi")
    return keyed.join(known, names, "left_anti").drop(*names)


def number_rows(
    df: DataFrame, order: Sequence[str], name: str, start: int = 0, at_most: int | None = None
) -> DataFrame:
    """Number the rows start+1, start+2, ... along a unique order.

    Where the caller knows that there are few rows at most, a window numbers them in one task.
    Otherwise the rows are spread by ranges of the order and sorted within each range. That layout
    is written down, then every range is shifted by the number of rows before it. The shifts are
    one row per range, so broadcasting them is safe at any size of ``df``.
    """
    if at_most is not None and at_most <= FEW_ROWS:
        place = F.row_number().over(Window.orderBy(*order)).cast("long")
        return df.withColumn(name, F.lit(start) + place)
    slot = F.monotonically_increasing_id()
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", slot.alias("_slot"))
    placed = freeze(placed, "numbered")

    part = F.shiftright("_slot", _ROW_BITS)
    row = F.col("_slot").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        placed.groupBy(part.alias("_part"))
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_shift"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(shifts), "_part")
        .withColumn(name, F.lit(start) + F.col("_shift") + row + 1)
        .drop("_part", "_shift", "_slot")
    )


def assign_ids(
    fresh: DataFrame, start: int, order: Sequence[str], at_most: int | None = None
) -> DataFrame:
    """Licence rows with the ids start+1, start+2, ... in the given order."""
    return number_rows(fresh, order, "id", start, at_most).select(*LICENCE.fieldNames())


def append(target: DataFrame, added: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return target.unionByName(added)
