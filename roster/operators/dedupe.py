"""Keep the first row of every identity."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roster.schema import IDENTITY


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key in the given order; NULL keys form one group, apart from ''.

    Spark applies the rank limit before the shuffle too, so every input task sends at most one
    row per key: a key that holds a third of all rows costs one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def repair_duplicates(licences: DataFrame) -> DataFrame:
    """Keep the row with the smallest id of every identity."""
    return keep_first(licences, IDENTITY, ["id"])


def duplicate_ids(licences: DataFrame) -> DataFrame:
    """The ids that ``repair_duplicates`` drops.

    Only the identity and the id are shuffled. The minimum is partly computed before the shuffle
    and the second step runs on the unique id, so a hot identity burdens no task.
    """
    kept = licences.groupBy(*IDENTITY).agg(F.min("id").alias("id")).select("id")
    return licences.select("id").join(kept, "id", "left_anti")
