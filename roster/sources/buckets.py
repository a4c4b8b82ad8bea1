"""The licence table laid out in buckets of the identity hash, for repairs and large loads that do not shuffle it.

A Spark table in the session's catalog: all rows of a person lie in one bucket, so grouping by person needs no
exchange, and a batch is dealt to the buckets instead of the table to the batch. The layout pays when batches are
large; daily batches are found faster through the Bloom filters of the ordinary table.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roster.operators.merge import identity_hash
from roster.schema import IDENTITY, IDENTITY_HASH, LICENCE

BUCKETS = 64


def create_buckets(spark: SparkSession, name: str, path: str, buckets: int = BUCKETS) -> None:
    """Make the files at ``path``, if any, known as the table ``name``; ``buckets`` must be what they were written with."""
    columns = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in LICENCE)
    location = path.replace("'", "''")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {IDENTITY_HASH} bigint) USING parquet"
        f" CLUSTERED BY ({IDENTITY_HASH}) SORTED BY ({IDENTITY_HASH}) INTO {buckets} BUCKETS LOCATION '{location}'"
    )


def append_buckets(licences: DataFrame, name: str) -> None:
    """Add rows; they are dealt to the buckets first, so that each bucket gets one file."""
    spark = licences.sparkSession
    buckets = int(spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Num Buckets'").first()["data_type"])
    rows = licences.select(*LICENCE.fieldNames(), identity_hash().alias(IDENTITY_HASH))
    rows.repartition(buckets, IDENTITY_HASH).write.insertInto(name)


def duplicate_ids_in_buckets(table: DataFrame) -> DataFrame:
    """The ids that ``repair_duplicates`` drops; the hash comes first, so the buckets serve as they are."""
    first = Window.partitionBy(IDENTITY_HASH, *IDENTITY).orderBy("id")
    return table.select("id", IDENTITY_HASH, *IDENTITY).withColumn("rank", F.row_number().over(first)).where(F.col("rank") > 1).select("id")


def insert_new_in_buckets(table: DataFrame, batch: DataFrame) -> DataFrame:
    """``insert_new`` where only the batch is dealt out.

    The hash alone is the join's key, as the buckets know no other; the columns themselves are compared by order,
    which Spark does not take for keys.
    """
    names = [f"_{key}" for key in IDENTITY]
    mine = [F.coalesce(key, F.lit("")).alias(name) for key, name in zip(IDENTITY, names)]
    stored = table.select(F.col(IDENTITY_HASH).alias("_hash"), *[m.alias(f"{n}_") for m, n in zip(mine, names)])
    asked = batch.select("*", identity_hash().alias(IDENTITY_HASH), *mine)
    same = F.col(IDENTITY_HASH) == F.col("_hash")
    for name in names:
        same = same & (F.col(name) <= F.col(f"{name}_")) & (F.col(name) >= F.col(f"{name}_"))
    return asked.join(stored, same, "left_anti").drop(IDENTITY_HASH, *names)
