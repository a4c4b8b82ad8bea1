"""Headered CSV in and out: the staged batch and exported query results."""

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roster.schema import BATCH_COLUMNS, STAGING_HEADERS, TEXT_COLUMNS

# Values are written as they are; a quote inside a quoted value is doubled.
_WRITE = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}

# The texts that mean true and false in a staged boolean.
TRUE_TEXTS = ["t", "tr", "tru", "true", "y", "ye", "yes", "on", "1"]
FALSE_TEXTS = ["f", "fa", "fal", "fals", "false", "n", "no", "of", "off", "0"]


def write_staging(batch: DataFrame, path: str) -> int:
    """Write a batch as CSV in the fixed column order and return its number of rows.

    An empty text is written as an empty cell, like NULL. The rows are counted by the write job.
    """
    written = Observation("staged")
    columns = [F.col(name).alias(header) for name, header in STAGING_HEADERS.items()]
    staged = batch.select(*columns).observe(written, F.count(F.lit(1)).alias("rows"))
    staged.write.options(**_WRITE, emptyValue="").csv(path)
    return written.get["rows"]


def _to_boolean(text: Column) -> Column:
    word = F.lower(F.trim(text))
    return (
        F.when(word.isin(TRUE_TEXTS), True)
        .when(word.isin(FALSE_TEXTS), False)
        .when(text.isNotNull(), F.raise_error(F.concat(F.lit("not a boolean: "), text)).cast("boolean"))
    )


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    """Read a staged batch by position: header skipped, empty cells as NULL, text to boolean."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in BATCH_COLUMNS])
    cells = spark.read.schema(schema).options(header=True, escape='"', multiLine=True).csv(path)
    texts = [F.nullif(name, F.lit("")).alias(name) for name in TEXT_COLUMNS]
    return cells.select(*texts, _to_boolean(F.col("checked")).alias("checked"))


def export_csv(df: DataFrame, path: str) -> None:
    """Write a query result as headered CSV: NULL as an empty cell, '' as a quoted empty cell."""
    df.write.options(**_WRITE).csv(path)


def read_export(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(header=True, escape='"', multiLine=True).csv(path)
