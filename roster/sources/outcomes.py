"""The send log: one row per attempt, only ever appended to."""

from pyspark.sql import DataFrame, SparkSession

from roster.schema import SEND_LOG


def record_outcomes(outcomes: DataFrame, path: str) -> None:
    """Append attempts. A crashed run loses at most the attempts it had not appended yet."""
    outcomes.select(*SEND_LOG.fieldNames()).write.mode("append").parquet(path)


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEND_LOG).parquet(path)
