"""The send log as a stream: outcome files of the mailer become changes of the table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from roster.schema import SEND_LOG
from roster.session import freeze, scratch
from roster.sources.changes import record_changes
from roster.sources.registry import literal_path


def mark_stream(spark: SparkSession, outcomes: str, root: str, checkpoint: str, name: str = "outcomes") -> StreamingQuery:
    """Record the successes in every outcome file not seen before, then stop.

    The state store keeps each id that was sent to, so a success that is reported again, in whatever later file, is
    recorded once; there are never more ids than licences. A micro-batch is recorded under its number: when it is
    run again after a failure, it finds itself recorded. Failures change nothing and stay in their files.
    """

    def record(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession, "outcomes"):
            # The state store is kept only if the whole batch is computed, also one that is recorded already.
            given = freeze(batch, "batch")
            record_changes(batch.sparkSession, root, f"{name}-{batch_id}", outcomes=given)

    attempts = spark.readStream.schema(SEND_LOG).option("maxFileAge", "100000d").parquet(literal_path(outcomes))
    return (
        attempts.where("ok")
        .dropDuplicates(["id"])
        .writeStream.foreachBatch(record)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
