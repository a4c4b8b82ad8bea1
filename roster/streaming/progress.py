"""What every micro-batch of the landing stream did, as a table."""

import threading
import uuid
from datetime import datetime

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from roster.plans.load import Targets
from roster.streaming.landing import Drop, load_stream

PROGRESS = """query string, run string, batch_id long, started timestamp, seconds double, files long,
    drops long, rows_read long, rows_matched long, rows_added long"""

_WAIT = 120.0  # seconds for Spark to deliver a query's last events


class _Recorder(StreamingQueryListener):
    """Writes a row when Spark reports that a micro-batch of the named query is done."""

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path
        self.loads: dict[int, list[dict]] = {}
        self.ended = threading.Event()
        self.run: str | None = None

    def loaded(self, batch_id: int, drop: Drop, report: dict) -> None:
        self.loads.setdefault(batch_id, []).append(report)

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self.run = str(event.runId)

    def onQueryProgress(self, event) -> None:
        done = event.progress
        reports = self.loads.pop(done.batchId, []) if done.name == self.name else []
        if done.name != self.name or not (done.numInputRows or reports):
            return
        totals = [sum(r[c] or 0 for r in reports) for c in ("rows_read", "rows_matched", "rows_added")]
        started = datetime.fromisoformat(done.timestamp.replace("Z", "+00:00"))
        seconds = done.durationMs.get("triggerExecution", 0) / 1000
        row = (str(done.id), str(done.runId), done.batchId, started, seconds, done.numInputRows, len(reports), *totals)
        self.spark.createDataFrame([row], PROGRESS).coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.runId) == self.run:
            self.ended.set()


def load_recorded(
    spark: SparkSession, landing: str, table: str, checkpoint: str, targets: Targets, progress: str, **how: bool
) -> None:
    """Run ``load_stream`` to its end and append a row for each of its micro-batches to ``progress``.

    ``files`` are those that the batch listed, ``drops`` the entries that were loaded, the rows are sums over their
    load reports. A batch that is run again after a failure has a row for each run that finished it.
    """
    recorder = _Recorder(spark, f"landing-{uuid.uuid4().hex}", progress)
    spark.streams.addListener(recorder)
    try:
        load_stream(spark, landing, table, checkpoint, targets, name=recorder.name, loaded=recorder.loaded, **how).awaitTermination()
        if not recorder.ended.wait(_WAIT):
            raise TimeoutError(f"Spark did not report the end of {recorder.name} within {_WAIT} seconds")
    finally:
        spark.streams.removeListener(recorder)


def read_progress(spark: SparkSession, progress: str):
    return spark.read.schema(PROGRESS).parquet(progress)
