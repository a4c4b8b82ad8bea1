"""Session helpers: a local session for tests, and the shared folder for intermediate tables."""

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("roster")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Where the setting is absent a local session gets a temporary folder; on a cluster that
    folder would exist on one machine only, so its absence is an error there.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="roster-"))
        named = context.getCheckpointDir()
    return named.rstrip("/")


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder, or in the job's own folder there, that nothing has used before."""
    top = _scratch.get() or f"{shared_dir(spark)}/roster"
    return f"{top}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[None]:
    """Within it, intermediate tables go to one folder, which is removed in the end.

    For jobs that have written their result by then. Where the session has no access to the file
    system, as on Spark Connect, the folder stays.
    """
    folder = scratch_path(spark, label)
    token = _scratch.set(folder)
    try:
        yield
    finally:
        _scratch.reset(token)
        if (jvm := getattr(spark, "_jvm", None)) is not None:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def freeze(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder once and read it back.

    The result has a fixed content however often it is used and whichever executor is lost,
    and Spark knows its size from the files, so later joins can pick a broadcast safely.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
