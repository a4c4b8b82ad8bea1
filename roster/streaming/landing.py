"""Incremental load: drops that arrive in a landing folder are loaded in order of arrival."""

import re
import warnings
from collections.abc import Callable
from typing import NamedTuple
from urllib.parse import urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType, TimestampType

from roster.plans.load import Targets, load
from roster.sources.registry import literal_path, read_registry, rejected_records
from roster.sources.table import commit_log, create_table

# Fixed value: the schema of Spark's binaryFile source, which a file stream must be given.
_BINARY_FILE = StructType(
    [
        StructField("path", StringType()),
        StructField("modificationTime", TimestampType()),
        StructField("length", LongType()),
        StructField("content", BinaryType()),
    ]
)

# A drop may be older than the newest one by any time: moving a file keeps its date.
_ANY_AGE = "100000d"


class Drop(NamedTuple):
    """One entry of the landing folder: a file, or a folder of part files."""

    entry: str
    load_key: str


def entry_of(path: Column, landing: str) -> Column:
    below = f"^.*?{re.escape(urlsplit(landing).path.rstrip('/'))}/+"
    return F.substring_index(F.regexp_replace(path, below, ""), "/", 1)


def _drops(spark: SparkSession, landing: str) -> DataFrame | None:
    """(entry, arrived, load_key) of what lies in the landing folder, or None where there is no folder."""
    try:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(literal_path(landing))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    arrived = F.unix_micros("modificationTime")
    content = F.sum(F.xxhash64("path", arrived, "length").cast("decimal(38,0)"))
    entries = files.groupBy(entry_of(F.col("path"), landing).alias("entry")).agg(
        F.min(arrived).alias("arrived"), F.count("*").alias("files"), content.alias("content")
    )
    key = F.concat_ws(":", "entry", F.col("files").cast("string"), F.col("content").cast("string"))
    return entries.select("entry", "arrived", key.alias("load_key"))


def _in_order(drops: DataFrame) -> list[Drop]:
    return [Drop(row.entry, row.load_key) for row in drops.orderBy("arrived", "entry").collect()]


def list_drops(spark: SparkSession, landing: str) -> list[Drop]:
    """What lies in the landing folder, in order of arrival.

    A load key is the entry's name and a sum over path, time and length of its files, so it is the same
    in every attempt and another one when a file has changed. One row per entry is gathered, not the files.
    """
    drops = _drops(spark, landing)
    return [] if drops is None else _in_order(drops)


def _load_drop(
    spark: SparkSession, landing: str, table: str, targets: Targets, drop: Drop, quarantine: bool = False, **how: bool
) -> dict:
    path = f"{landing.rstrip('/')}/{drop.entry}"
    aside = {"rejected": rejected_records(spark, path)} if quarantine else {}
    return load(spark, table, read_registry(spark, path, **how), targets, drop.load_key, **aside)


def loader(
    landing: str, table: str, targets: Targets, loaded: Callable[[int, Drop, dict], None] | None = None, **how: bool
) -> Callable[[DataFrame, int], None]:
    """The function that loads the drops of one micro-batch of file names into the table, and tells ``loaded`` of each."""

    def load_batch(files: DataFrame, batch_id: int) -> None:
        spark = files.sparkSession
        drops = _drops(spark, landing)
        if drops is None:
            return
        arrived = files.select(entry_of(F.col("path"), landing).alias("entry")).distinct()
        for drop in _in_order(drops.join(arrived, "entry", "left_semi")):
            report = _load_drop(spark, landing, table, targets, drop, **how)
            if loaded is not None:
                loaded(batch_id, drop, report)

    return load_batch


def load_changed(spark: SparkSession, landing: str, table: str, targets: Targets, **how: bool) -> None:
    """Load drops whose files changed under a name that was loaded before; a file stream only sees new names.

    The folder is compared with the commit log by joins; only changed drops are gathered.
    """
    create_table(spark, table)
    drops = _drops(spark, landing)
    if drops is None:
        return
    keys = commit_log(spark, table).select("load_key").distinct()
    entries = keys.select(F.regexp_replace("load_key", ":[^:]*:[^:]*\\z", "").alias("entry")).distinct()
    for drop in _in_order(drops.join(entries, "entry", "left_semi").join(keys, "load_key", "left_anti")):
        _load_drop(spark, landing, table, targets, drop, **how)


def hidden_entries(spark: SparkSession, landing: str) -> list[str]:
    """Names in the landing folder that Spark's readers pass over: they begin with ``_`` or ``.``.

    Empty where the session has no access to the file system, as on Spark Connect.
    """
    jvm = getattr(spark, "_jvm", None)
    if jvm is None:
        return []
    path = jvm.org.apache.hadoop.fs.Path(landing)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in system.listStatus(path)] if system.exists(path) else []
    return sorted(n for n in names if n[0] in "_." and not n.endswith((".crc", "_COPYING_")) and n != "_SUCCESS")


def load_stream(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    targets: Targets,
    name: str | None = None,
    loaded: Callable[[int, Drop, dict], None] | None = None,
    **how: bool,
) -> StreamingQuery:
    """Load every drop not seen before, then stop; missed runs are caught up by the next one.

    Move each drop into the landing folder when it is complete. Its date does not matter. A file that
    was replaced under its old name is loaded again, as a drop of its own; since loads only insert, the
    people already known stay as they are. Names that begin with ``_`` or ``.`` cannot be read: a
    warning names them.

    The stream carries names and times only. Content is read by the load of each drop, so a later
    drop meets the earlier ones in the table, exactly as in separate runs. With ``quarantine`` each drop's
    faulty records are set aside and counted, see ``load``. ``loaded`` is told the number of the micro-batch, the
    drop and its load report; ``progress.load_recorded`` writes them down. The rest of ``how`` is passed on to ``read_registry``.
    """
    if passed_over := hidden_entries(spark, landing):
        warnings.warn(f"not loaded, as their names begin with _ or a dot: {', '.join(passed_over)}", stacklevel=2)
    load_changed(spark, landing, table, targets, **how)
    names = (
        spark.readStream.format("binaryFile")
        .schema(_BINARY_FILE)
        .option("recursiveFileLookup", True)
        .option("maxFileAge", _ANY_AGE)
        .load(literal_path(landing))
        .select("path", "modificationTime")
    )
    writer = names.writeStream.foreachBatch(loader(landing, table, targets, loaded, **how)).option("checkpointLocation", checkpoint)
    writer = writer if name is None else writer.queryName(name)
    return writer.trigger(availableNow=True).start()
