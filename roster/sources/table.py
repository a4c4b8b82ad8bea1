"""The licence table on shared storage.

Rows live in Parquet folders that are written once and never changed. A ``commits`` table, one file
with one row per change, names the folders that make up the table. A change becomes visible by its
commit, so a job that fails half-way leaves the table as it was.

Every change is built on a state, and its commit is named by that state. The file is written aside and put
into place by one step that fails if the name is taken: a link on a local file system, else a rename
without overwriting, which shared file systems such as HDFS do as one step. So of all changes built on a
state, whatever they are, exactly one is committed. For the others ``ConcurrentChange`` is raised, nothing of
them is in the table, and they are to be run again.
"""

import time
import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from roster.operators.merge import identity_hash
from roster.schema import EDITS, IDENTITY_HASH, LICENCE
from roster.sources.counts import counts_of, read_counts, write_counts

# A commit is made on the one before it, (base_version, base_seq); ``restored`` marks a restore.
_COMMIT = """version int, seq int, base_version int, base_seq int, restored boolean, load_key string, folder string,
    rows long, rows_before long, last_id long, rows_read long, rows_matched long, rows_staged long,
    rejected string, rows_short long, rows_long long, rows_badly_quoted long"""


class ConcurrentChange(RuntimeError):
    """The table was changed while a change was prepared; run the change again."""


class TableState(NamedTuple):
    """The current version: its commits, rows in all, and the highest id ever given."""

    version: int
    commits: list
    rows: int
    last_id: int

    @property
    def head(self) -> tuple[int, int]:
        return self.version, self.commits[-1].seq


def empty_licences(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LICENCE)


def read_folders(spark: SparkSession, schema, path: str) -> DataFrame | None:
    """A folder of Parquet folders, or None where there is none."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def commit_log(spark: SparkSession, root: str) -> DataFrame:
    """All commits; one row per load, repair or restore."""
    log = read_folders(spark, _COMMIT, f"{root}/commits")
    return log if log is not None else spark.createDataFrame([], _COMMIT)


def table_state(spark: SparkSession, root: str) -> TableState | None:
    """The table's state, or None where there is no table. Only the latest version's commits are gathered."""
    log = commit_log(spark, root)
    version, last_id = log.agg(F.max("version"), F.max("last_id")).first()
    if version is None:
        return None
    found = log.where(F.col("version") == version).collect()
    # A table of an earlier layout may hold two commits in one place; the same one counts for every reader.
    placed = {c.seq: c for c in sorted(found, key=lambda c: c.folder or "", reverse=True)}
    commits = [placed[seq] for seq in sorted(placed)]
    # Ids of removed rows stay used up: the send log may still refer to them.
    return TableState(version, commits, sum(c.rows for c in commits), last_id)


def commit_of(spark: SparkSession, root: str, load_key: str):
    """The commit with this load key since the last restore, or None.

    A commit that came too late, onto a version that had been replaced, does not count.
    """
    log = commit_log(spark, root)
    since = F.coalesce(F.max(F.when(F.col("restored"), F.col("version"))), F.lit(0))
    first = log.agg(since).first()[0]
    replaced = log.where((F.col("seq") == 0) & (F.col("version") > 0))
    ends = replaced.select(F.col("base_version").alias("version"), F.col("base_seq").alias("last_seq"))
    known = log.where((F.col("load_key") == load_key) & (F.col("version") >= first))
    valid = known.join(ends, "version", "left").where(F.col("last_seq").isNull() | (F.col("seq") <= F.col("last_seq")))
    return valid.orderBy("version", "seq").first()


def publish(spark: SparkSession, folder: str, target: str) -> bool:
    """Put the one part file of ``folder`` in place as ``target``, in one step; False if there is such a file already."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    system = path(folder).getFileSystem(conf)
    part = next(s.getPath() for s in system.listStatus(path(folder)) if s.getPath().getName().startswith("part-"))
    system.mkdirs(path(target).getParent())
    try:
        if system.getUri().getScheme() == "file":
            places = [spark._jvm.java.io.File(p.toUri().getPath()).toPath() for p in (path(target), part)]
            spark._jvm.java.nio.file.Files.createLink(*places)
        else:
            keep = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), conf)
            context.rename(part, path(target), keep)
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        system.delete(path(folder), True)
    return True


def _commit(spark: SparkSession, root: str, **values) -> None:
    """Commit a change under the name of the state it was built on, or raise ConcurrentChange."""
    fields = StructType.fromDDL(_COMMIT).fields
    columns = [F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in fields]
    base = values.get("base_version"), values.get("base_seq")
    name = "first" if base[0] is None else f"after-{base[0]:09d}-{base[1]:09d}"
    row = spark.range(1, numPartitions=1).select(*columns)
    if getattr(spark, "_jvm", None) is None:  # no access to the file system, as on Spark Connect
        try:
            row.write.mode("errorifexists").parquet(f"{root}/commits/{name}")
            return
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
    else:
        aside = f"{root}/prepared/{uuid.uuid4().hex}"
        row.write.parquet(aside)
        if publish(spark, aside, f"{root}/commits/{name}.parquet"):
            return
    raise ConcurrentChange(f"another change was built on {base} of {root} and committed first; nothing of this one is in the table, run it again")


def _commit_on(spark: SparkSession, root: str, base: TableState, **values) -> None:
    """Commit a change built on ``base``, if no other one was."""
    _commit(spark, root, base_version=base.version, base_seq=base.commits[-1].seq, **values)


def create_table(spark: SparkSession, root: str) -> TableState:
    """Create an empty table if there is none."""
    state = table_state(spark, root)
    if state is None:
        try:
            _commit(spark, root, version=0, seq=0, load_key="create", restored=False, rows=0, rows_before=0, last_id=0)
        except ConcurrentChange:
            pass  # somebody else has just created it
    return state or table_state(spark, root)


_INDEXED = StructType([*LICENCE.fields, StructField(IDENTITY_HASH, LongType())])

# Each row group gets a Bloom filter over the identities' hashes, of a size that suits their number.
_BLOOM = {
    f"parquet.bloom.filter.enabled#{IDENTITY_HASH}": "true",
    "parquet.bloom.filter.adaptive.enabled": "true",
}


def read_table(
    spark: SparkSession, root: str, state: TableState | None = None, indexed: bool = False, after: int = -1
) -> DataFrame:
    """The current version, or the given state. The frame keeps showing it when loads come in.

    ``indexed`` adds the hash of the identity. With ``after`` only rows of later commits of the version are read.
    """
    state = state or table_state(spark, root)
    folders = [f"{root}/{c.folder}" for c in state.commits if c.rows and c.seq > after] if state else []
    schema = _INDEXED if indexed else LICENCE
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def _write_folder(licences: DataFrame, root: str, label: str) -> tuple[str, int, int]:
    """Write rows to a new folder, and their counts beside it; returns its name, its number of rows and its highest id."""
    spark = licences.sparkSession
    folder = f"rows/{label}-{uuid.uuid4().hex}"
    rows = licences.select(*LICENCE.fieldNames(), identity_hash().alias(IDENTITY_HASH))
    rows.write.options(**_BLOOM).parquet(f"{root}/{folder}")
    written = spark.read.schema(LICENCE).parquet(f"{root}/{folder}")
    write_counts(written, f"{root}/{counts_of(folder)}")
    rows, last_id = read_counts(spark, f"{root}/{counts_of(folder)}").agg(F.sum("rows"), F.max("last_id")).first()
    return folder, rows or 0, last_id or 0


def append_batch(
    spark: SparkSession, root: str, state: TableState, load_key: str, licences: DataFrame, **metrics: int | str
) -> int:
    """Add rows to the version they were built on and return how many they were."""
    seq = state.commits[-1].seq + 1
    folder, rows, last_id = _write_folder(licences, root, f"load-{seq}")
    _commit_on(
        spark,
        root,
        state,
        version=state.version,
        seq=seq,
        load_key=load_key,
        restored=False,
        folder=folder,
        rows=rows,
        rows_before=state.rows,
        last_id=max(last_id, state.last_id),
        **metrics,
    )
    return rows


def replace_table(
    spark: SparkSession,
    root: str,
    licences: DataFrame,
    load_key: str,
    state: TableState | None = None,
    restored: bool = False,
    expected: int | None = None,
) -> None:
    """Make ``licences`` the table's next version. If computed from the table, pass the state it was read at.

    With ``expected`` nothing is committed unless so many rows were written.
    """
    state = state or create_table(spark, root)
    version = state.version + 1
    folder, rows, last_id = _write_folder(licences, root, f"version-{version}")
    if expected is not None and rows != expected:
        raise RuntimeError(f"{rows} rows were written where {expected} were expected; the table is unchanged")
    _commit_on(
        spark,
        root,
        state,
        version=version,
        seq=0,
        load_key=load_key,
        restored=restored,
        folder=folder,
        rows=rows,
        rows_before=state.rows,
        last_id=max(last_id, state.last_id),
    )


def compact(spark: SparkSession, root: str) -> None:
    """Rewrite the table as one folder laid out by id."""
    state = create_table(spark, root)
    rows = read_table(spark, root, state).repartitionByRange("id").sortWithinPartitions("id")
    replace_table(spark, root, rows, f"compact-{uuid.uuid4().hex}", state, expected=state.rows)


def read_rejected(spark: SparkSession, root: str) -> DataFrame | None:
    """The records set aside by all loads, or None where no load set any aside."""
    folders = [r.rejected for r in commit_log(spark, root).where("rejected IS NOT NULL").select("rejected").distinct().collect()]
    return spark.read.parquet(*[f"{root}/{folder}" for folder in folders]) if folders else None


def forget_old_rows(spark: SparkSession, root: str, versions: int = 1, hours: float = 24.0) -> list[str]:
    """Delete the row folders that the latest ``versions`` of the table do not name; returns their names.

    Repaired, replaced and restored-over rows are gone for good then, as personal data may have to be. A frame
    read before keeps no files alive: let readers of older versions end first. Folders that are younger than
    ``hours`` stay, as a change that is not committed yet may have written them.
    """
    log = commit_log(spark, root)
    latest = log.agg(F.max("version")).first()[0]
    if latest is None:
        return []
    named = log.where(F.col("version") > latest - versions).select("folder").distinct().collect()
    kept = {row.folder.rsplit("/", 1)[-1] for row in named if row.folder}
    path = spark._jvm.org.apache.hadoop.fs.Path
    rows = path(f"{root}/rows")
    system = rows.getFileSystem(spark._jsc.hadoopConfiguration())
    old = time.time() * 1000 - hours * 3_600_000
    found = system.listStatus(rows) if system.exists(rows) else []
    names = [s.getPath().getName() for s in found if s.getModificationTime() <= old]
    gone = sorted(name for name in names if name not in kept)
    for name in gone:
        system.delete(path(f"{root}/rows/{name}"), True)
    return gone


def record_edits(edits: DataFrame, root: str) -> None:
    """Append staff edits: an id, when it was made, and new values for ``checked`` or ``personal_email``."""
    edits.select(*EDITS.fieldNames()).write.mode("append").parquet(f"{root}/edits")


def read_edits(spark: SparkSession, root: str) -> DataFrame:
    edits = read_folders(spark, EDITS, f"{root}/edits")
    return edits if edits is not None else spark.createDataFrame([], EDITS)


def mark_repaired(spark: SparkSession, root: str, version: int, seq: int) -> None:
    """Note that the table has no duplicates up to this commit."""
    spark.range(1, numPartitions=1).select(F.lit(version).alias("version"), F.lit(seq).alias("seq")).write.mode("append").parquet(f"{root}/repaired")


def repaired_up_to(spark: SparkSession, root: str, state: TableState) -> int | None:
    """The latest commit of the current version up to which duplicates were looked for; None if there is none."""
    marks = read_folders(spark, "version int, seq int", f"{root}/repaired")
    return None if marks is None else marks.where(F.col("version") == state.version).agg(F.max("seq")).first()[0]


def snapshot(licences: DataFrame, root: str, ts: str) -> str:
    """Write the whole table under a time stamp; refuses to overwrite an older snapshot.

    A second folder, written last, says that the snapshot is complete and how many rows it has.
    """
    path = f"{root}/snapshot_ts={ts}"
    licences.write.parquet(path)
    licences.sparkSession.read.schema(LICENCE).parquet(path).agg(F.count("*").alias("rows")).write.parquet(f"{root}/complete_ts={ts}")
    return path


def read_snapshot(spark: SparkSession, root: str, ts: str) -> DataFrame:
    return spark.read.schema(LICENCE).parquet(f"{root}/snapshot_ts={ts}")


def restore(spark: SparkSession, snapshots: str, ts: str, root: str) -> int:
    """Replace the table by a complete snapshot and return the number of rows now in it."""
    complete = read_folders(spark, "rows long", f"{snapshots}/complete_ts={ts}")
    if complete is None:
        raise ValueError(f"the snapshot {ts} in {snapshots} is not complete")
    rows = complete.first().rows
    replace_table(
        spark, root, read_snapshot(spark, snapshots, ts), f"restore-{ts}-{uuid.uuid4().hex}", restored=True, expected=rows
    )
    return rows
