"""Changes of licences by staff and by the send log, with what they change in the counts.

A batch of edits or outcomes is one file, numbered one after the other and put into place in one step, so a batch
is in the log with its counts or not at all, and a batch that is replayed changes nothing. Its counts are the
differences between the status of the touched licences before and after it; only these licences are read.

Counts belong to a version of the table. When a repair or restore has made a new one, what older batches change
in it is counted once, again for the touched licences only.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roster.operators.outreach import apply_edits, mark_checked
from roster.schema import EDITS, SEND_LOG
from roster.session import freeze, scratch
from roster.sources.counts import counts_of, read_counts, span_of
from roster.sources.table import ConcurrentChange, TableState, create_table, publish, read_folders, read_table

# Kinds of rows: an edit, an outcome, counts of a range, and one row for the batch itself.
_CHANGE = """kind string, place long, version int, batch string, based boolean,
    id long, edited_at timestamp, checked boolean, personal_email string, ok boolean, error string, span long, delta long"""


def read_changes(spark: SparkSession, root: str) -> DataFrame:
    log = read_folders(spark, _CHANGE, f"{root}/changes")
    return log if log is not None else spark.createDataFrame([], _CHANGE)


def edits_of(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("kind") == "edit").select(*EDITS.fieldNames())


def outcomes_of(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("kind") == "outcome").select(*SEND_LOG.fieldNames())


def with_changes(licences: DataFrame, changes: DataFrame) -> DataFrame:
    """Licences as staff and the send log left them: the latest edit of each value, then every success is checked."""
    return mark_checked(apply_edits(licences, edits_of(changes)), outcomes_of(changes))


def read_licences(spark: SparkSession, root: str, state: TableState | None = None) -> DataFrame:
    """The table with all changes."""
    return with_changes(read_table(spark, root, state), read_changes(spark, root))


def _differences(licences: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """(span, delta): how many more licences of each range are checked by the changes ``after`` than by those ``before``."""
    old, new = (with_changes(licences, changes).select("id", F.col("checked").cast("int").alias(name)) for changes, name in ((before, "old"), (after, "new")))
    return old.join(new, "id").where(F.col("old") != F.col("new")).groupBy(span_of().alias("span")).agg(F.sum(F.col("new") - F.col("old")).cast("long").alias("delta"))


def _touched(licences: DataFrame, changes: DataFrame) -> DataFrame:
    ids = changes.where(F.col("kind").isin("edit", "outcome")).select("id").distinct()
    return licences.join(ids, "id", "left_semi")


def _append(spark: SparkSession, root: str, place: int, state: TableState, batch: str, based: bool, *parts: DataFrame) -> None:
    head = spark.range(1, numPartitions=1).select(F.lit("batch").alias("kind"), F.lit(based).alias("based"))
    rows = head
    for part in parts:
        rows = rows.unionByName(part, allowMissingColumns=True)
    own = {"place": F.lit(place).cast("long"), "version": F.lit(state.version), "batch": F.lit(batch), "based": F.lit(based)}
    fields = spark.createDataFrame([], _CHANGE).unionByName(rows.withColumns(own), allowMissingColumns=True)
    aside = f"{root}/prepared/{uuid.uuid4().hex}"
    fields.coalesce(1).write.parquet(aside)
    if not publish(spark, aside, f"{root}/changes/{place:09d}.parquet"):
        raise ConcurrentChange(f"another batch of changes of {root} came first; nothing of {batch} was recorded, record it again")


def record_changes(
    spark: SparkSession, root: str, batch: str, edits: DataFrame | None = None, outcomes: DataFrame | None = None
) -> bool:
    """Record a batch of edits, of outcomes or of both, with its counts. False if there is a batch of this name already."""
    state, log = create_table(spark, root), read_changes(spark, root)
    heads = log.where(F.col("kind") == "batch").agg(F.count("*"), F.max(F.col("batch") == batch)).first()
    if heads[1]:
        return False
    with scratch(spark, "changes"):
        given = [
            frame.select(F.lit(kind).alias("kind"), *fields.fieldNames())
            for frame, kind, fields in ((edits, "edit", EDITS), (outcomes, "outcome", SEND_LOG))
            if frame is not None
        ]
        none = spark.createDataFrame([], _CHANGE)
        new = freeze(none.unionByName(given[0], allowMissingColumns=True), "given") if given else none
        if len(given) > 1:
            new = new.unionByName(freeze(none.unionByName(given[1], allowMissingColumns=True), "given"))
        touched = freeze(_touched(read_table(spark, root, state), new), "touched")
        ids = touched.select("id")
        earlier = log.where(F.col("kind") != "count").join(ids, "id", "left_semi")
        # Written down, as the batch's one file is put together by one task, which then only copies rows.
        delta = freeze(_differences(touched, earlier, earlier.unionByName(new)), "delta")
        _append(spark, root, heads[0], state, batch, False, new, delta.withColumn("kind", F.lit("count")))
    return True


def maintained_counts(spark: SparkSession, root: str, state: TableState | None = None) -> DataFrame:
    """(span, rows, checked) that sum up to the counts of the table with all changes; no licence is read."""
    state = state or create_table(spark, root)
    log = read_changes(spark, root)
    heads = log.where(F.col("kind") == "batch")
    mine = F.col("version") == state.version
    count, older, based = heads.agg(
        F.count("*"), F.count_if(F.col("version") < state.version), F.count_if(mine & F.col("based"))
    ).first()
    if older and not based:
        with scratch(spark, "counts"):
            earlier = log.where(F.col("version") < state.version)
            touched = freeze(_touched(read_table(spark, root, state), earlier), "touched")
            nothing = log.where(F.lit(False))
            delta = freeze(_differences(touched, nothing, earlier), "delta")
            _append(spark, root, count, state, f"counts of version {state.version}", True, delta.withColumn("kind", F.lit("count")))
        log = read_changes(spark, root)
    stored = read_counts(spark, *[f"{root}/{counts_of(c.folder)}" for c in state.commits if c.rows])
    changed = log.where((F.col("kind") == "count") & mine)
    return stored.select("span", "rows", "checked").unionByName(changed.select("span", F.lit(0).cast("long").alias("rows"), F.col("delta").alias("checked")))
