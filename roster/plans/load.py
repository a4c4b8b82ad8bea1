"""The composite jobs that change the licence table."""

import uuid
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roster.operators.dedupe import duplicate_ids, keep_first
from roster.operators.merge import FEW_ROWS, append, assign_ids, insert_new, look_up
from roster.operators.normalise import filter_target, scan_metrics, to_licences
from roster.schema import IDENTITY, LICENCE, ORDINAL
from roster.session import freeze, scratch
from roster.sources.table import (
    TableState,
    append_batch,
    commit_of,
    create_table,
    mark_repaired,
    read_table,
    repaired_up_to,
    replace_table,
)


class Targets(NamedTuple):
    """What to keep of the registry."""

    cities: DataFrame
    classes: Iterable[str]
    state: str = "FL"


def stage(raw: DataFrame, targets: Targets) -> DataFrame:
    """Filter, normalise, and keep the first row of every identity."""
    return keep_first(to_licences(filter_target(raw, *targets)), IDENTITY, [ORDINAL])


def merged(target: DataFrame, raw: DataFrame, targets: Targets) -> DataFrame:
    """The licences as they are after loading ``raw`` into ``target``."""
    staged = freeze(stage(raw, targets), "staged")
    last_id = target.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    fresh = assign_ids(insert_new(target, staged), last_id, [ORDINAL], at_most=staged.count())
    return append(target.select(*LICENCE.fieldNames()), fresh)


def load_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: licences before and after a load, and how many were added."""
    rows = before.select(F.lit(True).alias("old")).union(after.select(F.lit(False)))
    return rows.agg(
        F.count_if("old").alias("rows_before"),
        F.count_if(~F.col("old")).alias("rows_after"),
    ).withColumn("rows_added", F.col("rows_after") - F.col("rows_before"))


def load(
    spark: SparkSession,
    root: str,
    raw: DataFrame,
    targets: Targets,
    load_key: str,
    count_scan: bool = True,
    rejected: DataFrame | None = None,
) -> dict:
    """Load one drop into the stored table, all or nothing, and report the counts, all of them exact.

    A load key committed since the last restore is not loaded again. The batch is written down before
    the merge: Spark then knows its size, and a daily batch against a large table becomes a
    broadcast, with no shuffle of the table. ``rows_read`` and ``rows_matched`` take a pass over three
    columns of the drop; without ``count_scan`` they are None. The records in ``rejected``, as
    ``registry.rejected_records`` finds them, are set aside with the table and counted by their faults; they are
    loaded nevertheless.
    """
    state = create_table(spark, root)
    done = commit_of(spark, root, load_key)
    if done is not None:
        faulty = {name: done[name] for name in _FAULTS.values()} if done.rejected else {}
        return _report(done.rows_before, done.rows, done.rows_read, done.rows_matched, done.rows_staged) | faulty

    with scratch(spark, "load"):
        staged = freeze(stage(raw, targets), "staged")
        rows_read, rows_matched = scan_metrics(raw, *targets).first() if count_scan else (None, None)
        counts = {"rows_read": rows_read, "rows_matched": rows_matched, "rows_staged": staged.count()}
        fresh = insert_new(read_table(spark, root, state), staged) if state.rows else staged
        numbered = assign_ids(fresh, state.last_id, [ORDINAL], at_most=counts["rows_staged"])
        faulty = _set_aside(rejected, root) if rejected is not None else {}
        added = append_batch(spark, root, state, load_key, numbered, **counts, **faulty)
    return _report(state.rows, added, *counts.values()) | {name: n for name, n in faulty.items() if name != "rejected"}


# The counts of a load's report, for each fault.
_FAULTS = {"short": "rows_short", "long": "rows_long", "badly_quoted": "rows_badly_quoted"}


def _set_aside(rejected: DataFrame, root: str) -> dict[str, int | str]:
    """Write faulty records to a folder of their own; its name and the number of each fault go into the commit."""
    folder = f"rejected/{uuid.uuid4().hex}"
    rejected.write.parquet(f"{root}/{folder}")
    counts = rejected.sparkSession.read.parquet(f"{root}/{folder}").groupBy("fault").count().collect()
    found = {row.fault: row["count"] for row in counts}
    return {"rejected": folder} | {name: found.get(fault, 0) for fault, name in _FAULTS.items()}


def _report(before: int, added: int, read: int | None, matched: int | None, staged: int) -> dict[str, int | None]:
    return {
        "rows_read": read,
        "rows_matched": matched,
        "rows_staged": staged,
        "rows_before": before,
        "rows_after": before + added,
        "rows_added": added,
    }


def repair(spark: SparkSession, root: str, load_key: str) -> int:
    """Drop the duplicates from the stored table and return how many there were.

    The ids to drop are written down first; as they are few, the table is filtered by a broadcast
    and keeps its layout by id. Without duplicates nothing is rewritten.
    """
    state = create_table(spark, root)
    return _drop_duplicates(spark, root, state, read_table(spark, root, state), load_key)


def repair_incremental(spark: SparkSession, root: str, load_key: str) -> int:
    """``repair`` that looks only at people who were added since duplicates were last looked for.

    The rows of later commits are the frontier. A duplicate that was not there before has one of their identities, so
    only stored rows with these are grouped; a small frontier finds them through the Bloom filters. What was
    written as a new version by something else than a repair is looked at as a whole.
    """
    state = create_table(spark, root)
    known = repaired_up_to(spark, root, state)
    if known is None:
        return repair(spark, root, load_key)
    frontier = read_table(spark, root, state, after=known)
    return _drop_duplicates(spark, root, state, look_up(read_table(spark, root, state, indexed=True), frontier), load_key)


def _drop_duplicates(spark: SparkSession, root: str, state: TableState, suspects: DataFrame, load_key: str) -> int:
    """Drop the duplicates among the suspects from the table."""
    with scratch(spark, "repair"):
        surplus = freeze(duplicate_ids(suspects), "surplus")
        dropped = surplus.count()
        if dropped:
            kept = read_table(spark, root, state).join(surplus, "id", "left_anti")
            if dropped > FEW_ROWS:
                # So many ids may be joined by a shuffle, which scatters the ids: lay them out again.
                kept = kept.repartitionByRange("id").sortWithinPartitions("id")
            replace_table(spark, root, kept, load_key, state, expected=state.rows - dropped)
            mark_repaired(spark, root, state.version + 1, 0)
        else:
            mark_repaired(spark, root, *state.head)
    return dropped
