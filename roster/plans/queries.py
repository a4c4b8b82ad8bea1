"""One query per operator, over the benchmark tables. Each takes (spark, sf_dir)."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roster.functions.text import (
    clean_cell,
    clean_name_part,
    full_name,
    mailing_address,
    tel_link,
)
from roster.operators import views
from roster.operators.dedupe import duplicate_ids, keep_first, repair_duplicates
from roster.operators.merge import insert_new, insert_new_indexed, number_rows
from roster.operators.normalise import (
    clean_registry,
    filter_target,
    normalise_registry,
    scan_metrics,
    target_cities,
)
from roster.operators.outreach import apply_edits, mark_checked, outbox, outreach_candidates, outreach_summary
from roster.plans import driver_tables as tables
from roster.plans.load import load, load_report, merged, repair, repair_incremental, stage
from roster.plans.viewer import stored_page, stored_tallies
from roster.schema import LICENCE, ORDINAL, REGISTRY_HEADERS
from roster.session import freeze, scratch_path
from roster.sources.buckets import append_buckets, create_buckets, duplicate_ids_in_buckets, insert_new_in_buckets
from roster.sources.changes import read_licences, record_changes
from roster.sources.outcomes import read_outcomes, record_outcomes
from roster.sources.registry import read_registry, rejected_records, write_registry
from roster.sources.snapshots import restore_table, save_table
from roster.sources.staging import export_csv, read_export, read_staging, write_staging
from roster.sources.table import (
    append_batch,
    create_table,
    read_edits,
    read_rejected,
    read_table,
    record_edits,
    replace_table,
    restore,
    snapshot,
)
from roster.streaming.landing import load_stream
from roster.streaming.outcomes import mark_stream
from roster.streaming.progress import load_recorded, read_progress

# Wording of the rendered messages in the outbox queries.
MESSAGE = {
    "sender": "office@example.com",
    "subject": "A question about your licence",
    "template": "Dear {name},\n100% of our agents {know} you.\n",
    "nameless": "colleague",
}


def raw_registry(spark: SparkSession, sf: str) -> DataFrame:
    return tables.raw_registry(spark, sf)


def registry_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The raw rows written as CSV part files and read back by header name, numbered in file order."""
    path = scratch_path(spark, "registry")
    write_registry(freeze(tables.raw_registry(spark, sf), "raw"), path)
    rows = read_registry(spark, path)
    texts = [F.nullif(c, F.lit("")).alias(c) for c in rows.columns if c != ORDINAL]
    return number_rows(freeze(rows.select(*texts, ORDINAL), "read"), [ORDINAL], "place").drop(ORDINAL)


def registry_multiline(spark: SparkSession, sf: str) -> DataFrame:
    """Addresses with line breaks and quotes in them, written as CSV and read back in splits, numbered in file order."""
    path = scratch_path(spark, "registry")
    write_registry(freeze(tables.with_line_breaks(tables.raw_registry(spark, sf)), "raw"), path)
    rows = read_registry(spark, path)
    texts = [F.nullif(c, F.lit("")).alias(c) for c in rows.columns if c != ORDINAL]
    return number_rows(freeze(rows.select(*texts, ORDINAL), "read"), [ORDINAL], "place").drop(ORDINAL)


def rejected(spark: SparkSession, sf: str) -> DataFrame:
    """Records that are too short, too long or badly quoted, and what the load of the drop counts of them."""
    work = scratch_path(spark, "rejected")
    tables.write_faulty(tables.raw_registry(spark, sf), f"{work}/drop")
    report = load(
        spark, f"{work}/table", read_registry(spark, f"{work}/drop"), tables.targets(spark, sf), "drop",
        rejected=rejected_records(spark, f"{work}/drop"),
    )
    counted = [F.lit(report[name]).cast("long").alias(name) for name in ("rows_short", "rows_long", "rows_badly_quoted")]
    return read_rejected(spark, f"{work}/table").select("fault", "cells", "record", *counted)


def clean_cells(spark: SparkSession, sf: str) -> DataFrame:
    raw = tables.raw_registry(spark, sf)
    return clean_registry(raw).drop("odate")


def missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Two files of one drop: one without e-mail and city, the other with its columns in another order."""
    path = scratch_path(spark, "registry")
    raw = freeze(tables.raw_registry(spark, sf), "raw")
    headers = {column: header for header, column in REGISTRY_HEADERS.items()}
    fewer = [c for c in headers if c not in ("email", "city")]
    for name, rows, columns in (("a", tables.old_rows(raw), fewer), ("b", tables.new_rows(raw), list(headers)[::-1])):
        write_registry(rows, f"{path}/{name}", columns)
    rows = read_registry(spark, path)
    texts = [F.nullif(c, F.lit("")).alias(c) for c in rows.columns if c != ORDINAL]
    return rows.select(*texts)


def clean_documents(spark: SparkSession, sf: str) -> DataFrame:
    """The text functions on whole documents: accents, line breaks, long texts."""
    text = F.col("text")
    return tables.table(spark, sf, "documents").select(
        "doc_id",
        clean_cell(text).alias("cell"),
        clean_name_part(clean_cell(text)).alias("name_part"),
        tel_link(text).alias("tel"),
    )


def full_names(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean_registry(tables.raw_registry(spark, sf))
    name = full_name(F.col("first_name"), F.col("middle_name"), F.col("last_name"))
    return rows.select(ORDINAL, name.alias("full_name"))


def mailing_addresses(spark: SparkSession, sf: str) -> DataFrame:
    rows = clean_registry(tables.raw_registry(spark, sf))
    address = mailing_address(*[F.col(c) for c in ("addr1", "addr2", "city", "state", "zip")])
    return rows.select(ORDINAL, address.alias("mailing_address"))


def city_union(spark: SparkSession, sf: str) -> DataFrame:
    """Three county lists, one of them twice."""
    regions = ["AFRICA", "AMERICA", "AFRICA"]
    return target_cities(*[tables.county(spark, sf, region) for region in regions])


def filter_target_rows(spark: SparkSession, sf: str) -> DataFrame:
    return filter_target(tables.raw_registry(spark, sf), *tables.targets(spark, sf))


def normalised_rows(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_registry(tables.raw_registry(spark, sf), *tables.targets(spark, sf))


def scan_counts(spark: SparkSession, sf: str) -> DataFrame:
    return scan_metrics(tables.raw_registry(spark, sf), *tables.targets(spark, sf))


def dedupe_batch(spark: SparkSession, sf: str) -> DataFrame:
    return stage(tables.raw_registry(spark, sf), tables.targets(spark, sf))


def first_events(spark: SparkSession, sf: str) -> DataFrame:
    """Keep-first at volume: the first event of every user and type."""
    events = tables.table(spark, sf, "events")
    return keep_first(events, ["user_id", "event_type"], ["event_id"])


def insert_new_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The batch and the table are written down, as ``load`` finds them."""
    batch = stage(tables.new_rows(tables.raw_registry(spark, sf)), tables.targets(spark, sf))
    return insert_new(freeze(tables.old_table(spark, sf), "old"), freeze(batch, "staged"))


def insert_new_stored(spark: SparkSession, sf: str) -> DataFrame:
    """The same on a stored table of several folders, through the Bloom filters of its row groups."""
    root = scratch_path(spark, "table")
    batch = stage(tables.new_rows(tables.raw_registry(spark, sf)), tables.targets(spark, sf))
    old = freeze(tables.old_table(spark, sf), "old")
    for part in range(3):
        append_batch(spark, root, create_table(spark, root), f"part {part}", old.where(F.col("id") % 3 == part))
    return insert_new_indexed(read_table(spark, root, indexed=True), freeze(batch, "staged"))


def load_result(spark: SparkSession, sf: str) -> DataFrame:
    raw = tables.new_rows(tables.raw_registry(spark, sf))
    old = freeze(tables.old_table(spark, sf), "old")
    return merged(old, raw, tables.targets(spark, sf))


def load_report_row(spark: SparkSession, sf: str) -> DataFrame:
    raw = tables.new_rows(tables.raw_registry(spark, sf))
    old = freeze(tables.old_table(spark, sf), "old")
    return load_report(old, merged(old, raw, tables.targets(spark, sf)))


def stored_load(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops loaded into a stored table, the second one twice."""
    root = scratch_path(spark, "table")
    raw, targets = tables.raw_registry(spark, sf), tables.targets(spark, sf)
    create_table(spark, root)
    load(spark, root, tables.old_rows(raw), targets, "first")
    load(spark, root, tables.new_rows(raw), targets, "second")
    load(spark, root, tables.new_rows(raw), targets, "again")
    return read_table(spark, root)


def load_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The reports of two loads and of one that is not repeated."""
    root = scratch_path(spark, "table")
    raw, targets = freeze(tables.raw_registry(spark, sf), "raw"), tables.targets(spark, sf)
    drops = [("first", tables.old_rows(raw)), ("second", tables.new_rows(raw)), ("second", raw)]
    reports = [load(spark, root, rows, targets, key) for key, rows in drops]
    schema = "place long, rows_read long, rows_matched long, rows_staged long, rows_before long, rows_after long, rows_added long"
    return spark.createDataFrame([(i, *report.values()) for i, report in enumerate(reports)], schema)


def edited(spark: SparkSession, sf: str) -> DataFrame:
    """Staff edits from a log: a later one wins, value by value."""
    rows = tables.stored_licences(spark, sf)
    path = scratch_path(spark, "edits")
    for log in tables.staff_edits(rows):
        record_edits(log, path)
    return apply_edits(rows, read_edits(spark, path))


def repaired(spark: SparkSession, sf: str) -> DataFrame:
    return repair_duplicates(tables.with_edits(tables.licences(spark, sf)))


def surplus_ids(spark: SparkSession, sf: str) -> DataFrame:
    return duplicate_ids(tables.with_edits(tables.licences(spark, sf)))


def stored_repair(spark: SparkSession, sf: str) -> DataFrame:
    """The repair of a stored table: duplicates written down, then dropped in a new version."""
    root = scratch_path(spark, "table")
    replace_table(spark, root, tables.with_edits(tables.licences(spark, sf)), "fill")
    repair(spark, root, "repair")
    return read_table(spark, root)


def repaired_in_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Duplicates come in two portions; the second repair looks only at the people of the second one."""
    root = scratch_path(spark, "table")
    rows = freeze(tables.with_edits(tables.licences(spark, sf)), "licences")
    older = F.col("id") % 4 != 0
    replace_table(spark, root, rows.where(older), "fill")
    repair(spark, root, "first")
    append_batch(spark, root, create_table(spark, root), "more", rows.where(~older))
    repair_incremental(spark, root, "second")
    return read_table(spark, root)


def repaired_in_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The repair of a table in buckets of the identity hash, written in two portions."""
    name = f"licences_{uuid.uuid4().hex}"
    create_buckets(spark, name, scratch_path(spark, "buckets"), buckets=8)
    rows = freeze(tables.with_edits(tables.licences(spark, sf)), "licences")
    for part in (0, 1):
        append_buckets(rows.where(F.col("id") % 2 == part), name)
    surplus = freeze(duplicate_ids_in_buckets(spark.table(name)), "surplus")
    return spark.table(name).join(surplus, "id", "left_anti").select(*LICENCE.fieldNames())


def inserted_in_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The new rows of a batch against a table in buckets of the identity hash."""
    name = f"licences_{uuid.uuid4().hex}"
    create_buckets(spark, name, scratch_path(spark, "buckets"), buckets=8)
    append_buckets(tables.old_table(spark, sf), name)
    batch = stage(tables.new_rows(tables.raw_registry(spark, sf)), tables.targets(spark, sf))
    return insert_new_in_buckets(spark.table(name), freeze(batch, "staged"))


def _changed_table(spark: SparkSession, sf: str) -> str:
    """A table of two folders with edits before and after a repair, and outcomes; returns where it is."""
    root = scratch_path(spark, "table")
    rows = tables.stored_licences(spark, sf)
    early, late = tables.staff_edits(rows)[::-1]
    replace_table(spark, root, rows.where(F.col("id") % 2 == 0), "fill")
    append_batch(spark, root, create_table(spark, root), "more", rows.where(F.col("id") % 2 != 0))
    record_changes(spark, root, "early", edits=early)
    record_changes(spark, root, "sent", outcomes=tables.send_log(outreach_candidates(rows, None)))
    record_changes(spark, root, "sent", outcomes=tables.send_log(rows))
    repair(spark, root, "repair")
    record_changes(spark, root, "late", edits=late)
    return root


def maintained_tallies(spark: SparkSession, sf: str) -> DataFrame:
    return stored_tallies(spark, _changed_table(spark, sf))


def indexed_page(spark: SparkSession, sf: str) -> DataFrame:
    return stored_page(spark, _changed_table(spark, sf), "checked", 3)


def marked_by_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Outcome files that arrive in two runs of a stream, the second one with all of the first one's again."""
    work = scratch_path(spark, "outcomes")
    rows = tables.stored_licences(spark, sf)
    replace_table(spark, f"{work}/table", rows, "fill")
    log = freeze(tables.send_log(outreach_candidates(rows, None)), "log")
    for part in (log.where(F.col("id") % 3 == 0), log):
        record_outcomes(part, f"{work}/log")
        mark_stream(spark, f"{work}/log", f"{work}/table", f"{work}/checkpoint").awaitTermination()
    return read_licences(spark, f"{work}/table")


def status_tallies(spark: SparkSession, sf: str) -> DataFrame:
    return views.status_tallies(tables.licences(spark, sf))


def status_filter(spark: SparkSession, sf: str) -> DataFrame:
    return views.status_filter(tables.licences(spark, sf), "unchecked")


def status_page(spark: SparkSession, sf: str) -> DataFrame:
    return views.status_page(tables.stored_licences(spark, sf), "unchecked", "2")


def status_page_last(spark: SparkSession, sf: str) -> DataFrame:
    """A page beyond the last one, reached by counting and not by skipping rows."""
    return views.status_page(tables.stored_licences(spark, sf), "checked", "999999999", shallow=0)


def status_page_marked(spark: SparkSession, sf: str) -> DataFrame:
    """A deep page of rows whose status the send log decides."""
    rows = tables.stored_licences(spark, sf)
    log = freeze(tables.send_log(outreach_candidates(rows, None)), "send-log")
    return views.status_page(mark_checked(rows, log), "checked", 3, shallow=0)


def page_info(spark: SparkSession, sf: str) -> DataFrame:
    return views.page_info(tables.licences(spark, sf), "checked", "3")


def tel_links(spark: SparkSession, sf: str) -> DataFrame:
    return tables.raw_registry(spark, sf).select(ORDINAL, tel_link(F.col("phone")).alias("tel"))


def candidates(spark: SparkSession, sf: str) -> DataFrame:
    return outreach_candidates(tables.with_edits(tables.licences(spark, sf)))


def candidates_wide(spark: SparkSession, sf: str) -> DataFrame:
    """A limit too large for a top-k: the cut is found by counting."""
    return outreach_candidates(tables.with_edits(tables.stored_licences(spark, sf)), 100, shallow=0)


def candidates_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """The run after one over every candidate: only the failures are left."""
    rows = tables.stored_licences(spark, sf)
    log = tables.send_log(outreach_candidates(rows, None))
    path = scratch_path(spark, "send-log")
    record_outcomes(log, path)
    return outreach_candidates(rows, None, read_outcomes(spark, path))


def outbox_messages(spark: SparkSession, sf: str) -> DataFrame:
    return outbox(tables.licences(spark, sf), **MESSAGE, limit=20, delay=8.0)


def outbox_wide(spark: SparkSession, sf: str) -> DataFrame:
    """The outbox of a run over every candidate."""
    return outbox(tables.stored_licences(spark, sf), **MESSAGE, limit=None)


def marked(spark: SparkSession, sf: str) -> DataFrame:
    """Every candidate is attempted twice, with the same outcome."""
    rows = tables.stored_licences(spark, sf)
    log = tables.send_log(outreach_candidates(rows, None))
    return mark_checked(rows, log.union(log))


def summary(spark: SparkSession, sf: str) -> DataFrame:
    log = tables.send_log(outreach_candidates(tables.stored_licences(spark, sf), None))
    return outreach_summary(log)


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "staging")
    write_staging(stage(tables.raw_registry(spark, sf), tables.targets(spark, sf)), path)
    return read_staging(spark, path)


def staged_count(spark: SparkSession, sf: str) -> DataFrame:
    """The number of rows that writing a staging file reports."""
    batch = stage(tables.raw_registry(spark, sf), tables.targets(spark, sf))
    rows = write_staging(batch, scratch_path(spark, "staging"))
    return spark.createDataFrame([(rows,)], "rows_staged long")


def export_candidates(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "export")
    export_csv(outreach_candidates(tables.licences(spark, sf), None), path)
    return read_export(spark, path, "id long, full_name string, business_email string")


def _stream_drops(spark: SparkSession, sf: str, run) -> str:
    """Two drops for one run, then one that is dated weeks before for another; returns the work folder that ``run`` is given."""
    work = scratch_path(spark, "stream")
    raw, targets = freeze(tables.raw_registry(spark, sf), "raw"), tables.targets(spark, sf)
    late = F.col("odate") < F.lit(tables.EARLY).cast("timestamp_ntz")
    write_registry(tables.old_rows(raw).where(~late), f"{work}/landing/drop-1")
    write_registry(tables.new_rows(raw), f"{work}/landing/drop-2")
    run(work, targets)
    write_registry(raw.where(late), f"{work}/late")
    tables.move_with_date(spark, f"{work}/late", f"{work}/landing/drop-0", days_ago=30)
    run(work, targets)
    return work


def stream_load(spark: SparkSession, sf: str) -> DataFrame:
    """Drops picked up from a landing folder by a file stream."""

    def run(work, targets):
        load_stream(spark, f"{work}/landing", f"{work}/table", f"{work}/checkpoint", targets).awaitTermination()

    return read_table(spark, f"{_stream_drops(spark, sf, run)}/table")


def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """What a listener recorded of the micro-batches of the same drops."""

    def run(work, targets):
        load_recorded(spark, f"{work}/landing", f"{work}/table", f"{work}/checkpoint", targets, f"{work}/progress")

    rows = read_progress(spark, f"{_stream_drops(spark, sf, run)}/progress")
    return rows.select("batch_id", "drops", (F.col("files") >= F.col("drops")).alias("has_files"), "rows_read", "rows_matched", "rows_added")


def snapshot_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A table is saved, changed, and restored."""
    work = scratch_path(spark, "snapshot")
    rows = tables.stored_licences(spark, sf)
    replace_table(spark, f"{work}/table", rows, "fill")
    snapshot(read_table(spark, f"{work}/table"), f"{work}/saved", "20260101T090000")
    replace_table(spark, f"{work}/table", rows.where("checked"), "change")
    restore(spark, f"{work}/saved", "20260101T090000", f"{work}/table")
    return read_table(spark, f"{work}/table")


def snapshot_in_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Two snapshots, the second one of what came since; the table is then emptied and the second one restored."""
    work = scratch_path(spark, "snapshot")
    rows = tables.stored_licences(spark, sf)
    replace_table(spark, f"{work}/table", rows.where(F.col("id") % 3 != 0), "fill")
    save_table(spark, f"{work}/table", f"{work}/saved", "20260101T090000")
    append_batch(spark, f"{work}/table", create_table(spark, f"{work}/table"), "more", rows.where(F.col("id") % 3 == 0))
    save_table(spark, f"{work}/table", f"{work}/saved", "20260102T090000")
    replace_table(spark, f"{work}/table", rows.limit(0), "empty")
    restore_table(spark, f"{work}/saved", "20260102T090000", f"{work}/table")
    return read_table(spark, f"{work}/table")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "raw_registry": raw_registry,
    "registry_roundtrip": registry_roundtrip,
    "registry_multiline": registry_multiline,
    "rejected_records": rejected,
    "clean_cells": clean_cells,
    "missing_columns": missing_columns,
    "clean_documents": clean_documents,
    "full_name": full_names,
    "mailing_address": mailing_addresses,
    "city_union": city_union,
    "filter_target": filter_target_rows,
    "normalise_registry": normalised_rows,
    "scan_metrics": scan_counts,
    "dedupe_batch": dedupe_batch,
    "first_events": first_events,
    "insert_new": insert_new_rows,
    "insert_new_indexed": insert_new_stored,
    "insert_new_bucketed": inserted_in_buckets,
    "load_result": load_result,
    "load_report": load_report_row,
    "stored_load": stored_load,
    "load_counts": load_counts,
    "staff_edits": edited,
    "repair_duplicates": repaired,
    "duplicate_ids": surplus_ids,
    "stored_repair": stored_repair,
    "repair_incremental": repaired_in_steps,
    "stored_repair_bucketed": repaired_in_buckets,
    "status_tallies": status_tallies,
    "tallies_maintained": maintained_tallies,
    "status_filter": status_filter,
    "status_page": status_page,
    "status_page_last": status_page_last,
    "status_page_marked": status_page_marked,
    "status_page_indexed": indexed_page,
    "page_info": page_info,
    "tel_link": tel_links,
    "outreach_candidates": candidates,
    "outreach_candidates_wide": candidates_wide,
    "outreach_candidates_resumed": candidates_resumed,
    "outbox": outbox_messages,
    "outbox_wide": outbox_wide,
    "mark_checked": marked,
    "mark_checked_stream": marked_by_stream,
    "outreach_summary": summary,
    "csv_roundtrip": csv_roundtrip,
    "staged_count": staged_count,
    "export_candidates": export_candidates,
    "stream_load": stream_load,
    "stream_progress": stream_progress,
    "snapshot_roundtrip": snapshot_roundtrip,
    "snapshot_incremental": snapshot_in_steps,
}
