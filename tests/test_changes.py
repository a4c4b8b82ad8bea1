"""Counts kept with the table: tallies and pages against a pass over all licences, through random histories."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from roster.operators import views
from roster.plans.load import repair
from roster.plans.viewer import stored_page, stored_page_info, stored_tallies
from roster.schema import EDITS, SEND_LOG
from roster.sources import changes
from roster.sources.changes import maintained_counts, read_changes, read_licences, record_changes
from roster.sources.counts import spans_of_slice
from roster.sources.table import ConcurrentChange, append_batch, create_table, replace_table
from roster.streaming.outcomes import mark_stream


def log(spark, *rows):
    return spark.createDataFrame([(i, ok, None) for i, ok in rows], SEND_LOG)


def edits(spark, *rows):
    frame = spark.createDataFrame(rows, "id long, edited_at string, checked boolean, personal_email string")
    return frame.withColumn("edited_at", F.col("edited_at").cast("timestamp")).select(*EDITS.fieldNames())


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def assert_kept(spark, root, pages=((1, 3),)):
    now = read_licences(spark, root)
    assert rows_of(stored_tallies(spark, root)) == rows_of(views.status_tallies(now))
    for status in ("all", "checked", "unchecked", "whatever"):
        for page, size in pages:
            assert rows_of(stored_page_info(spark, root, status, page, size)) == rows_of(views.page_info(now, status, page, size))
            assert rows_of(stored_page(spark, root, status, page, size)) == rows_of(views.status_page(now, status, page, size))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_history(spark, licences, tmp_path, monkeypatch, seed):
    monkeypatch.setattr("roster.sources.counts.SPAN", 4)
    monkeypatch.setattr("roster.plans.viewer.SPAN", 4)
    pick, root, last = random.Random(seed), str(tmp_path / "t"), 0
    assert_kept(spark, root)
    for step, kind in enumerate(pick.sample(["load", "load", "edit", "sent", "repair", "edit", "sent", "load", "replayed"], 9)):
        ids = range(1, last + 4)
        if kind == "load":
            rows = [(last + i * pick.choice([1, 1, 5]) + 1, pick.choice("ABCDEFGHIJ"), "a@x", pick.random() < 0.3) for i in range(9)]
            rows = list({r[0]: r for r in rows}.values())
            append_batch(spark, root, create_table(spark, root), f"load {step}", licences(*rows))
            last = max(r[0] for r in rows)
        elif kind == "repair":
            repair(spark, root, f"repair {step}")
        elif kind == "edit":
            made = [(pick.choice(ids), f"2026-01-0{pick.randint(1, 9)} 00:00:00", pick.choice([True, False, None]), pick.choice(["p@x", None])) for _ in range(8)]
            assert record_changes(spark, root, f"edit {step}", edits=edits(spark, *made))
        else:
            sent = [(pick.choice(ids), pick.random() < 0.7) for _ in range(6)]
            assert record_changes(spark, root, f"sent {step}", outcomes=log(spark, *sent))
            if kind == "replayed":
                assert not record_changes(spark, root, f"sent {step}", outcomes=log(spark, *sent))
    assert_kept(spark, root, [(1, 3), (2, 4), (99, 5), ("x", 2)])


def test_a_page_reads_few_licences_and_the_tallies_none(spark, licences, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(1, 40_001).select("id").crossJoin(licences((0, "A", "a@x")).drop("id")).withColumn("checked", F.col("id") % 3 == 0)
    replace_table(spark, root, rows.repartitionByRange(8, "id").sortWithinPartitions("id"), "fill")
    record_changes(spark, root, "sent", outcomes=log(spark, (20_000, True), (7, True)))
    counts = maintained_counts(spark, root)
    assert "/rows/" not in " ".join(counts.inputFiles()) and counts.count() < 40
    page = stored_page(spark, root, "checked", 150, 50)
    assert page.count() == 50
    plan = page._jdf.queryExecution().executedPlan()
    while plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    assert "PushedFilters: [IsNotNull(id), GreaterThanOrEqual(id," in plan.toString() or "GreaterThanOrEqual(id" in page._jdf.queryExecution().explainString(
        page.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def test_spans_of_a_slice(spark):
    rows = [(s, n, 0, 0) for s, n in enumerate([3, 0, 4, 1, 10, 2])]
    counts = spark.createDataFrame(rows, "span long, rows long, checked long, last_id long")
    found = lambda start, size: sorted(rows_of(spans_of_slice(counts, "all", start, size)))
    assert found(0, 3) == [(0, 0)] and found(2, 2) == [(0, 0), (2, 3)] and found(7, 3) == [(3, 7), (4, 8)]
    assert found(19, 5) == [(5, 18)] and found(20, 5) == [] and found(0, 0) == []


def test_batches_recorded_at_once(spark, licences, tmp_path, monkeypatch):
    """Two batches computed from one state: one is recorded, the other knows that it is not and can be recorded again."""
    root, both, real, raced = str(tmp_path / "t"), threading.Barrier(2), changes.publish, []
    replace_table(spark, root, licences((1, "A", "a@x"), (2, "B", "b@x")), "fill")

    def together(*args):
        both.wait(60)
        return real(*args)

    def record(name):
        try:
            record_changes(spark, root, name, outcomes=log(spark, (1, True)))
        except ConcurrentChange:
            raced.append(name)

    with monkeypatch.context() as patched:
        patched.setattr(changes, "publish", together)
        threads = [threading.Thread(target=record, args=(name,)) for name in ("x", "y")]
        for thread in threads:
            thread.start()
        for thread in threads:
            thread.join()
    assert len(raced) == 1
    record(raced[0])
    assert_kept(spark, root)
    assert [r.checked for r in read_licences(spark, root).orderBy("id").collect()] == [True, False]


def test_the_send_log_as_a_stream(spark, licences, tmp_path):
    root, files = str(tmp_path / "t"), str(tmp_path / "log")
    replace_table(spark, root, licences((1, "A", "a@x"), (2, "B", "b@x"), (3, "C", "c@x")), "fill")

    def run(checkpoint="ckpt"):
        mark_stream(spark, files, root, str(tmp_path / checkpoint)).awaitTermination()
        outcomes = read_changes(spark, root).where("kind = 'outcome'").orderBy("id").collect()
        assert_kept(spark, root)
        return [r.id for r in outcomes]

    log(spark, (1, True), (2, False), (1, True)).write.mode("append").parquet(files)
    assert run() == [1]
    log(spark, (1, True), (2, True)).write.mode("append").parquet(files)
    assert run() == [1, 2] and run() == [1, 2]
    assert [r.checked for r in read_licences(spark, root).orderBy("id").collect()] == [True, True, False]


def test_a_replayed_micro_batch_of_outcomes_changes_nothing(spark, licences, tmp_path, monkeypatch):
    """The batch is recorded, then the run fails before its checkpoint says so."""
    root, files = str(tmp_path / "t"), str(tmp_path / "log")
    replace_table(spark, root, licences((1, "A", "a@x"), (2, "B", "b@x")), "fill")
    log(spark, (1, True)).write.parquet(files)

    def then_fails(*args, **how):
        record_changes(*args, **how)
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr("roster.streaming.outcomes.record_changes", then_fails)
        with pytest.raises(Exception, match="lost"):
            mark_stream(spark, files, root, str(tmp_path / "ckpt")).awaitTermination()
    before = rows_of(stored_tallies(spark, root))
    mark_stream(spark, files, root, str(tmp_path / "ckpt")).awaitTermination()
    assert rows_of(stored_tallies(spark, root)) == before == [(2, 1, 1)]
    assert read_changes(spark, root).where("kind = 'outcome'").count() == 1
