"""Loading drops from a landing folder."""

import os

import pytest

from roster.plans.load import load
from roster.sources.registry import read_registry
from roster.sources.table import commit_log, read_rejected, read_table
from roster.streaming.landing import loader, load_stream
from roster.streaming.progress import load_recorded, read_progress

HEADER = "Last Name,Email Address,Mailing State,Mailing City,License TYCL Desc,License Number\n"


def drop(path, mtime, *rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(HEADER + "".join(f'{name},{email},FL,Miami,life,"=""{n}"""\n' for name, email, n in rows))
    os.utime(path, (mtime, mtime))


def run(spark, base, targets):
    load_stream(spark, str(base / "landing"), str(base / "table"), str(base / "ckpt"), targets).awaitTermination()
    return [(r.id, r.license_number, r.full_name) for r in read_table(spark, str(base / "table")).orderBy("id").collect()]


def test_files_load_in_order_of_arrival_and_once(spark, targets, tmp_path):
    landing = tmp_path / "landing"
    drop(landing / "z.csv", 1_000_000, ("A", "", 1), ("B", "b@x", 2))
    drop(landing / "a.csv", 2_000_000, ("B", "b@x", 3), ("C", "", 4))
    want = [(1, "1", "A"), (2, "2", "B"), (3, "4", "C")]
    assert run(spark, tmp_path, targets) == want
    assert run(spark, tmp_path, targets) == want
    drop(landing / "m.csv", 3_000_000, ("C", "", 5), ("D", "", 6))
    (landing / "empty.csv").write_text("")
    assert run(spark, tmp_path, targets) == [*want, (4, "6", "D")]
    assert commit_log(spark, str(tmp_path / "table")).count() == 4


def test_a_folder_of_part_files_is_one_drop(spark, targets, tmp_path):
    landing = tmp_path / "landing"
    # The part that comes first by name arrived last.
    drop(landing / "day" / "part-0.csv", 3_000_000, ("A", "", 1))
    drop(landing / "day" / "part-1.csv", 1_000_000, ("A", "", 2), ("B", "", 3))
    drop(landing / "later.csv", 4_000_000, ("B", "", 4), ("C", "", 5))
    assert run(spark, tmp_path, targets) == [(1, "1", "A"), (2, "3", "B"), (3, "5", "C")]
    assert commit_log(spark, str(tmp_path / "table")).count() == 3


def test_stream_equals_separate_loads(spark, targets, tmp_path):
    landing = tmp_path / "landing"
    for day in range(3):
        drop(landing / f"d{9 - day}.csv", 1_000_000 + day, *[(f"P{i % 7 + day}", "", day * 10 + i) for i in range(10)])
    got = run(spark, tmp_path, targets)
    root = str(tmp_path / "batch")
    for day in range(3):
        load(spark, root, read_registry(spark, [str(landing / f"d{9 - day}.csv")]), targets, f"day {day}")
    assert got == [(r.id, r.license_number, r.full_name) for r in read_table(spark, root).orderBy("id").collect()]


def test_a_replayed_micro_batch_changes_nothing(spark, targets, tmp_path):
    landing, table = tmp_path / "landing", str(tmp_path / "table")
    drop(landing / "a.csv", 1_000_000, ("A", "", 1))
    drop(landing / "b.csv", 2_000_000, ("A", "", 2), ("B", "", 3))
    files = (
        spark.read.format("binaryFile").load(str(landing)).select("path", "modificationTime")
    )
    step = loader(str(landing), table, targets)
    step(files, 0)
    before = sorted(map(tuple, read_table(spark, table).collect()))
    step(files, 0)
    assert sorted(map(tuple, read_table(spark, table).collect())) == before
    assert commit_log(spark, table).count() == 3
    # Also after the checkpoint is lost and the stream lists every file again.
    run(spark, tmp_path, targets)
    assert sorted(map(tuple, read_table(spark, table).collect())) == before


def test_an_interrupted_micro_batch_is_completed(spark, targets, tmp_path, monkeypatch):
    """The second of two drops fails; the next run finishes the batch without repeating the first."""
    landing, calls = tmp_path / "landing", []
    drop(landing / "a.csv", 1_000_000, ("A", "", 1))
    drop(landing / "b.csv", 2_000_000, ("A", "", 2), ("B", "", 3))

    def fails_on_the_second(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return load(*args)

    with monkeypatch.context() as broken:
        broken.setattr("roster.streaming.landing.load", fails_on_the_second)
        try:
            run(spark, tmp_path, targets)
            raise AssertionError("the stream should have failed")
        except Exception as error:
            assert "lost" in str(error)
    assert read_table(spark, str(tmp_path / "table")).count() == 1
    assert run(spark, tmp_path, targets) == [(1, "1", "A"), (2, "3", "B")]


def test_a_drop_of_any_age_is_loaded(spark, targets, tmp_path):
    landing, now = tmp_path / "landing", 1_700_000_000
    drop(landing / "new.csv", now, ("A", "", 1))
    run(spark, tmp_path, targets)
    drop(landing / "late.csv", now - 9 * 86_400, ("B", "", 2))
    drop(landing / "very-late.csv", now - 400 * 86_400, ("C", "", 3))
    assert run(spark, tmp_path, targets) == [(1, "1", "A"), (2, "3", "C"), (3, "2", "B")]


def test_a_file_replaced_under_its_name_is_loaded_again(spark, targets, tmp_path):
    landing = tmp_path / "landing"
    drop(landing / "daily.csv", 1_000_000, ("A", "", 1))
    assert run(spark, tmp_path, targets) == [(1, "1", "A")]
    drop(landing / "daily.csv", 2_000_000, ("A", "", 1), ("B", "", 2))
    drop(landing / "other.csv", 3_000_000, ("C", "", 3))
    want = [(1, "1", "A"), (2, "2", "B"), (3, "3", "C")]
    assert run(spark, tmp_path, targets) == want
    assert run(spark, tmp_path, targets) == want
    assert commit_log(spark, str(tmp_path / "table")).count() == 4


def test_names_with_pattern_characters_and_hidden_names(spark, targets, tmp_path):
    landing = tmp_path / "landing"
    drop(landing / "r[1].csv", 1_000_000, ("A", "", 1))
    drop(landing / "{x,y} *?.csv", 2_000_000, ("B", "", 2))
    drop(landing / "_r.csv", 3_000_000, ("C", "", 3))
    with pytest.warns(UserWarning, match="_r.csv"):
        assert run(spark, tmp_path, targets) == [(1, "1", "A"), (2, "2", "B")]


def test_what_each_micro_batch_did_is_recorded(spark, targets, tmp_path):
    landing = tmp_path / "landing"
    paths = [str(tmp_path / name) for name in ("landing", "table", "ckpt")]

    def recorded():
        load_recorded(spark, *paths, targets, str(tmp_path / "progress"))
        rows = read_progress(spark, str(tmp_path / "progress")).orderBy("batch_id").collect()
        assert all(r.seconds > 0 and r.started is not None for r in rows) and len({r["query"] for r in rows}) == 1
        return [(r.batch_id, r.files, r.drops, r.rows_read, r.rows_added) for r in rows]

    drop(landing / "a.csv", 1_000_000, ("A", "", 1), ("B", "", 2))
    drop(landing / "day" / "part-0.csv", 2_000_000, ("A", "", 3))
    drop(landing / "day" / "part-1.csv", 2_000_000, ("C", "", 4))
    want = [(0, 3, 2, 4, 3)]
    assert recorded() == want
    drop(landing / "b.csv", 3_000_000, ("D", "", 5))
    assert recorded() == [*want, (1, 1, 1, 1, 1)]
    assert recorded() == [*want, (1, 1, 1, 1, 1)]


def test_faulty_records_of_drops_are_set_aside(spark, targets, tmp_path):
    landing = tmp_path / "landing"
    drop(landing / "a.csv", 1_000_000, ("A", "", 1))
    with open(landing / "a.csv", "a") as file:
        file.write("short\n")
    load_stream(spark, str(landing), str(tmp_path / "t"), str(tmp_path / "ckpt"), targets, quarantine=True).awaitTermination()
    assert [(r.fault, r.record) for r in read_rejected(spark, str(tmp_path / "t")).collect()] == [("short", "short")]
    assert commit_log(spark, str(tmp_path / "t")).agg({"rows_short": "sum"}).first()[0] == 1
