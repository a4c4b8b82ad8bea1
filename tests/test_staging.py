"""Staged batches and exports as CSV."""

import pytest
from pyspark.errors import PySparkException

from roster.schema import BATCH_COLUMNS
from roster.sources.staging import export_csv, read_export, read_staging, write_staging

ODD = [" blank ", 'q"uote', '="7"', "a,b", "two\nlines", "cr\r\nlf", "back\\", "é", "  ", "", None]


def parts(path):
    return b"".join(p.read_bytes() for p in sorted(path.glob("part-*")))


def test_roundtrip(spark, batch, tmp_path):
    rows = batch(*[(i, f"P{i}", value) for i, value in enumerate(ODD)]).coalesce(3)
    assert write_staging(rows, str(tmp_path / "s")) == len(ODD)
    back = read_staging(spark, str(tmp_path / "s"))
    assert back.columns == BATCH_COLUMNS
    got = sorted(back.collect(), key=lambda r: int(r.full_name[1:]))
    assert [r.business_email for r in got] == [v or None for v in ODD]
    assert {r.checked for r in got} == {False}


def test_an_empty_batch(spark, batch, tmp_path):
    assert write_staging(batch((1, "A", "")).where("false"), str(tmp_path / "s")) == 0
    assert read_staging(spark, str(tmp_path / "s")).collect() == []


def test_file_layout(batch, tmp_path):
    write_staging(batch((1, "A", ""), (2, 'B "b"', "x,y")).coalesce(1), str(tmp_path / "s"))
    assert parts(tmp_path / "s").decode().splitlines() == [
        "License Number,Full Name,NPN Number,License Type,Business Email,Business Phone,Mailing Address,Personal Email,checked",
        "L1,A,,LIFE,,,,,false",
        'L2,"B ""b""",,LIFE,"x,y",,,,false',
    ]


def test_reads_by_position_and_knows_boolean_words(spark, tmp_path):
    lines = ["a,b,c,d,e,f,g,h,i"] + [f"1,n,,,,,,,{w}" for w in ("true", "T", " yes ", "on", "1", "f", "NO", "off", "0", "")]
    (tmp_path / "s.csv").write_text("\n".join(lines) + "\n")
    rows = read_staging(spark, str(tmp_path / "s.csv")).collect()
    assert [r.checked for r in rows] == [True] * 5 + [False] * 4 + [None]
    assert rows[0].license_number == "1" and rows[0].npn_number is None


def test_an_unknown_boolean_is_an_error(spark, tmp_path):
    (tmp_path / "s.csv").write_text("h\n1,n,,,,,,,maybe\n")
    with pytest.raises(PySparkException, match="not a boolean"):
        read_staging(spark, str(tmp_path / "s.csv")).collect()


def test_export_tells_null_from_empty(spark, tmp_path):
    rows = spark.createDataFrame([(1, None, " x "), (2, "", 'q"')], "id long, a string, b string").coalesce(1)
    export_csv(rows.orderBy("id"), str(tmp_path / "e"))
    assert parts(tmp_path / "e").decode().splitlines() == ["id,a,b", "1,, x ", '2,"","q"""']
    back = read_export(spark, str(tmp_path / "e"), "id long, a string, b string").orderBy("id").collect()
    assert [(r.a, r.b) for r in back] == [(None, " x "), (None, 'q"')]
