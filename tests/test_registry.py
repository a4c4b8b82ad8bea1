"""Reading registry CSV files."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from roster.schema import REGISTRY_HEADERS
from roster.sources import records
from roster.sources.records import ends_inside, leaves_open, state_after
from roster.sources.registry import read_cities, read_registry, rejected_records, write_registry

HEADERS = list(REGISTRY_HEADERS)


def write(path, text, encoding="utf-8"):
    path.write_bytes(text if isinstance(text, bytes) else text.encode(encoding))
    return str(path)


def values(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.orderBy("ordinal").collect()]


def test_dialect(spark, tmp_path):
    header = ",".join(HEADERS[:3]) + "\n"
    body = (
        b'="33,101",x\n'
        b'"=""12345""","x ""q"" y",z\n'
        b'"two\nlines",\xff\xfeb,c\n'
        b"\n"
        b"short\n"
        b"long,b,c,d,e\n"
        b'"back\\slash\\",b,c\n'
    )
    rows = read_registry(spark, write(tmp_path / "r.csv", header.encode() + body))
    assert values(rows, "license_number", "first_name", "middle_name") == [
        ('="33', '101"', "x"),
        ('="12345"', 'x "q" y', "z"),
        ("two\nlines", "��b", "c"),
        ("short", None, None),
        ("long", "b", "c"),
        ("back\\slash\\", "b", "c"),
    ]
    assert rows.columns == [*REGISTRY_HEADERS.values(), "ordinal"]


def test_columns_by_name_in_any_order(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    write(drop / "a.csv", "License Number,Extra,First Name\n1,e,Ana\n2,e,Bob\n")
    write(drop / "b.csv", "First Name,License Number\nCid,3\n")
    write(drop / "c.csv", "License Number,Extra,First Name\n4,e,Dan\n")
    write(drop / "d.csv", "License Number,First Name\n")
    write(drop / "e.csv", "")
    rows = read_registry(spark, str(drop))
    assert values(rows, "license_number", "first_name", "zip") == [
        ("1", "Ana", ""), ("2", "Bob", ""), ("3", "Cid", ""), ("4", "Dan", "")
    ]


def test_header_names_are_case_sensitive(spark, tmp_path):
    rows = read_registry(spark, write(tmp_path / "r.csv", "license number,First Name\n1,Ana\n"))
    assert values(rows, "license_number", "first_name") == [("", "Ana")]


@pytest.mark.parametrize(
    "header", ["First Name,Last Name,First Name", "Mailing Address,x,Mailing Address", "First Name,FIRST NAME"]
)
def test_a_repeated_name_is_refused(spark, tmp_path, header):
    with pytest.raises(ValueError, match="occurs 2 times"):
        read_registry(spark, write(tmp_path / "r.csv", header + "\n1,2,3\n"))


def test_two_address_columns_are_no_repetition(spark, tmp_path):
    rows = read_registry(spark, write(tmp_path / "r.csv", "x,Mailing Address,Mailing Address2\n0,a,b\n"))
    assert values(rows, "addr1", "addr2") == [("a", "b")]


@pytest.mark.parametrize("multi_line", [True, False])
def test_one_header_is_checked_by_the_scan(spark, tmp_path, multi_line):
    drop = tmp_path / "drop"
    drop.mkdir()
    write(drop / "a.csv", "License Number,Extra,First Name\n1,e,Ana\n")
    write(drop / "b.csv", "License Number,Extra,First Name\n2,e,Bob\n")
    rows = read_registry(spark, str(drop), multi_line, one_header=True)
    assert values(rows, "license_number", "first_name") == [("1", "Ana"), ("2", "Bob")]
    write(drop / "c.csv", "First Name,Extra,License Number\nCid,e,3\n")
    with pytest.raises(Exception, match="(?s)header does not conform"):
        read_registry(spark, str(drop), multi_line, one_header=True).collect()


@pytest.mark.parametrize("one_header", [False, True])
def test_empty_files_hold_no_rows(spark, tmp_path, one_header):
    drop = tmp_path / "drop"
    drop.mkdir()
    files = [write(drop / "a.csv", "")]
    for path in (str(drop), files):
        nothing = read_registry(spark, path, one_header=one_header)
        assert nothing.collect() == [] and nothing.columns == [*REGISTRY_HEADERS.values(), "ordinal"]
    files.append(write(drop / "b.csv", "License Number\n7\n"))
    rows = read_registry(spark, files, one_header=one_header)
    assert values(rows, "license_number") == [("7",)]
    assert rows.schema["ordinal"].dataType.names == nothing.schema["ordinal"].dataType.names


def test_file_order_over_many_splits(spark, tmp_path):
    """The later file is the larger one, and one file is read by many tasks."""
    drop = tmp_path / "drop"
    drop.mkdir()
    line = "{},Ana\n"
    write(drop / "a.csv", "License Number,First Name\n" + "".join(line.format(i) for i in range(500)))
    write(drop / "b.csv", "License Number,First Name\n" + "".join(line.format(i) for i in range(500, 9000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = read_registry(spark, str(drop), multi_line=False)
        assert rows.rdd.getNumPartitions() > 5
        assert [int(v) for (v,) in values(rows, "license_number")] == list(range(9000))
        whole = read_registry(spark, str(drop))
        assert [int(v) for (v,) in values(whole, "license_number")] == list(range(9000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_parts_are_read_in_the_order_of_their_numbers(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    for number in (99999, 100000, 99998):
        write(drop / f"part-{number}-x.csv", f"License Number\n{number}\n")
    write(drop / "a.csv", "License Number\n0\n")
    assert values(read_registry(spark, str(drop)), "license_number") == [("0",), ("99998",), ("99999",), ("100000",)]


def test_files_with_and_without_records_over_several_lines(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    write(drop / "a.csv", "License Number,First Name\n" + "".join(f"{i},Ana\n" for i in range(3000)))
    write(drop / "b.csv", 'License Number,First Name\n3000,"two\nlines"\n3001,"a ""b"""\n')
    write(drop / "c.csv", "First Name,License Number\nCid,3002\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = read_registry(spark, str(drop))
        assert rows.rdd.getNumPartitions() > 5
        found = values(rows, "license_number", "first_name")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[2999:] == [("2999", "Ana"), ("3000", "two\nlines"), ("3001", 'a "b"'), ("3002", "Cid")]
    assert [int(n) for n, _ in found] == list(range(3003))
    with pytest.raises(ValueError, match="several lines in .*b.csv"):
        read_registry(spark, str(drop), multi_line=False)


def test_names_with_pattern_characters(spark, tmp_path):
    rows = read_registry(spark, write(tmp_path / "r[1]{a,b}*.csv", "License Number\n7\n"))
    assert values(rows, "license_number") == [("7",)]


def test_written_rows_read_back(spark, registry, tmp_path):
    odd = [" blank ", 'q"uote', '="7"', "a,b", "two\nlines", "cr\r\nlf", "back\\", "é", "", None]
    raw = registry(*[{"email": v, "addr1": v, "license_number": str(i)} for i, v in enumerate(odd)])
    write_registry(raw, str(tmp_path / "drop"))
    back = read_registry(spark, str(tmp_path / "drop"))
    assert [(a or "", b or "") for a, b in values(back, "email", "addr1")] == [(v or "", v or "") for v in odd]


def test_cities(spark, tmp_path):
    path = write(tmp_path / "cities.csv", 'county,city\nA,OPA-LOCKA\nB,"FT. X, Y"\n')
    assert [r.city for r in read_cities(spark, path).collect()] == ["OPA-LOCKA", "FT. X, Y"]


def nasty(pick, crlf, rows):
    """Lines of cells with quotes, commas and line breaks in all places, some of them badly quoted."""
    end = "\r\n" if crlf else "\n"

    def cell():
        kind = pick.random()
        if kind < 0.5:
            return pick.choice(["a", "12", "", "x y", " ", 'a"b', "é"])
        if kind < 0.97:
            return '"' + "".join(pick.choice(["a", '""', ",", "\n", "x", end, ""]) for _ in range(pick.randint(0, 6))) + '"'
        return pick.choice(['"q"t', '"q" ,', '"q" "x', ' "z"', '"a"""', '"b"" "'])

    lines = [",".join([str(i), *(cell() for _ in range(pick.choice([3, 3, 3, 2, 4])))]) for i in range(rows)]
    return (",".join(HEADERS[:4]) + end + end.join(lines) + pick.choice(["", end])).encode()


def whole_cells(df):
    return values(df, *list(REGISTRY_HEADERS.values())[:4])


@pytest.mark.parametrize("split", ["150", "1k", "1m"])
@pytest.mark.parametrize("crlf", [False, True])
def test_records_over_several_lines_are_read_in_splits(spark, tmp_path, split, crlf):
    """Rows and their order are those of Spark's reader that takes a file as a whole."""
    path = write(tmp_path / "r.csv", nasty(random.Random(f"{split}{crlf}"), crlf, 150))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        rows = read_registry(spark, path)
        assert split == "1m" or rows.rdd.getNumPartitions() > 3
        assert whole_cells(rows) == whole_cells(read_registry(spark, path, multi_line=True))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_one_file_with_line_breaks_is_read_by_many_tasks(spark, tmp_path):
    text = "License Number,First Name\n" + "".join(f'{i},"two\nlines of ""{i}"", with\n\nmore"\n' for i in range(2000))
    path = write(tmp_path / "r.csv", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        rows = read_registry(spark, path)
        assert rows.rdd.getNumPartitions() > 10
        found = values(rows, "license_number", "first_name")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [(str(i), f'two\nlines of "{i}", with\n\nmore') for i in range(2000)]


@pytest.mark.parametrize("split", ["60", "1m"])
def test_long_cells_cross_many_splits(spark, tmp_path, split):
    long = "line\n" * 60
    path = write(tmp_path / "r.csv", f'License Number,First Name\n1,"{long}"\n2,b\n3,"{long}{long}"\n4,"open\nto the end')
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        want = [("1", long), ("2", "b"), ("3", long + long), ("4", '"open\nto the end')]
        assert [(n, t.lstrip('"')) for n, t in values(read_registry(spark, path), "license_number", "first_name")] == [(n, t.lstrip('"')) for n, t in want]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_stray_quotes_within_cells_open_nothing(spark, tmp_path):
    path = write(tmp_path / "r.csv", 'License Number,First Name\n1,5" tall\n2,b\n3,"c\nd"\n')
    assert values(read_registry(spark, path), "license_number", "first_name") == [("1", '5" tall'), ("2", "b"), ("3", "c\nd")]
    other = write(tmp_path / "s.csv", 'License Number,First Name\n1,5" tall\n2,b\n')
    assert values(read_registry(spark, other, multi_line=False), "first_name") == [('5" tall',), ("b",)]


def test_lines_that_end_in_carriage_returns(spark, tmp_path):
    path = write(tmp_path / "r.csv", b'License Number,First Name\r1,"a\rb"\r2,c\r')
    assert values(read_registry(spark, path), "license_number")[-1:] == [("2",)]


def test_states_agree_with_the_column(spark):
    """The scan in Python and the one as a column find the same cells left open."""
    pick = random.Random(9)
    lines = ["".join(pick.choice('",a \t') for _ in range(pick.randint(0, 9))) for _ in range(3000)]
    got = spark.createDataFrame([(line,) for line in lines], "line string").select(leaves_open(F.col("line"))).collect()
    assert [r[0] for r in got] == [state_after(line.encode(), 0) == 2 for line in lines]


def test_rejected_records(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    write(drop / "a.csv", 'License Number,First Name,x\n1,a,b\n2,a\n3,a,b,c\n4,"a"b,c\n5,"a\nb",c\n\n  \n6,a"b",c\n7,"a" ,c\n8,"a" "b",c\n9\n')
    write(drop / "b.csv", 'First Name,License Number\na,1\n"a""b",2\nc,3,4\n"never,closed\n')
    write(drop / "c.csv", "First Name,License Number\n")
    found = rejected_records(spark, str(drop))
    assert [(r.file, r.fault, r.cells, r.record) for r in found.orderBy("place").collect()] == [
        ("a.csv", "short", 2, "2,a"),
        ("a.csv", "long", 4, "3,a,b,c"),
        ("a.csv", "badly_quoted", 3, '4,"a"b,c'),
        ("a.csv", "badly_quoted", 3, '8,"a" "b",c'),
        ("a.csv", "short", 1, "9"),
        ("b.csv", "long", 3, "c,3,4"),
        ("b.csv", "badly_quoted", 1, '"never,closed'),
    ]
    assert rejected_records(spark, []).collect() == [] and rejected_records(spark, str(drop / "c.csv")).collect() == []
    places = {r.place for r in found.collect()}
    assert places < {r.ordinal for r in read_registry(spark, str(drop)).collect()}


def test_lines_end_as_quote_by_quote(spark):
    """Short lines of all kinds, in both ways to begin, and as columns; a long one takes no more stack."""
    lines = ["".join(x) for n in range(7) for x in itertools.product('",a ', repeat=n)] + ['"' + 'a""' * 200_000, '"' + 'a""' * 200_000 + '"', "a,\"b\"\r"]
    for inside in (False, True):
        state = 2 if inside else 0
        assert [ends_inside(x.encode(), inside) for x in lines] == [state_after(x.encode(), state) == 2 for x in lines]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = rows.select("i", leaves_open(rows.line).alias("open")).orderBy("i").collect()
    assert [r.open for r in got] == [state_after(x.encode(), 0) == 2 for x in lines]


def test_clean_lines_are_not_scanned_and_splits_are_computed_once(spark, tmp_path, monkeypatch):
    def scanned(line, state):
        raise AssertionError(line)

    monkeypatch.setattr(records, "state_after", scanned)
    assert ends_inside(b'"=""12""",a,"b c"', False) is False and ends_inside(b'a,"b', False) is True
    assert ends_inside(b'b"" c', True) is True and ends_inside(b'b",c,"d"', True) is False
    monkeypatch.undo()
    (tmp_path / "a.csv").write_text('a,b\n"x\ny",1\n')
    seen, reading = spark.sparkContext.accumulator(0), records._answers

    def counted(batches):
        seen.add(1)
        yield from reading(batches)

    monkeypatch.setattr(records, "_answers", counted)
    assert len(records.find_splits(spark, [str(tmp_path / "a.csv")])) == 1 and seen.value == 1
