"""Cell functions: literal tables, and random strings against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

from roster.functions import text

CELLS = [
    (None, ""),
    ('="123"', "123"),
    ('=""', ""),
    ('="', ""),
    ('="a', '="a'),
    ('"=x"', '"=x"'),
    ('=" FL "', " FL "),
    (" FL ", "FL"),
    ("\x1cx", "x"),
    (' ="7"　', "7"),
    ('=" 7"', " 7"),
    ('="a"b"', 'a"b'),
    ("é", "é"),
    ("  ", ""),
    ("\t\n", ""),
    ('="x\ny"', "x\ny"),
    ("a᠎", "a᠎"),
]

NAMES = [
    (("O.", "", "X, Jr."), "O X Jr"),
    ((None, "  ", '="Z"'), "Z"),
    ((None, "", " "), ""),
    (("A ,\tB", ".", "C"), "A B C"),
]

PHONES = [
    ("(305) 555-0123", "tel:+13055550123"),
    ("+1 305 555 0123", "tel:+13055550123"),
    ("555-0123", "tel:+5550123"),
    ("n/a", ""),
    ("", ""),
    (None, ""),
    ("٣٠٥ 555 0123", "tel:+1٣٠٥5550123"),
    ("x²é", "tel:+²"),
]


def evaluate(spark, values, *columns):
    names = [f"c{i}" for i in range(len(values[0]))]
    rows = spark.createDataFrame(
        [(i, *v) for i, v in enumerate(values)], "i int, " + ", ".join(f"{n} string" for n in names)
    )
    return [tuple(r[1:]) for r in rows.select("i", *columns).orderBy("i").collect()]


def test_clean_cell(spark):
    got = evaluate(spark, [(v,) for v, _ in CELLS], text.clean_cell(F.col("c0")))
    assert [g[0] for g in got] == [want for _, want in CELLS]


def test_full_name(spark):
    name = text.full_name(*[text.clean_cell(F.col(c)) for c in ("c0", "c1", "c2")])
    assert [g[0] for g in evaluate(spark, [v for v, _ in NAMES], name)] == [want for _, want in NAMES]


def test_mailing_address_skips_empty_parts_and_keeps_inner_blanks(spark):
    rows = [("1  Main St", "", "Miami", ' ="FL" ', '="33101"'), (None, "", " ", '=""', None)]
    address = text.mailing_address(*[text.clean_cell(F.col(f"c{i}")) for i in range(5)])
    assert [g[0] for g in evaluate(spark, rows, address)] == ["1  Main St Miami FL 33101", ""]


def test_tel_link(spark):
    got = evaluate(spark, [(v,) for v, _ in PHONES], text.tel_link(F.col("c0")))
    assert [g[0] for g in got] == [want for _, want in PHONES]


@pytest.mark.parametrize("word, want", [("straße", "STRASSE"), ("ﬂ", "FL"), (' ="fl" ', "FL")])
def test_upper_cell(spark, word, want):
    assert evaluate(spark, [(word,)], text.upper_cell(F.col("c0"))) == [(want,)]


def test_every_digit_is_kept_and_nothing_else(spark):
    points = [chr(p) for p in range(0x20, 0x110000) if not 0xD800 <= p < 0xE000]
    chunks = [("".join(points[i : i + 5000]),) for i in range(0, len(points), 5000)]
    got = evaluate(spark, chunks, text.tel_link(F.col("c0")))
    assert [g[0] for g in got] == [plain_tel(value) for (value,) in chunks]
    assert sum(map(str.isdigit, points)) == 808


def test_white_space_is_pythons():
    assert set(text.WHITESPACE) == {chr(p) for p in range(0x110000) if chr(p).isspace()}


def plain_cell(value):
    stripped = (value or "").strip()
    wrapped = re.fullmatch(r'="(?:(.*)")?', stripped, re.S)
    return (wrapped[1] or "") if wrapped else stripped


def plain_name(value):
    return " ".join(value.translate({ord(","): " ", ord("."): " "}).split())


def plain_tel(value):
    digits = "".join(filter(str.isdigit, value or ""))
    return f"tel:+{'1' * (len(digits) == 10)}{digits}" if digits else ""


def test_random_strings(spark):
    pick = random.Random(20260101)
    alphabet = list('=="""ab,. 7é²٣\U0001d7ce') + list(text.WHITESPACE)
    values = [
        ("".join(pick.choice(alphabet) for _ in range(pick.randrange(14))),) for _ in range(20_000)
    ]
    values += [('="' + v[0] + '"',) for v in values[:4000]]
    got = evaluate(
        spark,
        values,
        text.clean_cell(F.col("c0")),
        text.clean_name_part(F.col("c0")),
        text.tel_link(F.col("c0")),
    )
    for (value,), row in zip(values, got):
        assert row == (plain_cell(value), plain_name(value), plain_tel(value)), repr(value)


def test_long_runs_of_white_space_stay_linear(spark):
    value = "é" + " " * 200_000 + "x" + " " * 200_000
    [(cell, name)] = evaluate(
        spark, [(value,)], text.clean_cell(F.col("c0")), text.clean_name_part(F.col("c0"))
    )
    assert cell == value.strip() and name == "é x"
