"""Filtering and projecting raw rows."""

from roster.operators.normalise import filter_target, normalise_registry, scan_metrics, target_cities

ROW = {
    "license_number": '="W1"',
    "first_name": "Ana",
    "middle_name": "M.",
    "last_name": "Ruiz, Jr",
    "license_desc": " life & health ",
    "email": " a@x ",
    "city": "miami",
    "state": '="fl"',
    "zip": '="33101"',
    "addr1": "1 Main St",
}


def test_city_list_is_a_set(spark):
    one = spark.createDataFrame([("A", "X"), ("A", "Y")], "county string, city string")
    two = spark.createDataFrame([("B", "Y"), ("B", "Z")], "county string, city string")
    assert sorted(r.city for r in target_cities(one, two).collect()) == ["X", "Y", "Z"]


def test_one_row(registry, targets):
    [row] = normalise_registry(registry(ROW), *targets).collect()
    assert row.asDict() == {
        "license_number": "W1",
        "full_name": "Ana M Ruiz Jr",
        "npn_number": None,
        "license_type": "LIFE & HEALTH",
        "business_email": "a@x",
        "business_phone": None,
        "mailing_address": "1 Main St miami fl 33101",
        "personal_email": None,
        "checked": False,
        "ordinal": 0,
    }


def test_filter(registry, targets):
    rows = registry(
        ROW,
        {**ROW, "state": "GA"},
        {**ROW, "state": "FLA"},
        {**ROW, "state": '=" FL "'},  # blanks inside the quotes stay, so it is another state
        {**ROW, "city": "MIAMI "},
        {**ROW, "city": "MIAMI  BEACH"},
        {**ROW, "license_desc": "LIFE &  HEALTH"},
        {**ROW, "license_desc": "life"},
        {**ROW, "state": None},
    )
    kept = filter_target(rows, *targets)
    assert sorted(r.ordinal for r in kept.collect()) == [0, 4, 7]
    counts = scan_metrics(rows, *targets).first()
    assert (counts.rows_read, counts.rows_matched) == (9, 3)


def test_metrics_of_nothing(registry, targets):
    counts = scan_metrics(registry(ROW).limit(0), *targets).first()
    assert (counts.rows_read, counts.rows_matched) == (0, 0)


def test_a_city_listed_twice_counts_once(spark, registry, targets):
    twice = targets.cities.union(targets.cities)
    assert filter_target(registry(ROW), twice, targets.classes).count() == 1
    assert scan_metrics(registry(ROW), twice, targets.classes).first().rows_matched == 1
