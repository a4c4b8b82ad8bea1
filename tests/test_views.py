"""Tallies, status filter, page clamp and pages."""

import pytest

from roster.operators import ranks, views


@pytest.fixture
def table(licences):
    # Ids with large gaps; every third row is checked.
    return licences(*[(i * i * 1000 + 7, f"P{i}", None, i % 3 == 0) for i in range(120)])


def test_tallies(table):
    assert tuple(views.status_tallies(table).first()) == (120, 40, 80)
    assert tuple(views.status_tallies(table.limit(0)).first()) == (0, 0, 0)


@pytest.mark.parametrize("status, rows", [("all", 120), ("checked", 40), ("unchecked", 80), ("other", 120)])
def test_status(table, status, rows):
    assert views.status_filter(table, status).count() == rows
    assert views.page_info(table, status).first()["total"] == rows


@pytest.mark.parametrize(
    "asked, shown", [("0", 1), ("-3", 1), ("abc", 1), (None, 1), ("2", 2), ("99", 3), (10**30, 3), (" 2 ", 2)]
)
def test_page_clamp(table, asked, shown):
    assert tuple(views.page_info(table, page=asked).first()) == (120, 3, shown)


def test_empty_table(table):
    nothing = table.limit(0)
    assert tuple(views.page_info(nothing, page="4").first()) == (0, 1, 1)
    assert views.status_page(nothing, page="4").collect() == []


@pytest.mark.parametrize("shallow", [ranks.SHALLOW, 0])
@pytest.mark.parametrize("status", ["all", "unchecked"])
def test_pages_make_up_the_table(table, status, shallow):
    shown = []
    for page in range(1, 5):
        rows = views.status_page(table, status, page, 30, shallow).collect()
        shown += [r.full_name for r in rows]
    whole = views.status_filter(table, status).orderBy("id").collect()
    assert shown[: len(whole)] == [r.full_name for r in whole]
    last = views.status_page(table, status, 10**9, 30, shallow).collect()
    assert last[-1].full_name == whole[-1].full_name


def test_page_columns(table):
    row = views.status_page(table).first()
    assert "id" not in row and row.phone_href == "tel:+13055550100"


def test_id_at_rank(spark):
    ids = spark.range(0, 50_000, numPartitions=5).selectExpr("id * id * 977 - 12345678901 AS id")
    for rank in (0, 1, 777, 49_999):
        assert ranks.id_at_rank(ids, rank) == rank * rank * 977 - 12345678901
    assert ranks.id_at_rank(ids, 50_000) is None
    assert ranks.id_at_rank(ids.limit(0), 0) is None


def test_changing_ids_are_noticed(spark):
    ids = spark.range(100_000)

    class Shrinking:
        def agg(self, *columns):
            return ids.agg(*columns)

        def where(self, condition):
            return ids.where(condition).where("id < 5")

    with pytest.raises(RuntimeError, match="changed"):
        ranks.id_at_rank(Shrinking(), 99_000)


@pytest.mark.parametrize("limit", [9, 10, 11])
def test_both_ways_agree_around_the_border(table, limit):
    """A slice that ends just before, at and behind the rank where counting begins."""
    want = [r.id for r in table.orderBy("id").collect()][4:limit]
    assert [r.id for r in ranks.slice_by_rank(table, 4, limit - 4, shallow=10).collect()] == want
