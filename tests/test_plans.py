"""The physical plans: what is pushed down, shuffled and broadcast."""

import pytest

import __spark_entry__ as entry
from roster.operators import views
from roster.operators.dedupe import duplicate_ids
from roster.operators.merge import insert_new
from roster.operators.outreach import mark_checked, outreach_candidates
from roster.operators.ranks import slice_by_rank
from roster.session import freeze

SF = "/root/testdata/sf0.001"
# Queries that act while they are built are covered by the tests of their parts.
LAZY = [
    "raw_registry", "clean_cells", "clean_documents", "full_name", "mailing_address", "city_union",
    "filter_target", "normalise_registry", "scan_metrics", "dedupe_batch", "first_events",
    "insert_new", "repair_duplicates", "duplicate_ids", "status_tallies", "status_filter",
    "page_info", "tel_link", "outreach_candidates", "outbox",
]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


@pytest.fixture
def table(spark, licences):
    return freeze(licences(*[(i, f"P{i}", f"{i}@x") for i in range(50)]), "table")


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for bad in ("Cartesian", "NestedLoop", "Python"):
        assert bad not in text


def test_a_small_batch_never_shuffles_the_table(table, batch):
    small = freeze(batch((1, "A", "a@x")), "batch")
    text = plan(insert_new(table, small))
    semi = text.index("LeftSemi")
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    # The only exchange lies above the semi join: it carries matches, not the table.
    assert text.rindex("Exchange hashpartitioning") < semi
    assert "ReadSchema: struct<full_name:string,business_email:string>" in text


def test_a_large_batch_shuffles_distinct_keys(no_broadcast, table, batch):
    text = plan(insert_new(table, freeze(batch((1, "A", "a@x")), "batch")))
    assert "Broadcast" not in text
    below = text[text.index("LeftSemi") :]
    assert below.count("HashAggregate(keys=[_full_name") == 2
    assert text.count("Exchange hashpartitioning") == 3


def test_tallies_read_one_column(table):
    text = plan(views.status_tallies(table))
    assert "ReadSchema: struct<checked:boolean>" in text


@pytest.mark.parametrize("shallow", [10_000, 0])
def test_a_page_reaches_the_scan_by_its_ids(table, shallow):
    text = plan(slice_by_rank(table, 10, 5, shallow))
    assert "GreaterThanOrEqual(id,10)" in text and "LessThanOrEqual(id,14)" in text


def actions(spark, build):
    """Jobs that write rows while ``build`` runs: so often is a joined input evaluated for later use."""
    from roster.operators import outreach, ranks

    calls = []
    real = freeze

    def counted(df, label):
        calls.append(df)
        return real(df, label)

    for module in (outreach, ranks):
        module.freeze = counted
    try:
        return build(), calls
    finally:
        for module in (outreach, ranks):
            module.freeze = real


def test_a_deep_page_joins_the_log_once_to_find_its_ids(no_broadcast, spark, table):
    log = freeze(spark.range(50).selectExpr("id", "true AS ok", "'' AS error"), "log")
    page, written = actions(spark, lambda: views.status_page(mark_checked(table, log), "checked", 3, 10, shallow=0))
    assert len(written) == 1 and written[0].columns == ["id"]
    assert page.count() == 10
    assert "GreaterThanOrEqual(id,20)" in plan(page) and "LessThanOrEqual(id,29)" in plan(page)


def test_a_large_campaign_joins_the_log_once(no_broadcast, spark, table):
    log = freeze(spark.range(50).selectExpr("id * 2 AS id", "true AS ok", "'' AS error"), "log")
    rows, written = actions(spark, lambda: outreach_candidates(table, 10, log, shallow=0))
    assert len(written) == 1 and "Join" not in plan(rows)
    assert sorted(r.id for r in rows.collect()) == list(range(1, 21, 2))


def test_candidates_are_a_top_k_over_a_pruned_scan(table):
    text = plan(outreach_candidates(table))
    assert "TakeOrderedAndProject(limit=5" in text
    assert "IsNotNull(business_email)" in text
    assert "mailing_address" not in text


def test_marking_joins_distinct_ids(no_broadcast, spark, table):
    log = freeze(spark.range(10).selectExpr("id % 2 AS id", "true AS ok", "'' AS error"), "log")
    text = plan(mark_checked(table, log).select("id", "checked"))
    assert text.count("HashAggregate(keys=[id") == 2
    assert "ReadSchema: struct<id:bigint,checked:boolean>" in text


def test_duplicates_shuffle_identity_and_id_only(table):
    text = plan(duplicate_ids(table))
    assert "partial_min(id" in text
    assert "mailing_address" not in text
