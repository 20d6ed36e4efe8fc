"""Every kind of check finds what it is for, and passes where nothing is wrong."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom.operators import checks
from eventloom.plans.catalog import TABLES, materialize
from tests.conftest import event


@pytest.fixture(scope="module")
def tables(spark, raw_of, tmp_path_factory):
    rows = [
        event("first_visit", 0, user="a", device="desktop"),
        event("view_item", 1, user="a", items=[{"item_id": "p", "price_in_usd": 3.0}], event_bundle_sequence_id=1),
        event("add_to_cart", 2, user="a", items=[{"item_id": "p"}], event_bundle_sequence_id=2),
        event("begin_checkout", 3, user="a"),
        event("purchase", 4, user="a", transaction="T", revenue=3.0, units=1, items=[{"item_id": "p", "price_in_usd": 3.0}]),
        event("view_item", 9 * 86400, user="b", items=[{"item_name": "q"}]),
    ]
    return materialize(raw_of(*rows), str(tmp_path_factory.mktemp("tables")))


def test_all_checks_pass_on_sound_tables(tables):
    for name in checks.NAMED_CHECKS:
        assert checks.NAMED_CHECKS[name](tables).isEmpty(), name
    for dataset in checks.GENERIC_CHECKS:
        failing = checks.generic_report(tables, dataset).where("failing_rows > 0").collect()
        assert failing == [], failing


def test_reports_cover_all_column_checks(tables):
    counted = sum(checks.generic_report(tables, d).count() for d in checks.GENERIC_CHECKS)
    assert counted == 108 + 16 + 10 + 3 and len(checks.NAMED_CHECKS) == 14


def test_tables_equal_their_plans(tables):
    assert set(TABLES) <= set(tables)
    for name in ("users", "executive_daily", "cohort_retention", "product_opportunity"):
        assert tables[name].exceptAll(tables.plan(name)).isEmpty()
        assert tables.plan(name).exceptAll(tables[name]).isEmpty()


def changed(tables, name, **columns):
    """The tables with some columns of one dataset replaced by SQL expressions."""
    df = tables[name]
    for c, value in columns.items():
        df = df.withColumn(c, F.expr(value).cast(df.schema[c].dataType))
    return {**{k: tables[k] for k in tables}, name: df}


def failures(report):
    return {r.check_name: r.failing_rows for r in report.collect() if r.failing_rows}


def test_column_checks_find_faults(tables):
    bad = changed(tables, "session_funnel", session_id="'x'", funnel_status="'?'", has_funnel_order_gap="NULL")
    assert failures(checks.generic_report(bad, "session_funnel")) == {
        "session_funnel.has_funnel_order_gap.not_null": 2,
        "session_funnel.session_id.unique": 1,
        "session_funnel.funnel_status.accepted_values": 1,
        "session_funnel.session_id.relationships": 2,
    }
    # A missing session is no broken reference.
    assert failures(checks.generic_report(changed(tables, "orders", session_id="NULL"), "orders")) == {}


CASES = [
    ("order_items_nonnegative", "order_items", {"line_revenue_usd": "-1.0D"}),
    ("orders_nonnegative", "orders", {"order_item_quantity": "-1"}),
    ("session_funnel_timestamp_order", "session_funnel", {"sequential_view_item_at": "NULL"}),
    ("session_funnel_timestamp_order", "session_funnel", {"seconds_view_to_cart": "-1"}),
    ("sessions_valid_time", "sessions", {"session_end_at": "'2000-01-01'"}),
    ("users_valid_values", "users", {"session_count": "0"}),
    ("users_valid_values", "users", {"last_seen_date": "'2000-01-01'"}),
    ("cohorts_valid", "cohort_retention", {"active_users": "5"}),
    ("cohorts_valid", "cohort_retention", {"retention_rate": "0.5D"}),
    ("customer_summary_reconciles", "customer_summary", {"lifetime_revenue_usd": "9.0D"}),
    ("executive_daily_reconciles", "executive_daily", {"total_sessions": "9"}),
    ("executive_daily_reconciles", "executive_daily", {"revenue_usd": "9.0D"}),
    ("funnel_segment_reconciles", "funnel_segment", {"order_count": "9"}),
    ("funnel_daily_sequential_monotonic", "funnel_daily", {"stage_sessions": "stage_number"}),
    ("product_opportunity_nonnegative", "product_opportunity", {"conversion_gap_to_category": "-1.0D"}),
    ("product_opportunity_reconciles", "product_opportunity", {"view_item_sessions": "9"}),
    ("product_performance_nonnegative", "product_performance", {"view_item_events": "-1"}),
]


@pytest.mark.parametrize(("check", "dataset", "columns"), CASES, ids=[f"{c[0]}-{n}" for n, c in enumerate(CASES)])
def test_named_checks_find_faults(tables, check, dataset, columns):
    assert not checks.NAMED_CHECKS[check](changed(tables, dataset, **columns)).isEmpty()


def test_row_count_check_finds_a_fan_out(tables):
    bad = {**{k: tables[k] for k in tables}, "session_funnel": tables["session_funnel"].unionAll(tables["session_funnel"])}
    assert not checks.session_funnel_row_count(bad).isEmpty()
