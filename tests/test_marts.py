"""Daily marts, products and cohorts."""

import datetime as dt

import pytest

from eventloom.operators.cohorts import cohort_retention, weekly_activity
from eventloom.operators.daily import executive_daily, funnel_daily, funnel_segment
from eventloom.operators.funnel import sequential_funnel, session_funnel
from eventloom.operators.orders import order_items, orders
from eventloom.operators.products import opportunity_scenario, product_opportunity, product_performance
from eventloom.operators.sessions import sessions
from eventloom.operators.users import users
from tests.conftest import by, event, only

DAY, WEEK = 86400, 7 * 86400


def funnel_and_orders(events):
    return session_funnel(sessions(events), sequential_funnel(events)), orders(events)


def test_executive_day_with_orders_only(events_of):
    rows = by(
        executive_daily(
            *funnel_and_orders(
                events_of(
                    event("view_item", 0, session=1),
                    event("page_view", 4, session=1),
                    event("x", 5, user="b", session=1),
                    event("purchase", 2 * DAY, session=None, transaction="T", revenue=8.0, units=2),
                )
            )
        ),
        "executive_daily_id",
    )
    first, last = rows["20240304"], rows["20240306"]
    assert (first.total_sessions, first.daily_active_users, first.total_events, first.order_count) == (2, 2, 3, 0)
    assert (first.revenue_per_session_usd, first.average_order_value_usd, first.events_per_session) == (None, None, 1.5)
    assert (first.average_session_duration_seconds, first.day_name) == (2.0, "Monday")
    assert (last.total_sessions, last.order_count, last.revenue_usd, last.units_purchased) == (0, 1, 8.0, 2)
    assert (last.average_session_duration_seconds, last.observed_session_conversion_rate) == (None, None)
    assert (last.week_start_date, last.month_start_date) == (dt.date(2024, 3, 4), dt.date(2024, 3, 1))


def stage_rows(events, kind):
    df = funnel_daily(session_funnel(sessions(events), sequential_funnel(events)))
    return by(df.where(df.funnel_type == kind), "stage_number")


def test_funnel_stage_increase(events_of):
    rows = stage_rows(
        events_of(
            event("view_item", 0, user="a"),
            event("add_to_cart", 1, user="a"),
            event("add_to_cart", 1, user="b"),
            event("begin_checkout", 1, user="b"),
        ),
        "Observed",
    )
    assert (rows[2].has_stage_increase, rows[2].dropoff_sessions, rows[2].stage_conversion_rate) == (True, None, 2.0)
    assert (rows[3].has_stage_increase, rows[3].dropoff_sessions, rows[3].dropoff_rate) == (False, 1, 0.5)
    assert (rows[1].stage_conversion_rate, rows[1].dropoff_sessions, rows[1].previous_stage_sessions) == (1.0, 0, None)
    assert (rows[4].funnel_daily_id, rows[4].stage_label) == ("20240304|observed|4", "4 - Purchase")


def test_funnel_day_without_views(events_of):
    rows = stage_rows(events_of(event("x")), "Sequential")
    assert (rows[1].stage_conversion_rate, rows[1].stage_1_retention_rate) == (1.0, None)
    assert (rows[2].stage_conversion_rate, rows[2].dropoff_sessions, rows[2].dropoff_rate) == (None, 0, None)


def test_segment_of_an_order_without_session(events_of):
    rows = by(
        funnel_segment(
            *funnel_and_orders(
                events_of(
                    event("purchase", 0, session=None, transaction="T", revenue=8.0, device="tablet"),
                    event("first_visit", 0, user="b", session=1, device="mobile"),
                    event("purchase", 1, user="b", session=1, transaction="U", revenue=4.0, device="desktop"),
                )
            )
        ),
        "user_type",
    )
    lost, found = rows["Unknown"], rows["New user session"]
    assert (lost.device_category, lost.total_sessions, lost.order_count, lost.revenue_usd) == ("tablet", 0, 1, 8.0)
    assert (lost.average_session_duration_seconds, lost.revenue_per_session_usd, lost.country) == (None, None, "Unknown")
    # The session's own device wins over the order's.
    assert (found.device_category, found.order_count, found.average_order_value_usd) == ("mobile", 1, 4.0)
    assert found.observed_session_conversion_rate == 1.0 and found.sequential_completion_rate == 0.0


def test_orders_without_session_join_once_per_segment(spark, events_of):
    """The join sees orders summed per session, so a mass of session-less orders is a few rows."""
    rows = [event("purchase", n, session=None, transaction=f"T{n}", revenue=1.0) for n in range(200)]
    df = funnel_segment(*funnel_and_orders(events_of(*rows, event("x"))))
    assert {r.user_type: r.order_count for r in df.collect()} == {"Unknown": 200, "Returning or other session": 0}


def performance(events_of, items_of, *rows):
    return product_performance(items_of(*rows), order_items(items_of(*rows), orders(events_of(*rows))))


def test_product_day(events_of, items_of):
    row = only(
        performance(
            events_of,
            items_of,
            event("view_item", 0, items=[{"item_id": "p", "item_brand": "old", "item_name": "n"}]),
            event("view_item", 1, items=[{"item_id": "p", "item_brand": "new"}]),
            event("view_item", 2, session=None, items=[{"item_id": "p"}]),
            event("add_to_cart", 3, user="b", items=[{"item_id": "p"}, {"item_id": "p"}]),
            event("purchase", 4, transaction="T", items=[{"item_id": "p", "quantity": 2, "price_in_usd": 3.0}]),
            event("purchase", 5, transaction="U", items=[{"item_id": "p", "quantity": 1, "price_in_usd": 3.0}]),
        )
    )
    assert (row.item_brand, row.item_name, row.item_id) == ("new", "n", "p")
    # Events count even without a session; session counts are distinct.
    assert (row.view_item_events, row.view_item_sessions, row.add_to_cart_events, row.add_to_cart_sessions) == (3, 1, 2, 1)
    assert (row.raw_purchase_item_rows, row.order_count, row.units_purchased, row.product_revenue_usd) == (2, 2, 3, 9.0)
    assert (row.same_day_view_session_to_order_rate, row.same_day_order_rate_over_one) == (2.0, True)
    assert row.average_unit_revenue_usd == 3.0


def test_product_order_on_another_day_than_its_items(events_of, items_of):
    rows = by(
        performance(
            events_of,
            items_of,
            event("purchase", 0, transaction="T"),
            event("purchase", DAY, transaction="T", items=[{"item_id": "p", "item_name": "n"}]),
        ),
        "metric_date",
    )
    assert rows[dt.date(2024, 3, 4)].order_count == 1 and rows[dt.date(2024, 3, 4)].item_name == "n"
    assert (rows[dt.date(2024, 3, 5)].order_count, rows[dt.date(2024, 3, 5)].raw_purchase_item_rows) == (0, 1)


def perf_row(spark, *rows):
    columns = (
        "metric_date date, product_key string, item_id string, item_name string, item_brand string,"
        " item_variant string, item_category string, view_item_events long, view_item_sessions long,"
        " add_to_cart_events long, add_to_cart_sessions long, order_count long, units_purchased long,"
        " product_revenue_usd double"
    )
    day = dt.date(2024, 3, 4)
    full = [(day, key, key, None, None, None, cat, v, v, 0, 0, n, n, r) for key, cat, v, n, r in rows]
    return spark.createDataFrame(full, columns)


def test_opportunity_gap_and_status(spark):
    df = product_opportunity(
        perf_row(
            spark,
            ("good", "c", 100, 30, 300.0),
            ("poor", "c", 100, 10, 200.0),
            ("unseen", "c", 0, 2, 10.0),
            ("odd", "d", 1, 2, 10.0),
            ("idle", " ", 10, 0, 0.0),
        )
    )
    rows = by(df, "product_key")
    poor = rows["poor"]
    assert poor.category_view_to_order_rate == pytest.approx(42 / 200)
    assert poor.conversion_gap_to_category == pytest.approx(0.21 - 0.10)
    assert poor.modeled_additional_orders_full_gap == pytest.approx(11.0)
    assert poor.modeled_revenue_opportunity_full_gap_usd == pytest.approx(11 * 20.0)
    assert {k: r.opportunity_status for k, r in rows.items()} == {
        "good": "At or above category benchmark",
        "poor": "Experiment candidate",
        "unseen": "No observed product views",
        "odd": "Tracking review needed",
        "idle": "At or above category benchmark",
    }
    assert rows["unseen"].has_tracking_anomaly and rows["unseen"].conversion_gap_to_category == 0.0
    assert rows["idle"].item_category == "Unknown"
    # No product or category order value: the portfolio's serves.
    assert rows["idle"].opportunity_order_value_usd == pytest.approx(520 / 44)
    top = opportunity_scenario(df, min_view_sessions=50, recovery=0.25, top=1).collect()
    assert [(r.product_key, r.scenario_additional_orders) for r in top] == [("poor", pytest.approx(2.75))]


def test_cohort_with_a_quiet_week(events_of):
    events = events_of(
        event("x", 0, session=1),
        event("x", 2 * WEEK, session=2),
        event("x", 3 * DAY, user="b", session=1),
        event("x", WEEK, user="c", session=1, device="mobile"),
    )
    s = sessions(events)
    rows = cohort_retention(s, users(s, orders(events))).collect()
    first = {r.cohort_age_weeks: r for r in rows if r.cohort_week == dt.date(2024, 3, 4)}
    assert {n: (r.active_users, r.retention_rate) for n, r in first.items()} == {0: (2, 1.0), 1: (0, 0.0), 2: (1, 0.5)}
    assert first[1].activity_week == dt.date(2024, 3, 11) and first[1].cohort_age_label == "Week 1"
    later = {(r.cohort_age_weeks, r.max_observable_age_weeks, r.cohort_size) for r in rows if r.first_device_category == "mobile"}
    assert later == {(0, 1, 1), (1, 1, 1)}
    assert weekly_activity(s).count() == 4


def test_fewer_dimensions(events_of):
    events = events_of(
        event("x", 0, device="mobile"),
        event("x", 0, user="b", device="tablet"),
        event("purchase", 1, user="b", device="tablet", transaction="T", revenue=2.0),
    )
    funnel, placed = funnel_and_orders(events)
    row = only(funnel_segment(funnel, placed, ["country"]))
    assert (row.country, row.total_sessions, row.order_count, row.revenue_usd) == ("Unknown", 2, 1, 2.0)
    s = sessions(events)
    row = only(cohort_retention(s, users(s, placed), ["first_country"]))
    assert (row.first_country, row.cohort_size, row.retention_rate) == ("Unknown", 2, 1.0)
