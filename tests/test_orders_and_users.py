"""Orders, order lines, reconciliation, users, customer summary."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from eventloom.functions.columns import money_sum
from eventloom.operators.orders import order_item_reconciliation, order_items, order_line_gaps, orders
from eventloom.operators.sessions import sessions
from eventloom.operators.users import customer_summary, users
from tests.conftest import by, event, only

HOUR, DAY = 3600, 86400


def buy(seconds, transaction="T", **more):
    return event("purchase", seconds, transaction=transaction, **more)


def test_repeated_transaction_is_one_order(events_of):
    row = only(
        orders(
            events_of(
                buy(9, session=2, revenue=12.0, units=1, device="mobile"),
                buy(0, session=1, revenue=10.0, units=3, device="desktop"),
                buy(5, session=1),
            )
        )
    )
    assert (row.session_id, row.device_category, row.order_revenue_usd, row.order_item_quantity) == ("a-1", "desktop", 12.0, 3)
    assert (row.source_purchase_event_count, row.source_session_count) == (3, 2)
    assert row.has_duplicate_purchase_event and row.spans_multiple_sessions and not row.has_missing_order_revenue


def test_order_without_revenue_or_session(events_of):
    row = only(orders(events_of(buy(0, session=None))))
    assert (row.order_revenue_usd, row.order_item_quantity, row.source_session_count) == (0.0, 0, 0)
    assert row.has_missing_order_revenue and not row.spans_multiple_sessions and row.session_id is None


def test_only_purchases_with_a_transaction_are_orders(events_of):
    assert orders(events_of(buy(0, " \t"), buy(0, None), event("view_item", transaction="T"))).collect() == []


def test_equal_times_are_settled_by_the_attributes(events_of):
    rows = [buy(0, session=2, device="x"), buy(0, session=1, device="z")]
    for given in (rows, rows[::-1]):
        row = only(orders(events_of(*given)))
        assert (row.session_id, row.device_category) == ("a-1", "z")


def test_lines_come_from_the_first_event_with_items(raw_of, events_of, items_of):
    rows = [
        buy(0, date="20240303"),
        buy(5, items=[{"item_id": "p", "item_revenue_in_usd": 4.0}, {"item_id": "q"}]),
        buy(9, items=[{"item_id": "r"}]),
    ]
    lines = by(order_items(items_of(*rows), orders(events_of(*rows))), "item_id")
    assert set(lines) == {"p", "q"}
    assert lines["p"].order_date == dt.date(2024, 3, 3) and lines["p"].purchased_at == dt.datetime(2024, 3, 4)
    assert (lines["p"].line_revenue_usd, lines["p"].used_calculated_line_value) == (4.0, False)
    assert (lines["q"].line_revenue_usd, lines["q"].has_missing_line_value) == (0.0, True)


def test_calculated_line_value(items_of, events_of):
    rows = [buy(0, items=[{"price_in_usd": 2.0, "quantity": 3}])]
    row = only(order_items(items_of(*rows), orders(events_of(*rows))))
    assert (row.line_revenue_usd, row.used_calculated_line_value, row.has_missing_line_value) == (6.0, True, False)
    assert row.product_key == "name:unknown|variant:unknown"


def test_reconciliation(items_of, events_of):
    rows = [
        buy(0, "A", revenue=10.0, items=[{"item_revenue_in_usd": 9.5}]),
        buy(1, "B", revenue=10.0, items=[{"item_revenue_in_usd": 5.0}, {"item_revenue_in_usd": 1.0}]),
        buy(2, "C", revenue=3.0),
    ]
    placed = orders(events_of(*rows))
    lines = order_items(items_of(*rows), placed)
    assert {k: r.revenue_gap_usd for k, r in by(order_line_gaps(placed, lines), "transaction_id").items()} == {
        "A": 0.5,
        "B": 4.0,
        "C": 3.0,
    }
    row = only(order_item_reconciliation(placed, lines))
    assert (row.order_count, row.item_row_count, row.orders_without_items) == (3, 3, 1)
    assert (row.orders_within_tolerance, row.orders_over_tolerance) == (1, 2)
    assert row.mean_revenue_gap_usd == pytest.approx(2.5)


def test_many_events_of_one_transaction(spark, items_of, events_of):
    """A transaction id holding a third of all events stays one order with its first event's lines."""
    base = [buy(n, "hot", items=[{"item_id": f"i{n}"}], event_bundle_sequence_id=n) for n in range(50)]
    rest = [buy(n, f"t{n}", items=[{"item_id": "x"}]) for n in range(100)]
    events, items = events_of(*base, *rest), items_of(*base, *rest)
    lines = order_items(items, orders(events))
    assert lines.count() == 101
    assert only(lines.where("transaction_id = 'hot'")).item_id == "i0"


def both(events):
    s = sessions(events)
    return users(s, orders(events)), s


def test_user_rollup(events_of):
    people, _ = both(
        events_of(
            event("view_item", 0, session=1, params=[{"key": "engagement_time_msec", "value": {"string_value": None, "int_value": 1500}}]),
            buy(DAY, "A", session=2, revenue=10.0, units=1),
            buy(2 * DAY, "B", session=3, revenue=20.0, units=2),
            event("x", 9 * DAY, user="b", session=1, device="tablet"),
        )
    )
    rows = by(people, "user_pseudo_id")
    a, b = rows["a"], rows["b"]
    assert (a.session_count, a.order_count, a.lifetime_revenue_usd, a.average_order_value_usd) == (3, 2, 30.0, 15.0)
    assert (a.observed_user_span_days, a.recency_days_at_dataset_end, a.days_to_first_purchase) == (3, 7, 1)
    assert (a.customer_status, a.total_engagement_seconds, a.first_device_category) == ("Repeat purchaser", 1.5, "Unknown")
    assert (b.customer_status, b.order_count, b.average_order_value_usd, b.days_to_first_purchase) == ("Non-purchaser", 0, None, None)
    assert (b.first_device_category, b.recency_days_at_dataset_end, b.has_purchased) == ("tablet", 0, False)


def test_unknown_at_first_session_is_not_skipped(events_of):
    people, _ = both(events_of(event("x", 0, session=1), event("x", DAY, session=2, device="mobile")))
    assert only(people).first_device_category == "Unknown"


def test_order_before_first_session(events_of):
    people, _ = both(events_of(buy(0, "A", session=None, revenue=1.0), event("x", 3 * DAY, session=1)))
    row = only(people)
    assert row.days_to_first_purchase is None and row.has_purchase_before_first_session
    assert row.customer_status == "One-time purchaser"


def test_customer_summary_bands(spark, events_of):
    rows = [
        event("x", n * HOUR, user=f"u{sessions_}", session=n)
        for sessions_ in (1, 2, 3, 4, 7, 8)
        for n in range(sessions_)
    ]
    people, _ = both(events_of(*rows))
    bands = {r.session_count: (r.session_frequency_band, r.customer_status_sort) for r in customer_summary(people).collect()}
    assert {n: b for n, (b, _) in bands.items()} == {
        1: "1 session",
        2: "2–3 sessions",
        3: "2–3 sessions",
        4: "4–7 sessions",
        7: "4–7 sessions",
        8: "8+ sessions",
    }
    assert {s for _, s in bands.values()} == {1}
    assert customer_summary(people).where(F.col("first_seen_week") != F.lit("2024-03-04")).count() == 0


def test_sums_of_money_have_the_same_bits_in_any_order(spark):
    rng = random.Random(6)
    amounts = [round(rng.uniform(0, 10_000), 2) for _ in range(3000)] + [None, float("nan"), float("inf"), 0.1, 0.2, -5.75]
    total = sum(round(a * 1_000_000) for a in amounts if a is not None and math.isfinite(a)) / 1_000_000
    plain = set()
    for parts in (1, 7, 40):
        rng.shuffle(amounts)
        df = spark.createDataFrame([(a,) for a in amounts], "a double").repartition(parts)
        assert df.agg(money_sum("a").alias("s")).first().s == total
        plain.add(df.where("NOT isnan(a) AND a < 1e300").agg(F.sum("a")).first()[0])
    assert len(plain) > 1  # which sums of doubles don't do
    assert spark.range(0).agg(money_sum(F.col("id").cast("double"))).first()[0] is None
