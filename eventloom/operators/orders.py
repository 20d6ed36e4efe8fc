"""Orders, their lines, and how well the two agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import hash_key, money_sum, or_zero, or_zero_money, product_key, ratio
from eventloom.operators.staging import ITEM_CATEGORIES, ITEM_PLACEMENT

# What an order takes from its earliest purchase event.
ORDER_ATTRIBUTES = [
    "session_id",
    "user_pseudo_id",
    "device_category",
    "operating_system",
    "browser",
    "country",
    "region",
    "first_user_source",
    "first_user_medium",
    "first_user_campaign",
]


def orders(events: DataFrame) -> DataFrame:
    """One row per transaction id, its repeated purchase events merged.

    The earliest event is a minimum over (time, attributes) structs: it combines on the map
    side and settles equal times by the attribute values, so the result is deterministic.
    """
    earliest = F.min(F.struct("event_timestamp", "event_date", *ORDER_ATTRIBUTES))
    merged = (
        events.where((F.col("event_name") == "purchase") & F.col("transaction_id").isNotNull())
        .groupBy("transaction_id")
        .agg(
            earliest.alias("first"),
            or_zero_money(F.max("purchase_revenue_usd")).alias("order_revenue_usd"),
            or_zero(F.max("total_item_quantity")).alias("order_item_quantity"),
            F.count("*").alias("source_purchase_event_count"),
            F.count_distinct("session_id").alias("source_session_count"),
            F.count("purchase_revenue_usd").alias("priced_events"),
        )
    )
    return merged.select(
        "transaction_id",
        F.col("first.event_date").alias("order_date"),
        F.col("first.event_timestamp").alias("purchased_at"),
        *[F.col(f"first.{c}").alias(c) for c in ORDER_ATTRIBUTES],
        "order_revenue_usd",
        "order_item_quantity",
        "source_purchase_event_count",
        "source_session_count",
        (F.col("source_purchase_event_count") > 1).alias("has_duplicate_purchase_event"),
        (F.col("source_session_count") > 1).alias("spans_multiple_sessions"),
        (F.col("priced_events") == 0).alias("has_missing_order_revenue"),
    )


def order_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines of each order, taken from its earliest purchase event that carries items.

    The chosen event and the order's attributes meet first, one row per transaction on both
    sides; the item rows are then shuffled once, by (transaction, event), so a transaction
    id shared by very many events spreads over the cluster.
    """
    purchased = items.where((F.col("event_name") == "purchase") & F.col("transaction_id").isNotNull())
    chosen = (
        purchased.groupBy("transaction_id")
        .agg(F.min(F.struct("event_timestamp", "event_key"))["event_key"].alias("event_key"))
        .join(
            orders.select("transaction_id", "order_date", "purchased_at", "session_id", "user_pseudo_id"),
            "transaction_id",
        )
    )
    lines = purchased.drop("session_id", "user_pseudo_id").join(chosen, ["transaction_id", "event_key"])
    return lines.select(
        hash_key("transaction_id", "event_key", "item_position").alias("order_item_id"),
        "transaction_id",
        F.col("event_key").alias("purchase_event_key"),
        "order_date",
        "purchased_at",
        "session_id",
        "user_pseudo_id",
        "item_position",
        product_key().alias("product_key"),
        "item_id",
        "item_name",
        "item_brand",
        "item_variant",
        *ITEM_CATEGORIES,
        "quantity",
        "item_price_usd",
        "item_price_local",
        "item_revenue_in_usd",
        "item_revenue_local",
        or_zero_money("item_value_usd").alias("line_revenue_usd"),
        (F.col("item_revenue_in_usd").isNull() & F.col("item_price_usd").isNotNull()).alias(
            "used_calculated_line_value"
        ),
        F.col("item_value_usd").isNull().alias("has_missing_line_value"),
        *ITEM_PLACEMENT,
    )


def order_line_gaps(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Per order: its revenue, the sum of its lines, and the absolute difference."""
    lines = order_items.groupBy("transaction_id").agg(
        F.count("*").alias("item_rows"), money_sum("line_revenue_usd").alias("line_revenue_usd")
    )
    line_revenue = or_zero_money("line_revenue_usd")
    return orders.join(lines, "transaction_id", "left").select(
        "transaction_id",
        "has_duplicate_purchase_event",
        "spans_multiple_sessions",
        "has_missing_order_revenue",
        "order_revenue_usd",
        or_zero("item_rows").alias("item_rows"),
        line_revenue.alias("line_revenue_usd"),
        F.abs(F.col("order_revenue_usd") - line_revenue).alias("revenue_gap_usd"),
    )


def order_item_reconciliation(orders: DataFrame, order_items: DataFrame, tolerance_usd: float = 1.0) -> DataFrame:
    """One row of order-quality counts over all orders."""
    gap = F.col("revenue_gap_usd")
    return order_line_gaps(orders, order_items).agg(
        F.count("*").alias("order_count"),
        or_zero(F.sum("item_rows")).alias("item_row_count"),
        F.count_if("has_duplicate_purchase_event").alias("orders_with_repeated_events"),
        F.count_if("spans_multiple_sessions").alias("orders_spanning_sessions"),
        F.count_if("has_missing_order_revenue").alias("orders_missing_revenue"),
        F.count_if(F.col("item_rows") == 0).alias("orders_without_items"),
        F.count_if(gap <= tolerance_usd).alias("orders_within_tolerance"),
        F.count_if(gap > tolerance_usd).alias("orders_over_tolerance"),
        ratio(money_sum(gap), F.count(gap)).alias("mean_revenue_gap_usd"),
    )
