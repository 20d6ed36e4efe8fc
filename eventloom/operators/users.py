"""User rollup and the customer summary built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import (
    UNKNOWN,
    first_known,
    hash_key,
    money_sum,
    month_start,
    or_zero,
    or_zero_money,
    ratio,
    week_start,
)

# Customer types.
NON_PURCHASER, ONE_TIME, REPEAT = "Non-purchaser", "One-time purchaser", "Repeat purchaser"

SESSION_COUNTS = {
    "product_view_session_count": "viewed_item",
    "cart_session_count": "added_to_cart",
    "checkout_session_count": "began_checkout",
    "purchase_session_count": "purchased",
}
# Output column -> session column; a NULL in the first session counts as 'Unknown'.
FIRST_SESSION = {
    "first_device_category": "device_category",
    "first_country": "country",
    "first_user_source": "first_user_source",
    "first_user_medium": "first_user_medium",
}


def users(sessions: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per pseudonymous user: sessions, orders, spans and purchase status."""
    with_user = F.col("user_pseudo_id").isNotNull()
    from_sessions = (
        sessions.where(with_user)
        .groupBy("user_pseudo_id")
        .agg(
            F.min("session_date").alias("first_seen_date"),
            F.max("session_date").alias("last_seen_date"),
            F.min("session_start_at").alias("first_session_at"),
            F.max("session_end_at").alias("last_session_at"),
            *[
                first_known(F.coalesce(F.col(source), F.lit(UNKNOWN)), "session_start_at").alias(name)
                for name, source in FIRST_SESSION.items()
            ],
            F.count("*").alias("session_count"),
            *[F.count_if(flag).alias(name) for name, flag in SESSION_COUNTS.items()],
            F.sum("event_count").alias("total_events"),
            F.sum("page_view_count").alias("total_page_views"),
            (F.sum(or_zero("engagement_time_msec")) / F.lit(1000.0)).alias("total_engagement_seconds"),
        )
    )
    from_orders = (
        orders.where(with_user)
        .groupBy("user_pseudo_id")
        .agg(
            F.min("order_date").alias("first_purchase_date"),
            F.max("order_date").alias("last_purchase_date"),
            F.min("purchased_at").alias("first_purchase_at"),
            F.max("purchased_at").alias("last_purchase_at"),
            F.count("*").alias("orders"),
            money_sum("order_revenue_usd").alias("revenue"),
            F.sum("order_item_quantity").alias("units"),
        )
    )
    dataset_end = sessions.agg(F.max("session_date")).scalar()
    order_count = or_zero("orders")
    first_seen, first_bought = F.col("first_seen_date"), F.col("first_purchase_date")
    return from_sessions.join(from_orders, "user_pseudo_id", "left").select(
        hash_key("user_pseudo_id").alias("anonymous_user_key"),
        "user_pseudo_id",
        "first_seen_date",
        "last_seen_date",
        "first_session_at",
        "last_session_at",
        dataset_end.alias("dataset_end_date"),
        *FIRST_SESSION,
        "session_count",
        *SESSION_COUNTS,
        "total_events",
        "total_page_views",
        "total_engagement_seconds",
        "first_purchase_date",
        "last_purchase_date",
        "first_purchase_at",
        "last_purchase_at",
        order_count.alias("order_count"),
        or_zero_money("revenue").alias("lifetime_revenue_usd"),
        or_zero("units").alias("units_purchased"),
        ratio("revenue", "orders").alias("average_order_value_usd"),
        (F.date_diff("last_seen_date", "first_seen_date") + 1).alias("observed_user_span_days"),
        F.date_diff(dataset_end, "last_seen_date").alias("recency_days_at_dataset_end"),
        F.when(first_bought >= first_seen, F.date_diff(first_bought, first_seen)).alias("days_to_first_purchase"),
        F.coalesce(first_bought < first_seen, F.lit(False)).alias("has_purchase_before_first_session"),
        (order_count > 0).alias("has_purchased"),
        (order_count >= 2).alias("is_repeat_purchaser"),
        F.when(order_count >= 2, REPEAT).when(order_count == 1, ONE_TIME).otherwise(NON_PURCHASER).alias(
            "customer_status"
        ),
    )


def customer_summary(users: DataFrame) -> DataFrame:
    """Users without their raw id and timestamps, plus calendar and banding columns."""
    status, n = F.col("customer_status"), F.col("session_count")
    status_sort = F.when(status == NON_PURCHASER, 1).when(status == ONE_TIME, 2).when(status == REPEAT, 3)
    band = (
        F.when(n == 1, "1 session")
        .when(n.between(2, 3), "2–3 sessions")
        .when(n.between(4, 7), "4–7 sessions")
        .otherwise("8+ sessions")
    )
    return users.select(
        "anonymous_user_key",
        "first_seen_date",
        "last_seen_date",
        week_start("first_seen_date").alias("first_seen_week"),
        month_start("first_seen_date").alias("first_seen_month"),
        "first_purchase_date",
        "last_purchase_date",
        *FIRST_SESSION,
        "session_count",
        *SESSION_COUNTS,
        "total_events",
        "total_page_views",
        "total_engagement_seconds",
        "order_count",
        "lifetime_revenue_usd",
        "units_purchased",
        "average_order_value_usd",
        "observed_user_span_days",
        "recency_days_at_dataset_end",
        "days_to_first_purchase",
        "has_purchase_before_first_session",
        "has_purchased",
        "is_repeat_purchaser",
        "customer_status",
        status_sort.alias("customer_status_sort"),
        band.alias("session_frequency_band"),
    )
