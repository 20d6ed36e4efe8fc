"""Session rollup and the orders seen inside each session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import elapsed_seconds, first_known, money_sum, or_zero, or_zero_money

FIRST_KNOWN = [
    "device_category",
    "operating_system",
    "browser",
    "country",
    "region",
    "first_user_source",
    "first_user_medium",
]

# Event name -> (count column, flag column, first-time column)
STEPS = {
    "view_item": ("view_item_count", "viewed_item", "first_view_item_at"),
    "add_to_cart": ("add_to_cart_count", "added_to_cart", "first_add_to_cart_at"),
    "begin_checkout": ("begin_checkout_count", "began_checkout", "first_begin_checkout_at"),
    "purchase": ("purchase_event_count", "purchased", "first_purchase_at"),
}


def session_orders(events: DataFrame) -> DataFrame:
    """Orders and revenue per session; repeats of a transaction within the session count once."""
    per_transaction = (
        events.where(
            (F.col("event_name") == "purchase")
            & F.col("session_id").isNotNull()
            & F.col("transaction_id").isNotNull()
        )
        .groupBy("session_id", "transaction_id")
        .agg(F.max(or_zero_money("purchase_revenue_usd")).alias("revenue"))
    )
    return per_transaction.groupBy("session_id").agg(
        F.count("*").alias("transactions"), money_sum("revenue").alias("revenue_usd")
    )


def sessions(events: DataFrame) -> DataFrame:
    """One row per session id: span, first known attributes, event counts and flags, orders."""

    def named(name: str):
        return F.col("event_name") == name

    rollup = (
        events.where(F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(
            F.min("user_pseudo_id").alias("user_pseudo_id"),
            F.min("event_date").alias("session_date"),
            F.min("event_timestamp").alias("session_start_at"),
            F.max("event_timestamp").alias("session_end_at"),
            elapsed_seconds(F.min("event_timestamp"), F.max("event_timestamp")).alias("session_duration_seconds"),
            *[first_known(c, "event_timestamp").alias(c) for c in FIRST_KNOWN],
            F.count("*").alias("event_count"),
            F.sum(or_zero("engagement_time_msec")).alias("engagement_time_msec"),
            F.count_if(named("page_view")).alias("page_view_count"),
            *[F.count_if(named(step)).alias(names[0]) for step, names in STEPS.items()],
            (F.count_if(named("first_visit")) > 0).alias("is_new_user_session"),
            *[(F.count_if(named(step)) > 0).alias(names[1]) for step, names in STEPS.items()],
            *[
                F.min(F.when(named(step), F.col("event_timestamp"))).alias(names[2])
                for step, names in STEPS.items()
            ],
        )
    )
    return rollup.join(session_orders(events), "session_id", "left").select(
        *rollup.columns,
        or_zero("transactions").alias("transactions"),
        or_zero_money("revenue_usd").alias("revenue_usd"),
    )
