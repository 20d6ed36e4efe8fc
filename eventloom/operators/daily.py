"""Daily reporting tables: executive metrics, funnel stages, and segments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import (
    UNKNOWN,
    clean_text,
    hash_key,
    known,
    money_sum,
    month_start,
    or_zero,
    or_zero_money,
    ratio,
    week_start,
)

# Reported count -> session flag it counts.
FLAG_COUNTS = {
    "observed_product_view_sessions": "viewed_item",
    "observed_cart_sessions": "added_to_cart",
    "observed_checkout_sessions": "began_checkout",
    "observed_purchase_sessions": "purchased",
    "sequential_product_view_sessions": "sequential_viewed_item",
    "sequential_cart_sessions": "sequential_added_to_cart",
    "sequential_checkout_sessions": "sequential_began_checkout",
    "sequential_purchase_sessions": "sequential_purchased",
    "sessions_with_funnel_order_gap": "has_funnel_order_gap",
}

# Stage names in order, and per funnel type the counts they come from.
STAGE_NAMES = ("Product view", "Add to cart", "Checkout", "Purchase")
FUNNEL_TYPES = {
    "Observed": list(FLAG_COUNTS)[0:4],
    "Sequential": list(FLAG_COUNTS)[4:8],
}

# Labels of the session types.
NEW_SESSION, OTHER_SESSION = "New user session", "Returning or other session"
SEGMENT_DIMENSIONS = ["device_category", "country", "first_user_source", "first_user_medium"]


def _flag_counts() -> list[Column]:
    return [F.count_if(flag).alias(name) for name, flag in FLAG_COUNTS.items()]


def _averages() -> list[Column]:
    return [
        F.avg("session_duration_seconds").alias("average_session_duration_seconds"),
        (F.avg("engagement_time_msec") / F.lit(1000.0)).alias("average_engagement_seconds"),
    ]


def executive_daily(funnel: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per date on which a session started or an order was placed."""
    by_session_date = funnel.groupBy(F.col("session_date").alias("metric_date")).agg(
        F.count("*").alias("total_sessions"),
        F.count_distinct("user_pseudo_id").alias("daily_active_users"),
        F.count_if("is_new_user_session").alias("new_user_sessions"),
        *_flag_counts(),
        F.sum("event_count").alias("total_events"),
        F.sum("page_view_count").alias("total_page_views"),
        *_averages(),
    )
    by_order_date = orders.groupBy(F.col("order_date").alias("metric_date")).agg(
        F.count("*").alias("order_count"),
        money_sum("order_revenue_usd").alias("revenue_usd"),
        F.sum("order_item_quantity").alias("units_purchased"),
    )
    session_counts = [c for c in by_session_date.columns[1:] if not c.startswith("average")]
    # Rates use the raw sides, so a date without sessions or orders has NULL rates.
    return by_session_date.join(by_order_date, "metric_date", "full").select(
        F.date_format("metric_date", "yyyyMMdd").alias("executive_daily_id"),
        "metric_date",
        week_start("metric_date").alias("week_start_date"),
        month_start("metric_date").alias("month_start_date"),
        F.date_format("metric_date", "EEEE").alias("day_name"),
        *[or_zero(c).alias(c) for c in session_counts],
        "average_session_duration_seconds",
        "average_engagement_seconds",
        or_zero("order_count").alias("order_count"),
        or_zero_money("revenue_usd").alias("revenue_usd"),
        or_zero("units_purchased").alias("units_purchased"),
        ratio("observed_purchase_sessions", "total_sessions").alias("observed_session_conversion_rate"),
        ratio("sequential_purchase_sessions", "total_sessions").alias("sequential_completion_rate"),
        ratio("revenue_usd", "order_count").alias("average_order_value_usd"),
        ratio("revenue_usd", "total_sessions").alias("revenue_per_session_usd"),
        ratio("total_events", "total_sessions").alias("events_per_session"),
        ratio("total_page_views", "total_sessions").alias("page_views_per_session"),
    )


def funnel_daily(funnel: DataFrame) -> DataFrame:
    """Date x funnel type x stage in long form, each stage against the previous and the first.

    The eight counts of a date sit in one row, so previous and first stage are plain columns
    of it: turning the row into eight needs neither a union of scans nor a window.
    """
    counts = funnel.groupBy(F.col("session_date").alias("metric_date")).agg(*_flag_counts())
    rows = []
    for funnel_type, stages in FUNNEL_TYPES.items():
        for i, (stage, name) in enumerate(zip(stages, STAGE_NAMES)):
            rows.append(
                F.struct(
                    F.lit(funnel_type).alias("funnel_type"),
                    F.lit(i + 1).alias("stage_number"),
                    F.lit(name).alias("stage_name"),
                    F.col(stage).alias("stage_sessions"),
                    (F.col(stages[i - 1]) if i else F.lit(None).cast("long")).alias("previous_stage_sessions"),
                    F.col(stages[0]).alias("stage_1_sessions"),
                )
            )
    first = F.col("stage_number") == 1
    now, before = F.col("stage_sessions"), F.col("previous_stage_sessions")
    return counts.select("metric_date", F.inline(F.array(*rows))).select(
        F.concat_ws(
            "|", F.date_format("metric_date", "yyyyMMdd"), F.lower("funnel_type"), F.col("stage_number").cast("string")
        ).alias("funnel_daily_id"),
        "metric_date",
        "funnel_type",
        "stage_number",
        "stage_name",
        F.concat(F.col("stage_number").cast("string"), F.lit(" - "), F.col("stage_name")).alias("stage_label"),
        "stage_sessions",
        "previous_stage_sessions",
        "stage_1_sessions",
        F.when(first, 1.0).otherwise(ratio(now, before)).alias("stage_conversion_rate"),
        ratio(now, "stage_1_sessions").alias("stage_1_retention_rate"),
        F.when(first, 0).when(now <= before, before - now).alias("dropoff_sessions"),
        F.when(first, 0.0).when(now <= before, ratio(before - now, before)).alias("dropoff_rate"),
        F.when(first, False).otherwise(now > before).alias("has_stage_increase"),
    )


def _user_type() -> Column:
    return F.when(F.col("is_new_user_session"), NEW_SESSION).otherwise(OTHER_SESSION)


def _segment_keys(dimensions: Sequence[str]) -> list[str]:
    return ["metric_date", *dimensions[:1], "user_type", *dimensions[1:]]


def _orders_by_segment(funnel: DataFrame, orders: DataFrame, dimensions: Sequence[str]) -> DataFrame:
    """Orders per segment; dimensions from the order's session first, then from the order.

    Orders are summed per (date, session, own dimensions) before they meet the sessions:
    orders without a session, or a session with very many orders, shrink to a few rows
    there and cannot pile up on one join key.
    """
    own = [clean_text(c).alias(f"order_{c}") for c in dimensions]
    per_session = orders.groupBy(F.col("order_date").alias("metric_date"), "session_id", *own).agg(
        F.count("*").alias("n"), money_sum("order_revenue_usd").alias("revenue")
    )
    session_side = funnel.select("session_id", "is_new_user_session", *dimensions)
    return (
        per_session.join(session_side, "session_id", "left")
        .select(
            "metric_date",
            *[known(c, f"order_{c}").alias(c) for c in dimensions],
            F.when(F.col("is_new_user_session").isNull(), UNKNOWN).otherwise(_user_type()).alias("user_type"),
            "n",
            "revenue",
        )
        .groupBy(*_segment_keys(dimensions))
        .agg(F.sum("n").alias("order_count"), money_sum("revenue").alias("revenue_usd"))
    )


def funnel_segment(
    funnel: DataFrame,
    orders: DataFrame,
    dimensions: Sequence[str] = SEGMENT_DIMENSIONS,
    orders_mark_sessions: bool = False,
) -> DataFrame:
    """Session, funnel and order metrics per date, user type and the given dimensions.

    `orders_mark_sessions` says that each order's session has `purchased` set, as where both come
    from the same events; then only those sessions meet the orders.
    """
    keys = _segment_keys(dimensions)
    session_side = (
        funnel.select(
            F.col("session_date").alias("metric_date"),
            *[known(c).alias(c) for c in dimensions],
            _user_type().alias("user_type"),
            *FLAG_COUNTS.values(),
            "session_duration_seconds",
            "engagement_time_msec",
        )
        .groupBy(*_segment_keys(dimensions))
        .agg(F.count("*").alias("total_sessions"), *_flag_counts(), *_averages())
    )
    counts = ["total_sessions", *FLAG_COUNTS]
    merged = session_side.join(_orders_by_segment(funnel.where("purchased") if orders_mark_sessions else funnel, orders, dimensions), keys, "full").select(
        hash_key(*keys).alias("funnel_segment_id"),
        *keys,
        *[or_zero(c).alias(c) for c in counts],
        "average_session_duration_seconds",
        "average_engagement_seconds",
        or_zero("order_count").alias("order_count"),
        or_zero_money("revenue_usd").alias("revenue_usd"),
    )
    rates = []
    for kind in ("observed", "sequential"):
        view, cart, checkout, purchase = (f"{kind}_{s}_sessions" for s in ("product_view", "cart", "checkout", "purchase"))
        rates += [
            ratio(cart, view).alias(f"{kind}_view_to_cart_rate"),
            ratio(checkout, cart).alias(f"{kind}_cart_to_checkout_rate"),
            ratio(purchase, checkout).alias(f"{kind}_checkout_to_purchase_rate"),
            ratio(purchase, "total_sessions").alias(
                "observed_session_conversion_rate" if kind == "observed" else "sequential_completion_rate"
            ),
        ]
    return merged.select(
        "*",
        *rates,
        ratio("revenue_usd", "total_sessions").alias("revenue_per_session_usd"),
        ratio("revenue_usd", "order_count").alias("average_order_value_usd"),
    )
