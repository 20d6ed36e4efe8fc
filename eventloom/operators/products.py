"""Product reporting: daily performance, gap to category, and recovery scenarios."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import (
    clean_text,
    hash_key,
    known,
    last_known,
    money_sum,
    or_zero,
    or_zero_money,
    product_key,
    ratio,
)

DAY_PRODUCT = ["metric_date", "product_key"]
ATTRIBUTES = ["item_id", "item_name", "item_brand", "item_variant", "item_category"]
# The item id is part of the product key, so it is grouped by, not searched for.
LATEST = ATTRIBUTES[1:]

# Recommendation labels.
NO_VIEWS = "No observed product views"
REVIEW = "Tracking review needed"
CANDIDATE = "Experiment candidate"
AT_BENCHMARK = "At or above category benchmark"


def _latest(time: str) -> list:
    return [F.max(F.when(F.col(c).isNotNull(), F.struct(time, c))).alias(c) for c in LATEST]


def _latest_again() -> list:
    """Merge the (time, value) pairs of the finer groups and keep the value."""
    return [F.max(c)[c].alias(c) for c in LATEST]


def _events_by_day(items: DataFrame) -> DataFrame:
    """Two plain groupings, by session and then without it.

    They replace two distinct counts over all item rows, which Spark would plan by copying
    every row once per count; and a product with a huge share of the rows is first spread
    over its sessions.
    """
    view, cart = F.col("event_name") == "view_item", F.col("event_name") == "add_to_cart"
    per_session = (
        items.where(F.col("event_name").isin("view_item", "add_to_cart", "purchase"))
        .groupBy(F.col("event_date").alias("metric_date"), product_key().alias("product_key"), "item_id", "session_id")
        .agg(
            F.count_if(view).alias("views"),
            F.count_if(cart).alias("carts"),
            F.count_if(F.col("event_name") == "purchase").alias("purchases"),
            *_latest("event_timestamp"),
        )
    )
    in_session = F.col("session_id").isNotNull()
    return per_session.groupBy(*DAY_PRODUCT).agg(
        F.max("item_id").alias("item_id"),
        *_latest_again(),
        F.sum("views").alias("view_item_events"),
        F.count_if(in_session & (F.col("views") > 0)).alias("view_item_sessions"),
        F.sum("carts").alias("add_to_cart_events"),
        F.count_if(in_session & (F.col("carts") > 0)).alias("add_to_cart_sessions"),
        F.sum("purchases").alias("raw_purchase_item_rows"),
    )


def _orders_by_day(order_items: DataFrame) -> DataFrame:
    per_order = order_items.groupBy(
        F.col("order_date").alias("metric_date"), "product_key", "item_id", "transaction_id"
    ).agg(
        F.sum("quantity").alias("units"),
        money_sum("line_revenue_usd").alias("revenue"),
        *_latest("purchased_at"),
    )
    return per_order.groupBy(*DAY_PRODUCT).agg(
        F.max("item_id").alias("item_id"),
        *_latest_again(),
        F.count("*").alias("order_count"),
        F.sum("units").alias("units_purchased"),
        money_sum("revenue").alias("product_revenue_usd"),
    )


def product_performance(items: DataFrame, order_items: DataFrame) -> DataFrame:
    """Date x product: latest attributes, views, carts, orders, units, revenue, same-day rates."""
    events = _events_by_day(items)
    orders = _orders_by_day(order_items)
    event_counts = events.columns[len(DAY_PRODUCT) + len(ATTRIBUTES) :]
    orders = orders.select(*DAY_PRODUCT, *[F.col(c).alias(f"order_{c}") for c in ATTRIBUTES], *orders.columns[-3:])
    order_rate = ratio("order_count", "view_item_sessions")
    return (
        events.join(orders, DAY_PRODUCT, "full")
        .select(
            hash_key(*DAY_PRODUCT).alias("product_daily_id"),
            *DAY_PRODUCT,
            *[F.coalesce(c, f"order_{c}").alias(c) for c in ATTRIBUTES],
            *[or_zero(c).alias(c) for c in event_counts],
            or_zero("order_count").alias("order_count"),
            or_zero("units_purchased").alias("units_purchased"),
            or_zero_money("product_revenue_usd").alias("product_revenue_usd"),
        )
        .select(
            "*",
            ratio("add_to_cart_sessions", "view_item_sessions").alias("same_day_view_to_cart_rate"),
            order_rate.alias("same_day_view_session_to_order_rate"),
            ratio("order_count", "add_to_cart_sessions").alias("same_day_cart_session_to_order_rate"),
            ratio("product_revenue_usd", "units_purchased").alias("average_unit_revenue_usd"),
            F.coalesce(order_rate > 1, F.lit(False)).alias("same_day_order_rate_over_one"),
        )
    )


def product_opportunity(performance: DataFrame) -> DataFrame:
    """Per product: totals against its category, the gap, and what closing it would model to.

    Products are joined to category totals without a broadcast hint: Spark broadcasts them
    when they are measured small and otherwise splits a crowded category's partition.
    """
    summed = [
        "view_item_events",
        "view_item_sessions",
        "add_to_cart_events",
        "add_to_cart_sessions",
        "order_count",
        "units_purchased",
        "product_revenue_usd",
    ]
    products = performance.groupBy("product_key").agg(
        F.min("metric_date").alias("first_activity_date"),
        F.max("metric_date").alias("last_activity_date"),
        *[last_known(c, "metric_date").alias(c) for c in ATTRIBUTES[:-1]],
        known(last_known(clean_text("item_category"), "metric_date")).alias("item_category"),
        *[(money_sum(c) if c.endswith("_usd") else F.sum(c)).alias(c) for c in summed],
    )
    categories = products.groupBy("item_category").agg(
        F.sum("view_item_sessions").alias("category_view_item_sessions"),
        F.sum("add_to_cart_sessions").alias("category_add_to_cart_sessions"),
        F.sum("order_count").alias("category_order_count"),
        money_sum("product_revenue_usd").alias("category_revenue_usd"),
    )
    # Summed from the category totals, which the join below shuffles anyway.
    portfolio = categories.agg(
        F.struct(
            ratio(F.sum("category_order_count"), F.sum("category_view_item_sessions")).alias("order_rate"),
            ratio(F.sum("category_revenue_usd"), F.sum("category_order_count")).alias("order_value"),
            F.sum("category_add_to_cart_sessions").alias("cart_sessions"),
        )
    ).scalar()
    views = F.col("view_item_sessions")
    no_views = views == 0
    gap = F.greatest(
        or_zero_money("category_view_to_order_rate") - or_zero_money("product_view_to_order_rate"), F.lit(0.0)
    )
    anomaly = (no_views & (F.col("order_count") > 0)) | F.coalesce(
        F.col("product_view_to_order_rate") > 1, F.lit(False)
    )
    modeled_orders = F.col("conversion_gap_to_category") * views
    status = (
        F.when(no_views, NO_VIEWS)
        .when(F.col("has_tracking_anomaly"), REVIEW)
        .when(F.col("conversion_gap_to_category") > 0, CANDIDATE)
        .otherwise(AT_BENCHMARK)
    )
    return (
        products.join(categories, "item_category", "left")
        .select(
            hash_key("product_key").alias("product_opportunity_id"),
            "product_key",
            "first_activity_date",
            "last_activity_date",
            *ATTRIBUTES,
            *summed,
            ratio("add_to_cart_sessions", "view_item_sessions").alias("product_view_to_cart_rate"),
            ratio("order_count", "view_item_sessions").alias("product_view_to_order_rate"),
            *categories.columns[1:],
            ratio("category_order_count", "category_view_item_sessions").alias("category_view_to_order_rate"),
            portfolio["order_rate"].alias("portfolio_view_to_order_rate"),
            ratio("product_revenue_usd", "order_count").alias("product_average_order_value_usd"),
            ratio("category_revenue_usd", "category_order_count").alias("category_average_order_value_usd"),
            portfolio["order_value"].alias("portfolio_order_value"),
        )
        .select(
            "*",
            F.coalesce(
                "product_average_order_value_usd",
                "category_average_order_value_usd",
                "portfolio_order_value",
                F.lit(0.0),
            ).alias("opportunity_order_value_usd"),
            F.when(no_views, 0.0).otherwise(gap).alias("conversion_gap_to_category"),
            anomaly.alias("has_tracking_anomaly"),
        )
        .drop("portfolio_order_value")
        .select(
            "*",
            modeled_orders.alias("modeled_additional_orders_full_gap"),
            (modeled_orders * F.col("opportunity_order_value_usd")).alias("modeled_revenue_opportunity_full_gap_usd"),
            status.alias("opportunity_status"),
        )
        .select(*OPPORTUNITY_COLUMNS)
    )


OPPORTUNITY_COLUMNS = [
    "product_opportunity_id",
    "product_key",
    "first_activity_date",
    "last_activity_date",
    *ATTRIBUTES,
    "view_item_events",
    "view_item_sessions",
    "add_to_cart_events",
    "add_to_cart_sessions",
    "order_count",
    "units_purchased",
    "product_revenue_usd",
    "product_view_to_cart_rate",
    "product_view_to_order_rate",
    "category_view_item_sessions",
    "category_add_to_cart_sessions",
    "category_order_count",
    "category_revenue_usd",
    "category_view_to_order_rate",
    "portfolio_view_to_order_rate",
    "product_average_order_value_usd",
    "category_average_order_value_usd",
    "opportunity_order_value_usd",
    "conversion_gap_to_category",
    "modeled_additional_orders_full_gap",
    "modeled_revenue_opportunity_full_gap_usd",
    "has_tracking_anomaly",
    "opportunity_status",
]


def opportunity_scenario(
    opportunity: DataFrame, min_view_sessions: int = 100, recovery: float = 0.5, top: int | None = None
) -> DataFrame:
    """High-traffic products below their category, at a partial recovery of the gap: all, or the `top` ones by revenue."""
    recovered = F.lit(float(recovery))
    found = (
        opportunity.where(
            (F.col("view_item_sessions") >= min_view_sessions) & (F.col("opportunity_status") == CANDIDATE)
        )
        .select(
            "product_key",
            "item_name",
            "item_category",
            "view_item_sessions",
            "product_view_to_order_rate",
            "category_view_to_order_rate",
            "conversion_gap_to_category",
            (F.col("modeled_additional_orders_full_gap") * recovered).alias("scenario_additional_orders"),
            (F.col("modeled_revenue_opportunity_full_gap_usd") * recovered).alias("scenario_revenue_usd"),
        )
    )
    return found if top is None else found.orderBy(F.col("scenario_revenue_usd").desc(), "product_key").limit(top)
