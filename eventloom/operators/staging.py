"""Flattening of the raw nested export: one row per event, one row per event item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import clean_text, event_param, hash_key, session_key
from eventloom.sources.raw import between_days

# Output column -> nested source field, for the texts whose blanks become NULL.
EVENT_TEXTS = {
    "device_category": "device.category",
    "operating_system": "device.operating_system",
    "device_language": "device.language",
    "browser": "device.web_info.browser",
    "country": "geo.country",
    "region": "geo.region",
    "city": "geo.city",
    "first_user_source": "traffic_source.source",
    "first_user_medium": "traffic_source.medium",
    "first_user_campaign": "traffic_source.name",
}
ITEM_ATTRIBUTES = ["item_id", "item_name", "item_brand", "item_variant"]
ITEM_CATEGORIES = ["item_category"] + [f"item_category{n}" for n in range(2, 6)]
ITEM_PLACEMENT = [
    "coupon",
    "affiliation",
    "location_id",
    "item_list_id",
    "item_list_name",
    "item_list_index",
    "promotion_id",
    "promotion_name",
    "creative_name",
    "creative_slot",
]


def _event_date():
    return F.to_date("event_date", "yyyyMMdd").alias("event_date")


def _event_timestamp():
    return F.timestamp_micros("event_timestamp").alias("event_timestamp")


def _with_session_number(raw: DataFrame) -> DataFrame:
    """A step of its own, so that the column and the session id share one parameter lookup."""
    return raw.select("*", event_param("ga_session_id", "int_value").alias("ga_session_id"))


def flatten_events(raw: DataFrame, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """One row per event with its struct leaves, six parameters and session id.

    A map-only plan: no column is computed that a later operator does not select, and
    the date range and any `event_name` filter reach the Parquet scan.
    """
    return _with_session_number(between_days(raw, date_from, date_to)).select(
        _event_date(),
        _event_timestamp(),
        "event_name",
        "user_pseudo_id",
        "user_id",
        "platform",
        "ga_session_id",
        event_param("ga_session_number", "int_value").alias("ga_session_number"),
        session_key("user_pseudo_id", "ga_session_id").alias("session_id"),
        *[clean_text(source).alias(name) for name, source in EVENT_TEXTS.items()],
        event_param("engagement_time_msec", "int_value").alias("engagement_time_msec"),
        *[event_param(p, "string_value").alias(p) for p in ("page_location", "page_title", "page_referrer")],
        clean_text("ecommerce.transaction_id").alias("transaction_id"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("purchase_revenue_usd"),
        F.col("ecommerce.total_item_quantity").alias("total_item_quantity"),
    )


def flatten_items(raw: DataFrame, date_from: str | None = None, date_to: str | None = None) -> DataFrame:
    """One row per element of `items`, numbered from 1; events without items drop out."""
    # Hashed per event, before the array is expanded, and from the untrimmed transaction id.
    event_key = hash_key(
        F.coalesce("user_pseudo_id", F.lit("<null-user>")),
        "event_timestamp",
        F.coalesce("event_name", F.lit("<null-event>")),
        F.coalesce("event_bundle_sequence_id", F.lit(-1)),
        F.coalesce("event_previous_timestamp", F.lit(-1)),
        F.coalesce("event_server_timestamp_offset", F.lit(-1)),
        F.coalesce("ecommerce.transaction_id", F.lit("<no-transaction>")),
    )
    per_event = _with_session_number(between_days(raw, date_from, date_to)).select(
        _event_date(),
        _event_timestamp(),
        "event_name",
        "user_pseudo_id",
        "user_id",
        "platform",
        "ga_session_id",
        session_key("user_pseudo_id", "ga_session_id").alias("session_id"),
        event_key.alias("event_key"),
        clean_text("ecommerce.transaction_id").alias("transaction_id"),
        F.col("ecommerce.purchase_revenue_in_usd").alias("purchase_revenue_in_usd"),
        F.col("ecommerce.total_item_quantity").alias("total_item_quantity"),
        "items",
    )
    event_columns = [c for c in per_event.columns if c != "items"]
    position = (F.col("position") + 1).cast("long")
    quantity = F.coalesce("item.quantity", F.lit(1))
    return per_event.select(*event_columns, F.posexplode("items").alias("position", "item")).select(
        hash_key("event_key", position).alias("event_item_id"),
        *event_columns,
        position.alias("item_position"),
        *[clean_text(f"item.{c}").alias(c) for c in ITEM_ATTRIBUTES + ITEM_CATEGORIES],
        F.col("item.price_in_usd").alias("item_price_usd"),
        F.col("item.price").alias("item_price_local"),
        quantity.alias("quantity"),
        F.col("item.item_revenue_in_usd").alias("item_revenue_in_usd"),
        F.col("item.item_revenue").alias("item_revenue_local"),
        *[clean_text(f"item.{c}").alias(c) for c in ITEM_PLACEMENT],
        F.coalesce("item.item_revenue_in_usd", F.col("item.price_in_usd") * quantity).alias("item_value_usd"),
    )
