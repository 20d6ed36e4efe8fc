"""The flat `events` test table reshaped into the raw nested export.

Every input row becomes one raw event. The rules below only use integer arithmetic on the
row's own columns, so that any SQL engine can rebuild the same columns from the same table.
They are chosen to reach the awkward cases: equal timestamps, blank and absent values,
transactions repeated within and across sessions, purchases without items, users who skip
weeks, and event dates kept in another time zone than the timestamps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.sources.raw import Layout, laid_out, read_raw_events, write_export
from eventloom.sources.schema import ITEM, PARAM, RAW_EVENT

DAY_US = 86_400_000_000
SIX_HOURS_US = DAY_US // 4
EIGHT_HOURS_US = DAY_US // 3
FIRST_DAY = 19_723  # 2024-01-01 in days since the epoch


def _text(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _pick(number: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


def _null_struct(schema: T.StructType, **given: Column) -> Column:
    """A struct of the schema's fields in order, NULL where not given."""
    return F.struct(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def _param(key: str, text: Column | None = None, number: Column | None = None) -> Column:
    value = _null_struct(
        PARAM["value"].dataType,
        **({"string_value": text} if text is not None else {}),
        **({"int_value": number} if number is not None else {}),
    )
    return F.struct(F.lit(key).alias("key"), value.alias("value"))


def _item(j: Column) -> Column:
    k, user = F.col("k"), F.col("shopper")
    # The number of products grows with the users; a third of the rows fall on the same 240 everywhere.
    product = F.when(k % 3 == 0, (k * 3 + j * 11) % 240).otherwise(k * 3 + j * 11 + user * 7)
    price = F.when(product % 13 != 0, (product % 40 + 10).cast("double"))
    quantity = F.when((k + j) % 6 != 0, j + 1)
    revenue = F.when(
        (F.col("event_name") == "purchase") & (k % 3 != 0), price * F.coalesce(quantity, F.lit(1)).cast("double")
    )
    return _null_struct(
        ITEM,
        item_id=F.when(product % 8 != 0, _text("P", product)),
        item_name=F.when(product % 16 != 0, _text("item ", product)),
        item_brand=_text("Brand#", (product + k) % 25),
        item_variant=F.when(product % 3 != 0, _text("v", product % 3)),
        item_category=_pick(product, "bolt", "widget", "", "gear", "panel"),
        item_category2=F.when(product % 2 == 0, _text("second ", product % 6)),
        item_category3=_text("third ", product % 7),
        item_category4=F.when(product % 9 > 2, _text("fourth ", product % 9)),
        item_category5=_pick(product, "", "fifth", " fifth "),
        price_in_usd=price,
        price=price * 2,
        quantity=quantity,
        item_revenue_in_usd=revenue,
        item_revenue=revenue * 2,
        coupon=F.when(k % 10 == 3, F.lit("SAVE")),
        affiliation=_text("shop ", user % 3),
        location_id=F.when(k % 8 > 0, _text("place ", k % 8)),
        item_list_id=_text("list ", k % 4),
        item_list_name=_pick(k, " ", "First list", "Second list"),
        item_list_index=j.cast("string"),
        promotion_id=F.when(k % 2 == 1, _text("P-", k % 6)),
        promotion_name=F.when(k % 2 == 1, _text("offer ", user % 6)),
        creative_name=_text("banner ", (k + j) % 3),
        creative_slot=F.when(j > 0, _text("slot ", j)),
    )


def _dated(events: DataFrame) -> DataFrame:
    """Flat events with what the raw rows are made of, their name and the date they are exported under."""
    k, user = F.col("k"), F.col("shopper")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    # A third of the users report times rounded down to six hours, so that times tie.
    coarse = F.when(user % 3 == 0, us - us % SIX_HOURS_US).otherwise(us)
    kind = F.col("event_type")
    return (
        events.select(
            "event_id",
            F.col("user_id").alias("shopper"),
            "event_type",
            "value",
            F.get_json_object("props", "$.k").cast("long").alias("k"),
            coarse.alias("us"),
        )
        .select("*", (F.floor(F.col("us") / DAY_US) - FIRST_DAY).alias("day"))
        .select(
            "event_id",
            "shopper",
            "value",
            "k",
            "us",
            "day",
            F.floor(F.col("day") / 7).alias("week"),
            F.when(kind == "view", "view_item")
            .when(kind == "click", "add_to_cart")
            .when((kind == "purchase") & (k < 60), "purchase")
            .when(kind.isin("purchase", "signup"), "begin_checkout")
            .when(k % 4 == 0, "first_visit")
            .otherwise("page_view")
            .alias("event_name"),
            # The export's dates are local to a shop eight hours west of UTC.
            F.date_format(F.timestamp_micros(F.col("us") - EIGHT_HOURS_US), "yyyyMMdd").alias("event_date"),
        )
    )


def _nested(rows: DataFrame) -> DataFrame:
    """The raw nested event of each dated row."""
    k, user = F.col("k"), F.col("shopper")
    day, week = F.col("day"), F.col("week")
    # In some weeks, and before a staggered start, a user's rows belong to a guest of that week.
    regular = (day >= user % 4 * 7) & ((user + week) % 5 != 0)
    pseudo_id = F.when(regular, _text("u", user)).otherwise(
        F.concat(_text("g", user), _text("-", week))
    )
    buys = F.col("event_name") == "purchase"
    transaction = F.when(k % 20 == 0, F.lit("")).otherwise(
        F.concat(_text("T", user), _text("-", k % 10), F.when(k % 20 == 5, F.lit(" ")).otherwise(F.lit("")))
    )
    params = F.filter(
        F.array(
            F.when(k != 98, _param("ga_session_id", number=F.floor(day / 3))),
            _param("ga_session_number", number=F.floor(day / 3) + 1),
            F.when(k % 2 == 0, _param("engagement_time_msec", number=k * 100)),
            _param("page_location", text=_text("https://shop.example/p/", k)),
            F.when(k % 5 != 0, _param("page_title", text=_text("Page ", k))),
            F.when(k % 3 == 0, _param("page_referrer", text=F.lit("https://search.example/"))),
        ),
        lambda p: p.isNotNull(),
    )
    has_items = F.col("event_name").isin("view_item", "add_to_cart") | (buys & (k % 11 != 0))
    last_item = F.when(has_items, k % 3)
    given = {
        "event_date": F.col("event_date"),
        "event_timestamp": F.col("us"),
        "event_previous_timestamp": F.when(k % 3 > 0, F.col("us") - k * 1000),
        "event_bundle_sequence_id": F.col("event_id"),
        "event_server_timestamp_offset": F.when(k % 2 == 0, k * 10),
        "event_name": F.col("event_name"),
        "user_pseudo_id": F.when(k != 97, pseudo_id),
        "user_id": F.when(user % 4 == 0, _text("login ", user)),
        "platform": F.when(user % 10 == 8, "IOS").when(user % 10 == 9, "ANDROID").otherwise("WEB"),
        "device": _null_struct(
            RAW_EVENT["device"].dataType,
            category=_pick(F.col("event_id"), "desktop", "mobile", "tablet", "\t "),
            operating_system=_pick(user, "Windows", "Macintosh", ""),
            language=F.when(user % 2 == 0, F.lit("en-us")),
            web_info=F.struct(_pick(user, "Chrome", "Safari").alias("browser")),
        ),
        "geo": _null_struct(
            RAW_EVENT["geo"].dataType,
            country=_text("country_", user % 7),
            region=F.when(k % 9 != 0, _text("region_", user % 11)),
            city=_text("city_", k % 13),
        ),
        "traffic_source": _null_struct(
            RAW_EVENT["traffic_source"].dataType,
            source=_pick(user, "google", "(direct)", "  "),
            medium=_pick(user, "organic", "(none)"),
            name=F.when(user % 5 == 0, F.lit("(referral)")),
        ),
        "ecommerce": _null_struct(
            RAW_EVENT["ecommerce"].dataType,
            transaction_id=F.when(buys, transaction),
            purchase_revenue_in_usd=F.when(buys & (k % 7 != 0), F.col("value")),
            total_item_quantity=F.when(buys, k % 5 + 1),
        ),
        "event_params": params,
        # A NULL upper bound gives a NULL array, which flattens to no rows like an empty one.
        "items": F.transform(F.sequence(F.lit(0).cast("long"), last_item), _item),
    }
    return rows.select(
        *[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in RAW_EVENT.fields]
    )


def raw_events(events: DataFrame) -> DataFrame:
    """Flat events in, raw nested events out; same number of rows."""
    return _nested(_dated(events))


def export(spark: SparkSession, directory: str, path: str) -> DataFrame:
    """Write the whole `events` table of a folder as a date-partitioned export and read it back.

    The flat rows are brought together by day and sorted by event name, and only then become the raw rows,
    which are some fifteen times as large.
    """
    dated = _dated(spark.read.parquet(f"{directory}/events.parquet"))
    raw = _nested(laid_out(dated, Layout("event_date", "event_name", rebalance=True)))
    write_export(raw, path, Layout("event_date"))
    return read_raw_events(spark, path)
