"""Schema of the raw nested event export."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()

ITEM = _struct(
    item_id=_S,
    item_name=_S,
    item_brand=_S,
    item_variant=_S,
    item_category=_S,
    item_category2=_S,
    item_category3=_S,
    item_category4=_S,
    item_category5=_S,
    price_in_usd=_D,
    price=_D,
    quantity=_L,
    item_revenue_in_usd=_D,
    item_revenue=_D,
    coupon=_S,
    affiliation=_S,
    location_id=_S,
    item_list_id=_S,
    item_list_name=_S,
    item_list_index=_S,
    promotion_id=_S,
    promotion_name=_S,
    creative_name=_S,
    creative_slot=_S,
)

PARAM = _struct(key=_S, value=_struct(string_value=_S, int_value=_L))

RAW_EVENT = _struct(
    event_date=_S,
    event_timestamp=_L,
    event_previous_timestamp=_L,
    event_bundle_sequence_id=_L,
    event_server_timestamp_offset=_L,
    event_name=_S,
    user_pseudo_id=_S,
    user_id=_S,
    platform=_S,
    device=_struct(category=_S, operating_system=_S, language=_S, web_info=_struct(browser=_S)),
    geo=_struct(country=_S, region=_S, city=_S),
    traffic_source=_struct(source=_S, medium=_S, name=_S),
    ecommerce=_struct(transaction_id=_S, purchase_revenue_in_usd=_D, total_item_quantity=_L),
    event_params=T.ArrayType(PARAM),
    items=T.ArrayType(ITEM),
)
