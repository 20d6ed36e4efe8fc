"""Flattening: parameters, session ids, blanks, item rows, the raw source."""

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from eventloom.functions.columns import clean_text, elapsed_seconds, product_key, session_key
from eventloom.operators.staging import flatten_events, flatten_items
from eventloom.sources import demo_export
from eventloom.sources.raw import Layout, read_raw_events, write_export
from eventloom.sources.schema import RAW_EVENT
from tests.conftest import event, micros, only


def test_parameters_are_looked_up_by_key(events_of):
    params = [
        {"key": "page_title", "value": {"string_value": "Home", "int_value": None}},
        {"key": "engagement_time_msec", "value": {"string_value": None, "int_value": None}},
        {"key": "engagement_time_msec", "value": {"string_value": None, "int_value": 40}},
    ]
    rows = events_of(event("page_view", params=params), {**event("page_view"), "event_params": None}).collect()
    row = rows[0]
    assert rows[1].ga_session_id is None
    assert (row.page_title, row.engagement_time_msec, row.page_location) == ("Home", 40, None)
    assert (row.ga_session_id, row.session_id) == (1, "a-1")


def test_session_id_needs_user_and_number(events_of):
    rows = events_of(event("x", user=None), event("x", session=None), event("x")).collect()
    assert [r.session_id for r in rows] == [None, None, "a-1"]


@pytest.mark.parametrize(
    ("text", "expected"),
    [("  ", None), ("\t\n", None), ("", None), (None, None), ("\t a b  ", "a b"), ("　x ", "x")],
)
def test_clean_text_trims_all_white_space(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert only(df.select(clean_text("t").alias("t"))).t == expected


def test_event_date_is_its_own_field(events_of):
    row = only(events_of(event("x", date="20240303")))
    assert row.event_date == dt.date(2024, 3, 3)
    assert row.event_timestamp == dt.datetime(2024, 3, 4)


def test_date_range_is_inclusive(raw_of):
    raw = raw_of(*[event("x", date=f"2024030{n}") for n in range(1, 6)])
    kept = flatten_events(raw, "20240302", "20240304").select("event_date").collect()
    assert sorted(r.event_date.day for r in kept) == [2, 3, 4]


def test_items_are_numbered_and_valued(items_of):
    rows = items_of(
        event("view_item", items=[{"item_id": "p", "price_in_usd": 2.5, "quantity": 2}, {"item_revenue_in_usd": 9.0}, {}]),
        event("view_item"),
        {**event("view_item"), "items": None},
    ).collect()
    assert [(r.item_position, r.quantity, r.item_value_usd) for r in rows] == [(1, 2, 5.0), (2, 1, 9.0), (3, 1, None)]


def test_event_key_hashes_the_untrimmed_transaction(items_of):
    row = only(items_of(event("purchase", transaction=" T ", items=[{}], event_bundle_sequence_id=7)))
    text = f"a|{micros(0)}|purchase|7|-1|-1| T "
    assert row.event_key == hashlib.md5(text.encode()).hexdigest()
    assert row.transaction_id == "T"
    assert row.event_item_id == hashlib.md5(f"{row.event_key}|1".encode()).hexdigest()


def test_event_key_defaults(items_of):
    row = only(items_of(event(None, user=None, items=[{}])))
    text = f"<null-user>|{micros(0)}|<null-event>|-1|-1|-1|<no-transaction>"
    assert row.event_key == hashlib.md5(text.encode()).hexdigest()


def test_product_key_forms(spark):
    df = spark.createDataFrame(
        [("7", "n", "v"), (None, "n", "v"), (None, None, None)], "item_id string, item_name string, item_variant string"
    )
    keys = [r[0] for r in df.select(product_key()).collect()]
    assert keys == ["id:7", "name:n|variant:v", "name:unknown|variant:unknown"]


def test_elapsed_seconds_is_not_a_clock_difference(spark):
    df = spark.sql("select timestamp'2024-01-01 00:00:00.9' a, timestamp'2024-01-01 00:00:02.1' b")
    assert only(df.select(elapsed_seconds("a", "b").alias("s"))).s == 1


def test_demo_export_has_the_raw_schema_and_all_rows(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    raw = demo_export.raw_events(events)
    assert raw.schema.simpleString() == RAW_EVENT.simpleString()
    assert raw.count() == events.count()


def test_session_id_reads_no_text_parameters(spark, raw_of, tmp_path):
    path = str(tmp_path / "raw")
    write_export(raw_of(event("a")), path, Layout("event_date"))
    plan = flatten_events(read_raw_events(spark, path)).select("session_id")._jdf.queryExecution().executedPlan().toString()
    assert "event_params:array<struct<key:string,value:struct<int_value:bigint>>>" in plan


def test_date_range_prunes_partitions(spark, raw_of, tmp_path):
    path = str(tmp_path / "raw")
    write_export(raw_of(event("a", date="20240301"), event("b", date="20240302")), path, Layout("event_date"))
    df = flatten_events(read_raw_events(spark, path), "20240302", "20240331")
    assert [r.event_name for r in df.collect()] == ["b"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    few = df.where(F.col("event_name") == "purchase").select("event_timestamp")
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_name,purchase)" in plan
    assert "ReadSchema: struct<event_timestamp:bigint,event_name:string>" in plan


def test_session_key(spark):
    assert only(spark.range(1).select(session_key(F.lit("u"), F.lit(3)).alias("k"))).k == "u-3"
