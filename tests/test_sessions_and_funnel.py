"""Sessions, their orders, and the ordered funnel, including against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators.funnel import STAGES, _composed, sequential_funnel, session_funnel, transfer_tables
from eventloom.operators.sessions import session_orders, sessions
from tests.conftest import by, event, only


def whole_funnel(events):
    return session_funnel(sessions(events), sequential_funnel(events))


def test_first_known_attribute_skips_blank(events_of):
    row = only(sessions(events_of(event("x", 0, device="\t"), event("x", 5, device="mobile"), event("x", 9, device="tablet"))))
    assert (row.device_category, row.event_count, row.session_duration_seconds) == ("mobile", 3, 9)


def test_equal_times_take_the_smaller_value(events_of):
    assert only(sessions(events_of(event("x", device="b"), event("x", device="a")))).device_category == "a"


def test_counts_flags_and_dates(events_of):
    row = only(
        sessions(
            events_of(
                event("first_visit", 0, date="20240303"),
                event("view_item", 1),
                event("view_item", 2),
                event("page_view", 3),
                event("purchase", 4, transaction="T", revenue=5.0),
                event("purchase", 5, transaction="T", revenue=7.0),
                event("purchase", 6, transaction=" ", revenue=50.0),
            )
        )
    )
    assert row.session_date.day == 3 and row.is_new_user_session
    assert (row.view_item_count, row.page_view_count, row.purchase_event_count) == (2, 1, 3)
    assert (row.viewed_item, row.added_to_cart, row.purchased) == (True, False, True)
    assert (row.transactions, row.revenue_usd) == (1, 7.0)


def test_transaction_in_two_sessions_counts_in_both(events_of):
    events = events_of(
        event("purchase", 0, session=1, transaction="T", revenue=10.0),
        event("purchase", 9, session=2, transaction="T", revenue=12.0),
    )
    assert {k: r.revenue_usd for k, r in by(session_orders(events), "session_id").items()} == {"a-1": 10.0, "a-2": 12.0}


def test_events_without_session_are_left_out(events_of):
    assert sessions(events_of(event("x", session=None), event("x", user=None))).collect() == []


def test_cart_before_view(events_of):
    row = only(whole_funnel(events_of(event("add_to_cart", 0), event("view_item", 5))))
    assert (row.deepest_sequential_stage_number, row.has_funnel_order_gap) == (1, True)
    assert row.funnel_status == "Dropped after product view"


def test_all_stages_at_one_moment(events_of):
    row = only(whole_funnel(events_of(*[event(s) for s in reversed(STAGES)])))
    assert (row.deepest_sequential_stage_number, row.has_same_timestamp_transition) == (4, True)
    assert (row.seconds_view_to_cart, row.seconds_view_to_purchase) == (0, 0)
    assert (row.funnel_status, row.deepest_sequential_stage) == ("Converted", "4 - Purchase")


def test_purchase_without_view(events_of):
    row = only(whole_funnel(events_of(event("purchase"))))
    assert (row.deepest_sequential_stage_number, row.purchased_without_ordered_funnel) == (0, True)
    assert (row.sequential_viewed_item, row.has_same_timestamp_transition) == (False, False)
    assert (row.funnel_status, row.seconds_view_to_cart) == ("No product view", None)


def test_seconds_are_whole_elapsed_seconds(events_of):
    row = only(whole_funnel(events_of(event("view_item", 0.9), event("add_to_cart", 2.1))))
    assert row.seconds_view_to_cart == 1


def test_later_stage_uses_first_event_after_the_chosen_one(events_of):
    # The early cart is before the view, the early checkout before the chosen cart.
    row = only(
        whole_funnel(
            events_of(
                event("add_to_cart", 0),
                event("view_item", 10),
                event("begin_checkout", 20),
                event("add_to_cart", 700),
                event("begin_checkout", 1500),
                event("begin_checkout", 1400),
                event("purchase", 1450),
            )
        )
    )
    assert row.seconds_view_to_cart == 690 and row.seconds_cart_to_checkout == 700
    assert (row.seconds_checkout_to_purchase, row.completed_sequential_funnel) == (50, True)


def greedy(rows, stages):
    """The definition: each stage's earliest time not before the stage before it."""
    reached, floor = [], None
    for stage in stages:
        times = [t for s, t in rows if s == stage and (floor is None or t >= floor)]
        if not times or (reached and reached[-1] is None):
            reached.append(None)
            continue
        floor = min(times)
        reached.append(floor)
    return reached


@pytest.mark.parametrize("chunk_seconds", [1, 7, 600, 10**6])
@pytest.mark.parametrize("n_stages", [1, 2, 4, 5])
def test_funnel_equals_brute_force(spark, chunk_seconds, n_stages):
    rng = random.Random(chunk_seconds * 10 + n_stages)
    stages = [f"s{i}" for i in range(n_stages)]
    names = stages + ["other"]
    rows = []
    for session in range(60):
        span = rng.choice([2, 20, 200])
        rows += [
            (f"k{session}", rng.choice(names), rng.randrange(span)) for _ in range(rng.choice([1, 3, 12, 40]))
        ]
    rows.append((None, "s0", 0))
    df = spark.createDataFrame(rows, "k string, event_name string, second long").select(
        "k", "event_name", F.timestamp_seconds("second").alias("at")
    )
    found = {
        r[0]: [None if v is None else v for v in r[1:]]
        for r in sequential_funnel(df, stages, key="k", time="at", chunk_seconds=chunk_seconds)
        .select("k", *[F.unix_seconds(f"sequential_{s}_at") for s in stages])
        .collect()
    }
    expected = {}
    for key in {k for k, _, _ in rows if k is not None}:
        walk = greedy([(s, t) for k, s, t in rows if k == key], stages)
        if walk[0] is not None:
            expected[key] = walk
    assert found == expected


def test_hot_session_is_spread_over_chunks(spark):
    """A third of all rows in one session, at distinct microseconds of one minute: a chunk is a second of them."""
    names = F.element_at(F.array(*[F.lit(s) for s in STAGES]), (F.col("id") % 4 + 1).cast("int"))
    hot = spark.range(30_000).select(
        F.lit("hot").alias("session_id"), names.alias("event_name"), F.timestamp_micros(F.col("id") * 2000 + F.col("id") % 7).alias("event_timestamp")
    )
    rest = spark.range(60_000).select(
        F.concat(F.lit("s"), (F.col("id") % 20_000).cast("string")).alias("session_id"),
        names.alias("event_name"),
        F.timestamp_seconds("id").alias("event_timestamp"),
    )
    events = hot.unionByName(rest).unionByName(hot)
    tables = transfer_tables(events).where("key = 'hot'").collect()
    assert len(tables) == 60 and {len(t.table) for t in tables} == {10}
    row = only(sequential_funnel(events).where("session_id = 'hot'").select(*[F.unix_micros(f"sequential_{s}_at") for s in STAGES]))
    assert list(row) == [k * 2000 + k for k in range(4)]


def test_transfer_tables_compose_in_any_grouping(spark):
    rng = random.Random(8)
    rows = [("k", rng.choice("abc"), rng.randrange(40)) for _ in range(40)]
    df = spark.createDataFrame(rows, "k string, event_name string, second long").select("k", "event_name", F.timestamp_seconds("second").alias("at"))
    whole = only(transfer_tables(df, "abc", "k", "at", chunk_seconds=1000)).table
    parts = [r.table for r in transfer_tables(df, "abc", "k", "at", chunk_seconds=10).orderBy("chunk").collect()]
    assert len(parts) == 4
    table = lambda values: F.array(*[F.lit(v).cast("long") for v in values])
    left, right, nothing = table(parts[0]), table(parts[3]), table([None] * 6)
    for part in parts[1:]:
        left = _composed(left, table(part), 3)
    for part in parts[2::-1]:
        right = _composed(table(part), right, 3)
    for found in (left, right, _composed(nothing, left, 3), _composed(left, nothing, 3)):
        assert spark.range(1).select(found).first()[0] == whole


@pytest.mark.parametrize("chunks_per_span", [1, 3])
def test_spans_do_not_change_the_funnel(spark, chunks_per_span):
    rng = random.Random(9)
    rows = [(f"k{rng.randrange(5)}", rng.choice("abcd"), rng.randrange(-100, 100)) for _ in range(300)]
    df = spark.createDataFrame(rows, "k string, event_name string, second long").select("k", "event_name", F.timestamp_seconds("second").alias("at"))
    found = sequential_funnel(df, "abcd", "k", "at", chunks_per_span=chunks_per_span)
    found = {r[0]: list(r[1:]) for r in found.select("k", *[F.unix_seconds(f"sequential_{s}_at") for s in "abcd"]).collect()}
    assert found == {k: greedy([(s, t) for key, s, t in rows if key == k], "abcd") for k in {r[0] for r in rows}}


def test_stages_must_differ(events_of):
    for stages in ([], ["view_item", "view_item"]):
        with pytest.raises(ValueError):
            sequential_funnel(events_of(event("view_item")), stages)


def test_funnel_over_other_columns(spark):
    df = spark.createDataFrame([("x", "go", 1), ("x", "stop", 2)], "who string, what string, second long").select(
        "who", "what", F.timestamp_seconds("second").alias("at")
    )
    row = only(sequential_funnel(df, ["go", "stop"], key="who", time="at", name="what"))
    assert (row.who, row.sequential_go_at.second, row.sequential_stop_at.second) == ("x", 1, 2)
