"""Ordered funnels: the earliest chain of stages inside each session."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import elapsed_seconds

# Event names of the stages, in order.
STAGES = ("view_item", "add_to_cart", "begin_checkout", "purchase")

# Stage labels and statuses, from no stage reached to the last one.
STAGE_LABELS = ("0 - No product view", "1 - Product view", "2 - Add to cart", "3 - Checkout", "4 - Purchase")
STATUSES = (
    "No product view",
    "Dropped after product view",
    "Dropped after cart",
    "Dropped after checkout",
    "Converted",
)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """The body with the value bound once: inside a lambda an expression would be worked out for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _places(n: int) -> dict[tuple[int, int], int]:
    """Where a transfer table has the time of a stage for a walk that enters with so many stages done."""
    pairs = [(entry, stage) for entry in range(n) for stage in range(entry, n)]
    return {pair: i for i, pair in enumerate(pairs)}


def _table_of(times: Sequence[Column]) -> Column:
    """The transfer table of one chunk from the times of each stage, in any order.

    For every entry state: the earliest time of its next stage, then of each later stage the
    earliest not before the one before it; NULL from where the walk gets no farther.
    """

    def walk(stage: int, reached: list[Column]) -> Column:
        if stage == len(times):
            return F.array(*reached)
        later = F.filter(times[stage], lambda at: at >= reached[-1]) if reached else times[stage]
        return _let(F.array_min(later), lambda at: walk(stage + 1, [*reached, at]))

    return F.concat(*[walk(entry, []) for entry in range(len(times))])


def _continued(so_far: Column, table: Column, n: int, entry: int = 0) -> list[Column]:
    """Times by stage of a walk, given by what it reached and the table of what comes after.

    so_far: from the entry stage on, as places of an array that `at` reads.
    """
    place = _places(n)
    first = place[entry, entry]

    def reached(stage: int) -> Column:
        return F.get(so_far, F.lit(first + stage - entry))

    def next_time(stage: int) -> Column:
        # Where the walk stopped: the first stage without a time, at the latest this one.
        found = F.get(table, F.lit(place[stage, stage]))
        for stop in range(stage - 1, entry - 1, -1):
            found = F.when(reached(stop).isNull(), F.get(table, F.lit(place[stop, stage]))).otherwise(found)
        return F.coalesce(reached(stage), found)

    return [next_time(stage) for stage in range(entry, n)]


def _composed(first: Column, second: Column, n: int) -> Column:
    """The transfer table of two chunks, one after the other. Associative; all NULL is neutral."""
    return F.array(*[at for entry in range(n) for at in _continued(first, second, n, entry)])


def _folded(tables: Column, n: int, whole: bool) -> Column:
    """Tables in the order of their chunks, composed; for a `whole` session only the walk from no stage done."""
    size = n if whole else n * (n + 1) // 2
    nothing = F.array(*[F.lit(None).cast("long")] * size)
    step = (lambda a, b: F.array(*_continued(a, b["table"], n))) if whole else (lambda a, b: _composed(a, b["table"], n))
    one = F.get(tables, F.lit(0))["table"]
    one = F.slice(one, 1, n) if whole else one
    return F.when(F.size(tables) == 1, one).otherwise(F.aggregate(F.array_sort(tables), nothing, step))


def transfer_tables(
    events: DataFrame,
    stages: Sequence[str] = STAGES,
    key: str = "session_id",
    time: str = "event_timestamp",
    name: str = "event_name",
    chunk_seconds: float = 1.0,
) -> DataFrame:
    """One row per key and chunk of time: key, chunk, and the chunk's transfer table.

    The table says, for each number of stages already done, when a walk through the chunk reaches
    which stages (microseconds). It is of fixed size and composes with the tables of later chunks, so the
    events themselves are shuffled once, and copies of an event vanish before that.
    """
    at = F.unix_micros(F.col(time))
    chunk = F.floor(at / F.lit(int(chunk_seconds * 1_000_000)))
    times = [F.collect_set(F.when(F.col(name) == stage, F.col("at"))) for stage in stages]
    return (
        events.where(F.col(key).isNotNull() & F.col(name).isin(*stages) & F.col(time).isNotNull())
        .select(F.col(key).alias("key"), chunk.alias("chunk"), at.alias("at"), F.col(name))
        .groupBy("key", "chunk")
        .agg(_table_of(times).alias("table"))
    )


def sequential_funnel(
    events: DataFrame,
    stages: Sequence[str] = STAGES,
    key: str = "session_id",
    time: str = "event_timestamp",
    name: str = "event_name",
    chunk_seconds: float = 1.0,
    chunks_per_span: int = 4096,
) -> DataFrame:
    """Per session: the earliest first stage, then each next stage's earliest event not before it.

    Equal times count as ordered. Sessions that never reach the first stage have no row.
    Output: key, then `sequential_<stage>_at` per stage.

    The chunks' transfer tables meet at their session and are composed in the order of time, first
    within spans of so many chunks, then the spans. No group grows with a session's events: a chunk
    of a second has at most a million moments, a span its number of chunks, and a session the spans that it
    lasts. A busy session's events are spread over the cluster by second.
    """
    n = len(stages)
    if n == 0 or len(set(stages)) < n:
        raise ValueError("stages must be given and differ from each other")
    tables = transfer_tables(events, stages, key, time, name, chunk_seconds)
    # Hashed by session, the tables stay where they are for both groupings.
    entry = F.struct("chunk", "table")
    spans = (
        tables.repartition("key")
        .groupBy("key", F.floor(F.col("chunk") / F.lit(chunks_per_span)).alias("span"))
        .agg(_folded(F.collect_list(entry), n, whole=False).alias("table"))
        .withColumnRenamed("span", "chunk")
    )
    # The fold is part of the aggregation, so no filter or later column works it out again.
    walks = spans.groupBy("key").agg(_folded(F.collect_list(entry), n, whole=True).alias("walk"))
    reached = [F.timestamp_micros(F.get("walk", F.lit(i))).alias(f"sequential_{stage}_at") for i, stage in enumerate(stages)]
    return walks.where(F.get("walk", F.lit(0)).isNotNull()).select(F.col("key").alias(key), *reached)


def session_funnel(sessions: DataFrame, funnel: DataFrame) -> DataFrame:
    """Every session with its ordered funnel: flags, elapsed times, deepest stage, status.

    Both sides arrive hashed by `session_id`, so the join adds no shuffle.
    """
    view, cart, checkout, purchase = (F.col(f"sequential_{s}_at") for s in STAGES)
    order_gap = (
        (F.col("added_to_cart") & cart.isNull())
        | (F.col("began_checkout") & checkout.isNull())
        | (F.col("purchased") & purchase.isNull())
    )
    depth = (
        F.when(purchase.isNotNull(), 4)
        .when(checkout.isNotNull(), 3)
        .when(cart.isNotNull(), 2)
        .when(view.isNotNull(), 1)
        .otherwise(0)
    )

    def by_depth(labels: Sequence[str]) -> Column:
        return F.element_at(F.array(*[F.lit(text) for text in labels]), depth + 1)

    return sessions.join(funnel, "session_id", "left").select(
        *sessions.columns,
        *[f"sequential_{s}_at" for s in STAGES],
        view.isNotNull().alias("sequential_viewed_item"),
        cart.isNotNull().alias("sequential_added_to_cart"),
        checkout.isNotNull().alias("sequential_began_checkout"),
        purchase.isNotNull().alias("sequential_purchased"),
        (F.col("viewed_item") & F.col("added_to_cart") & F.col("began_checkout") & F.col("purchased")).alias(
            "observed_complete_funnel"
        ),
        purchase.isNotNull().alias("completed_sequential_funnel"),
        order_gap.alias("has_funnel_order_gap"),
        (F.col("purchased") & purchase.isNull()).alias("purchased_without_ordered_funnel"),
        F.coalesce((cart == view) | (checkout == cart) | (purchase == checkout), F.lit(False)).alias(
            "has_same_timestamp_transition"
        ),
        # NULL ends give NULL seconds, so no stage test is needed around them.
        elapsed_seconds(view, cart).alias("seconds_view_to_cart"),
        elapsed_seconds(cart, checkout).alias("seconds_cart_to_checkout"),
        elapsed_seconds(checkout, purchase).alias("seconds_checkout_to_purchase"),
        elapsed_seconds(view, purchase).alias("seconds_view_to_purchase"),
        depth.alias("deepest_sequential_stage_number"),
        by_depth(STAGE_LABELS).alias("deepest_sequential_stage"),
        by_depth(STATUSES).alias("funnel_status"),
    )
