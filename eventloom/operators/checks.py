"""Data checks. Each generic or named check is a DataFrame of failing rows; none means pass.

Checks that look at one row at a time (not null, accepted values, signs and orders within a row) are
counted by the write of a table, as `measures` says; reports over such a table scan nothing for them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]

# --- generic checks --------------------------------------------------------------------


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def duplicate_values(df: DataFrame, column: str) -> DataFrame:
    """Values held by more than one row, with their counts."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("row_count"))
        .where(F.col("row_count") > 1)
    )


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Distinct non-null values outside the accepted list."""
    return df.where(~F.col(column).isin(*accepted)).select(column).distinct()


def orphan_values(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Non-null child values without a parent row, with the number of child rows.

    Children are counted per value first, so a crowded value is one row in the join.
    """
    values = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("row_count"))
    )
    return values.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


# Which columns of each dataset must be filled, unique, from a list, or known elsewhere.
PLATFORMS = ["WEB", "IOS", "ANDROID"]
CUSTOMER_STATUSES = ["Non-purchaser", "One-time purchaser", "Repeat purchaser"]
GENERIC_CHECKS: dict[str, dict] = {
    "stg_events": {
        "not_null": ["event_date", "event_timestamp", "event_name"],
        "accepted": {"platform": PLATFORMS},
    },
    "stg_items": {
        "not_null": [
            "event_item_id",
            "event_key",
            "event_date",
            "event_timestamp",
            "event_name",
            "item_position",
            "quantity",
        ],
        "unique": ["event_item_id"],
    },
    "sessions": {
        "not_null": [
            "session_id",
            "user_pseudo_id",
            "session_date",
            "session_start_at",
            "session_end_at",
            "session_duration_seconds",
            "event_count",
            "purchased",
            "transactions",
            "revenue_usd",
        ],
        "unique": ["session_id"],
    },
    "session_funnel": {
        "not_null": [
            "session_id",
            "sequential_viewed_item",
            "sequential_added_to_cart",
            "sequential_began_checkout",
            "sequential_purchased",
            "completed_sequential_funnel",
            "has_funnel_order_gap",
            "has_same_timestamp_transition",
            "deepest_sequential_stage_number",
            "deepest_sequential_stage",
            "funnel_status",
        ],
        "unique": ["session_id"],
        "accepted": {
            "deepest_sequential_stage_number": [0, 1, 2, 3, 4],
            "deepest_sequential_stage": [
                "0 - No product view",
                "1 - Product view",
                "2 - Add to cart",
                "3 - Checkout",
                "4 - Purchase",
            ],
            "funnel_status": [
                "Converted",
                "Dropped after checkout",
                "Dropped after cart",
                "Dropped after product view",
                "No product view",
            ],
        },
        "relationships": {"session_id": ("sessions", "session_id")},
    },
    "orders": {
        "not_null": [
            "transaction_id",
            "order_date",
            "purchased_at",
            "order_revenue_usd",
            "order_item_quantity",
            "source_purchase_event_count",
            "has_duplicate_purchase_event",
            "spans_multiple_sessions",
            "has_missing_order_revenue",
        ],
        "unique": ["transaction_id"],
        "relationships": {"session_id": ("sessions", "session_id")},
    },
    "order_items": {
        "not_null": [
            "order_item_id",
            "transaction_id",
            "product_key",
            "item_position",
            "quantity",
            "line_revenue_usd",
            "used_calculated_line_value",
            "has_missing_line_value",
        ],
        "unique": ["order_item_id"],
        "relationships": {"transaction_id": ("orders", "transaction_id")},
    },
    "users": {
        "not_null": [
            "anonymous_user_key",
            "user_pseudo_id",
            "first_seen_date",
            "last_seen_date",
            "session_count",
            "order_count",
            "lifetime_revenue_usd",
            "has_purchased",
            "is_repeat_purchaser",
            "customer_status",
        ],
        "unique": ["anonymous_user_key", "user_pseudo_id"],
        "accepted": {"customer_status": CUSTOMER_STATUSES},
    },
    "executive_daily": {
        "not_null": [
            "executive_daily_id",
            "metric_date",
            "total_sessions",
            "daily_active_users",
            "order_count",
            "revenue_usd",
        ],
        "unique": ["executive_daily_id", "metric_date"],
    },
    "funnel_daily": {
        "not_null": [
            "funnel_daily_id",
            "metric_date",
            "funnel_type",
            "stage_number",
            "stage_sessions",
            "has_stage_increase",
        ],
        "unique": ["funnel_daily_id"],
        "accepted": {"funnel_type": ["Observed", "Sequential"], "stage_number": [1, 2, 3, 4]},
    },
    "funnel_segment": {
        "not_null": [
            "funnel_segment_id",
            "metric_date",
            "device_category",
            "user_type",
            "country",
            "first_user_source",
            "first_user_medium",
            "total_sessions",
            "order_count",
            "revenue_usd",
        ],
        "unique": ["funnel_segment_id"],
        "accepted": {"user_type": ["New user session", "Returning or other session", "Unknown"]},
    },
    "product_performance": {
        "not_null": [
            "product_daily_id",
            "metric_date",
            "product_key",
            "view_item_sessions",
            "add_to_cart_sessions",
            "order_count",
            "units_purchased",
            "product_revenue_usd",
            "same_day_order_rate_over_one",
        ],
        "unique": ["product_daily_id"],
    },
    "customer_summary": {
        "not_null": [
            "anonymous_user_key",
            "first_seen_date",
            "session_count",
            "order_count",
            "lifetime_revenue_usd",
            "customer_status",
        ],
        "unique": ["anonymous_user_key"],
        "accepted": {"customer_status": CUSTOMER_STATUSES},
    },
    "cohort_retention": {
        "not_null": [
            "customer_cohort_id",
            "cohort_week",
            "activity_week",
            "cohort_age_weeks",
            "cohort_size",
            "active_users",
            "retention_rate",
        ],
        "unique": ["customer_cohort_id"],
    },
    "product_opportunity": {
        "not_null": [
            "product_opportunity_id",
            "product_key",
            "view_item_sessions",
            "order_count",
            "product_revenue_usd",
            "opportunity_status",
        ],
        "unique": ["product_opportunity_id", "product_key"],
        "accepted": {
            "opportunity_status": [
                "No observed product views",
                "Tracking review needed",
                "Experiment candidate",
                "At or above category benchmark",
            ]
        },
    },
}


def _count(name: str, failing: DataFrame, weight: Column | None = None) -> DataFrame:
    failures = F.count("*") if weight is None else F.coalesce(F.sum(weight), F.lit(0))
    return failing.agg(F.lit(name).alias("check_name"), failures.alias("failing_rows"))


def measures(dataset: str) -> dict[str, Column]:
    """Aggregates by name: the rows of a dataset that fail each check of single rows."""
    wanted = GENERIC_CHECKS.get(dataset, {})
    found = {f"not_null:{c}": F.col(c).isNull() for c in wanted.get("not_null", [])}
    for c, values in wanted.get("accepted", {}).items():
        found[f"accepted:{c}"] = ~F.col(c).isin(*values)
    for name, (of, failing) in ROW_CHECKS.items():
        if of == dataset:
            found[f"named:{name}"] = failing()
    return {name: F.count_if(failing) for name, failing in found.items()}


def measured(tables: Tables, dataset: str) -> dict[str, int]:
    """What was counted when the dataset was written; nothing for tables that were not written so."""
    look = getattr(tables, "measured", None)
    return (look(dataset) or {}) if look else {}


def _counted(df: DataFrame, rows: list[tuple[str, int]]) -> DataFrame:
    return df.sparkSession.createDataFrame(rows, "check_name string, failing_rows long")


def generic_report(tables: Tables, dataset: str) -> DataFrame:
    """Every generic check of one dataset with its number of failures.

    Of a written table, not-null checks and values that are all accepted were counted by the write.
    Otherwise all not-null checks share one scan; the others read one column each.
    """
    df, wanted = tables[dataset], GENERIC_CHECKS[dataset]
    known = measured(tables, dataset)
    counted, parts = [], []
    if all(f"not_null:{c}" in known for c in wanted["not_null"]):
        counted += [(f"{dataset}.{c}.not_null", known[f"not_null:{c}"]) for c in wanted["not_null"]]
    else:
        parts.append(_nulls(df, dataset, wanted["not_null"]))
    for c in wanted.get("unique", []):
        parts.append(_count(f"{dataset}.{c}.unique", duplicate_values(df, c)))
    for c, values in wanted.get("accepted", {}).items():
        if known.get(f"accepted:{c}") == 0:
            counted.append((f"{dataset}.{c}.accepted_values", 0))
        else:
            # Rows were counted, but different values are asked for.
            parts.append(_count(f"{dataset}.{c}.accepted_values", unaccepted_values(df, c, values)))
    for c, (parent, parent_column) in wanted.get("relationships", {}).items():
        orphans = orphan_values(df, c, tables[parent], parent_column)
        parts.append(_count(f"{dataset}.{c}.relationships", orphans, F.col("row_count")))
    if counted:
        parts.insert(0, _counted(df, counted))
    return reduce(DataFrame.unionByName, parts)


def _nulls(df: DataFrame, dataset: str, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    names = [F.struct(F.lit(f"{dataset}.{c}.not_null").alias("check_name"), F.col(c).alias("failing_rows")) for c in columns]
    return counts.select(F.inline(F.array(*names)))


# --- named checks ----------------------------------------------------------------------


def _any(*conditions: Column) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _negative(*columns: str) -> Column:
    return _any(*[F.col(c) < 0 for c in columns])


# Checks of single rows: the dataset, and when one of its rows fails.


def _funnel_disordered() -> Column:
    stages = [f"sequential_{s}_at" for s in ("view_item", "add_to_cart", "begin_checkout", "purchase")]
    broken = [
        F.col(later).isNotNull() & (F.col(earlier).isNull() | (F.col(later) < F.col(earlier)))
        for earlier, later in zip(stages, stages[1:])
    ]
    spans = ["view_to_cart", "cart_to_checkout", "checkout_to_purchase", "view_to_purchase"]
    return _any(*broken, _negative(*[f"seconds_{s}" for s in spans]))


def _user_invalid() -> Column:
    return _any(
        F.col("last_seen_date") < F.col("first_seen_date"),
        F.col("session_count") <= 0,
        F.col("observed_user_span_days") <= 0,
        _negative("order_count", "lifetime_revenue_usd", "units_purchased", "recency_days_at_dataset_end"),
    )


def _cohort_invalid() -> Column:
    first_week = F.col("cohort_age_weeks") == 0
    return _any(
        _negative("cohort_age_weeks", "active_users", "retention_rate"),
        F.col("cohort_size") <= 0,
        F.col("active_users") > F.col("cohort_size"),
        F.col("retention_rate") > 1,
        first_week & (F.col("active_users") != F.col("cohort_size")),
        first_week & (F.abs(F.col("retention_rate") - 1.0) > 0.000001),
    )


ROW_CHECKS: dict[str, tuple[str, Callable[[], Column]]] = {
    "order_items_nonnegative": ("order_items", lambda: _negative("quantity", "item_price_usd", "line_revenue_usd")),
    "orders_nonnegative": ("orders", lambda: _negative("order_revenue_usd", "order_item_quantity")),
    "session_funnel_timestamp_order": ("session_funnel", _funnel_disordered),
    "sessions_valid_time": (
        "sessions",
        lambda: (F.col("session_end_at") < F.col("session_start_at")) | _negative("session_duration_seconds"),
    ),
    "users_valid_values": ("users", _user_invalid),
    "cohorts_valid": ("cohort_retention", _cohort_invalid),
    "product_opportunity_nonnegative": (
        "product_opportunity",
        lambda: _negative(
            "view_item_sessions",
            "add_to_cart_sessions",
            "order_count",
            "units_purchased",
            "product_revenue_usd",
            "conversion_gap_to_category",
            "modeled_additional_orders_full_gap",
            "modeled_revenue_opportunity_full_gap_usd",
        ),
    ),
    "product_performance_nonnegative": (
        "product_performance",
        lambda: _negative(
            "view_item_events",
            "view_item_sessions",
            "add_to_cart_events",
            "add_to_cart_sessions",
            "order_count",
            "units_purchased",
            "product_revenue_usd",
        ),
    ),
}


def _rows_failing(name: str) -> Callable[[Tables], DataFrame]:
    dataset, failing = ROW_CHECKS[name]
    return lambda t: t[dataset].where(failing())


def _unequal_totals(left: DataFrame, right: DataFrame, exact: list[Column], money: list[Column]) -> DataFrame:
    """The two rows of totals when any count differs, or any amount by more than a cent.

    Both sides are whole-table aggregates, one row each, compared as scalars.
    """

    def totals(df: DataFrame) -> Column:
        counts = [c.alias(f"count_{i}") for i, c in enumerate(exact)]
        sums = [F.coalesce(c, F.lit(0.0)).alias(f"amount_{i}") for i, c in enumerate(money)]
        return df.agg(F.struct(*counts, *sums)).scalar()

    sides = left.sparkSession.range(1).select(totals(left).alias("mart"), totals(right).alias("source"))
    different = [~F.col(f"mart.count_{i}").eqNullSafe(F.col(f"source.count_{i}")) for i in range(len(exact))]
    different += [
        F.abs(F.col(f"mart.amount_{i}") - F.col(f"source.amount_{i}")) > 0.01 for i in range(len(money))
    ]
    return sides.where(_any(*different))


def session_funnel_row_count(t: Tables) -> DataFrame:
    """The funnel's rows against the sessions that the events name, counted apart from both tables."""
    named = t["stg_events"].where(F.col("session_id").isNotNull()).select("session_id").distinct()
    return _unequal_totals(t["session_funnel"], named, [F.count("*")], [])


def customer_summary_reconciles(t: Tables) -> DataFrame:
    return _unequal_totals(
        t["customer_summary"],
        t["users"],
        [F.count("*"), F.sum("order_count")],
        [F.sum("lifetime_revenue_usd")],
    )


def _sessions_and_orders(t: Tables, mart: str) -> DataFrame:
    """Sessions, orders and revenue of a mart against the session and order tables."""
    df = t[mart]
    counted = df.select("total_sessions", "order_count", "revenue_usd")
    zero = F.lit(0).cast("long")
    source = (
        t["session_funnel"]
        .agg(F.count("*").alias("total_sessions"), zero.alias("order_count"), F.lit(0.0).alias("revenue_usd"))
        .unionByName(
            t["orders"].agg(
                zero.alias("total_sessions"),
                F.count("*").alias("order_count"),
                F.sum("order_revenue_usd").alias("revenue_usd"),
            )
        )
    )
    return _unequal_totals(
        counted,
        source,
        [F.coalesce(F.sum("total_sessions"), zero), F.coalesce(F.sum("order_count"), zero)],
        [F.sum("revenue_usd")],
    )


def executive_daily_reconciles(t: Tables) -> DataFrame:
    return _sessions_and_orders(t, "executive_daily")


def funnel_segment_reconciles(t: Tables) -> DataFrame:
    return _sessions_and_orders(t, "funnel_segment")


def funnel_daily_sequential_monotonic(t: Tables) -> DataFrame:
    # At most four rows per date share a window.
    previous = F.lag("stage_sessions").over(W.partitionBy("metric_date").orderBy("stage_number"))
    return (
        t["funnel_daily"]
        .where(F.col("funnel_type") == "Sequential")
        .select("metric_date", "stage_number", previous.alias("previous_sessions"), "stage_sessions")
        .where(F.col("stage_sessions") > F.col("previous_sessions"))
    )


def product_opportunity_reconciles(t: Tables) -> DataFrame:
    counts = ["view_item_sessions", "add_to_cart_sessions", "order_count", "units_purchased"]
    return _unequal_totals(
        t["product_opportunity"],
        t["product_performance"],
        [F.sum(c) for c in counts],
        [F.sum("product_revenue_usd")],
    )


NAMED_CHECKS: dict[str, Callable[[Tables], DataFrame]] = {
    **{name: _rows_failing(name) for name in ROW_CHECKS},
    **{
        check.__name__: check
        for check in (
            session_funnel_row_count,
            customer_summary_reconciles,
            executive_daily_reconciles,
            funnel_daily_sequential_monotonic,
            funnel_segment_reconciles,
            product_opportunity_reconciles,
        )
    },
}


def named_report(tables: Tables, check: str) -> DataFrame:
    """One row: the named check and its number of failing rows."""
    if check in ROW_CHECKS:
        dataset = ROW_CHECKS[check][0]
        if (known := measured(tables, dataset).get(f"named:{check}")) is not None:
            return _counted(tables[dataset], [(check, known)])
    return _count(check, NAMED_CHECKS[check](tables))
