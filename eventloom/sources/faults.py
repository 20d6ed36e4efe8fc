"""A fault plan for the datasets: damage with known counts, so that every check is seen to fail.

Most columns that the checks look at are filled, unique and in range by construction, whatever the raw
rows hold, so faults are put into the datasets themselves, as a broken write or a changed operator would. A fault
falls on the rows whose hash of fault name and key starts with a low digit pair. It depends on nothing
else, needs no state, is the same after a retry, and can be repeated in any SQL engine, which gives
the expected counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.checks import GENERIC_CHECKS

#: What makes the key of a row, in text.
KEYS = {
    "stg_events": lambda: F.concat_ws("|", F.unix_micros("event_timestamp").cast("string"), "event_name"),
    "stg_items": lambda: F.col("event_item_id"),
    "sessions": lambda: F.col("session_id"),
    "session_funnel": lambda: F.col("session_id"),
    "orders": lambda: F.col("transaction_id"),
    "order_items": lambda: F.col("order_item_id"),
    "users": lambda: F.col("user_pseudo_id"),
    "executive_daily": lambda: F.col("executive_daily_id"),
    "funnel_daily": lambda: F.col("funnel_daily_id"),
    "funnel_segment": lambda: F.col("funnel_segment_id"),
    "product_performance": lambda: F.col("product_daily_id"),
    "product_opportunity": lambda: F.col("product_opportunity_id"),
    "customer_summary": lambda: F.col("anonymous_user_key"),
    "cohort_retention": lambda: F.col("customer_cohort_id"),
}
#: A number of each dataset that gets out of range, and by how much.
NUMBERS = {
    "order_items": ("line_revenue_usd", -1_000_000),
    "orders": ("order_revenue_usd", -1_000_000),
    "session_funnel": ("seconds_view_to_purchase", -1_000_000_000),
    "sessions": ("session_duration_seconds", -1_000_000_000),
    "users": ("lifetime_revenue_usd", -1_000_000_000),
    "cohort_retention": ("retention_rate", -2),
    "funnel_daily": ("stage_sessions", 1_000_000),
    "product_opportunity": ("product_revenue_usd", -1_000_000_000),
    "product_performance": ("product_revenue_usd", -1_000_000_000),
}
ODD_NUMBER = 99


def hit(fault: str, key: Column, below: str = "60") -> Column:
    """Whether the fault falls on the row: a bit more than a third of the rows, by hash."""
    return F.substring(F.md5(F.concat(F.lit(f"{fault}:"), key)), 1, 2) < below


def copied(df: DataFrame, key: Column) -> DataFrame:
    """Some rows twice."""
    times = F.when(hit("copy", key), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.select("*", F.explode(times).alias("fault_copy")).drop("fault_copy")


def broken_columns(df: DataFrame, dataset: str) -> DataFrame:
    """Copies, values outside the lists, references to nowhere, and values that are missing."""
    wanted, key = GENERIC_CHECKS[dataset], F.col("fault_key")
    rows = copied(df.select("*", KEYS[dataset]().alias("fault_key")), key)
    made: dict[str, Column] = {}
    for c in wanted.get("accepted", {}):
        odd = F.concat(F.lit("odd "), F.substring(F.md5(key), 1, 1)) if dict(df.dtypes)[c] == "string" else F.lit(ODD_NUMBER)
        made[c] = F.when(hit(f"value:{c}", key), odd).otherwise(F.col(c))
    for c in wanted.get("relationships", {}):
        made[c] = F.when(hit(f"orphan:{c}", key), F.concat(F.lit("missing "), key)).otherwise(F.col(c))
    for c in wanted["not_null"]:
        made[c] = F.when(~F.coalesce(hit(f"null:{c}", key), F.lit(False)), made.get(c, F.col(c)))
    return rows.select(*[made.get(c, F.col(c)).cast(df.schema[c].dataType).alias(c) for c in df.columns])


def broken_numbers(df: DataFrame, dataset: str) -> DataFrame:
    """Numbers out of range, and copies, which no total survives; counts by stage have none, as they are compared in order."""
    key = F.col("fault_key")
    rows = df.select("*", KEYS[dataset]().alias("fault_key"))
    if dataset != "funnel_daily":
        rows = copied(rows, key)
    if dataset in NUMBERS:
        column, by = NUMBERS[dataset]
        moved = F.coalesce(F.col(column), F.lit(0)) + by
        rows = rows.withColumn(column, F.when(hit(f"number:{column}", key), moved).otherwise(F.col(column)).cast(df.schema[column].dataType))
    return rows.select(*df.columns)


class Broken(Mapping[str, DataFrame]):
    """Datasets with faults. They were not written, so nothing was counted on the way."""

    def __init__(self, tables: Mapping[str, DataFrame], damage=broken_columns):
        self._tables, self._damage = tables, damage

    def __getitem__(self, name: str) -> DataFrame:
        return self._damage(self._tables[name], name)

    def __iter__(self) -> Iterator[str]:
        return iter(KEYS)

    def __len__(self) -> int:
        return len(KEYS)
