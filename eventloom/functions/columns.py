"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "Unknown"

# The characters with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\u000b\f\r \u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(text: Column | str) -> Column:
    """Trim all white space (Spark's plain `trim` removes spaces only); blank becomes NULL."""
    return F.nullif(F.btrim(col(text), F.lit(WHITE_SPACE)), F.lit(""))


def known(text: Column | str, *fallbacks: Column | str) -> Column:
    """First non-blank of the given texts, else 'Unknown'."""
    return F.coalesce(*[clean_text(t) for t in (text, *fallbacks)], F.lit(UNKNOWN))


def event_param(key: str, slot: str, params: str = "event_params") -> Column:
    """The first non-null value of one repeated key/value parameter; NULL when there is none.

    Only the keys and one value slot are touched, so the scan reads no other slot. The value
    is taken by position; arrays are searched row by row only where the key is present with
    a NULL value, in case it repeats.
    """
    keys, values = F.col(f"{params}.key"), F.col(f"{params}.value.{slot}")
    position = F.array_position(keys, F.lit(key))
    matching = F.zip_with(keys, values, lambda k, v: F.when(k == key, v))
    repeated = F.get(F.filter(matching, lambda v: v.isNotNull()), F.lit(0))
    return F.when(position > 0, F.coalesce(F.get(values, (position - 1).cast("int")), repeated))


def session_key(user: Column | str, session: Column | str) -> Column:
    """`user-session`; `concat` is NULL when either part is NULL."""
    return F.concat(col(user), F.lit("-"), col(session).cast("string"))


def product_key(item_id="item_id", item_name="item_name", item_variant="item_variant") -> Column:
    by_name = F.concat(
        F.lit("name:"),
        F.coalesce(col(item_name), F.lit("unknown")),
        F.lit("|variant:"),
        F.coalesce(col(item_variant), F.lit("unknown")),
    )
    return F.coalesce(F.concat(F.lit("id:"), col(item_id)), by_name)


def hash_key(*parts: Column | str) -> Column:
    """md5 over the parts joined by '|'; NULL when any part is NULL."""
    texts = [col(p).cast("string") for p in parts]
    joined = [texts[0]]
    for text in texts[1:]:
        joined += [F.lit("|"), text]
    return F.md5(F.concat(*joined))


def first_known(value: Column | str, time: Column | str) -> Column:
    """Aggregate: the earliest non-null value; equal times fall back to the smaller value.

    A minimum over (time, value) pairs combines on the map side, so one key holding a
    large share of the rows costs each map task one row, never one task the whole key.
    """
    pair = F.struct(col(time).alias("at"), col(value).alias("value"))
    return F.min(F.when(col(value).isNotNull(), pair))["value"]


def last_known(value: Column | str, time: Column | str) -> Column:
    """Aggregate: the latest non-null value; equal times fall back to the larger value."""
    pair = F.struct(col(time).alias("at"), col(value).alias("value"))
    return F.max(F.when(col(value).isNotNull(), pair))["value"]


def ratio(part: Column | str, whole: Column | str) -> Column:
    """Double division, NULL for a zero or NULL divisor."""
    return F.try_divide(col(part).cast("double"), col(whole).cast("double"))


def or_zero(value: Column | str) -> Column:
    return F.coalesce(col(value), F.lit(0))


def or_zero_money(value: Column | str) -> Column:
    return F.coalesce(col(value), F.lit(0.0))


MICROS = 1_000_000


def money_sum(value: Column | str) -> Column:
    """Aggregate: the sum of amounts in fixed point, whole millionths.

    Whole numbers add up to the same whatever their order, so the result has the same bits for any
    partitioning, join strategy or retry, which a sum of doubles has not. NULL, NaN and infinite amounts
    are left out; sums go up to nine trillion, beyond which is an error.
    """
    return F.sum(F.round(col(value) * MICROS).try_cast("long")) / F.lit(MICROS)


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """Whole seconds elapsed (0.9 s to 2.1 s is 1), not a difference of truncated clocks."""
    return F.timestamp_diff("SECOND", col(start), col(end))


def week_start(day: Column | str) -> Column:
    """The Monday on or before the day."""
    return F.trunc(col(day), "week")


def month_start(day: Column | str) -> Column:
    return F.trunc(col(day), "month")
