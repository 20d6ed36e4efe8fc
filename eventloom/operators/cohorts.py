"""Weekly activity and cohort retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import UNKNOWN, hash_key, or_zero, ratio, week_start

# User columns that split the cohorts of a week.
DIMENSIONS = ("first_device_category", "first_user_source", "first_user_medium")


def weekly_activity(sessions: DataFrame) -> DataFrame:
    """Distinct (user, Monday of an active week)."""
    return (
        sessions.where(F.col("user_pseudo_id").isNotNull())
        .select("user_pseudo_id", week_start("session_date").alias("activity_week"))
        .distinct()
    )


def _weeks_between(start: str, end) -> Column:
    """Both ends are Mondays, so whole sevens of days are weeks."""
    return F.floor(F.date_diff(end, F.col(start)) / 7).cast("int")


WEEKS_PER_WORD = 63  # bits of a long without its sign


def _week_number(day) -> Column:
    """Weeks since the Monday 1969-12-29, the one before the epoch."""
    return F.floor((F.date_diff(day, F.lit("1970-01-01").cast("date")) + 3) / 7)


def _monday(number: Column) -> Column:
    return F.date_add(F.lit("1969-12-29").cast("date"), (number * 7).cast("int"))


def active_weeks(sessions: DataFrame) -> DataFrame:
    """user_pseudo_id, word, weeks: a user's active weeks as bits, 63 to a word.

    Bits merge by OR, on the map side and in any order, in a hash aggregation of fixed-size values.
    """
    week = _week_number(week_start("session_date"))
    word = F.floor(week / WEEKS_PER_WORD)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (week - word * WEEKS_PER_WORD).cast("int"))
    return (
        sessions.where(F.col("user_pseudo_id").isNotNull() & F.col("session_date").isNotNull())
        .groupBy("user_pseudo_id", word.alias("word"))
        .agg(F.bit_or(bit).alias("weeks"))
    )


def _weeks_of(word: Column, bits: Column) -> Column:
    """Numbers of the weeks whose bits are set."""
    set_ = F.filter(F.sequence(F.lit(0), F.lit(WEEKS_PER_WORD - 1)), lambda k: F.getbit(bits, k) == 1)
    return F.transform(set_, lambda k: word * WEEKS_PER_WORD + k)


def cohort_activity(sessions: DataFrame, users: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Active users per cohort and week in which any of the cohort was active.

    A user's active weeks are a few words of bits. The lowest bit of the first word is the cohort; after
    the expansion each user appears once per week, which makes the distinct user count a plain count.
    """
    words = active_weeks(sessions)
    # Below the lowest bit that is set lie as many bits as weeks before the first active one.
    lowest = F.bit_count(F.col("weeks").bitwiseAND(-F.col("weeks")) - 1)
    first = words.groupBy("user_pseudo_id").agg(F.min(F.col("word") * WEEKS_PER_WORD + lowest).alias("first"))
    of_user = [F.coalesce(F.col(c), F.lit(UNKNOWN)).alias(c) for c in dimensions]
    cohort = users.select("user_pseudo_id", *of_user).join(first, "user_pseudo_id")
    cohort = cohort.select("user_pseudo_id", *dimensions, _monday(F.col("first")).alias("cohort_week"))
    return (
        words.join(cohort, "user_pseudo_id")
        .select("cohort_week", *dimensions, F.explode(_weeks_of(F.col("word"), F.col("weeks"))).alias("week"))
        .groupBy("cohort_week", *dimensions, "week")
        .agg(F.count("*").alias("active_users"))
        .select("cohort_week", *dimensions, _monday(F.col("week")).alias("activity_week"), "active_users")
    )


def cohort_retention(sessions: DataFrame, users: DataFrame, dimensions: Sequence[str] = DIMENSIONS) -> DataFrame:
    """Every cohort at every observable age in weeks, quiet weeks as zero rows.

    A cohort's weekly counts are gathered into one map, no longer than the calendar, and
    looked up for each age. A join of the dense ages with the counts would compute the
    counts twice.
    """
    last_week = (
        sessions.where(F.col("user_pseudo_id").isNotNull()).agg(F.max(week_start("session_date"))).scalar()
    )
    per_cohort = (
        cohort_activity(sessions, users, dimensions)
        .groupBy("cohort_week", *dimensions)
        .agg(F.map_from_entries(F.collect_list(F.struct("activity_week", "active_users"))).alias("active_in"))
    )
    # All of a cohort is active in its first week, so that count is the cohort's size.
    max_age = F.greatest(_weeks_between("cohort_week", last_week), F.lit(0))
    by_age = (
        per_cohort.select(
            "*", F.col("active_in")[F.col("cohort_week")].alias("cohort_size"), max_age.alias("max_observable_age_weeks")
        )
        .select("*", F.explode(F.sequence(F.lit(0), "max_observable_age_weeks")).alias("cohort_age_weeks"))
        .select("*", F.date_add("cohort_week", F.col("cohort_age_weeks") * 7).alias("activity_week"))
        .select("*", or_zero(F.col("active_in")[F.col("activity_week")]).alias("active_users"))
    )
    return by_age.select(
        hash_key("cohort_week", *dimensions, "cohort_age_weeks").alias("customer_cohort_id"),
        "cohort_week",
        F.date_format("cohort_week", "yyyy-MM-dd").alias("cohort_week_label"),
        "activity_week",
        "cohort_age_weeks",
        F.concat(F.lit("Week "), F.col("cohort_age_weeks").cast("string")).alias("cohort_age_label"),
        *dimensions,
        "cohort_size",
        "active_users",
        ratio("active_users", "cohort_size").alias("retention_rate"),
        "max_observable_age_weeks",
    )
