"""Exact distinct counts that add up over time: bitmaps over dense numbers.

Numbers of distinct users of single days don't add up to those of a week. Bitmaps do: each user has a
number, a day's users are set bits, and the bits of several days are joined by OR. So one pass over the events
makes the days, and any longer period comes from the days' bitmaps, exactly.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.columns import month_start, week_start

PERIODS = {"day": lambda day: day, "week": week_start, "month": month_start}


def places(df: DataFrame, key: str) -> DataFrame:
    """(key, place): every distinct non-null value, counted through in its partition.

    Which value gets which place is not fixed, so these rows have to be written before `numbered` reads them.
    """
    values = df.where(F.col(key).isNotNull()).select(key).distinct()
    return values.select(key, F.monotonically_increasing_id().alias("place"))


def _offsets(placed: DataFrame) -> Column:
    """Where the numbers of each partition begin, as a map; no larger than the number of partitions."""
    part = F.shiftright("place", 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    listed = counts.agg(F.array_sort(F.collect_list(F.struct("part", "n"))).alias("parts"))
    before = F.transform("parts", lambda p, i: F.aggregate(F.slice("parts", 1, i), F.lit(0).cast("long"), lambda a, q: a + q["n"]))
    return listed.select(F.map_from_arrays(F.transform("parts", lambda p: p["part"]), before)).scalar()


def numbered(placed: DataFrame, key: str) -> DataFrame:
    """(key, number): the written rows of `places`, numbered from 0 on without gaps.

    A partition's values begin after those of the partitions before it. What all tasks need to know for
    that is a count for each partition, not a sort or a window over all values.
    """
    within = F.col("place").bitwiseAND((1 << 33) - 1)
    return placed.select(key, (_offsets(placed)[F.shiftright("place", 33)] + within).alias("number"))


def daily_bitmaps(rows: DataFrame, numbers: DataFrame, key: str, day: str) -> DataFrame:
    """day, bucket, bits: which of the bucket's 32,768 numbers were seen on that day.

    Rows are reduced to days and keys first, then to bits on the map side; a bitmap has 4 KB.
    """
    seen = rows.where(F.col(key).isNotNull() & F.col(day).isNotNull()).select(key, F.col(day).alias("day")).distinct()
    bits, number = seen.join(numbers, key), F.col("number") + 1  # bitmaps count from 1
    return bits.groupBy("day", F.bitmap_bucket_number(number).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")
    )


def distinct_by_period(bitmaps: DataFrame, periods: Mapping[str, object] = PERIODS) -> DataFrame:
    """period, start, active_users: exact distinct counts for each period, all from the days' bitmaps.

    All periods share one read of the bitmaps: each day's bits go to each of its periods.
    """
    starts = F.array(*[F.struct(F.lit(name).alias("period"), start(F.col("day")).alias("start")) for name, start in periods.items()])
    spread = bitmaps.select(F.explode(starts).alias("of"), "bucket", "bits")
    joined = spread.groupBy("of", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    counts = joined.groupBy("of").agg(F.sum(F.bitmap_count("bits")).alias("active_users"))
    return counts.select("of.period", "of.start", "active_users")
