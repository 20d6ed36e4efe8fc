"""Distinct counts by bitmaps, and weeks as bits, against sets."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import cohorts, distinct
from eventloom.plans.catalog import Catalog
from tests.conftest import event

MONDAY = dt.date(2024, 1, 1)


def rows_of(seed, users, days, n):
    rng = random.Random(seed)
    return [(f"u{rng.randrange(users)}", MONDAY + dt.timedelta(days=rng.randrange(days))) for _ in range(n)]


def numbers_of(df, path):
    distinct.places(df, "who").write.parquet(path)
    return distinct.numbered(df.sparkSession.read.parquet(path), "who")


def test_numbers_are_dense(spark, tmp_path):
    df = spark.range(70_000).selectExpr("IF(id % 50 = 0, NULL, concat('u', id % 40000)) AS who").repartition(7)
    found = numbers_of(df, str(tmp_path / "places")).collect()
    want = {f"u{i % 40_000}" for i in range(70_000) if i % 50}
    assert {r.who for r in found} == want and sorted(r.number for r in found) == list(range(len(want)))
    assert numbers_of(df.where("who = 'nobody'"), str(tmp_path / "none")).collect() == []


def test_counts_equal_sets(spark, tmp_path):
    rows = rows_of(1, 400, 70, 3000) + [(None, MONDAY), ("u1", None)]
    df = spark.createDataFrame(rows, "who string, day date").repartition(5)
    maps = distinct.daily_bitmaps(df, numbers_of(df, str(tmp_path / "places")), "who", "day")
    found = {(r.period, r.start): r.active_users for r in distinct.distinct_by_period(maps).collect()}
    want = {}
    for who, day in rows:
        if who and day:
            for key in (("day", day), ("week", day - dt.timedelta(days=day.weekday())), ("month", day.replace(day=1))):
                want.setdefault(key, set()).add(who)
    assert found == {k: len(v) for k, v in want.items()}
    week = {d: n for (p, d), n in found.items() if p == "day" and MONDAY <= d < MONDAY + dt.timedelta(days=7)}
    assert sum(week.values()) > found["week", MONDAY]  # which days alone can't tell


def test_several_buckets_and_late_days(spark, tmp_path):
    """More users than a bitmap has bits; a new day is joined to the days' bitmaps without reading the others again."""
    df = spark.range(80_000).selectExpr("concat('u', id % 70000) AS who", "date_add(DATE'2024-01-01', CAST(id % 3 AS INT)) AS day")
    numbers = numbers_of(df, str(tmp_path / "places"))
    numbers.write.parquet(str(tmp_path / "numbers"))
    numbers = spark.read.parquet(str(tmp_path / "numbers"))
    maps = distinct.daily_bitmaps(df.where("day < '2024-01-03'"), numbers, "who", "day")
    late = distinct.daily_bitmaps(df.where("day = '2024-01-03'"), numbers, "who", "day")
    assert maps.select("bucket").distinct().count() == 3
    found = {(r.period, r.start.day): r.active_users for r in distinct.distinct_by_period(maps.unionByName(late)).collect()}
    want = {d: df.where(F.dayofmonth("day") == d).select("who").distinct().count() for d in (1, 2, 3)}
    assert found == {("day", d): n for d, n in want.items()} | {("week", 1): 70_000, ("month", 1): 70_000}


def test_views_have_no_numbers(raw_of):
    with pytest.raises(ValueError):
        Catalog(raw_of(event("a")))["active_users"]


def test_weeks_are_bits_over_many_years(spark):
    rng = random.Random(2)
    start = dt.date(1968, 5, 1)
    rows = [(f"u{rng.randrange(12)}", start + dt.timedelta(days=rng.randrange(1500))) for _ in range(400)] + [(None, start), ("u1", None)]
    sessions = spark.createDataFrame(rows, "user_pseudo_id string, session_date date")
    users = spark.createDataFrame([(f"u{i}", f"d{i % 2}" if i else None) for i in range(12)], "user_pseudo_id string, device string")
    weeks = {}
    for who, day in rows:
        if who and day:
            weeks.setdefault(who, set()).add(day - dt.timedelta(days=day.weekday()))
    want = {}
    for who, own in weeks.items():
        device = f"d{int(who[1:]) % 2}" if who != "u0" else "Unknown"
        for week in own:
            key = (min(own), device, week)
            want[key] = want.get(key, 0) + 1
    found = cohorts.cohort_activity(sessions, users, ["device"])
    assert {(r.cohort_week, r.device, r.activity_week): r.active_users for r in found.collect()} == want
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    assert cohorts.active_weeks(sessions).groupBy("user_pseudo_id").count().agg(F.max("count")).first()[0] > 2
