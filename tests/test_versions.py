"""Versioned tables: replacement, failed writes, single days, concurrent writers, counts of the write."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from eventloom.operators import checks
from eventloom.plans.catalog import Catalog, restage
from eventloom.sources import versions
from eventloom.sources.raw import Layout
from tests.conftest import event


def days_of(spark, *days, worth=1):
    """Two rows a day."""
    rows = [(dt.date(2024, 3, d), i, worth) for d in days for i in range(2)]
    return spark.createDataFrame(rows, "day date, id int, worth int")


def contents(df):
    return sorted((r.day.day, r.id, r.worth) for r in df.collect())


@pytest.fixture()
def path(tmp_path):
    return str(tmp_path / "table")


def versions_of(path_of_table):
    import os

    return {name for name in os.listdir(path_of_table) if name.startswith("version=")}


def files_of(path_of_table):
    import pathlib

    return {str(p): p.stat().st_mtime_ns for p in pathlib.Path(path_of_table).rglob("*.parquet")}


@pytest.mark.parametrize("layout", [Layout(), Layout("day", "id"), Layout("day", rebalance=True)])
def test_replacement_keeps_columns_and_old_readers(spark, path, layout):
    first = versions.publish(days_of(spark, 1, 2), path, layout)
    second = versions.publish(days_of(spark, 2, 3, worth=5), path, layout)
    assert second.columns == first.columns == ["day", "id", "worth"] and second.schema == first.schema
    assert contents(second) == [(2, 0, 5), (2, 1, 5), (3, 0, 5), (3, 1, 5)]
    # Whoever reads the old version goes on.
    assert contents(first) == [(1, 0, 1), (1, 1, 1), (2, 0, 1), (2, 1, 1)]
    assert contents(versions.read_version(spark, path)) == contents(second)
    assert versions.current(spark, path).number == 2


def test_a_write_that_fails_leaves_the_table(spark, path):
    versions.publish(days_of(spark, 1), path, Layout("day"))
    broken = days_of(spark, 1, worth=2).withColumn("worth", F.raise_error(F.lit("lost")).cast("int"))
    for days in (None, ("2024-03-01", "2024-03-01")):
        with pytest.raises(Exception, match="lost"):
            versions.publish(broken, path, Layout("day"), days=days)
        assert contents(versions.read_version(spark, path)) == [(1, 0, 1), (1, 1, 1)]
    assert versions.current(spark, path).number == 1


def test_days_are_replaced_alone(spark, path):
    layout = Layout("day")
    versions.publish(days_of(spark, 1, 2, 3, 4), path, layout)
    before = files_of(path)
    # Rows of other days that come along are not written; a day without rows is gone.
    back = versions.publish(days_of(spark, 2, 4, worth=7), path, layout, days=("2024-03-02", "2024-03-03"))
    assert contents(back) == [(1, 0, 1), (1, 1, 1), (2, 0, 7), (2, 1, 7), (4, 0, 1), (4, 1, 1)]
    after = files_of(path)
    assert before.items() <= after.items() and all("day=2024-03-02" in name for name in after.keys() - before.keys())
    plan = back.where("day = '2024-03-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    again = versions.publish(days_of(spark, 2, worth=7), path, layout, days=("2024-03-02", "2024-03-03"))
    assert contents(again) == contents(back)
    with pytest.raises(ValueError):
        versions.publish(days_of(spark, 1), path, Layout(), days=("2024-03-01", "2024-03-01"))


def test_one_of_two_writers_is_told(spark, path, monkeypatch):
    versions.publish(days_of(spark, 1), path)
    seen = versions.current(spark, path)
    versions.publish(days_of(spark, 2), path)
    monkeypatch.setattr(versions, "current", lambda *_: seen)
    with pytest.raises(versions.Conflict):
        versions.publish(days_of(spark, 3), path)
    monkeypatch.undo()
    assert {d for d, *_ in contents(versions.read_version(spark, path))} == {2}


def test_vacuum_keeps_what_is_used_and_what_may_be_running(spark, path):
    layout = Layout("day")
    versions.publish(days_of(spark, 1, 2), path, layout)
    versions.publish(days_of(spark, 1, 2, worth=2), path, layout)
    versions.publish(days_of(spark, 2, worth=3), path, layout, days=("2024-03-02", "2024-03-02"))
    assert versions.vacuum(spark, path) == [] and len(versions_of(path)) == 3
    assert len(versions.vacuum(spark, path, older_than_hours=-1)) == 1
    assert contents(versions.read_version(spark, path)) == [(1, 0, 2), (1, 1, 2), (2, 0, 3), (2, 1, 3)]
    assert contents(versions.publish(days_of(spark, 5), path, layout)) == [(5, 0, 1), (5, 1, 1)]


def test_nothing_published_and_empty_tables(spark, path):
    assert versions.current(spark, path) is None
    with pytest.raises(AnalysisException):
        versions.read_version(spark, path)
    for layout in (Layout(), Layout("day")):
        for empty in (days_of(spark, 1).where("id > 9"), days_of(spark, 1).limit(0)):
            back = versions.publish(empty, path, layout, {"n": F.count("*")})
            assert back.count() == 0 and back.columns == ["day", "id", "worth"]


def test_counts_of_the_write(spark, path):
    layout = Layout("day", "id", rebalance=True)
    count = {"rows": F.count("*"), "odd": F.count_if(F.col("id") == 1)}
    versions.publish(days_of(spark, 1, 2, 3), path, layout, count)
    assert versions.current(spark, path).measured() == {"rows": 6, "odd": 3}
    # A version that counted days since replaced says nothing about the table.
    versions.publish(days_of(spark, 2), path, layout, count, days=("2024-03-02", "2024-03-02"))
    assert versions.current(spark, path).measured() is None
    versions.publish(days_of(spark, 1, 3), path, layout, count, days=("2024-03-01", "2024-03-01"))
    versions.publish(days_of(spark, 3), path, layout, count, days=("2024-03-03", "2024-03-03"))
    assert versions.current(spark, path).measured() == {"rows": 6, "odd": 3}


def test_staging_a_day_again(spark, raw_of, path):
    march = [event("view_item", date=f"2024030{d}", user=f"u{d}", items=[{"item_id": "p"}]) for d in (1, 2, 3)]
    tables = Catalog(raw_of(*march), warehouse=path, tables=("stg_events", "stg_items"))
    assert (tables["stg_events"].count(), tables["stg_items"].count()) == (3, 3)
    late = raw_of(*march, event("view_item", 5, date="20240302", user="late", items=[{"item_id": "q"}]), event("purchase", date="20240303"))
    before = files_of(path)
    restage(late, path, "20240302", "20240302")
    again = {n: versions.read_version(spark, f"{path}/{n}") for n in ("stg_events", "stg_items")}
    # The late event of the day is there, the one of another day isn't.
    assert sorted(r.event_date.day for r in again["stg_events"].collect()) == [1, 2, 2, 3]
    assert sorted(r.item_id for r in again["stg_items"].collect()) == ["p", "p", "p", "q"]
    assert all("event_date=2024-03-02" in name for name in files_of(path).keys() - before.keys())


def test_row_checks_are_counted_by_the_write(spark, raw_of, path):
    rows = [event("view_item", 0, items=[{"item_id": "p", "quantity": -2}]), event("purchase", 1, transaction="T", revenue=-5.0), event("x", platform="ODD"), event("y", platform="ODD")]
    written = Catalog(raw_of(*rows), warehouse=path, tables=("stg_events", "sessions", "orders", "session_funnel", "users"))
    plain = {name: written[name] for name in written}
    assert written.measured("stg_events")["accepted:platform"] == 2 and written.measured("order_items") is None
    for name in ("stg_events", "sessions", "orders", "session_funnel", "users"):
        found = {tuple(r) for r in checks.generic_report(written, name).collect()}
        assert found == {tuple(r) for r in checks.generic_report(plain, name).collect()}
    for name in checks.ROW_CHECKS:
        assert checks.named_report(written, name).collect() == checks.named_report(plain, name).collect(), name
    assert checks.named_report(written, "orders_nonnegative").first().failing_rows == 1
    plan = checks.named_report(written, "orders_nonnegative")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan
    # Two unique checks and two scans for them; the ten not-null checks and the accepted values need none.
    plan = checks.generic_report(written, "users")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
