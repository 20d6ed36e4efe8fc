"""What the physical plans must look like when no side is small enough to broadcast."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from eventloom.plans.catalog import TABLES, Catalog, materialize, shared_folder
from eventloom.sources import demo_export, versions
from eventloom.sources.raw import Layout, laid_out
from eventloom.sources.schema import RAW_EVENT
from tests.conftest import event


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plans"))
    raw = demo_export.export(spark, "/root/testdata/sf0.001", f"{folder}/raw")
    return materialize(raw, f"{folder}/tables", tables=TABLES)


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hash_exchanges(df) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", physical(df))


def test_no_cross_join_and_no_python(tables, no_broadcast):
    for name in tables:
        plan = physical(tables.plan(name))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "PythonUDF"):
            assert operator not in plan, (name, operator)


def test_session_side_joins_add_no_shuffle(tables, no_broadcast):
    # The sessions table 1, funnel 2; nothing more for the join.
    assert len(hash_exchanges(tables.plan("session_funnel"))) == 3
    # Rollup 1, session orders 2; nothing for their join.
    assert len(hash_exchanges(tables.plan("sessions"))) == 3


def test_funnel_shuffles_events_once_then_tables_by_session(tables, no_broadcast):
    plan = physical(tables.plan("sequential_funnel"))
    keys = hash_exchanges(tables.plan("sequential_funnel"))
    assert sorted(k.count("#") for k in keys) == [1, 2]
    assert plan.count("Exchange") == 2 and plan.count("FileScan") == 1 and "Window" not in plan and "Sort" not in plan
    # Events meet their copies before the shuffle.
    assert "partial_collect_set" in plan


def test_item_rows_are_shuffled_by_transaction_and_event(tables, no_broadcast):
    keys = [k for k in hash_exchanges(tables.plan("order_items")) if "event_key" in k]
    assert len(keys) == 2 and all("transaction_id" in k for k in keys)


def test_daily_funnel_is_one_small_shuffle(tables, no_broadcast):
    plan = physical(tables.plan("funnel_daily"))
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1 and "Window" not in plan


def test_cohorts_read_each_input_once(tables, no_broadcast):
    df = tables.plan("cohort_retention")
    # Sessions for the weeks and for the first of them, users, and the last week, which is a narrow read of its own.
    assert physical(df).count("FileScan") == 4
    df.collect()
    # When it runs, the weeks of users are shuffled once and used twice.
    assert "ReusedExchange" in physical(df) and "SortAggregate" not in physical(df)


def test_no_distinct_copies_of_item_rows(tables, no_broadcast):
    assert "Expand" not in physical(tables.plan("product_performance"))


def test_purchase_filter_and_columns_reach_the_scan(tables):
    plan = physical(tables.plan("session_orders"))
    assert "EqualTo(event_name,purchase)" in plan
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} <= {
        "event_name",
        "session_id",
        "transaction_id",
        "purchase_revenue_usd",
    }


def test_parameter_lookup_is_shared(tables, spark):
    raw = demo_export.raw_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    # Read back from files, as the real export is.
    stored = spark.read.schema(raw.schema).parquet(tables._warehouse + "/../raw")
    plan = physical(Catalog(stored)["stg_events"])
    # The session id is made from the looked-up column, not from a second lookup.
    assert re.search(r"concat\(user_pseudo_id#\d+, -, cast\(ga_session_id#", plan)


def test_skewed_join_sides_are_split(spark, tmp_path):
    """One transaction-event pair holding a third of the item rows is split over several tasks."""
    from eventloom.operators.orders import order_items
    from eventloom.sources.schema import ITEM

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        hot = F.col("id") % 3 == 0
        key = F.when(hot, "hot").otherwise(F.col("id").cast("string"))
        texts = [f for f in ITEM.names if f not in ("price_in_usd", "price", "quantity", "item_revenue_in_usd", "item_revenue")]
        items = spark.range(0, 60_000, 1, 8).select(
            F.lit("purchase").alias("event_name"),
            key.alias("transaction_id"),
            key.alias("event_key"),
            F.timestamp_seconds(F.lit(1)).alias("event_timestamp"),
            F.lit("s").alias("session_id"),
            F.lit("u").alias("user_pseudo_id"),
            F.col("id").alias("item_position"),
            *[F.md5(F.col("id").cast("string")).alias(c) for c in texts],
            F.lit(1).cast("long").alias("quantity"),
            *[F.lit(1.0).alias(c) for c in ("item_price_usd", "item_price_local", "item_revenue_in_usd", "item_revenue_local", "item_value_usd")],
        )
        items.write.parquet(str(tmp_path / "items"))
        items = spark.read.parquet(str(tmp_path / "items"))
        orders = items.groupBy("transaction_id").agg(
            F.lit("2024-03-04").cast("date").alias("order_date"),
            F.min("event_timestamp").alias("purchased_at"),
            F.min("session_id").alias("session_id"),
            F.min("user_pseudo_id").alias("user_pseudo_id"),
        )
        lines = order_items(items, orders)
        assert len(lines.collect()) == 60_000
        assert "skew=true" in physical(lines)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x") == f"{named}/x-{spark.sparkContext.applicationId}"


def test_views_and_tables_give_equal_rows(raw_of, tmp_path):
    raw = raw_of(event("view_item", 1), event("purchase", 5, transaction="t", revenue=3.0, units=1))
    views = Catalog(raw, warehouse=str(tmp_path / "a"), tables=())
    tables = Catalog(raw, warehouse=str(tmp_path / "b"), tables=TABLES)
    for name in ("stg_events", "sessions", "session_funnel", "orders", "executive_daily"):
        assert views[name].exceptAll(tables[name]).isEmpty() and tables[name].exceptAll(views[name]).isEmpty()
    assert not (tmp_path / "a").exists() and (tmp_path / "b" / "stg_events").exists()


def test_folders_of_one_name_and_changed_files_are_told_apart(spark, tmp_path):
    def events(folder, n):
        (tmp_path / folder).mkdir(parents=True, exist_ok=True)
        spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(n).write.mode("overwrite").parquet(f"{tmp_path}/{folder}/events.parquet")
        return f"{tmp_path}/{folder}"

    a, b = events("a/x", 20), events("b/x", 30)
    count = lambda folder: entry.queries()["stg_events"](spark, folder).count()
    assert [count(b), count(a), count(b)] == [30, 20, 30]
    assert count(events("a/x", 10)) == 10


def test_experiment_reads_one_assigned_table(tables, no_broadcast):
    """The target is chosen when that table is written; no query chooses it again."""
    scans = {}
    for name in ("variant_summary", "ab_ztest", "user_ratio_test", "modeled_impact", "guardrails", "srm_check", "rollout_decision"):
        plan = physical(entry.EXPERIMENTS[name](tables))
        assert plan.count("session_funnel") == 0, name
        scans[name] = plan.count("FileScan")
    assert {scans[n] for n in ("variant_summary", "ab_ztest", "user_ratio_test", "srm_check")} == {1}
    assert scans["guardrails"] == 2 and (scans["modeled_impact"], scans["rollout_decision"]) <= (4, 8), scans


@pytest.fixture(scope="module")
def bucketed(spark, tables, tmp_path_factory):
    raw = spark.read.schema(RAW_EVENT).parquet(tables._warehouse + "/../raw")
    return materialize(raw, str(tmp_path_factory.mktemp("bucketed")), tables=TABLES, buckets=4)


def below_joins(df) -> list[str]:
    """The parts of the plan under each join."""
    plan = physical(df)
    return [plan[m.start() :] for m in re.finditer(r"SortMergeJoin|ShuffledHashJoin", plan)]


def test_tables_by_session_meet_without_shuffles(bucketed, tables, no_broadcast):
    orders = bucketed["orders"].where("session_id IS NOT NULL").groupBy("session_id").agg(F.count("*").alias("n"))
    funnel, sessions = bucketed["session_funnel"], bucketed["sessions"].select("session_id", "event_count")
    met = sessions.join(funnel.select("session_id", "funnel_status"), "session_id").join(orders, "session_id", "left")
    assert "Exchange" not in physical(met) and physical(met).count("SortMergeJoin") == 2
    joined = below_joins(entry.EXPERIMENTS["guardrails"](bucketed))
    assert len(joined) == 1 and "Exchange" not in joined[0]
    # As many buckets as shuffle partitions: what is computed by session meets them too.
    assert len(hash_exchanges(bucketed.plan("session_funnel"))) < len(hash_exchanges(tables.plan("session_funnel")))
    plain = tables["sessions"].join(tables["session_funnel"].select("session_id", "funnel_status"), "session_id")
    assert physical(plain).count("Exchange") == 2


def test_bucketed_tables_hold_the_same(bucketed, tables, spark):
    for name in ("sessions", "session_funnel", "orders", "experiment_sessions", "executive_daily"):
        assert bucketed[name].schema == tables[name].schema
        assert bucketed[name].exceptAll(tables[name]).isEmpty() and tables[name].exceptAll(bucketed[name]).isEmpty(), name
    # Another application reads them by their manifest.
    path = f"{bucketed._warehouse}/sessions"
    (version,) = versions.current(spark, path).parts.values()
    spark.sql(f"DROP TABLE bucketed_{version}")
    again = versions.read_version(spark, path)
    assert again.count() == tables["sessions"].count() and "Bucketed: true" in physical(again.groupBy("session_id").count())
    assert bucketed.measured("sessions") == tables.measured("sessions")
    with pytest.raises(ValueError):
        Layout(day="d", bucket="k", buckets=2)


def test_export_is_shuffled_and_sorted_before_its_rows_are_nested(spark, tmp_path, monkeypatch):
    seen = []
    write = demo_export.write_export
    monkeypatch.setattr(demo_export, "write_export", lambda df, path, layout: (seen.append((physical(df), layout)), write(df, path, layout)))
    rows = demo_export.export(spark, "/root/testdata/sf0.001", str(tmp_path / "raw"))
    (plan, layout) = seen[0]
    assert plan.count("Exchange") == plan.count("Sort [") == 1 and layout == Layout("event_date")
    assert plan.index("transform(") < plan.index("Sort [") < plan.index("Exchange") and "transform(" not in plan[plan.index("Sort [") :]
    flat = demo_export.raw_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    assert rows.count() == flat.count()
    texts = [df.select(F.xxhash64(F.to_json(F.struct(*RAW_EVENT.names)))) for df in (rows, flat)]
    assert texts[0].exceptAll(texts[1]).isEmpty() and texts[1].exceptAll(texts[0]).isEmpty()


def test_staged_rows_are_written_without_a_sort_in_the_order_of_the_raw_files(spark, tables):
    for name in ("stg_events", "stg_items"):
        plan = physical(laid_out(tables.plan(name), TABLES[name]))
        assert "Sort" not in plan and "Exchange" not in plan, name
        found = tables[name].select(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("at"), "event_name").collect()
        files = {}
        for r in sorted(found, key=lambda r: r.at):
            files.setdefault(r.file, []).append(r.event_name)
        assert len(files) >= 30 and all(names == sorted(names) for names in files.values()), name
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 32


def test_a_task_with_more_days_than_open_files_writes_them_all(spark, tmp_path):
    day = F.date_add(F.lit("2024-03-01").cast("date"), (F.col("id") % 90).cast("int"))
    rows = spark.range(0, 9000, 1, 1).select("id", F.when(F.col("id") % 91 > 0, day).alias("day"))
    found = versions.publish(rows, str(tmp_path / "days"), Layout("day"))
    assert found.exceptAll(rows).isEmpty() and found.count() == 9000


def test_product_performance_is_written_without_a_shuffle_of_its_own(tables, no_broadcast):
    df = tables.plan("product_performance")
    laid = physical(laid_out(df, TABLES["product_performance"]))
    assert laid.count("Exchange") == physical(df).count("Exchange") and "rebalance" not in laid.lower()
    assert tables["product_performance"].exceptAll(df).isEmpty() and df.exceptAll(tables["product_performance"]).isEmpty()


def test_tables_and_export_are_written_with_the_codec(tables):
    folder = tables._warehouse
    for name in ("../raw", "stg_items", "product_performance"):
        files = list(Path(folder, name).resolve().rglob("*.parquet"))
        assert files and all(f.name.endswith(".zstd.parquet") for f in files), name
