"""All datasets wired over one raw event frame."""

from __future__ import annotations

import hashlib
from collections.abc import Collection, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from eventloom.operators import checks, cohorts, daily, distinct, experiment, funnel, orders, products, sessions, staging, users
from eventloom.sources import versions
from eventloom.sources.raw import Layout

# Datasets written as tables. The staged rows arrive by day, because the raw files are split
# by day, and are written without a shuffle and without a sort, which would take the widest rows of all:
# they keep the order of the raw files. Where those are sorted by event name, so are the staged files, and
# a read of the purchases skips nearly all row groups. Session and order tables are always read whole, so they are
# not split by day, which would cost a shuffle. Nor is the performance of products, which has nearly as many rows as
# there are items where products are many. The daily segments are few.
TABLES = {
    "stg_events": Layout("event_date"),
    "stg_items": Layout("event_date"),
    "sessions": Layout(),
    "session_funnel": Layout(),
    "orders": Layout(),
    "order_items": Layout(),
    "users": Layout(),
    "executive_daily": Layout(),
    "funnel_daily": Layout(),
    "funnel_segment": Layout("metric_date", rebalance=True),
    "product_performance": Layout(),
    "product_opportunity": Layout(),
    "customer_summary": Layout(),
    "cohort_retention": Layout(),
    # The target is chosen once, for all that evaluates the experiment.
    "experiment_sessions": Layout(),
    # Numbers of users, the same for all that counts by them.
    "user_places": Layout(),
}
# Tables that meet by session. With a number of buckets they are written hashed by session id, and their
# joins and groupings by session need no shuffle.
BY_SESSION = ("sessions", "session_funnel", "orders", "experiment_sessions")
# Staged rows are as many as the raw ones, so they are views unless asked for as tables.
DEFAULT_TABLES = tuple(name for name in TABLES if not name.startswith("stg_"))


class Catalog(Mapping[str, DataFrame]):
    """Datasets by name, each built from the others on first use.

    Without a warehouse path every dataset is a lazy plan over the raw events. With one,
    each dataset of `tables` is written on first use and read back, so that what several
    datasets share is computed once and a lost executor never reaches behind the last table;
    all others stay views. A written table becomes current only when it is complete, and the
    checks that look at one row at a time are counted by the write (`measured`).
    """

    def __init__(
        self,
        raw: DataFrame,
        date_from: str | None = None,
        date_to: str | None = None,
        warehouse: str | None = None,
        tables: Collection[str] = DEFAULT_TABLES,
        buckets: int | None = None,
    ):
        if unknown := set(tables) - set(TABLES):
            raise ValueError(f"not to be written as tables: {', '.join(sorted(unknown))}")
        self._warehouse = warehouse
        self._layouts = TABLES | ({n: Layout(bucket="session_id", buckets=buckets) for n in BY_SESSION} if buckets else {})
        self._tables = frozenset(tables)
        self._built: dict[str, DataFrame] = {}
        self._recipes = {
            "stg_events": lambda: staging.flatten_events(raw, date_from, date_to),
            "stg_items": lambda: staging.flatten_items(raw, date_from, date_to),
            "session_orders": lambda: sessions.session_orders(self["stg_events"]),
            "sequential_funnel": lambda: funnel.sequential_funnel(self["stg_events"]),
            "sessions": lambda: sessions.sessions(self["stg_events"]),
            # As plans, both sides come from the events and share the hash on the session id.
            "session_funnel": lambda: funnel.session_funnel(self["sessions"], self.plan("sequential_funnel")),
            "orders": lambda: orders.orders(self["stg_events"]),
            "order_items": lambda: orders.order_items(self["stg_items"], self["orders"]),
            "users": lambda: users.users(self["sessions"], self["orders"]),
            "executive_daily": lambda: daily.executive_daily(self["session_funnel"], self["orders"]),
            "funnel_daily": lambda: daily.funnel_daily(self["session_funnel"]),
            "funnel_segment": lambda: daily.funnel_segment(
                self["session_funnel"], self["orders"], orders_mark_sessions=True
            ),
            "product_performance": lambda: products.product_performance(self["stg_items"], self["order_items"]),
            "product_opportunity": lambda: products.product_opportunity(self["product_performance"]),
            "customer_summary": lambda: users.customer_summary(self["users"]),
            "weekly_activity": lambda: cohorts.weekly_activity(self["sessions"]),
            "cohort_retention": lambda: cohorts.cohort_retention(self["sessions"], self["users"]),
            "user_places": lambda: distinct.places(self["sessions"], "user_pseudo_id"),
            "active_users": self._active_users,
            "experiment_sessions": lambda: experiment.experiment_sessions(self["session_funnel"]),
        }

    def _active_users(self) -> DataFrame:
        if self._warehouse is None or "user_places" not in self._tables:
            raise ValueError("active_users counts by numbers that have to be written: give a warehouse")
        numbers = distinct.numbered(self["user_places"], "user_pseudo_id")
        return distinct.distinct_by_period(distinct.daily_bitmaps(self["sessions"], numbers, "user_pseudo_id", "session_date"))

    def plan(self, name: str) -> DataFrame:
        """The dataset computed from its inputs, even where it is also a written table."""
        return self._recipes[name]()

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        df = self.plan(name)
        if self._warehouse is not None and name in self._tables:
            return versions.publish(df, f"{self._warehouse}/{name}", self._layouts[name], checks.measures(name))
        return df

    def measured(self, name: str) -> dict[str, int] | None:
        """What `checks.measures` counted when the dataset was written; None for a view."""
        if self._warehouse is None or name not in self._tables:
            return None
        return versions.current(self[name].sparkSession, f"{self._warehouse}/{name}").measured()

    def __iter__(self) -> Iterator[str]:
        """The datasets that this catalog can give: `active_users` needs numbers that were written."""
        counted = self._warehouse is not None and "user_places" in self._tables
        return (name for name in self._recipes if counted or name != "active_users")

    def __len__(self) -> int:
        return sum(1 for _ in self)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder of this application below the one the cluster names in `spark.checkpoint.dir`."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{shared.rstrip('/')}/{name}-{spark.sparkContext.applicationId}"


def input_version(spark: SparkSession, path: str) -> str:
    """A short digest of a path and of the names, sizes and times of the files there; other files, another digest."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(where)
    files = sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found)
    return hashlib.sha256(repr((path, files)).encode()).hexdigest()[:16]


def materialize(
    raw: DataFrame,
    warehouse: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    tables: Collection[str] = DEFAULT_TABLES,
    buckets: int | None = None,
) -> Catalog:
    """Write the named datasets (full replacement) and return the catalog over them.

    A run that fails on the way leaves the tables it hasn't reached as they were. `buckets`: into how many files,
    hashed by session id, the tables of sessions are dealt; about one for each 100 MB of the largest, and as many as
    shuffles have partitions, so that what is computed by session meets them where they are.
    """
    found = Catalog(raw, date_from, date_to, warehouse or shared_folder(raw.sparkSession, "tables"), tables, buckets)
    for name in TABLES:
        if name in found._tables:
            found[name]
    return found


def restage(raw: DataFrame, warehouse: str, date_from: str, date_to: str, names: Collection[str] = ("stg_events", "stg_items")) -> None:
    """Stage the inclusive `yyyyMMdd` range of days again; the tables' other days are neither read nor written."""
    days = tuple(f"{d[:4]}-{d[4:6]}-{d[6:]}" for d in (date_from, date_to))
    fresh = Catalog(raw, date_from, date_to)
    for name in names:
        versions.publish(fresh.plan(name), f"{warehouse}/{name}", TABLES[name], checks.measures(name), days)
