"""Reading and writing the date-partitioned raw export and the tables built from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.sources.schema import RAW_EVENT


def read_raw_events(spark: SparkSession, path: str) -> DataFrame:
    """Raw events from Parquet laid out as `event_date=yyyyMMdd/`.

    The explicit schema keeps the partition value a string and the nested reads narrow:
    a filter on `event_date` becomes a partition filter, unused struct leaves are not read.
    """
    return spark.read.schema(RAW_EVENT).parquet(path)


def between_days(raw: DataFrame, date_from: str | None, date_to: str | None) -> DataFrame:
    """Keep the inclusive `yyyyMMdd` range on the partition column."""
    if date_from is not None:
        raw = raw.where(F.col("event_date") >= date_from)
    if date_to is not None:
        raw = raw.where(F.col("event_date") <= date_to)
    return raw


#: Of the files written. Keys are hashes in hex digits, which the default codec leaves at twice their size.
CODEC = "zstd"


@dataclass(frozen=True)
class Layout:
    """How a table's files are laid out.

    day: partition column. cluster: sort column inside each file, so that the Parquet
    statistics let a filter on it skip most row groups. rebalance: shuffle by day before
    writing, for rows that do not arrive by day; days of ordinary size then land in one file
    and a day holding much of the data is split over several tasks. bucket: column by whose hash
    the rows lie in `buckets` files, each sorted by it, so that tables with the same column and
    number join, and group, without a shuffle; for tables that are not split by day.
    """

    day: str | None = None
    cluster: str | None = None
    rebalance: bool = False
    bucket: str | None = None
    buckets: int = 0

    def __post_init__(self):
        if self.bucket is not None and (self.day is not None or self.buckets < 1):
            raise ValueError("a bucketed table is not split by day and has a number of buckets")


def laid_out(df: DataFrame, layout: Layout) -> DataFrame:
    """The rows as the writer wants them."""
    if layout.bucket is not None:
        return df.repartition(layout.buckets, layout.bucket)
    if layout.rebalance:
        df = df.hint("rebalance", layout.day)
    if layout.cluster is not None:
        df = df.sortWithinPartitions(*filter(None, (layout.day, layout.cluster)))
    return df


def write_export(df: DataFrame, path: str, layout: Layout) -> None:
    """Write plain files by day, as the raw export comes. `versions.publish` is for tables that are replaced."""
    writer = laid_out(df, layout).write.mode("overwrite").option("compression", CODEC)
    if layout.day is not None:
        writer = writer.partitionBy(layout.day)
    writer.parquet(path)
