"""Tables whose files are only added; a manifest says which of them are the table.

A write goes to a folder of its own, `version=<id>`, and becomes the table when the next numbered
manifest appears. So a write that fails leaves the table as it was, readers of the old version
go on undisturbed, and of two writers that start from the same manifest one gets an error. A table split by
day can have single days replaced: the manifest then takes those days from the new version and all
others from where they are, and no other day is read or written.

Counts asked for (`measures`) are gathered by the write itself and kept in the manifest.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.sources.raw import CODEC, Layout, laid_out

MANIFESTS = "manifests"
VERSION = "version"


class Conflict(RuntimeError):
    """Somebody else changed the table since the manifest that this write started from."""


@dataclass(frozen=True)
class Manifest:
    """number: of this state of the table. parts: the version that each day is taken from, or the one
    of the whole table under "". measures: what each version counted when it was written, in all its days."""

    number: int
    schema: str
    day: str | None
    parts: dict[str, str]
    bucket: str | None = None
    buckets: int = 0
    written: dict[str, list[str]] = field(default_factory=dict)
    measures: dict[str, dict[str, int]] = field(default_factory=dict)

    def folders(self, path: str) -> list[str]:
        tail = lambda day: f"/{self.day}={day}" if self.day else ""
        return [f"{path}/{VERSION}={version}{tail(day)}" for day, version in sorted(self.parts.items())]

    def measured(self) -> dict[str, int] | None:
        """Counts over the whole table; None where a version counted days that were since replaced."""
        total: dict[str, int] = {}
        for version in set(self.parts.values()):
            if {d for d, v in self.parts.items() if v == version} != set(self.written.get(version, [])):
                return None
            for name, count in self.measures.get(version, {}).items():
                total[name] = total.get(name, 0) + count
        return total


class _Files:
    """The few operations on a Hadoop file system that manifests need."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.jvm = spark, spark.sparkContext._jvm
        self.hadoop = self.jvm.org.apache.hadoop.fs
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.system = self.path(path).getFileSystem(self.conf)

    def path(self, name: str):
        return self.hadoop.Path(name)

    def list(self, folder: str) -> list[tuple[str, int]]:
        """Names and modification times in milliseconds; none where there is no such folder."""
        if not self.system.exists(self.path(folder)):
            return []
        return [(f.getPath().getName(), f.getModificationTime()) for f in self.system.listStatus(self.path(folder))]

    def read(self, name: str) -> str:
        return self.spark.read.text(name, wholetext=True).first()[0]

    def create(self, name: str, text: str) -> None:
        """The whole file at once, or FileExistsError if there is one of that name."""
        hidden = f"{name.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        out = self.system.create(self.path(hidden), False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        context = self.hadoop.FileContext.getFileContext(self.system.getUri(), self.conf)
        never = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.path(hidden), self.path(name), never)
        except Exception as error:
            self.delete(hidden)
            if "FileAlreadyExists" in str(error):
                raise FileExistsError(name) from None
            raise

    def delete(self, name: str) -> None:
        self.system.delete(self.path(name), True)


def current(spark: SparkSession, path: str) -> Manifest | None:
    """The newest manifest; None where nothing was published."""
    files = _Files(spark, path)
    names = sorted(name for name, _ in files.list(f"{path}/{MANIFESTS}") if name.endswith(".json"))
    return Manifest(**json.loads(files.read(f"{path}/{MANIFESTS}/{names[-1]}"))) if names else None


def read_version(spark: SparkSession, path: str, manifest: Manifest | None = None) -> DataFrame:
    """The table as a manifest has it, the newest one unless given."""
    manifest = manifest or current(spark, path)
    if manifest is None:
        raise AnalysisException(f"no table was published at {path}")
    schema = T.StructType.fromJson(json.loads(manifest.schema))
    stored = T.StructType([*[f for f in schema.fields if f.name != manifest.day], T.StructField(VERSION, T.StringType())])
    if manifest.day:
        stored.add(schema[manifest.day])
    folders = manifest.folders(path)
    if not folders:
        return spark.createDataFrame([], schema)
    if manifest.bucket:
        # Only a table of the session's catalog can say how its files are dealt.
        (version,) = manifest.parts.values()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {_table(version)} ({columns}) USING parquet CLUSTERED BY (`{manifest.bucket}`)"
            f" SORTED BY (`{manifest.bucket}`) INTO {manifest.buckets} BUCKETS LOCATION '{folders[0]}'"
        )
        return spark.table(_table(version)).select(*schema.names)
    return spark.read.schema(stored).option("basePath", path).parquet(*folders).select(*schema.names)


def _table(version: str) -> str:
    return f"bucketed_{version}"


def publish(
    df: DataFrame,
    path: str,
    layout: Layout = Layout(),
    measures: Mapping[str, Column] | None = None,
    days: tuple[str, str] | None = None,
) -> DataFrame:
    """Write a new version, make it the table, and read the table back, which also ends the lineage.

    days: an inclusive range of days, as the partition's folders name them. Only rows of those days are
    written, and only those days are replaced; one of them without rows is then gone from the table.
    measures: aggregates over the written rows, named; the write gathers them without a scan of its own.
    """
    spark = df.sparkSession
    base = current(spark, path)
    version = uuid.uuid4().hex
    if days is not None:
        if layout.day is None:
            raise ValueError("only a table split by day can have days replaced")
        df = df.where(F.col(layout.day).cast("string").between(*days))
    rows = laid_out(df, layout)
    seen = Observation(f"{VERSION}-{version}") if measures else None
    if seen is not None:
        # Above the last shuffle, so that each row is counted by the task whose file is kept.
        rows = rows.observe(seen, *[value.alias(name) for name, value in measures.items()])
    folder = f"{path}/{VERSION}={version}"
    writer = rows.write.option("compression", CODEC)
    if layout.bucket is not None:
        writer.bucketBy(layout.buckets, layout.bucket).sortBy(layout.bucket).option("path", folder).saveAsTable(_table(version))
    else:
        writer = writer if layout.day is None else writer.partitionBy(layout.day)
        writer.parquet(folder)
    files = _Files(spark, path)
    if layout.day is None:
        written = [""]
    else:
        head = f"{layout.day}="
        written = sorted(name.removeprefix(head) for name, _ in files.list(f"{path}/{VERSION}={version}") if name.startswith(head))
    parts = {day: version for day in written}
    if days is not None and base is not None:
        parts = {d: v for d, v in base.parts.items() if not days[0] <= d <= days[1]} | parts
    used = set(parts.values()) | {version}
    carried = {v: d for v, d in (base.written if base else {}).items() if v in used}
    counted = {v: m for v, m in (base.measures if base else {}).items() if v in used}
    if seen is not None and written:
        counted[version] = {name: int(n or 0) for name, n in seen.get.items()}
    manifest = Manifest(
        number=base.number + 1 if base else 1,
        schema=df.schema.json(),
        day=layout.day,
        parts=parts,
        bucket=layout.bucket,
        buckets=layout.buckets,
        written=carried | {version: written},
        measures=counted,
    )
    try:
        files.create(f"{path}/{MANIFESTS}/{manifest.number:09d}.json", json.dumps(asdict(manifest)))
    except FileExistsError:
        raise Conflict(f"{path} was changed during the write; version {version} is not part of it") from None
    return read_version(spark, path, manifest)


def vacuum(spark: SparkSession, path: str, keep: int = 1, older_than_hours: float = 24.0) -> list[str]:
    """Delete versions that none of the last `keep` manifests uses and that are older than a running write may be.

    Older manifests go as well. Returns the versions that were deleted.
    """
    files, horizon = _Files(spark, path), (time.time() - older_than_hours * 3600) * 1000
    names = sorted(name for name, _ in files.list(f"{path}/{MANIFESTS}") if name.endswith(".json"))
    used = {v for name in names[-keep:] for v in json.loads(files.read(f"{path}/{MANIFESTS}/{name}"))["parts"].values()}
    for name in names[:-keep]:
        files.delete(f"{path}/{MANIFESTS}/{name}")
    head, gone = f"{VERSION}=", []
    for name, changed in files.list(path):
        version = name.removeprefix(head)
        if name.startswith(head) and version not in used and changed <= horizon:
            spark.sql(f"DROP TABLE IF EXISTS {_table(version)}")
            files.delete(f"{path}/{name}")
            gone.append(version)
    return sorted(gone)
