"""Folders that driver and executors share, for intermediate tables and written files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Only where none is named, as in local tests, one is made and set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if found is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="eventloom-llm-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, lineage ends there."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
