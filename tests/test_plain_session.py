"""The registered queries in a session that names no shared folder, as a smoke test starts it."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__ as entry
assert spark.conf.get("spark.checkpoint.dir", None) is None
assert entry.entry(spark).count() > 0
"""


def test_flagship_runs_without_a_named_shared_folder(tmp_path):
    root = Path(__file__).resolve().parents[1]
    plain = {**os.environ, "SPARK_CONF_DIR": str(tmp_path)}  # no defaults of the machine
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=root, env=plain, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
