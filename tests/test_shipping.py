"""Queries with Python workers run wherever the driver was started."""

import os
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
SCRIPT = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
import __spark_entry__ as e
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate()
for name in ("label_normal", "stream_vs_batch_asof"):
    print(name, e.queries()[name](spark, "/root/testdata/sf0.001").count() > 1000)
"""


def test_workers_find_the_package_from_any_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "label_normal True" in done.stdout and "stream_vs_batch_asof True" in done.stdout, done.stderr[-2000:]
