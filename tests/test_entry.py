"""The driver's contract: the package reaches Python workers that don't have its folder."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

# the driver finds the package by its own path, workers start without it
CODE = f"""
import sys
sys.path.insert(0, {ROOT!r})
import __spark_entry__
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
print("rows", __spark_entry__.queries()["q_root_tags"](spark, "/root/testdata/sf0.001").count())
"""


def test_workers_get_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows " in run.stdout, run.stderr[-2000:]
