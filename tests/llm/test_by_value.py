"""Tasks get their functions by value: workers that cannot import the repository run every query."""

import os
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
import __spark_entry__
for name, query in __spark_entry__.queries().items():
    if name.startswith("op"):
        print(name, query(spark, "/root/testdata/sf0.001").count() > 0)
"""


def test_workers_without_the_repository(tmp_path):
    repo = str(Path(__file__).parents[2])
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.count("True") == 13, done.stderr[-2000:]
