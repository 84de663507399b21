"""The package reaches Python workers of a driver that was started elsewhere."""

import subprocess
import sys
from pathlib import Path

CODE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()
import __spark_entry__
print('rows', __spark_entry__.queries()['text_similarity'](spark, '/root/testdata/sf0.001').count(), __spark_entry__.queries()['text_similarity'](spark, '/root/testdata/sf0.001').agg({{'score': 'max'}}).first()[0])
"""


def test_workers_find_the_package(tmp_path):
    root = str(Path(__file__).parents[1])
    done = subprocess.run([sys.executable, "-c", CODE.format(root=root)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]
