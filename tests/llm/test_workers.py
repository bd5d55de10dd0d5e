"""Executors need no copy of the package: tasks carry what they run."""
import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
CODE = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config(
    "spark.sql.shuffle.partitions", "2").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
from costledger.llm.queries import QUERIES
for name, query in QUERIES.items():
    query(spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
print("DONE", len(QUERIES))
"""


def test_queries_run_from_another_folder():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", CODE, REPO], cwd=tempfile.mkdtemp(prefix="elsewhere-"), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "DONE 13" in out.stdout, out.stderr[-2000:]
