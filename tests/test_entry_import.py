"""The driver may import __spark_entry__.py by path from another directory,
with a plain session: every query must still run (no Python worker may need
to import this package)."""
import os
import subprocess
import sys
import tempfile

SCRIPT = r'''
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry_mod", sys.argv[1])
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("entry", E.entry(spark).count())
print("ingest", E.queries()["ingest_summary"](spark, "/root/testdata/sf0.001").first()["n_ingested"])
'''


def test_entry_runs_from_another_directory():
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    cwd = tempfile.mkdtemp(prefix="costledger-entry-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT, os.path.join(here, "__spark_entry__.py")],
                         cwd=cwd, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "entry 63" in out.stdout and "ingest 5" in out.stdout
