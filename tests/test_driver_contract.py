"""The driver imports __spark_entry__ from elsewhere and builds its own bare session."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r'''
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry_mod", sys.argv[1] + "/__spark_entry__.py")
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
print("ENTRY", m.entry(spark).count())
print("W2", m.queries()["inst_speed_stateful"](spark, "/root/testdata/sf0.001").count())
'''


def test_queries_run_from_another_directory(tmp_path):
    out = subprocess.run([sys.executable, "-c", SCRIPT, REPO], cwd=str(tmp_path), capture_output=True,
                         text=True, timeout=600, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert "ENTRY 911" in out.stdout, out.stderr[-2000:]
    assert "W2 506" in out.stdout, out.stderr[-2000:]
