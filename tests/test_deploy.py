"""The driver may import the entry module from any working directory with its
own plain session: pandas functions must still find the package on the
Python workers (shipped with addPyFile)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import sys
sys.path.insert(0, {REPO!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
import __spark_entry__ as E
n = E.queries()["isolation_forest_pipeline"](spark, "/root/testdata/sf0.001").count()
m = E.entry(spark).count()
print("RESULT", n, m)
"""


def test_pandas_queries_run_from_another_directory_in_a_plain_session():
    with tempfile.TemporaryDirectory(prefix="orbitlens-deploy-") as d:
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        r = subprocess.run([sys.executable, "-c", SCRIPT], cwd=d, env=env, capture_output=True,
                           text=True, timeout=600)
    line = [ln for ln in r.stdout.splitlines() if ln.startswith("RESULT")]
    assert line, r.stderr[-2000:]
    _, n, m = line[0].split()
    assert int(n) >= 0 and int(m) > 0
