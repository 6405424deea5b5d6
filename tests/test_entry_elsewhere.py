"""The driver contract from a process started in another folder with a plain session: the
Python steps that run inside tasks must not need the package to be importable there."""

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
spark.sparkContext.setLogLevel("ERROR")
import __spark_entry__ as E
qs = E.queries()
print("entry", E.entry(spark).count())
print("pacf", qs["e9_pacf_yw_72"](spark, "/root/testdata/sf0.01").count())
print("lags", qs["i4_streaming_lags"](spark, "/root/testdata/sf0.001").count())
spark.stop()
"""


def test_python_steps_run_without_the_package_on_the_workers_path():
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    cwd = tempfile.mkdtemp(prefix="airshed-elsewhere-")
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True,
                         text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-3000:]
    lines = dict(ln.split() for ln in out.stdout.splitlines() if ln.split()[:1] in (["entry"], ["pacf"], ["lags"]))
    assert int(lines["entry"]) > 0 and int(lines["pacf"]) == 4 * 73 and int(lines["lags"]) > 0
