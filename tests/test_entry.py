"""The driver contract from a foreign working directory and a session without spark.checkpoint.dir."""

import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = r'''
import importlib.util, sys
spec = importlib.util.spec_from_file_location("entry_mod", sys.argv[1])
m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spark.sparkContext.setLogLevel("ERROR")
assert spark.conf.get("spark.checkpoint.dir", None) is None
rows = m.entry(spark).collect()
q, o = m.queries(), m.oracle_sql()
assert set(o) <= set(q)
n = q["knn_cosine"](spark, "/root/testdata/sf0.001").count()
print("RESULT", len(rows), n, len(q), len(o))
'''


def test_entry_from_foreign_cwd_without_checkpoint_conf():
    if not os.path.isdir("/root/testdata/sf0.001"):
        import pytest
        pytest.skip("driver test data not available")
    work = tempfile.mkdtemp(prefix="pubstrata-entry-")
    conf = tempfile.mkdtemp(prefix="pubstrata-conf-")  # empty: no spark-defaults
    env = dict(os.environ, SPARK_CONF_DIR=conf)
    env.pop("PYTHONPATH", None)
    p = subprocess.run([sys.executable, "-c", SCRIPT, os.path.join(ROOT, "__spark_entry__.py")], cwd=work, env=env,
                       capture_output=True, text=True, timeout=600)
    line = [x for x in p.stdout.splitlines() if x.startswith("RESULT")]
    assert line, p.stderr[-2000:]
    _, n_entry, n_knn, n_q, n_o = line[0].split()
    assert int(n_entry) == 18 and int(n_knn) > 0 and int(n_q) >= 80 and int(n_o) >= 50
