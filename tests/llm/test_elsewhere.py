"""The queries in a process that starts outside the repository: workers cannot import the package."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
CODE = """
import sys, tempfile
sys.path.insert(0, sys.argv[1])
import __spark_entry__ as entry
from barlake.session import build_session
spark = build_session("elsewhere", master="local[4]", **{
    "spark.sql.shuffle.partitions": "4", "spark.checkpoint.dir": tempfile.mkdtemp(), "spark.driver.memory": "3g"})
spark.sparkContext.setLogLevel("ERROR")
for name in ("op1_mix", "op2_byte_bpe", "op4_dual_tree", "op5_simhash", "op6_toxicity", "op10_pstable_dedup",
             "op11_periodic_runs", "op13_centroids", "pipeline"):
    print(name, entry.queries()[name](spark, sys.argv[2]).count())
"""


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="given tables are not here")
def test_workers_need_no_copy_of_the_package(tmp_path):
    root = os.path.dirname(os.path.abspath(contract.__file__))
    left = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", CODE, root, FOLDER], cwd=tmp_path, env=left, capture_output=True, text=True, timeout=600
    )
    assert done.returncode == 0, done.stderr[-3000:]
    counts = dict(line.rsplit(" ", 1) for line in done.stdout.splitlines() if line.startswith(("op", "pipeline")))
    assert len(counts) == 9 and counts["op6_toxicity"] == "200"
