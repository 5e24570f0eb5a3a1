"""Tasks run where the package is not: a session from another folder, whose workers cannot import it."""

import os
import subprocess
import sys

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
import __spark_entry__ as entry

def known(batches):
    import importlib.util
    for batch in batches:
        assert importlib.util.find_spec("hitledger") is None
        yield batch

spark.range(1).mapInArrow(known, "id long").collect()
for name in {names!r}:
    print(name, entry.queries()[name](spark, "/root/testdata/sf0.001").count())
"""
NAMES = ["op1_token_output", "op4_language_cnn", "op8_decontaminate", "op11_toxicity_cnn", "op12_fill_in_middle", "op13_spill_alignment"]


def test_workers_without_the_package(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "PYSPARK_GATEWAY_PORT", "PYSPARK_GATEWAY_SECRET")}
    tools = os.path.dirname(os.path.dirname(__import__("public_tokenizers").__file__))
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(repo=repo, names=NAMES)], cwd=tmp_path, env=env | {"PYTHONPATH": tools}, capture_output=True, text=True, timeout=600,
    )
    assert run.returncode == 0, run.stderr[-3000:]
    assert [line.split()[0] for line in run.stdout.splitlines() if line.startswith("op")] == NAMES
