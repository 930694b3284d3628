"""The operators on workers that don't have the repository on their path."""

import os
import subprocess
import sys

REPO = os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..")

SCRIPT = """
import sys
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
spark.range(1).rdd.map(lambda r: 1).collect()
sys.path.insert(0, sys.argv[1])
from pyspark.sql import functions as F
import corpus_pipeline
from cyclograph.llm.queries import QUERIES

def absent(_):
    import importlib.util
    return importlib.util.find_spec("cyclograph") is None

assert spark.sparkContext.parallelize([1]).map(absent).first()
folder = "/root/testdata/sf0.001"
for name in ("op2_language_id", "op10_benchmark_decontamination", "op11_quality_classifier", "op12_embedding_whitening", "op13_token_alignment"):
    assert QUERIES[name](spark, folder).count() > 0, name
docs = spark.read.parquet(folder + "/documents.parquet")
assert corpus_pipeline.language(spark, docs, folder).count() > 0
print("all ran")
"""


def test_no_repository_on_the_workers(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT, os.path.abspath(REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "all ran" in run.stdout, run.stderr[-3000:]
