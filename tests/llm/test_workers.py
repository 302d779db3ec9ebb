"""Workers that can't import this repository, as on a cluster that has no copy of it."""
import importlib
import os
import subprocess
import sys
from pathlib import Path

from cairn.llm import queries

REPO = str(Path(__file__).resolve().parents[2])
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})  # the driver's path alone
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", {folder!r}).getOrCreate()
assert spark.range(1).rdd.map(lambda _: __import__("importlib.util").util.find_spec("cairn") is None).first()
from cairn.llm import queries
import corpus_pipeline
for name, query in queries.queries().items():
    assert query(spark, {sf!r}).count() > 0 or name == "op10_decontaminate", name
docs = spark.read.parquet({sf!r} + "/documents.parquet")
assert corpus_pipeline.drop_leaks(spark, docs, {sf!r}).count() < docs.count()
print("done")
"""


def test_every_query_without_the_repository_on_the_workers_path(sf_tiny, tmp_path):
    env = {k: v for k, v in os.environ.items() if k not in ("PYTHONPATH", "SPARK_HOME_CONF")}
    script = tmp_path / "run.py"
    script.write_text(SCRIPT.format(repo=REPO, folder=str(tmp_path / "checkpoint"), sf=sf_tiny))
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "done" in done.stdout, done.stderr[-3000:]


def test_no_function_travels_by_name():
    """A cached function is pickled by its name, which workers without the repository can't look up."""
    for module in queries.MODULES.values():
        own = vars(importlib.import_module(f"cairn.llm.{module}"))
        assert not [name for name, x in own.items() if hasattr(x, "cache_info")], module
