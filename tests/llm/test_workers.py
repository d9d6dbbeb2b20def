"""Operators on a user's own frames, in a plain session whose workers cannot import the package by themselves."""

import os
import subprocess
import sys

from conftest import ROOT

CODE = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
from vacantia.llm import encoding, neardup, packing, quantiles
docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
assert {{r["doc_id"]: len(r["ids"]) for r in encoding.encode(docs).collect()}}[2] == 0
assert packing.pack(encoding.token_counts(docs), "doc_id", "n_tokens").count() == 2
assert quantiles.percentiles(quantiles.partials(docs.selectExpr("text", "doc_id * 1.0D AS v"), ["text"], "v"), ["text"]).count() == 2
rows = spark.createDataFrame([("a", "Network Technician", "Gritiholm", None), ("b", "Network Technicain", "Gritiholm", None)], "posting_id string, title string, company string, location_raw string")
assert neardup.same_openings(rows).count() == 1
from vacantia.operators import nested_tables, similarity
assert nested_tables.board_trees(docs.selectExpr("doc_id AS envelope_id", "text AS payload"), docs.selectExpr("doc_id AS envelope_id", "array(struct(doc_id AS id)) AS jobs")).count() == 2
labels = spark.createDataFrame([("2221", "network technicians", "preferred")], "isco_code string, label string, label_kind string")
assert similarity.best_labels(rows.select("title"), labels).count() == 2
"""


def test_workers_are_served_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH" and not k.startswith("SPARK")}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
