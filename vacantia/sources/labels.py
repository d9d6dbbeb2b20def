"""The label list of occupations: built from a tree of concepts, written as a snapshot, and loaded with its faults refused."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("isco_code", "label", "label_kind")
# Fixed value: how a concept's address tells its four-digit code.
CODE = r"/isco/C(\d{4})$"


class LabelError(ValueError):
    """A label list that cannot be used."""


def load(spark: SparkSession, path: str) -> DataFrame:
    """isco_code, label, label_kind of a snapshot; raises if columns are missing, codes are malformed or there are no rows."""
    rows = spark.read.parquet(path)
    missing = [c for c in COLUMNS if c not in rows.columns]
    if missing:
        raise LabelError(f"{path}: no column {', '.join(missing)}")
    rows = rows.select(*COLUMNS)
    told = rows.agg(F.count("*").alias("n"), F.count_if(~F.coalesce(F.col("isco_code").rlike(r"^\d{4}$"), F.lit(False))).alias("bad")).first()
    if not told["n"] or told["bad"]:
        raise LabelError(f"{path}: {told['n']} labels, {told['bad']} with malformed codes")
    return rows


def walk(edges: DataFrame, root: str) -> DataFrame:
    """node: all concepts below ``root``, itself included, over ``edges`` (parent, child). Trees and graphs without cycles end."""
    return edges.sparkSession.sql(
        "WITH RECURSIVE w(node) AS (SELECT {root} AS node UNION ALL SELECT e.child FROM w JOIN {edges} e ON e.parent = w.node) SELECT DISTINCT node FROM w",
        edges=edges, root=root,
    )


def from_concepts(concepts: DataFrame, narrower: DataFrame, occupations: DataFrame, root: str) -> DataFrame:
    """isco_code, label, label_kind of the four-digit concepts below ``root``.

    ``concepts`` (uri, title), ``narrower`` (parent, child) and ``occupations`` (parent, title). A leaf gives its own
    title as preferred and the titles of its occupations as alternatives; blank titles give nothing."""
    leaves = walk(narrower, root).select(F.col("node").alias("uri"), F.regexp_extract("node", CODE, 1).alias("isco_code")).filter("isco_code <> ''")
    own = leaves.join(concepts, "uri").select("isco_code", F.col("title").alias("label"), F.lit("preferred").alias("label_kind"))
    more = leaves.join(occupations, leaves["uri"] == occupations["parent"]).select("isco_code", F.col("title").alias("label"), F.lit("alt").alias("label_kind"))
    return distinct_labels(own.unionByName(more).filter("trim(label) <> ''"))


def distinct_labels(labels: DataFrame) -> DataFrame:
    """Of rows alike in code and lower-case label the one that comes first by (label_kind, label)."""
    first = labels.groupBy("isco_code", F.lower("label").alias("_l")).agg(F.min(F.struct("label_kind", "label")).alias("m"))
    return first.select("isco_code", "m.label", "m.label_kind")


def write(labels: DataFrame, path: str) -> None:
    """A snapshot, distinct and in order (isco_code, label_kind, label), in one file: a reference list fits one task."""
    distinct_labels(labels).coalesce(1).sortWithinPartitions("isco_code", "label_kind", "label").select(*COLUMNS).write.mode("overwrite").parquet(path)
