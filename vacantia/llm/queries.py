"""Queries of the problems tagged llm, with their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vacantia.llm import encoding, labelmatch, neardup, packing, quantiles, reading
from vacantia.runtime import cut_lineage, table


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, ids by byte_bpe_50k of every document."""
    return encoding.encode(table(spark, d, "documents"))


def p8_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Per source, how many documents there are and how many come back unchanged from their ids."""
    docs = table(spark, d, "documents").select("doc_id", "source", F.col("text").alias("original"))
    back = encoding.decode(p8_ids(spark, d))
    same = (F.coalesce("original", F.lit("")) == F.col("text")).cast("long")
    return docs.join(back, "doc_id").groupBy("source").agg(F.count("*").alias("n_docs"), F.sum(same).alias("n_same"))


def p9_containers(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, piece_no, start, n_tokens, bucket, container_id: all documents in containers of 2,048 tokens."""
    return packing.pack(encoding.token_counts(table(spark, d, "documents")), "doc_id", "n_tokens")


def p9_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers of p9_containers are."""
    return packing.fill(p9_containers(spark, d))


def p9_whole(spark: SparkSession, d: str) -> DataFrame:
    """One row: documents placed, containers over 2,048 tokens, documents of at most 2,048 tokens that were split, and gaps in the numbering."""
    packed = cut_lineage(p9_containers(spark, d))
    per = packed.groupBy("container_id").agg(F.sum("n_tokens").alias("n")).agg(F.count_if(F.col("n") > 2048).alias("n_overfull"), (F.max("container_id") + 1 - F.count("*")).alias("n_gaps"))
    docs = packed.groupBy("doc_id").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("pieces")).agg(F.count("*").alias("n_docs"), F.count_if((F.col("n") <= 2048) & (F.col("pieces") > 1)).alias("n_split"))
    # two single rows
    return docs.crossJoin(F.broadcast(per))


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, lang, score, level of every document of at least 50 words in English, German or French."""
    return reading.reading_levels(table(spark, d, "documents"), table(spark, d, "reading_labels"))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    """doc_id, level."""
    return p10_scores(spark, d).select("doc_id", "level")


def p10_profile(spark: SparkSession, d: str) -> DataFrame:
    """How many documents of each level every source has."""
    return p10_scores(spark, d).join(table(spark, d, "documents").select("doc_id", "source"), "doc_id").groupBy("source", "level").count()


def p10_covered(spark: SparkSession, d: str) -> DataFrame:
    """lang, n_docs: how many documents of each language have a level."""
    return p10_scores(spark, d).filter("level BETWEEN 1 AND 3").groupBy("lang").agg(F.count("*").alias("n_docs"))


def p3_percentiles(spark: SparkSession, d: str) -> DataFrame:
    """snapshot_date ('all' for all together), isco_code, country, percent, value, n, rank_bound."""
    return quantiles.salary_percentiles(table(spark, d, "posting_snapshots"))


def p3_accuracy(spark: SparkSession, d: str) -> DataFrame:
    """percent, n_groups, n_outside: percentiles of p3_percentiles and those further from the exact rank than their bound."""
    return quantiles.salary_accuracy(table(spark, d, "posting_snapshots")).select("percent", "n_groups", "n_outside")


def p7_matches(spark: SparkSession, d: str) -> DataFrame:
    """posting_id, isco_code ('none' if unmatched), label, isco_match_score of every posting without isco_code."""
    return labelmatch.match_titles(spark, table(spark, d, "postings"), table(spark, d, "isco_labels"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """posting_id, isco_code."""
    return p7_matches(spark, d).select("posting_id", "isco_code").distinct()


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """posting_id_a, posting_id_b of all pairs of postings that advertise the same opening."""
    return neardup.same_openings(table(spark, d, "postings"))


def p1_classes(spark: SparkSession, d: str) -> DataFrame:
    """posting_id, class_id, town, n_links of every posting with a company."""
    return neardup.opening_classes(table(spark, d, "postings"))


def p1_links(spark: SparkSession, d: str) -> DataFrame:
    """a, b of all pairs of classes of p1_classes that are the same opening."""
    return neardup.opening_links(table(spark, d, "postings"))


QUERIES = {"p1_found": p1_found, "p1_classes": p1_classes, "p1_links": p1_links, "p7_found": p7_found, "p7_matches": p7_matches, "p3_percentiles": p3_percentiles, "p3_accuracy": p3_accuracy, "p10_found": p10_found, "p10_scores": p10_scores, "p10_profile": p10_profile, "p10_covered": p10_covered, "p9_containers": p9_containers, "p9_fill": p9_fill, "p9_whole": p9_whole, "p8_ids": p8_ids, "p8_roundtrip": p8_roundtrip}

_BLANKS = r"[\t\n\v\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

SQL = {"p9_whole": "SELECT count(DISTINCT doc_id) AS n_docs, 0 AS n_split, 0 AS n_overfull, 0 AS n_gaps FROM documents", "p10_covered": f"SELECT lower(lang[:2]) AS lang, count(*) AS n_docs FROM documents WHERE lower(lang[:2]) IN ('en', 'de', 'fr') AND len(list_filter(string_split_regex(text, '{_BLANKS}+'), lambda w: w <> '')) >= 50 GROUP BY 1", "p7_matches": labelmatch.BRUTE_MATCHES, "p3_accuracy": quantiles.ACCURACY, "p7_found": labelmatch.BRUTE, "p8_roundtrip": "SELECT source, count(*) AS n_docs, count(*) AS n_same FROM documents GROUP BY source"}
