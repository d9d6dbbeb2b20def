"""The helpers keep rows, partitioning and single evaluation."""

from pyspark.sql import functions as F

from vacantia import runtime


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_blanks(spark):
    df = spark.createDataFrame([("  a \tb \n",), ("",), (None,), (" 　",)], "v string")
    got = df.select(runtime.strip_blanks(F.col("v")).alias("s"), runtime.squash_blanks(F.col("v")).alias("q")).collect()
    assert [tuple(r) for r in got] == [("a \tb", "a b"), ("", ""), (None, None), ("", "")]


def test_once_keeps_rows_and_is_not_merged(spark):
    df = spark.range(5).withColumn("v", F.when(F.col("id") > 1, F.col("id")))
    x = runtime.once(df, "w", F.regexp_replace(F.col("v").cast("string"), "(.)", "$1$1"))
    y = x.filter("w <> 'x' OR w IS NULL").select("id", F.concat("w", "w").alias("z"), F.length("w").alias("n"))
    assert y.count() == 5 and y.filter("z IS NULL").count() == 2
    assert plan(y).count("regexp_replace") == 1


def test_partitioning_outlives_the_cut(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), "id")
    cut = runtime.cut_partitioned(df, "k")
    sums = cut.groupBy("k").agg(F.sum("id").alias("s"))
    joined = cut.join(sums, "k")
    assert "hashpartitioning" not in plan(sums) and "hashpartitioning" not in plan(joined)
    assert joined.count() == 100 and spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_cut_lineage_reads_what_was_written(spark):
    df = runtime.cut_lineage(spark.range(10).filter("id > 3"))
    assert df.count() == 6 and "ExistingRDD" in plan(df)
