"""Exact quantiles per group that hold no group in memory or in one task.

Values are first counted per group (combined before the shuffle, so a hot group comes as its distinct values). Bands of
near values are summed up, a few thousand per group at most, to find the bands that hold the quantile; only their values are
then put in order. So the largest group is as spread out as its values are."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bands per factor of e: values of one band differ by less than 1 %.
BANDS = 128


def exact_quantile(rows: DataFrame, keys: list[str], value: str, share: float, to: str = "p50", n: str = "n") -> DataFrame:
    """``keys``, ``to`` (the quantile, interpolated between neighbours) and ``n`` (how many values), per group.

    Null values take no part; groups without any have no row. Null keys are groups like others. NaN counts as the
    greatest value."""
    counted = rows.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(F.count("*").alias("_c"))
    size = F.col("_v").cast("double")
    band = F.when(F.isnan(size), F.lit(2**62)).otherwise(F.floor(F.signum(size) * F.log1p(F.abs(size)) * BANDS))
    counted = counted.withColumn("_b", band)
    by = Window.partitionBy(*keys)
    sums = counted.groupBy(*keys, "_b").agg(F.sum("_c").alias("_s"))
    run = F.sum("_s").over(by.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = sums.withColumn("_end", run).withColumn("_n", F.sum("_s").over(by))
    at = (F.col("_n") - 1) * share
    low, high = F.floor(at), F.ceil(at)

    def holds(p, size):
        return (F.col("_end") > p) & (F.col("_end") - size <= p)

    # the one or two bands of each group that hold the neighbours of the quantile
    bands = placed.filter(holds(low, F.col("_s")) | holds(high, F.col("_s"))).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_kb"), (F.col("_end") - F.col("_s")).alias("_start"), "_n")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)], F.col("_b") == F.col("_kb"))
    near = counted.join(bands, same).select(*keys, "_v", "_c", "_b", "_start", "_n")
    within = F.sum("_c").over(Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    near = near.withColumn("_end", F.col("_start") + within)
    ends = near.filter(holds(low, F.col("_c")) | holds(high, F.col("_c"))).groupBy(*keys).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"), F.max("_n").alias(n))
    part = (F.col(n) - 1) * share - F.floor((F.col(n) - 1) * share)
    return ends.select(*keys, F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.col("_low") + (F.col("_high") - F.col("_low")) * part).alias(to), n)
