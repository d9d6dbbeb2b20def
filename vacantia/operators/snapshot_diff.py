"""Problem 4: what changed between consecutive full snapshots.

Method: EXCEPT ALL in both directions removes the rows that are alike in two consecutive snapshots; a full
join of what is left, by key, labels each key as added, removed or changed.

The rows are brought to their keys once: the newest delivery per (snapshot, key) is found with a map-side
combine, the winners are partitioned by key, and both sides of every later set operation and join keep
that partitioning, so neither EXCEPT ALL nor the full join moves the table again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from vacantia.runtime import squash_blanks


def latest_per_key(df: DataFrame, keys: list[str], order: str, keep: list[str]) -> DataFrame:
    """One row per ``keys``: the values ``keep`` of the row with the greatest ``order``.

    Rows with a null key are left out; a null ``order`` is the oldest; rows equal in ``order`` are decided by
    the greatest values, so that the result never depends on the order of delivery. A hot key is combined
    before it is shuffled."""
    ranked = F.struct(F.col(order).alias("_o"), *[F.col(c).alias(f"_v{i}") for i, c in enumerate(keep)])
    live = df.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    best = live.groupBy(*keys).agg(F.max(ranked).alias("_best"))
    return best.select(*keys, *[F.col(f"_best._v{i}").alias(c) for i, c in enumerate(keep)])


def consecutive(df: DataFrame, snapshot: str) -> DataFrame:
    """(snapshot, next snapshot), one row per snapshot but the last. Their number is bounded by the calendar."""
    days = df.filter(F.col(snapshot).isNotNull()).select(snapshot).distinct()
    later = F.lead(snapshot).over(Window.orderBy(snapshot))
    return days.select(F.col(snapshot).alias("_this"), later.alias("_next")).filter("_next is not null")


def snapshot_changes(df: DataFrame, snapshot: str, key: str, order: str, compare: dict[str, Column]) -> DataFrame:
    """(``snapshot``, ``key``, change), change being ``added``, ``removed`` or ``changed``.

    ``compare`` maps a name to the expression over the delivered columns that two snapshots are compared by;
    null equals null. ``snapshot`` is the later of the two. The first snapshot gives no rows; a key absent
    from one snapshot and back in a later one is removed and then added. Empty input gives no rows; other
    columns of ``df`` are never read. Rows with a null snapshot or key are left out."""
    names = list(compare)
    newest = latest_per_key(df.select(snapshot, key, order, *[v.alias(f"_c_{n}") for n, v in compare.items()]), [snapshot, key], order, [f"_c_{n}" for n in names])
    placed = newest.repartition(F.col(key))
    days = consecutive(df, snapshot)
    values = [F.col(f"_c_{n}") for n in names]
    new = placed.join(F.broadcast(days.select(F.col("_next").alias(snapshot))), snapshot).select(F.col(snapshot).alias("_at"), F.col(key).alias("_key"), *values)
    old = placed.join(F.broadcast(days.select(F.col("_this").alias(snapshot), F.col("_next"))), snapshot).select(F.col("_next").alias("_at"), F.col(key).alias("_key"), *values)
    came = new.exceptAll(old).select("_at", "_key", F.lit(True).alias("_came"))
    went = old.exceptAll(new).select("_at", "_key", F.lit(True).alias("_went"))
    change = F.when(F.col("_went").isNull(), "added").when(F.col("_came").isNull(), "removed").otherwise("changed")
    return came.join(went, ["_at", "_key"], "full").select(F.col("_at").alias(snapshot), F.col("_key").alias(key), change.alias("change"))


def cents(c: Column) -> Column:
    """An amount in whole cents, as a double so that no amount overflows."""
    return F.round(c.cast(T.DoubleType()) * 100)


def posting_changes(snapshots: DataFrame) -> DataFrame:
    """Added, removed and changed postings between consecutive snapshot dates, by title and yearly salary."""
    return snapshot_changes(
        snapshots, "snapshot_date", "posting_id", "delivered_at",
        {"title": squash_blanks(F.col("title")), "salary": cents(F.col("salary_annual_eur_p50"))},
    )
