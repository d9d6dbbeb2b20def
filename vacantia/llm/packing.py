"""Problem 9: documents into containers of fixed capacity with little space unused.

Method: dynamic programming over the global histogram of sizes chooses the boundaries of ``buckets`` length
buckets so that padding every item up to its bucket's upper boundary wastes least; token-budget batches then
form inside each bucket: as many items as the budget holds at the bucket's boundary. Every container begins as such a
batch. A bucket whose batches leave more than ``LOOSE`` of the budget unused (batches of a bucket of 700 tokens waste
a third) would not give the required result on its own, so there the method is extended: the batch's remaining budget is
filled by batches of the next smaller buckets that fit. ``fill`` reports how many containers are of one bucket, and
which share of the tokens is in the batches that containers begin with.

Everything decided centrally is decided on the histogram, of at most ``capacity`` counts, and the plan made of
it has a few segments per bucket, whatever the number of documents. Documents find their containers by their
rank within the bucket, counted in shards so that no bucket is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from vacantia.runtime import cut_lineage, ship_package

#: Share of the budget that a batch of one bucket may leave unused before it is topped up from other buckets.
LOOSE = 0.01


def length_buckets(sizes: np.ndarray, counts: np.ndarray, buckets: int) -> np.ndarray:
    """The upper boundaries (ascending) of at most ``buckets`` buckets that minimise total padding.

    ``sizes`` are distinct and ascending, ``counts`` how many items have them."""
    n = len(sizes)
    if n <= buckets:
        return sizes.copy()
    number = np.concatenate([[0], np.cumsum(counts, dtype=np.float64)])
    weight = np.concatenate([[0], np.cumsum(counts * sizes, dtype=np.float64)])
    # padding of a bucket that holds the sizes i..j: size j for all of them, less what they are
    best, cut = np.full(n + 1, np.inf), np.zeros((buckets + 1, n + 1), dtype=np.int32)
    best[0] = 0
    for b in range(1, buckets + 1):
        new = np.full(n + 1, np.inf)
        new[0] = 0
        for j in range(1, n + 1):
            total = best[:j] + sizes[j - 1] * (number[j] - number[:j]) - (weight[j] - weight[:j])
            k = int(np.argmin(total))
            new[j], cut[b, j] = total[k], k
        best = new
    uppers, j = [], n
    for b in range(buckets, 0, -1):
        if j == 0:
            break
        uppers.append(sizes[j - 1])
        j = cut[b, j]
    return np.array(uppers[::-1], dtype=np.int64)


def plan(uppers: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[list[tuple[int, int, int, int]], int]:
    """Segments (bucket, first rank, items per container, first container) and the number of containers.

    The items of a bucket with ranks from a segment's first to the next segment's fill its containers in turn."""
    left, used = counts.astype(np.int64).copy(), np.zeros(len(counts), dtype=np.int64)
    segments: list[tuple[int, int, int, int]] = []
    containers = 0

    def form(pattern: list[tuple[int, int]], times: int) -> None:
        nonlocal containers
        for b, m in pattern:
            segments.append((b, int(used[b]), m, containers))
            taken = min(m * times, int(left[b]))
            used[b] += taken
            left[b] -= taken
        containers += times

    for b in range(len(uppers) - 1, -1, -1):
        per = capacity // int(uppers[b])
        if left[b] >= per and capacity - per * uppers[b] <= LOOSE * capacity:
            form([(b, per)], int(left[b] // per))
    while True:
        there = np.nonzero(left)[0]
        if not len(there):
            return segments, containers
        room, pattern = capacity, []
        for b in there[::-1]:
            m = int(min(room // uppers[b], left[b]))
            if m:
                pattern.append((int(b), m))
                room -= m * int(uppers[b])
            if room < uppers[there[0]]:
                break
        form(pattern, max(1, min(int(left[b] // m) for b, m in pattern)))


def pack(items: DataFrame, key: str, size: str, capacity: int = 2048, buckets: int = 256) -> DataFrame:
    """``key``, piece_no, start, n_tokens, bucket, container_id: every item, in containers of ``capacity``.

    An item is split only if its size exceeds the capacity: into full pieces, each a container of its own, and
    a last piece that is packed like other items. ``start`` is the offset of the piece within the item. An item
    of size 0 (also null or negative) takes no space and is in some container all the same. An empty table
    gives no rows. Containers are numbered from 0 without gaps. ``bucket`` is the upper boundary of the piece's bucket (0 for
    size 0)."""
    ship_package(items.sparkSession)
    whole = F.greatest(F.coalesce(F.col(size), F.lit(0)), F.lit(0)).cast("long")
    sized = cut_lineage(items.select(F.col(key).alias("_key"), whole.alias("_size")))
    last = F.when(F.col("_size") > capacity, (F.col("_size") - 1) % capacity + 1).otherwise(F.col("_size"))
    hist = sorted((int(r["n"]), int(r["count"])) for r in sized.groupBy(last.alias("n")).count().collect())
    zeros = sum(c for n, c in hist if n == 0)
    sizes = np.array([n for n, _ in hist if n > 0], dtype=np.int64)
    counts = np.array([c for n, c in hist if n > 0], dtype=np.int64)
    uppers = length_buckets(sizes, counts, buckets)
    of_size = np.searchsorted(uppers, sizes) if len(sizes) else np.array([], dtype=np.int64)
    totals = np.bincount(of_size, weights=counts, minlength=len(uppers)).astype(np.int64) if len(sizes) else counts
    segments, containers = plan(uppers, totals, capacity)

    # the last pieces, ranked within their bucket shard by shard
    # (one array literal of ``capacity`` entries says the bucket of each size)
    bucket_of = F.lit([-1, *np.searchsorted(uppers, np.arange(1, capacity + 1)).tolist()])
    bucket = F.element_at(bucket_of, (F.col("n_tokens") + 1).cast("int"))
    total = int(counts.sum()) + zeros
    shards = max(8, total // 200_000)
    tails = sized.select("_key", (F.col("_size") - last).alias("start"), last.alias("n_tokens")).withColumn("_bucket", bucket).withColumn("_shard", F.pmod(F.xxhash64("_key"), F.lit(shards)).cast("int"))
    sums = tails.groupBy("_bucket", "_shard").count()
    before = sums.withColumn("_before", F.sum("count").over(Window.partitionBy("_bucket").orderBy("_shard")) - F.col("count")).drop("count")
    ranked = tails.withColumn("_rank", F.row_number().over(Window.partitionBy("_bucket", "_shard").orderBy("_key", "n_tokens")) - 1)
    # one row per bucket and shard; both sides are already partitioned by them
    placed = ranked.join(before, ["_bucket", "_shard"]).select("_key", "start", "n_tokens", "_bucket", (F.col("_rank") + F.col("_before")).alias("_rank"))

    by_bucket: dict[int, np.ndarray] = {}
    for b, first, per, base in segments:
        by_bucket.setdefault(b, []).append((first, per, base))
    by_bucket = {b: np.array(sorted(s), dtype=np.int64) for b, s in by_bucket.items()}
    shared = items.sparkSession.sparkContext.broadcast((by_bucket, max(1, containers), np.append(uppers, 0)))
    kind = sized.schema["_key"].dataType.simpleString()

    def assign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segs, number, bounds = shared.value
        for f in frames:
            out = f["_rank"].to_numpy(dtype=np.int64) % number
            for b, rows in f.groupby("_bucket").indices.items():
                if b >= 0:
                    rank = f["_rank"].to_numpy(dtype=np.int64)[rows]
                    seg = segs[b][np.searchsorted(segs[b][:, 0], rank, side="right") - 1]
                    out[rows] = seg[:, 2] + (rank - seg[:, 0]) // seg[:, 1]
            yield f[["_key", "start", "n_tokens"]].assign(bucket=bounds[f["_bucket"].to_numpy(dtype=np.int64)], container_id=out)

    tail_rows = placed.mapInPandas(assign, f"_key {kind}, start long, n_tokens long, bucket long, container_id long").withColumn("piece_no", (F.col("start") / capacity).cast("int"))
    # full pieces of items beyond the capacity, numbered after the packed containers
    full = sized.filter(F.col("_size") > capacity).withColumn("_n", ((F.col("_size") - 1) / capacity).cast("int")).withColumn("_shard", F.pmod(F.xxhash64("_key"), F.lit(shards)).cast("int"))
    per_shard = full.groupBy("_shard").agg(F.sum("_n").alias("s"))
    base = per_shard.withColumn("_base", F.sum("s").over(Window.orderBy("_shard")) - F.col("s")).drop("s")
    run = F.sum("_n").over(Window.partitionBy("_shard").orderBy("_key", "_size").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_n")
    # one row per shard: their number is total / 200,000
    pieces = full.withColumn("_run", run).join(base, "_shard").select("_key", (F.col("_run") + F.col("_base")).alias("_first"), F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("piece_no"))
    full_rows = pieces.select("_key", "piece_no", (F.col("piece_no").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("n_tokens"), F.lit(capacity).cast("long").alias("bucket"), (F.lit(containers) + F.col("_first") + F.col("piece_no")).cast("long").alias("container_id"))
    out = tail_rows.select("_key", "piece_no", "start", "n_tokens", "bucket", "container_id").unionByName(full_rows)
    return out.withColumnRenamed("_key", key)


def fill(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row: containers, pieces, tokens, the fewest containers that could hold them, the fullest, the share unused, the
    share of containers whose pieces are of one bucket, and the share of tokens in the batches that containers begin with."""
    batches = packed.groupBy("container_id", "bucket").agg(F.count("*").alias("pieces"), F.sum("n_tokens").alias("tokens"))
    # empty pieces are of no bucket
    per = batches.groupBy("container_id").agg(F.sum("pieces").alias("pieces"), F.sum("tokens").alias("tokens"), F.count_if(F.col("bucket") > 0).alias("buckets"), F.max_by("tokens", "bucket").alias("first"))
    return per.agg(
        F.count("*").alias("containers"), F.sum("pieces").alias("pieces"), F.sum("tokens").alias("tokens"),
        F.ceil(F.sum("tokens") / capacity).alias("least_containers"), F.max("tokens").alias("fullest"),
        F.round(1 - F.sum("tokens") / (F.count("*") * capacity), 6).alias("unused"),
        F.round(F.count_if(F.col("buckets") <= 1) / F.count("*"), 6).alias("of_one_bucket"), F.round(F.sum("first") / F.sum("tokens"), 6).alias("in_first_batches"),
    )
