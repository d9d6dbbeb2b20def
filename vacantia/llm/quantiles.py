"""Problem 3: percentiles per group from mergeable partial results with bounded error.

Method: dyadic Count-sketches. Values are encoded as integers of ``BITS`` bits in the order of the values; each
binary resolution (the code without its last bits) has a signed Count-sketch of ``DEPTH`` rows and ``WIDTH``
counters, except that resolutions with no more nodes than a sketch has counters are one exact array. Every group,
small or large, is such a sketch. Sketches merge by addition and take back rows by subtraction. A percentile descends the
resolutions, at each going left or right by the estimated count of the left half.

Errors. A value is known to within a factor of ``GAMMA`` ** 0.5 (0.1 %), plus 0.001 near zero; the codes cover
all doubles, infinities included. A rank is off by at most the sum over the hashed resolutions of
3 * sqrt(R / WIDTH), R being the sum of squared counts of the resolution's nodes but the heavy ones, those of a
``HEAVY``-th of the rows at least. (A row is off by more with probability 1/9 by Chebyshev, or as one of at most
``HEAVY`` heavy nodes falls on the same counter, with HEAVY / WIDTH; the median of five rows then with 0.02, and any
of the eight resolutions with 0.16, at most.) ``rank_bound`` is that sum divided by the group's size, with R estimated by
the sketch itself and never taken as less than a tenth of all squares. Observed errors are far smaller.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacantia.operators.snapshot_diff import latest_per_key
from vacantia.runtime import cut_lineage, ship_package

BITS, GAMMA, DEPTH, WIDTH, HEAVY = 20, 1.002, 5, 1024, 32
_MIDDLE = 1 << (BITS - 1)
#: Resolutions that are hashed: those with more nodes than a sketch has counters.
HASHED = max(0, BITS - int(math.log2(DEPTH * WIDTH)))
_EXACT = 1 << (BITS - HASHED)
_TOP = HASHED * DEPTH * WIDTH
_SIZE = _TOP + _EXACT
PERCENTS = (10, 25, 50, 75, 90, 95, 99)


def encode(value: Column) -> Column:
    """The code of a value: the sign and the logarithm to the base ``GAMMA`` of one more than its size."""
    size = F.least(F.floor(F.log1p(F.abs(value)) / math.log(GAMMA)), F.lit(_MIDDLE - 1))
    return F.when(value < 0, _MIDDLE - 1 - size).otherwise(_MIDDLE + size).cast("int")


def decode(codes: np.ndarray) -> np.ndarray:
    """The middle of the values that have a code, in cents."""
    size = np.where(codes >= _MIDDLE, codes - _MIDDLE, _MIDDLE - 1 - codes)
    with np.errstate(over="ignore"):
        middle = np.expm1((size + 0.5) * math.log(GAMMA))
    return np.round(np.where(codes >= _MIDDLE, middle, -middle), 2)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLES: list[tuple[np.ndarray, np.ndarray]] = []


def _tables() -> list[tuple[np.ndarray, np.ndarray]]:
    """For each hashed resolution the counter (over the whole sketch) and sign of each node in each row."""
    if not _TABLES:
        for level in range(HASHED):
            nodes = np.arange(1 << (BITS - level), dtype=np.uint64)
            at, sign = [], []
            for row in range(DEPTH):
                with np.errstate(over="ignore"):
                    h = _mixed(nodes + np.uint64(0x9E3779B97F4A7C15) * np.uint64(1 + level * DEPTH + row))
                at.append(((level * DEPTH + row) * WIDTH + (h % np.uint64(WIDTH)).astype(np.int64)).astype(np.int32))
                sign.append(np.where((h >> np.uint64(40)) & np.uint64(1), 1, -1).astype(np.int8))
            _TABLES.append((np.array(at), np.array(sign)))
    return _TABLES


def sketch_of(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The counters that given codes and counts (negative for deletion) add up to."""
    at, add = [_TOP + (codes >> HASHED)], [counts]
    for level, (place, sign) in enumerate(_tables()):
        nodes = codes >> level
        at.append(place[:, nodes].ravel())
        add.append((sign[:, nodes] * counts).ravel())
    out = np.zeros(_SIZE, dtype=np.int64)
    np.add.at(out, np.concatenate(at), np.concatenate(add))
    return out


def packed(sketch: np.ndarray) -> bytes:
    """A sketch as bytes: the width of its integers, then they, compressed."""
    most = int(np.abs(sketch).max(initial=0))
    kind = next(k for k in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(k).max)
    return bytes([np.dtype(kind).itemsize]) + zlib.compress(sketch.astype(kind).tobytes(), 1)


def unpacked(state: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(state[1:]), dtype=f"<i{state[0]}").astype(np.int64)


def percentiles_of(sketch: np.ndarray, shares: np.ndarray) -> tuple[int, np.ndarray, float]:
    """Rows of a sketch, the codes at the given shares of them, and the bound of the rank's error as a share."""
    run = np.cumsum(sketch[_TOP:])
    n = int(run[-1])
    counts = np.diff(run, prepend=0)
    ranks = np.maximum(np.ceil(shares * n), 1)
    node = np.minimum(np.searchsorted(run, ranks), _EXACT - 1)
    left_over = ranks - np.where(node > 0, run[node - 1], 0)
    total = counts[node].astype(float)
    bound = 0.0
    heavy = np.nonzero(counts >= max(n, 1) / HEAVY)[0]
    for level in range(HASHED - 1, -1, -1):
        at, sign = _tables()[level]

        def estimate(nodes: np.ndarray) -> np.ndarray:
            return np.median(sign[:, nodes] * sketch[at[:, nodes]], axis=0) if len(nodes) else np.zeros(0)

        first = 2 * node
        # both halves are estimated, and what they miss of their sum is shared between them
        a, b = estimate(first), estimate(first + 1)
        low = np.clip((a + total - b) / 2, 0, total)
        right = left_over > low
        left_over = np.where(right, left_over - low, left_over)
        total = np.where(right, total - low, low)
        node = first + right
        rows = sketch[level * DEPTH * WIDTH : (level + 1) * DEPTH * WIDTH].reshape(DEPTH, WIDTH)
        squares = float(np.median((rows.astype(float) ** 2).sum(1)))
        halves = np.concatenate([2 * heavy, 2 * heavy + 1])
        held = estimate(halves)
        heavy, held = halves[held >= n / HEAVY], held[held >= n / HEAVY]
        bound += 3 * math.sqrt(max(squares - float((held**2).sum()), squares / 10) / WIDTH)
    return n, node, bound / max(n, 1)


def _runs(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Where in a batch sorted by its first ``width`` columns the runs of equal keys begin, and the batch's length."""
    new = np.zeros(batch.num_rows, dtype=bool)
    new[:1] = True
    for i in range(width):
        at = batch.column(i).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= at[1:] != at[:-1]
    return np.append(np.nonzero(new)[0], batch.num_rows)


def _summed(width: int, sketches):
    """A function over batches sorted by their first ``width`` columns that adds up each run of equal keys.

    ``sketches(batch, i, j)`` is the sketch of a batch's rows i to j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now, kinds = None, None, None

        def flush(done: list) -> pa.RecordBatch:
            keys = [pa.array([k[i] for k, _ in done], kinds[i]) for i in range(width)]
            return pa.RecordBatch.from_arrays([*keys, pa.array([s for _, s in done], pa.binary())], names=[*(f"k{i}" for i in range(width)), "sketch"])

        for batch in batches:
            kinds = [batch.column(i).type for i in range(width)]
            ends = _runs(batch, width) if batch.num_rows else np.zeros(1, dtype=int)
            done = []
            for i, j in zip(ends[:-1], ends[1:]):
                k = tuple(batch.column(c)[int(i)].as_py() for c in range(width))
                mine = sketches(batch, int(i), int(j))
                if now is not None and k == key:
                    now += mine
                    continue
                if now is not None:
                    done.append((key, packed(now)))
                key, now = k, mine
            if done:
                yield flush(done)
        if now is not None:
            yield flush([(key, packed(now))])

    return run


def _mapped(rows: DataFrame, keys: list[str], values: list[str], sketches) -> DataFrame:
    ship_package(rows.sparkSession)
    kinds = ", ".join(f"k{i} {rows.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    out = rows.select(*keys, *values).sortWithinPartitions(*keys).mapInArrow(_summed(len(keys), sketches), f"{kinds}, sketch binary")
    return out.withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})


def partials(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys`` and the sketch of every group of ``rows``; null and NaN values are left out.

    Null keys are a group like others. Rows are first counted per group and code, combined before they are
    shuffled, so that a hot group comes as ``2 ** BITS`` counts at most, read batch by batch."""
    width = len(keys)

    def counted_rows(batch: pa.RecordBatch, i: int, j: int) -> np.ndarray:
        return sketch_of(*(batch.column(width + c).slice(i, j - i).to_numpy(zero_copy_only=False).astype(np.int64) for c in (0, 1)))

    live = rows.filter(F.col(value).isNotNull() & ~F.isnan(value)).select(*keys, encode(F.col(value).cast("double")).alias("_code"))
    counted = live.groupBy(*keys, "_code").agg(F.count("*").alias("_n")).repartition(*keys)
    return _mapped(counted, keys, ["_code", "_n"], counted_rows)


def merge(states: DataFrame, keys: list[str], sign: str | None = None) -> DataFrame:
    """The sketches added up per ``keys``, within partitions first and then across them; none is ever collected with others.

    ``sign`` names a column of 1 and -1: sketches with -1 are taken back."""
    width = len(keys)

    def added(batch: pa.RecordBatch, i: int, j: int) -> np.ndarray:
        signs = batch.column(width + 1).slice(i, j - i).to_pylist() if batch.num_columns > width + 1 else [1] * (j - i)
        return sum((f * unpacked(s) for f, s in zip(signs, batch.column(width).slice(i, j - i).to_pylist())), np.zeros(_SIZE, dtype=np.int64))

    near = _mapped(states, keys, ["sketch", *([sign] if sign else [])], added)
    return _mapped(near.repartition(*keys), keys, ["sketch"], added)


def percentiles(states: DataFrame, keys: list[str], percents: tuple[int, ...] = PERCENTS) -> DataFrame:
    """``keys``, n, a column pN per percent (the value of rank ceil(N% of n)), rank_bound. Groups with n <= 0 are left out."""
    width, shares = len(keys), np.array(percents) / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, sizes, found, bounds = [], [], [], []
            for i, state in enumerate(batch.column(width).to_pylist()):
                n, codes, bound = percentiles_of(unpacked(state), shares)
                if n > 0:
                    keep.append(i)
                    sizes.append(n)
                    found.append(decode(codes))
                    bounds.append(bound)
            table = np.array(found, dtype=float).reshape(len(found), len(percents))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i).take(pa.array(keep, pa.int64())) for i in range(width)), pa.array(sizes, pa.int64()), *(pa.array(table[:, j], pa.float64()) for j in range(len(percents))), pa.array(bounds, pa.float64())],
                names=[*(f"k{i}" for i in range(width)), "n", *(f"p{p}" for p in percents), "rank_bound"],
            )

    ship_package(states.sparkSession)
    kinds = ", ".join(f"k{i} {states.schema[k].dataType.simpleString()}" for i, k in enumerate(keys))
    out = states.select(*keys, "sketch").mapInArrow(run, f"{kinds}, n bigint, {', '.join(f'p{p} double' for p in percents)}, rank_bound double")
    return out.withColumnsRenamed({f"k{i}": k for i, k in enumerate(keys)})


_SALARY = ["snapshot_date", "isco_code", "country"]


def newest_salaries(snapshots: DataFrame) -> DataFrame:
    """snapshot_date, isco_code, country and yearly salary; of several deliveries of a posting in a snapshot the last counts, once."""
    return latest_per_key(snapshots, ["snapshot_date", "posting_id"], "delivered_at", ["isco_code", "country", "salary_annual_eur_p50"])


def salary_partials(snapshots: DataFrame) -> DataFrame:
    """snapshot_date, isco_code, country and the sketch of the yearly salaries, kept (written once) for later merges."""
    return cut_lineage(partials(newest_salaries(snapshots), _SALARY, "salary_annual_eur_p50"))


def salary_percentiles(snapshots: DataFrame) -> DataFrame:
    """snapshot_date, isco_code, country, percent, value, n, rank_bound: one row per percentile.

    Percentiles are per occupation and country, for each snapshot_date and for all dates together ('all'), which
    are merged from the dates' kept sketches."""
    kept = salary_partials(snapshots)
    every = merge(kept, ["isco_code", "country"]).withColumn("snapshot_date", F.lit("all"))
    wide = percentiles(kept.select(*_SALARY, "sketch").unionByName(every), _SALARY)
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("percent"), F.col(f"p{p}").alias("value")) for p in PERCENTS]))
    return wide.select(*_SALARY, each.alias("e"), "n", "rank_bound").select(*_SALARY, "e.percent", "e.value", "n", "rank_bound")


def salary_accuracy(snapshots: DataFrame) -> DataFrame:
    """percent, n_groups, n_outside: how many percentiles there are, and how many are further from the exact rank than ``rank_bound`` says.

    Every percentile of ``salary_percentiles`` is held against all salaries of its group."""
    rows = newest_salaries(snapshots).filter("salary_annual_eur_p50 IS NOT NULL AND NOT isnan(salary_annual_eur_p50)")
    rows = rows.unionByName(rows.withColumn("snapshot_date", F.lit("all"))).withColumnRenamed("salary_annual_eur_p50", "pay")
    counted = rows.groupBy(*_SALARY, "pay").agg(F.count("*").alias("c"))
    found = salary_percentiles(snapshots).withColumnsRenamed({k: f"_{k}" for k in _SALARY})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in _SALARY]
    room = F.abs("value") * (GAMMA**0.5 - 1) * 1.001 + 0.012
    met = found.join(counted, same).groupBy(*[f"_{k}" for k in _SALARY], "percent", "n", "rank_bound").agg(
        F.sum(F.when(F.col("pay") < F.col("value") - room, F.col("c")).otherwise(0)).alias("below"), F.sum(F.when(F.col("pay") <= F.col("value") + room, F.col("c")).otherwise(0)).alias("upto"))
    rank = F.greatest(F.ceil(F.col("percent") / 100 * F.col("n")), F.lit(1))
    off = F.greatest(F.col("below") + 1 - rank, rank - F.col("upto"), F.lit(0)) / F.col("n")
    return met.groupBy("percent").agg(F.count("*").alias("n_groups"), F.count_if(off > F.col("rank_bound")).alias("n_outside"), F.max(off).alias("worst"), F.max("rank_bound").alias("loosest"), F.avg("rank_bound").alias("bound"))


#: How many percentiles there are in DuckDB; none may be outside its bound.
ACCURACY = f"""
WITH newest AS (SELECT snapshot_date, arg_max(struct_pack(i := isco_code, c := country, s := salary_annual_eur_p50), struct_pack(d := delivered_at, i := isco_code, c := country, s := salary_annual_eur_p50)) AS v
  FROM posting_snapshots WHERE snapshot_date IS NOT NULL AND posting_id IS NOT NULL GROUP BY snapshot_date, posting_id),
groups AS (SELECT DISTINCT snapshot_date, v.i, v.c FROM newest WHERE v.s IS NOT NULL AND NOT isnan(v.s)),
every AS (SELECT * FROM groups UNION SELECT 'all', i, c FROM groups)
SELECT percent, count(*) AS n_groups, 0 AS n_outside FROM every, unnest({list(PERCENTS)}) AS p(percent) GROUP BY percent"""
