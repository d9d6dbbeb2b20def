"""Snapshots as a stream: deliveries counted once, weekly counts with late data, and a table of first and last sightings."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from vacantia.operators.dashboard import accumulated


def deliveries(spark: SparkSession, path: str, schema, files: int = 1) -> DataFrame:
    """Parquet files below ``path`` as a stream, ``files`` at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def counted_once(stream: DataFrame, key: str, at: str, late: str = "15 days") -> DataFrame:
    """The first row of each key within the time that deliveries may be late; state older than that is dropped."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def weekly(stream: DataFrame, at: str, late: str = "180 days") -> DataFrame:
    """week (its Monday), n: rows per calendar week; weeks are final once ``late`` has passed.

    1970-01-01 was a Thursday, so weeks start four days after the epoch."""
    timed = stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late)
    return timed.groupBy(F.window(at, "7 days", startTime="4 days").alias("w")).agg(F.count("*").alias("n")).select(F.to_date("w.start").alias("week"), "n")


def keep_history(stream: DataFrame, key: str, at: str, folder: Path, checkpoint: Path) -> StreamingQuery:
    """A query that folds each batch into a history (first and last sighting, last values) below ``folder``.

    Each batch writes a new version, named after the batch, from the one before and the batch's own fold; the
    newest whole version (with Spark's success mark) is the history, so a batch run again writes the same."""

    def fold(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mine = accumulated(batch, key, at)
        before = [p for p in versions(folder) if int(p.name[1:]) < number]
        if before:
            old = spark.read.parquet(str(before[-1]))
            both = old.unionByName(mine)
            rest = [c for c in mine.columns if c not in (key, "first_seen_at", "last_seen_at")]
            last = F.max(F.struct("last_seen_at", *rest))
            got = both.groupBy(key).agg(F.min("first_seen_at").alias("first_seen_at"), last.alias("_l"))
            mine = got.select(key, "first_seen_at", F.col("_l.last_seen_at").alias("last_seen_at"), *[F.col(f"_l.{c}").alias(c) for c in rest])
        mine.write.mode("overwrite").parquet(str(folder / f"v{number:08d}"))

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()


def versions(folder: Path) -> list[Path]:
    """The whole versions of a history, oldest first."""
    return sorted(p for p in folder.glob("v*") if (p / "_SUCCESS").exists())


def history(spark: SparkSession, folder: Path) -> DataFrame:
    """The newest whole version of a history."""
    return spark.read.parquet(str(versions(folder)[-1]))
