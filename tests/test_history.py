"""Accumulated history in batch and as a stream."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from vacantia.operators import dashboard
from vacantia.streaming import history

SCHEMA = "posting_id string, delivered_at timestamp, title string"
T0 = datetime(2025, 1, 6)


def rows(week, *ids):
    return [(i, T0 + timedelta(days=7 * week), f"{i}{week}") for i in ids]


def write(spark, folder, week, *ids):
    spark.createDataFrame(rows(week, *ids), SCHEMA).coalesce(1).write.parquet(str(folder / f"w{week}"))


def test_batch(spark):
    df = spark.createDataFrame(rows(0, "a", "b") + rows(1, "a") + rows(1, "a") + [(None, T0, "x"), ("z", None, "y")], SCHEMA)
    got = {r["posting_id"]: (r["first_seen_at"], r["last_seen_at"], r["title"]) for r in dashboard.accumulated(df, "posting_id", "delivered_at").collect()}
    assert got == {"a": (T0, T0 + timedelta(days=7), "a1"), "b": (T0, T0, "b0")}
    assert dashboard.closed(dashboard.accumulated(df, "posting_id", "delivered_at"), F.lit(T0 + timedelta(days=7))).count() == 1
    assert dashboard.accumulated(df.limit(0), "posting_id", "delivered_at").count() == 0


def test_stream_equals_batch_and_goes_on(spark, tmp_path):
    source = tmp_path / "in"
    for week, ids in enumerate([("a", "b"), ("a", "c")]):
        write(spark, source, week, *ids)
    for week in (2, 2):
        stream = history.deliveries(spark, str(source / "*"), SCHEMA)
        history.keep_history(stream, "posting_id", "delivered_at", tmp_path / "h", tmp_path / "c").awaitTermination(120)
        if not (source / "w2").exists():
            write(spark, source, 2, "b", "d")
    got = {tuple(r) for r in history.history(spark, tmp_path / "h").collect()}
    whole = spark.read.schema(SCHEMA).parquet(str(source / "*"))
    assert got == {tuple(r) for r in dashboard.accumulated(whole, "posting_id", "delivered_at").collect()}


def test_weeks_and_repeats(spark, tmp_path):
    source = tmp_path / "in"
    write(spark, source, 0, "a", "a", "b")
    write(spark, source, 1, "a", "c")
    once = history.counted_once(history.deliveries(spark, str(source / "*"), SCHEMA, 9), "posting_id", "delivered_at")
    q = once.writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("once").count() == 3
    q = history.weekly(history.deliveries(spark, str(source / "*"), SCHEMA, 9), "delivered_at").writeStream.outputMode("complete").format("memory").queryName("weeks").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {(str(r["week"]), r["n"]) for r in spark.table("weeks").collect()} == {("2025-01-06", 3), ("2025-01-13", 2)}
