"""Streams account for every row: late, undated and repeated ones, and rows that are tried again."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobloom.sources import sinks
from jobloom.streaming import jobs as streams

ROW = "k BIGINT, ts TIMESTAMP_NTZ"


def land(spark, root: str, n: int, rows: list[tuple]):
    df = spark.createDataFrame(rows, "k bigint, at string").select("k", F.col("at").cast("timestamp_ntz").alias("ts"))
    df.coalesce(1).write.parquet(f"{root}/landing/{n}")
    return streams.file_stream(spark, f"{root}/landing/*", df.schema)


def test_tally_adds_up(spark, tmp_path):
    root = str(tmp_path)
    slices = [
        [(1, "2024-01-05"), (1, "2024-01-05"), (2, None)],
        [],
        [(1, "2024-01-05"), (3, "2024-01-04 23:59:59"), (4, "2024-01-05"), (5, "2024-01-07")],
    ]
    for n, rows in enumerate(slices):
        streams.mark_stream(land(spark, root, n, rows), "f", "ts", ["k"], root).awaitTermination()
    tally = sinks.read_batches(spark, f"{root}/tally", streams.TALLY)
    sums = tally.groupBy("feed").agg(*[F.sum(c).alias(c) for c in ("n_read", "n_taken", "n_late", "n_undated", "n_repeated")]).collect()
    assert [tuple(r) for r in sums] == [("f", 7, 3, 1, 1, 2)]
    late = sinks.read_batches(spark, f"{root}/late", f"{ROW}, reason STRING")
    assert {(r["k"], r["reason"]) for r in late.collect()} == {(2, "undated"), (3, "late")}


def test_rows_are_tried_until_the_last_try(spark, tmp_path):
    """Two equal rows stay two; a replayed batch changes nothing; nothing is tried before it is due."""
    root = str(tmp_path)
    slices = [
        [(1, "2024-01-01 10:00:00"), (1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:00:00"), (3, None)],
        [(10, "2024-01-01 10:05:00")],
        [(11, "2024-01-01 10:10:00")],
        [(12, "2024-01-01 10:30:00")],
    ]
    broken = F.col("k").isin(1, 3) | ((F.col("k") == 2) & (F.col("attempt") == 1))
    attempt = lambda rows: rows.withColumn("error", F.when(broken, F.lit("no")))
    for n, rows in enumerate(slices):
        streams.retry_stream(land(spark, root, n, rows), "ts", attempt, root, tries=3, delay="10 minutes").awaitTermination()
    log = sinks.read_batches(spark, f"{root}/outcomes", f"{ROW}, attempt INT, error STRING, status STRING")
    got = sorted((r["batch"], r["k"], r["attempt"], r["status"]) for r in log.collect())
    assert got == [
        (0, 1, 1, "retry"), (0, 1, 1, "retry"), (0, 2, 1, "retry"), (0, 3, 1, "retry"),
        (1, 10, 1, "completed"),
        (2, 1, 2, "retry"), (2, 1, 2, "retry"), (2, 2, 2, "completed"), (2, 3, 2, "retry"), (2, 11, 1, "completed"),
        (3, 1, 3, "failed"), (3, 1, 3, "failed"), (3, 3, 3, "failed"), (3, 12, 1, "completed"),
    ]
    assert sinks.read_batches(spark, f"{root}/open", f"{ROW}, attempt INT, due_at TIMESTAMP_NTZ").filter("batch = 3").count() == 0
