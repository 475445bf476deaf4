"""The continuous jobs. Every batch writes only its own folders, so a replayed batch adds nothing."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from jobloom import schemas
from jobloom.fixed_values import CYCLE_ZONE
from jobloom.functions import dates
from jobloom.operators.feeds import next_mark, run_metrics, since, streaks
from jobloom.operators.graph import build_graph
from jobloom.operators.jobs import Dictionaries, job_rows
from jobloom.operators.normalize import graph_safe
from jobloom.operators.staging import clean_batch, first_copies, not_yet
from jobloom.sources.readers import FIRST_MARK, MARKS
from jobloom.sources.sinks import committed, read_batches, write_batch, write_graph
from jobloom.sources.state import read_touched, upsert_state


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)


def _start(df: DataFrame, checkpoint: str, step, mode: str = "append") -> StreamingQuery:
    return (
        df.writeStream.foreachBatch(step)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def clean_stream(
    raw: DataFrame, dictionaries: Dictionaries, root: str, as_of, sources: list[str] | None = None
) -> StreamingQuery:
    """Raw arrivals to `cleaned` (all rows with their outcome) and `jobs`.

    `sources` narrows the parsers to those that can occur.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = read_batches(spark, f"{root}/jobs", schemas.JOB, before=batch_id)
        write_batch(clean_batch(batch, done, as_of=as_of, sources=sources), f"{root}/cleaned", batch_id)
        cleaned = spark.read.parquet(f"{root}/cleaned/batch={batch_id}")
        good = cleaned.filter(F.col("raw_status") == "completed")
        write_batch(job_rows(good, dictionaries, as_of), f"{root}/jobs", batch_id)

    return _start(raw, f"{root}/_checkpoint_clean", step)


def first_seen(events: DataFrame, keys: list[str], ts: str | None = None, delay: str = "1 day") -> DataFrame:
    """Streaming rows with each key once.

    With an event time the state of a key is dropped after `delay`; without one the
    state holds every key seen.
    """
    if ts is None:
        return events.dropDuplicates(keys)
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def append_stream(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stage_stream(new: DataFrame, keys: list[str], order: str, root: str) -> StreamingQuery:
    """First copy of each key over the whole history: batches against all staged keys."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema.fields)

    def step(batch: DataFrame, batch_id: int) -> None:
        staged = read_batches(batch.sparkSession, f"{root}/staged", schema, before=batch_id)
        fresh = not_yet(first_copies(batch, keys, [order]), staged, keys)
        write_batch(fresh, f"{root}/staged", batch_id)

    return _start(new, f"{root}/_checkpoint_stage", step)


#: What became of the rows of a batch: taken, behind the mark, without a date, copies of taken ones.
TALLY = "feed STRING, n_read BIGINT, n_taken BIGINT, n_late BIGINT, n_undated BIGINT, n_repeated BIGINT"


def mark_stream(new: DataFrame, feed: str, ts: str, keys: list[str], root: str) -> StreamingQuery:
    """Rows at or after the feed's mark, once each; the mark moves after the write.

    Rows that are not taken for their date go to `late` with the `reason` (late or undated), and `tally`
    counts every row of a batch: taken, late, undated and repeated ones add up to those read.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema.fields)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = read_batches(spark, f"{root}/marks", MARKS, before=batch_id).filter(F.col("feed") == feed)
        old = marks.agg(F.coalesce(F.max("max_date"), dates.moment(FIRST_MARK))).first()[0]
        # rows before the mark are not taken, so only history at or after it can hold a copy
        staged = since(read_batches(spark, f"{root}/staged", schema, before=batch_id), ts, old)
        fresh = not_yet(first_copies(since(batch, ts, old), keys, [ts]), staged, keys)
        write_batch(fresh, f"{root}/staged", batch_id)
        reason = F.when(F.col(ts).isNull(), "undated").when(F.col(ts) < dates.moment(old), "late")
        write_batch(batch.withColumn("reason", reason).filter(F.col("reason").isNotNull()), f"{root}/late", batch_id)
        written = spark.read.parquet(f"{root}/staged/batch={batch_id}")
        sums = batch.select(reason.alias("reason")).agg(
            F.count("*").alias("n_read"), F.count_if(F.col("reason") == "late").alias("n_late"),
            F.count_if(F.col("reason") == "undated").alias("n_undated"),
        )
        tally = sums.withColumn("n_taken", written.agg(F.count("*")).scalar()).withColumn("feed", F.lit(feed))
        repeated = F.col("n_read") - F.col("n_taken") - F.col("n_late") - F.col("n_undated")
        write_batch(tally.withColumn("n_repeated", repeated), f"{root}/tally", batch_id)
        mark = spark.range(1).select(F.lit(feed).alias("feed"), next_mark(written, ts, old).alias("max_date"))
        write_batch(mark, f"{root}/marks", batch_id)

    return _start(new, f"{root}/_checkpoint_mark", step)


def retry_stream(
    new: DataFrame, ts: str, attempt: Callable[[DataFrame], DataFrame], root: str, tries: int = 3, delay: str = "10 minutes"
) -> StreamingQuery:
    """Rows through `attempt`; those that fail are tried again after `delay`, `tries` times in all.

    `attempt` gets the rows with their `attempt` number (from 1) and adds `error`, null where it went well.
    Time is the latest `ts` the stream has read, so a replayed batch does the same again. Every batch writes to
    `outcomes` the rows it tried, as completed, retry or failed (the last try went wrong: the quarantine), and to
    `open` the rows that wait, each with `due_at`. A batch opens only the waiting rows of the one before it, so
    its work follows what is new and what waits, not the history. Rows wait for the next arrivals, and rows
    without a time are tried at the present one.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema.fields)

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        clock = read_batches(spark, f"{root}/clock", "now TIMESTAMP_NTZ", before=batch_id)
        write_batch(
            batch.agg(F.max(F.col(ts).cast("timestamp_ntz")).alias("now"))
            .select(F.greatest("now", clock.agg(F.max("now")).scalar()).alias("now")),
            f"{root}/clock", batch_id,
        )
        now = spark.read.parquet(f"{root}/clock/batch={batch_id}").select("now").scalar()
        waiting = read_batches(spark, f"{root}/open", f"{fields}, attempt INT, due_at TIMESTAMP_NTZ")
        waiting = waiting.filter(F.col("batch") == batch_id - 1).drop("batch").withColumn("_due", F.col("due_at") <= now)
        again = waiting.filter("_due").withColumn("attempt", F.col("attempt") + 1).drop("due_at", "_due")
        tried = attempt(batch.withColumn("attempt", F.lit(1)).unionByName(again))
        status = F.when(F.col("error").isNull(), "completed").when(F.col("attempt") < tries, "retry").otherwise("failed")
        write_batch(tried.withColumn("status", status), f"{root}/outcomes", batch_id)
        held = spark.read.parquet(f"{root}/outcomes/batch={batch_id}").filter("status = 'retry'").drop("status", "error")
        held = held.withColumn("due_at", now + F.expr(f"INTERVAL {delay}"))
        write_batch(held.unionByName(waiting.filter(~F.coalesce("_due", F.lit(False))).drop("_due")), f"{root}/open", batch_id)

    return _start(new, f"{root}/_checkpoint_retry", step)


def streak_stream(
    new: DataFrame, feed: str, seq: str, is_new: str, k: int, root: str, page: str | None = None, width: int = 100_000
) -> StreamingQuery:
    """Rows of each feed up to the position where k duplicates in a row are complete, across micro-batches.

    The state of a feed is one row in buckets: its last position, the run that stands open there (on its page, where
    `page` is given) and the stop once there is one. A batch opens the buckets of its feeds. Rows that are not
    taken go to `left_out` with a `reason`: stopped, late (at or before the last position of an earlier batch) or
    incomplete (no feed or no position). Positions are whole numbers, unique in their feed.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    home, on_page = f"{root}/streaks", [] if page is None else [page]
    types = {f.name: f.dataType.simpleString() for f in new.schema.fields}
    empty = ", ".join(f"`{c}` {types[c]}" for c in (feed, *on_page)) + ", _at BIGINT, _run BIGINT, _stop BIGINT"

    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = committed(spark, home, before=batch_id)
        known = read_touched(spark, home, "feeds", batch, [feed], earlier[-1]) if earlier else spark.createDataFrame([], empty)
        met = batch.join(known.select(feed, "_at", "_stop"), feed, "left")
        reason = (
            F.when(F.col(feed).isNull() | F.col(seq).isNull(), "incomplete")
            .when(F.col("_stop").isNotNull(), "stopped").when(F.col(seq) <= F.col("_at"), "late")
        )
        met = met.withColumn("reason", reason).drop("_at", "_stop")
        runs = streaks(met.filter("reason IS NULL"), feed, seq, is_new, page, width, known.filter("_stop IS NULL"))
        write_batch(
            runs.groupBy(feed).agg(
                *[F.max_by(c, "_seq").alias(c) for c in on_page],
                F.max("_seq").cast("bigint").alias("_at"), F.max_by("_streak", "_seq").cast("bigint").alias("_run"),
                F.min(F.when(F.col("_streak") >= k, F.col("_seq"))).cast("bigint").alias("_stop"),
            ),
            f"{root}/feeds_now", batch_id,
        )
        now = spark.read.parquet(f"{root}/feeds_now/batch={batch_id}")
        met = met.join(now.select(feed, "_stop"), feed, "left")
        met = met.withColumn("reason", F.coalesce("reason", F.when(F.col(seq) > F.col("_stop"), "stopped"))).drop("_stop")
        write_batch(met.filter("reason IS NULL").drop("reason"), f"{root}/taken", batch_id)
        write_batch(met.filter("reason IS NOT NULL"), f"{root}/left_out", batch_id)
        # last: the next batch goes on from here
        upsert_state(spark, {"feeds": now}, {"feeds": [feed]}, home, batch_id)

    return _start(new, f"{root}/_checkpoint_streak", step)


def cycle_count_stream(
    events: DataFrame, ts: str, root: str, zone: str = CYCLE_ZONE, delay: str = "6 hours"
) -> StreamingQuery:
    """Counts by local day, cycle and source; a closed day leaves the state.

    The three cycles are unequal, so the window is the local day and the cycle label
    is a second key. Each batch writes the groups it changed.
    """
    local = dates.local_time(F.col(ts), zone).cast("timestamp")
    counts = (
        events.withColumn("_local", local)
        .withWatermark("_local", delay)
        .groupBy(
            F.window("_local", "1 day").alias("w"),
            dates.cycle_label(F.col("_local")).alias("cycle"),
            "source",
        )
        .agg(F.count("*").alias("jobs"))
        .select(F.to_date("w.start").alias("day"), "cycle", "source", "jobs")
    )
    return _start(
        counts,
        f"{root}/_checkpoint_cycles",
        lambda batch, batch_id: write_batch(batch, f"{root}/cycles", batch_id),
        mode="update",
    )


def metrics_stream(
    events: DataFrame, ts: str, location: str, failed: Column, is_new: Column, root: str, delay: str = "6 hours"
) -> StreamingQuery:
    """Running metrics per day and location."""
    days = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", delay)
    grouped = run_metrics(
        days.withColumn("w", F.window("_ts", "1 day")), ["w", location], failed, is_new
    ).select(F.to_date("w.start").alias("day"), location, "total_requests", "failed_requests",
             "inserted_jobs", "duplicate_jobs")
    return _start(
        grouped,
        f"{root}/_checkpoint_metrics",
        lambda batch, batch_id: write_batch(batch, f"{root}/metrics", batch_id),
        mode="update",
    )


def graph_stream(jobs: DataFrame, root: str, as_of, key: str = "_id", seq: Column | None = None) -> StreamingQuery:
    """Finished jobs to node and edge tables, one batch folder per table and micro-batch."""

    def step(batch: DataFrame, batch_id: int) -> None:
        write_graph(build_graph(graph_safe(batch), as_of, key, seq), f"{root}/graph", batch_id)

    return _start(jobs, f"{root}/_checkpoint_graph", step)
