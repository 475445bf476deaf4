"""Feed bookkeeping: stop rules, high-water marks, cycle filters and run metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from jobloom.fixed_values import CYCLE_SOURCES
from jobloom.functions import dates

#: Parts into which the rows of one feed are spread where they meet its stop.
SALTS = 64


def streaks(
    df: DataFrame, feed: str, seq: str, is_new: str, page: str | None = None, width: int = 100_000, carry: DataFrame | None = None
) -> DataFrame:
    """(feed, page if given, _seq, _streak): how many duplicates in a row end at each position.

    `seq` is a whole number, unique in its feed. A feed is cut into spans of `width`
    positions, so one task never holds more than a span of a hot feed: runs are
    counted inside each span, and the run carried in from earlier spans comes from
    the one summary row per span. With `page` the count starts anew on every page.
    `carry` (feed, page if given, _run) holds runs that stood open before all of these rows.
    """
    runs_of = [feed] if page is None else [feed, page]
    span = F.floor(F.col(seq) / F.lit(width)).alias("_span")
    rows = df.select(*runs_of, span, F.col(seq).alias("_seq"), F.col(is_new).alias("_new"))

    in_span = Window.partitionBy(*runs_of, "_span").orderBy("_seq")
    upto = in_span.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_news", F.sum(F.col("_new").cast("long")).over(upto)).withColumn(
        "_pos", F.row_number().over(in_span)
    )
    in_run = Window.partitionBy(*runs_of, "_span", "_news").orderBy("_seq")
    rows = rows.withColumn(
        "_run",
        F.row_number().over(in_run) - F.when(F.col("_news") > 0, F.lit(1)).otherwise(F.lit(0)),
    )
    spans = rows.groupBy(*runs_of, "_span").agg(
        F.max("_news").alias("_news"), F.max_by("_run", "_seq").alias("_tail")
    )
    if carry is not None:  # like a span in front of all others, without a new row
        before = carry.select(*runs_of, F.lit(-(2**62)).cast("bigint").alias("_span"), F.lit(0).cast("bigint").alias("_news"), F.col("_run").alias("_tail"))
        spans = spans.unionByName(before)
    by_span = Window.partitionBy(*runs_of).orderBy("_span")
    spans = spans.withColumn(
        "_island", F.sum((F.col("_news") > 0).cast("long")).over(by_span)
    )
    in_island = Window.partitionBy(*runs_of, "_island").orderBy("_span")
    tails = spans.withColumn(
        "_sum", F.sum("_tail").over(in_island.rowsBetween(Window.unboundedPreceding, 0))
    )
    carried = tails.withColumn("_carry", F.coalesce(F.lag("_sum").over(by_span), F.lit(0))).select(
        *runs_of, "_span", "_carry"
    )
    streak = F.col("_run") + F.when(F.col("_news") == 0, F.col("_carry")).otherwise(F.lit(0))
    return rows.join(carried, [*runs_of, "_span"]).select(*runs_of, "_seq", streak.alias("_streak"))


def streak_stops(
    df: DataFrame, feed: str, seq: str, is_new: str, k: int, page: str | None = None, width: int = 100_000
) -> DataFrame:
    """(feed, stop): the position at which k duplicates in a row are complete."""
    if k < 1:
        raise ValueError("k must be at least 1")
    complete = streaks(df, feed, seq, is_new, page, width).filter(F.col("_streak") >= k)
    return complete.groupBy(feed).agg(F.min("_seq").alias("stop"))


def _upto(df: DataFrame, feed: str, position: str, stops: DataFrame, salts: int = SALTS) -> DataFrame:
    """Rows up to the stop of their feed; all rows of a feed without one.

    Stops are one row per feed, repeated per salt; the rows of a feed are spread over the salts.
    """
    spread = F.pmod(F.xxhash64(position), F.lit(salts)).cast("int")
    salted = stops.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (
        df.withColumn("_salt", spread)
        .join(salted, [feed, "_salt"], "left")
        .filter(F.col("stop").isNull() | (F.col(position) <= F.col("stop")))
        .select(*df.columns)
    )


def cut_at_streak(
    df: DataFrame, feed: str, seq: str, is_new: str, k: int, page: str | None = None, width: int = 100_000
) -> DataFrame:
    """Rows read before the feed is stopped; the row that completes the streak is the last."""
    return _upto(df, feed, seq, streak_stops(df, feed, seq, is_new, k, page, width))


def page_stops(df: DataFrame, feed: str, page: str, is_new: str, after: int = 5) -> DataFrame:
    """(feed, stop): first page past index `after` without a new row."""
    return (
        df.groupBy(feed, page)
        .agg(F.count_if(F.col(is_new)).alias("n_new"))
        .filter((F.col("n_new") == 0) & (F.col(page) > after))
        .groupBy(feed)
        .agg(F.min(page).alias("stop"))
    )


def cut_at_stale_page(df: DataFrame, feed: str, page: str, is_new: str, after: int = 5) -> DataFrame:
    """Rows of the pages read before (and including) the first stale one."""
    return _upto(df, feed, page, page_stops(df, feed, page, is_new, after))


def since(df: DataFrame, ts: str, mark) -> DataFrame:
    """Rows dated at or after the mark; rows without a date go."""
    return df.filter(F.col(ts) >= dates.moment(mark))


def in_range(df: DataFrame, ts: str, start, end) -> DataFrame:
    """Rows in [start, end)."""
    return df.filter((F.col(ts) >= dates.moment(start)) & (F.col(ts) < dates.moment(end)))


def next_mark(inserted: DataFrame, ts: str, old) -> Column:
    """The mark after a run: latest inserted date, never before the old mark."""
    return F.greatest(dates.moment(old), inserted.agg(F.max(F.col(ts).cast("timestamp_ntz"))).scalar())


def cycle_table(spark: SparkSession, config: dict[str, tuple[str, ...]] = CYCLE_SOURCES) -> DataFrame:
    rows = [(label, source) for label, sources in config.items() for source in sources]
    return spark.createDataFrame(rows, "label string, source string")


def sources_for_cycle(df: DataFrame, label: str, config: DataFrame) -> DataFrame:
    """Rows of the sources that run in a cycle; an unknown label keeps none."""
    active = config.filter(F.col("label") == label).select("source").distinct()
    return df.join(active, "source", "left_semi")


def fresh(df: DataFrame, ts: str, as_of, days: int = 1) -> DataFrame:
    return df.filter(F.col(ts) >= dates.add_days(dates.moment(as_of), -days))


def by_location(df: DataFrame, column: str, places: list[str]) -> DataFrame:
    return df.filter(F.col(column).isin(*places))


def by_keyword(df: DataFrame, column: str, word: str) -> DataFrame:
    return df.filter(F.lower(column).contains(word.lower()))


def run_metrics(df: DataFrame, group: list[str], failed: Column, is_new: Column) -> DataFrame:
    """Requests, failures, inserts and duplicates per group."""
    return df.groupBy(*group).agg(
        F.count("*").alias("total_requests"),
        F.count_if(failed).alias("failed_requests"),
        F.count_if(~failed & is_new).alias("inserted_jobs"),
        F.count_if(~failed & ~is_new).alias("duplicate_jobs"),
    )
