"""Ranking: per group, and over a whole table without a one-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.operators.lookup import computed_once

#: Sampled rows per range, and of all ranges together: they meet in one task.
SAMPLE_ROWS = 64
SAMPLE_BOUND = 65_536


def top_per_group(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First k rows of each group. Spark cuts each task's groups to k rows before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def points_upto(points: Column, key: Column, most: int) -> Column:
    """How many of at most `most` sorted points are not above `key`: a bisection, by falling powers of two."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])

    def further(n: Column, step: Column) -> Column:
        fits = (n + step <= F.size(points)) & (F.get(points, n + step - 1) <= key)
        return F.when(fits, n + step).otherwise(n)

    return F.aggregate(steps, F.lit(0), further)


def global_row_number(df: DataFrame, order: list[Column], name: str, splits: int | None = None) -> DataFrame:
    """1-based position of every row in a total order (ascending `order`, no ties).

    A bounded sample (the rows of the smallest hashes, so the same one in every
    run) gives the split points, each range is numbered on its own, and the range
    sizes give the offsets. There are `splits` ranges, by default as many as the
    session's shuffle partitions, so they grow with what the cluster is set up for.
    Nothing but the sample and the range sizes meets in one task.
    """
    splits = splits or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("_key", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]))
    sample = keyed.select("_key").orderBy(F.xxhash64("_key"), "_key").limit(min(SAMPLE_ROWS * splits, SAMPLE_BOUND))
    step = F.greatest((F.col("n") / F.lit(splits)).cast("int"), F.lit(1))
    points = sample.agg(F.array_sort(F.collect_list("_key")).alias("s"), F.count("*").alias("n")).select(
        F.filter("s", lambda x, i: (F.pmod(i, step) == 0) & (i > 0)).alias("p")
    )
    ranged = computed_once(
        keyed.withColumn("_points", points.scalar()),
        ("_points",),
        # the points are every `step`-th of the sample, so less than two a range
        _range=points_upto(F.col("_points"), F.col("_key"), 2 * splits),
    )
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    # at most 2 * splits rows, whatever the data
    return (
        ranged.join(F.broadcast(offsets), "_range")
        .withColumn(
            name,
            F.row_number().over(Window.partitionBy("_range").orderBy("_key")) + F.col("_offset"),
        )
        .drop("_range", "_offset", "_key")
    )
