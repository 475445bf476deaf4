"""Staging of raw records, their cleaning status, flags and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.functions.values import packed, unpacked
from jobloom.operators.normalize import normalize, with_job_id

RAW_KEY = ("source", "external_id")


def first_copies(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the first in `order`; rows that tie there are ordered by a hash of all they hold.

    Rows that still tie are the same, so any of them will do. The row_number limit is applied in each task before the shuffle, so a key with
    a third of all rows travels as one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order, F.xxhash64(*df.columns))
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") == 1).drop("_n")


def not_yet(fresh: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `fresh` whose keys are not in `history`.

    The history is first cut to the keys of `fresh`: next to a small increment, which
    the planner can send to the history's tasks, none of the history is shuffled.
    """
    met = history.select(*keys).join(fresh.select(*keys), keys, "left_semi")
    return fresh.join(met, keys, "left_anti")


def stage_raw(
    new: DataFrame, existing: DataFrame, keys: tuple[str, ...] = RAW_KEY, order: tuple[str, ...] = ("created_at",)
) -> DataFrame:
    """New raw rows to append: first copy of each key that is not staged yet, status queued."""
    fresh = first_copies(new.filter(all_present(keys)), list(keys), list(order))
    return not_yet(fresh, existing, list(keys)).withColumn("status", F.lit("queued"))


def stage_counts(new: DataFrame, staged: DataFrame) -> DataFrame:
    """One row: inserted and duplicate counts of a staging run."""
    total = new.filter(all_present(RAW_KEY)).agg(F.count("*").alias("total"))
    return total.select(
        staged.agg(F.count("*")).scalar().alias("inserted"),
        (F.col("total") - staged.agg(F.count("*")).scalar()).alias("duplicates"),
    )


def all_present(keys: tuple[str, ...]) -> Column:
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull() & (F.col(k) != "")
    return ok


def known_ids(raw: DataFrame, jobs: DataFrame) -> DataFrame:
    """The ids of raw rows that are jobs already, once each; ids need no parsing."""
    ids = with_job_id(raw.filter(F.col("status") == "queued").select(*RAW_KEY), *RAW_KEY)
    # packed: where the history is shuffled for them, ids travel as half their letters
    met = jobs.select(packed(F.col("_id")).alias("_k")).join(ids.select(packed(F.col("_id")).alias("_k")), "_k", "left_semi")
    return met.distinct().select(unpacked(F.col("_k")).alias("_id"))


def clean_batch(
    raw: DataFrame,
    jobs: DataFrame,
    order: str = "created_at",
    as_of=None,
    unique: bool = False,
    sources: list[str] | None = None,
    met: bool = False,
) -> DataFrame:
    """Queued raw rows as job rows with the outcome of each in `raw_status` and `error`.

    completed: the row becomes a job. duplicate: its `_id` is a job already, or an
    earlier good row of the batch has it. failed: no external id, or unreadable.
    Earlier means before in (`order`, hash of the payload, place in the batch), nulls
    first, which no two rows share. Rows of `stage_raw` have each key once: pass `unique`
    and the search for earlier rows is left out. `met` says that `jobs` are `known_ids`.
    """
    place = F.struct(F.col(order), F.xxhash64("payload"), F.monotonically_increasing_id())
    queued = raw.filter(F.col("status") == "queued").drop("status").withColumn("_place", place)
    parsed = with_job_id(normalize(queued, as_of, sources), "raw_source", "external_id")
    no_id = F.coalesce(F.col("external_id"), F.lit("")) == ""
    parsed = parsed.withColumn(
        "error", F.when(no_id, F.lit("Missing externalId")).otherwise(F.col("error"))
    )
    # the history is cut to the ids of the batch, which need no parsing, before it meets the wide rows
    known = jobs.select("_id").distinct() if met else known_ids(raw, jobs)
    seen = known.select("_id", F.lit(True).alias("_known"), F.lit(None).cast(parsed.schema["_place"].dataType).alias("_first"))
    if not unique:
        good = parsed.filter(F.col("error").isNull())
        first = good.groupBy("_id").agg(F.min("_place").alias("_first"))
        # one table, so one join: a run-time split of a hot key works on a single join only
        seen = (
            seen.unionByName(first.withColumn("_known", F.lit(False)))
            .groupBy("_id")
            .agg(F.bool_or("_known").alias("_known"), F.min("_first").alias("_first"))
        )
    joined = parsed.join(seen, "_id", "left")
    earlier = F.coalesce(F.col("_place") > F.col("_first"), F.lit(False))
    status = (
        F.when(no_id, "failed")
        .when(F.coalesce("_known", F.lit(False)) | earlier, "duplicate")
        .when(F.col("error").isNotNull(), "failed")
        .otherwise("completed")
    )
    return (
        joined.withColumn("raw_status", status)
        .withColumn("error", F.when(F.col("raw_status") == "failed", F.col("error")))
        .drop("_known", "_first", "_place")
    )


def quarantine(cleaned: DataFrame) -> DataFrame:
    """Failed rows with their error; they are not cleaned again unless replayed."""
    return cleaned.filter(F.col("raw_status") == "failed").select(
        "raw_source", "external_id", "error"
    )


def replay(raw: DataFrame, chosen: DataFrame) -> DataFrame:
    """Put chosen failed rows back to queued."""
    hit = chosen.select(*RAW_KEY).distinct().withColumn("_hit", F.lit(True))
    again = (F.col("status") == "failed") & F.col("_hit")
    return (
        raw.join(hit, list(RAW_KEY), "left")
        .withColumn("status", F.when(again, F.lit("queued")).otherwise(F.col("status")))
        .drop("_hit")
    )


def scan_pending(jobs: DataFrame, flag: str, limit: int | None = None, key: str = "_id") -> DataFrame:
    """Rows whose flag is not set yet: all of them, or the first `limit` by key."""
    pending = jobs.filter(~F.col(flag))
    return pending if limit is None else pending.orderBy(key).limit(limit)


def mark(jobs: DataFrame, acknowledged: DataFrame, flag: str, key: str = "_id") -> DataFrame:
    """Set `flag` on the rows whose key was acknowledged."""
    hit = acknowledged.select(key).distinct().withColumn("_hit", F.lit(True))
    return (
        jobs.join(hit, key, "left")
        .withColumn(flag, F.coalesce("_hit", flag))
        .select(*jobs.columns)
    )


def retention(raw: DataFrame, jobs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What stays: raw rows not completed, jobs not yet in the graph."""
    return (
        raw.filter(~F.coalesce(F.col("status") == "completed", F.lit(False))),
        jobs.filter(~F.coalesce("is_ingested", F.lit(False))),
    )


def retention_counts(raw: DataFrame, jobs: DataFrame) -> DataFrame:
    """(table, deleted, kept) of a retention run."""

    def counts(df: DataFrame, name: str, gone: Column) -> DataFrame:
        gone = F.coalesce(gone, F.lit(False))
        return df.agg(F.count_if(gone).alias("deleted"), F.count_if(~gone).alias("kept")).select(
            F.lit(name).alias("table_name"), "deleted", "kept"
        )

    return counts(raw, "raw_jobs", F.col("status") == "completed").unionByName(
        counts(jobs, "jobs", F.col("is_ingested"))
    )


def publish_view(jobs: DataFrame) -> DataFrame:
    """The fields handed to the downstream store; missing lists become empty."""
    from jobloom.functions.values import array_or_empty

    skills = F.struct(
        *[array_or_empty(F.col(f"skills.{b}")).alias(b) for b in ("technical", "tools", "soft")]
    )
    return jobs.select(
        "job_id", "source", "source_url", "job_title", "role_title", "company_name",
        skills.alias("skills"),
        "min_experience", "max_experience", "difficulty_level",
        "salary_min", "salary_max", "salary_currency", "salary_period",
        "location", "location_state", "location_country", "job_type", "work_mode",
        array_or_empty(F.col("industry")).alias("industry"),
        "description", "posted_at", "expiry_at",
    )
