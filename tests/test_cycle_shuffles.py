"""Wide rows of a cycle meet small tables of keys where they lie."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.operators import roles, staging
from jobloom.plans import cycle, views
from jobloom.sources import readers, sinks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def raw_rows(spark, *ids):
    rows = spark.createDataFrame([(str(i), str(n)) for n, i in enumerate(ids)], "external_id STRING, payload STRING")
    return rows.select(F.lit("naukri").alias("source"), "external_id", "payload", F.lit("queued").alias("status"), F.lit("2024-01-01").cast("timestamp").alias("created_at"))


def test_clean_batch_shuffles_nothing_without_jobs(spark, tmp_path):
    none = readers.read_or_empty(spark, f"{tmp_path}/nothing", schemas.JOB)
    cleaned = staging.clean_batch(raw_rows(spark, 1, 2), none, unique=True, sources=["naukri"])
    assert "Exchange" not in plan(cleaned)
    assert cleaned.count() == 2


def test_rows_meet_their_lists_without_a_shuffle(spark, tmp_path):
    spark.createDataFrame([(1, ["React", "css"]), (2, ["zzz"]), (3, None), (4, [])], "k INT, skills ARRAY<STRING>").write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    found = roles.with_profiles(rows, "skills", views.taxonomy(spark), views.role_skill(spark))
    assert "Exchange hashpartitioning" not in plan(found)
    buckets = {r["k"]: [(t["skill"], t["bucket"]) for t in r["_tagged"]] for r in found.collect()}
    assert buckets[1] == [("react", "technical"), ("css", "technical")] and buckets[3] == buckets[4] == [] and buckets[2][0][1] is None


def test_only_new_records_are_staged_and_failed_ones_come_again_when_asked(spark, tmp_path):
    root = str(tmp_path)
    stage = lambda batch, again, *ids: cycle.stage_source(raw_rows(spark, *ids), "naukri", root, batch, again)
    assert stage(0, False, 1, 2, 2, "", 3) == 3
    assert stage(1, False, 1, 3, 4, 4) == 1
    log = [("naukri", "1", "failed"), ("naukri", "2", "completed"), ("naukri", "3", "failed")]
    sinks.write_batch(spark.createDataFrame(log, "raw_source STRING, external_id STRING, raw_status STRING"), f"{root}/cleaned", 1)
    sinks.write_batch(spark.createDataFrame([("naukri", 0)], cycle.CLEANED), f"{root}/cleaned_batches", 1)
    assert stage(2, False, 1, 2, 3, 4) == 0
    assert stage(3, True, 1, 5) == 3
    rows = sinks.read_batches(spark, f"{root}/raw/naukri", schemas.RAW).filter("batch = 3").collect()
    assert sorted((r["external_id"], r["status"], r["payload"]) for r in rows) == [("1", "queued", "0"), ("3", "queued", "4"), ("5", "queued", "1")]
