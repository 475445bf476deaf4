"""Streams give the batch result; replays add nothing; plans look as meant."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.operators import analytics, roles
from jobloom.operators.normalize import normalize
from jobloom.operators.ranking import global_row_number
from jobloom.operators.staging import stage_raw
from jobloom.plans import cycle, views
from jobloom.plans.catalog_classify import title_rules_table
from jobloom.plans.catalog_feeds import dictionaries, landing, stream_graph
from jobloom.plans.catalog_records import payloads
from jobloom.plans.cycle import run_cycle
from jobloom.sources import sinks
from jobloom.streaming import jobs as streams

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_clean_stream_takes_arrivals_once(spark, tmp_path):
    root = str(tmp_path)
    raw = payloads(spark, SF, "foundit")
    raw.filter("external_id % 2 = 0").write.parquet(f"{root}/landing/a")
    source = lambda: streams.file_stream(spark, f"{root}/landing/*", schemas.RAW)
    streams.clean_stream(source(), dictionaries(spark), root, "2001-08-01").awaitTermination()
    first = sinks.read_batches(spark, f"{root}/jobs", schemas.JOB).count()
    # all rows land again: the known half is a duplicate, the rest is new
    raw.write.parquet(f"{root}/landing/b")
    streams.clean_stream(source(), dictionaries(spark), root, "2001-08-01").awaitTermination()
    jobs = sinks.read_batches(spark, f"{root}/jobs", schemas.JOB)
    assert first == raw.filter("external_id % 2 = 0").count()
    assert jobs.count() == jobs.select("_id").distinct().count() == raw.count()
    outcome = {r["raw_status"]: r["count"] for r in spark.read.parquet(f"{root}/cleaned").groupBy("raw_status").count().collect()}
    assert outcome == {"completed": raw.count(), "duplicate": first}


def test_first_seen_with_event_time(spark, tmp_path):
    root = str(tmp_path)
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, s int").withColumn("ts", F.timestamp_seconds("s"))
    rows.write.parquet(f"{root}/in")
    once = streams.first_seen(streams.file_stream(spark, f"{root}/in", rows.schema), ["k"], ts="ts")
    streams.append_stream(once, f"{root}/out", f"{root}/cp").awaitTermination()
    assert {r["k"] for r in spark.read.parquet(f"{root}/out").collect()} == {"a", "b"}
    assert spark.read.parquet(f"{root}/out").count() == 2


def test_cycle_again_adds_nothing_and_failures_are_reported(spark, tmp_path):
    root = str(tmp_path)
    raw = payloads(spark, SF, "foundit").limit(200)
    fetched = {"foundit": raw, "naukri": raw.select("source")}  # the second source is broken
    first = {r["step"]: r for r in run_cycle(spark, "MORNING", "2001-08-01 10:00:00", fetched, dictionaries(spark), root).collect()}
    assert first["stage:naukri"]["outcome"] == "failed" and first["stage:naukri"]["error"]
    assert first["clean"]["n_rows"] == first["ingest"]["n_rows"] == raw.count()
    again = {r["step"]: r for r in run_cycle(spark, "MORNING", "2001-08-02 10:00:00", fetched, dictionaries(spark), root, batch=2).collect()}
    assert again["stage:foundit"]["n_rows"] == again["clean"]["n_rows"] == again["ingest"]["n_rows"] == 0
    assert again["total_links"]["n_rows"] == first["total_links"]["n_rows"]


def test_twins_without_time_are_one_job(spark, tmp_path):
    root = str(tmp_path)
    raw = payloads(spark, SF, "foundit").limit(50).withColumn("created_at", F.lit(None).cast("timestamp"))
    raw.unionByName(raw).coalesce(1).write.parquet(f"{root}/landing")
    streams.clean_stream(streams.file_stream(spark, f"{root}/landing", schemas.RAW), dictionaries(spark), root, "2001-08-01").awaitTermination()
    outcome = {r["raw_status"]: r["count"] for r in spark.read.parquet(f"{root}/cleaned").groupBy("raw_status").count().collect()}
    assert outcome == {"completed": 50, "duplicate": 50}
    assert sinks.read_batches(spark, f"{root}/jobs", schemas.JOB).count() == 50


def test_running_an_older_batch_again_leaves_newer_jobs(spark, tmp_path):
    root = str(tmp_path)
    raw = payloads(spark, SF, "foundit").limit(100)
    d = dictionaries(spark)
    run = lambda batch, rows: {r["step"]: r["n_rows"] for r in run_cycle(spark, "MORNING", "2001-08-01 10:00:00", {"foundit": rows}, d, root, batch).collect()}
    first = run(0, raw.filter("external_id % 2 = 0"))
    second = run(1, raw)
    assert first["ingest"] + second["ingest"] == 100
    assert run(0, raw.filter("external_id % 2 = 0"))["ingest"] == first["ingest"]


def test_steps_read_only_job_batches_they_have_not_seen(spark, tmp_path):
    """The ledger names what a step has read; a later step does not open the folders of earlier ones."""
    root = str(tmp_path)
    raw = payloads(spark, SF, "foundit").limit(60)
    d = dictionaries(spark)
    for batch, rows in enumerate(("external_id % 2 = 0", "true")):
        run_cycle(spark, "MORNING", "2001-08-01 10:00:00", {"foundit": raw.filter(rows)}, d, root, batch)
    assert cycle.unseen(spark, root, 2, "ingested_batches") == [] and cycle.unseen(spark, root, 2, "published_batches") == [0, 1]
    assert cycle.unseen(spark, root, 0, "ingested_batches") == [0]
    files = cycle.new_jobs(spark, root, [1]).inputFiles()
    assert len(cycle.new_jobs(spark, root, [1]).select("_id").collect()) == 30 and files
    assert plan(cycle.new_jobs(spark, root, [1])).count("PartitionFilters: [isnotnull(batch") == 1
    assert cycle.publish_jobs(spark, root, 1) == 60 and cycle.publish_jobs(spark, root, 2) == 0
    assert cycle.remove_old_state(spark, root, 1) > 0
    assert cycle.read_state(spark, f"{root}/state", "node_job").count() == 60


def test_half_written_graph_is_not_read(spark, tmp_path):
    root = str(tmp_path)
    sinks.write_batch(spark.range(3).select(F.col("id").alias("name")), f"{root}/node_tool", 0)
    sinks.commit(spark, root, 0)
    sinks.write_batch(spark.range(9).select(F.col("id").alias("name")), f"{root}/node_tool", 1)
    assert sinks.read_graph(spark, root, ["node_tool"])["node_tool"].count() == 3


def test_landings_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    assert landing(spark.range(6400), f"{tmp_path}/in") // 2 >= 32
    assert len(spark.read.parquet(f"{tmp_path}/in").inputFiles()) >= 64
    monkeypatch.setattr("jobloom.plans.catalog_feeds.scratch_dir", lambda *_: f"{tmp_path}/graph")
    stream_graph(spark, SF)
    assert len(spark.read.parquet(f"{tmp_path}/graph/landing").inputFiles()) > 32


def test_rows_are_dealt_out_before_they_become_many(spark):
    text = plan(title_rules_table(spark, SF))
    assert "hashpartitioning(p_partkey" in text and "REPARTITION_BY_NUM" in text


def test_ranges_follow_the_shuffle_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("n"))
    ranked = global_row_number(df, [F.col("n")], "rank")
    assert ranked.filter("rank = n + 1").count() == 1000


def test_rank_limits_before_the_shuffle(spark):
    df = analytics.role_skill_links(views.maps_to_view(spark, SF), views.requires_view(spark, SF))
    assert plan(df).count("WindowGroupLimit") == 2


def test_copies_are_cut_before_the_shuffle(spark):
    raw = spark.range(100).select(
        F.lit("s").alias("source"), (F.col("id") % 3).cast("string").alias("external_id"), F.col("id").alias("created_at")
    )
    text = plan(stage_raw(raw, raw.limit(0)))
    partial, shuffle = text.rindex("WindowGroupLimit"), text.index("Exchange hashpartitioning(")
    assert text.count("WindowGroupLimit") == 2 and partial > shuffle  # children print below


def test_small_increment_leaves_the_history_in_place(spark, tmp_path):
    history = spark.range(200_000).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("external_id"))
    history.write.parquet(f"{tmp_path}/history")
    new = spark.range(199_990, 200_010).select(F.lit("s").alias("source"), F.col("id").cast("string").alias("external_id"), F.lit(None).cast("timestamp").alias("created_at"))
    out = stage_raw(new, spark.read.parquet(f"{tmp_path}/history"))
    assert sorted(int(r.external_id) for r in out.collect()) == list(range(200_000, 200_010))
    out.write.format("noop").mode("overwrite").save()
    text = out._jdf.queryExecution().executedPlan().toString()
    assert any("BroadcastHashJoin" in line and "LeftSemi" in line for line in text.splitlines())


def test_time_filter_reaches_the_scan(spark):
    events = views.table(spark, SF, "events").select(F.col("ts").alias("created_at"), F.col("event_type").alias("source"))
    text = plan(analytics.source_counts(events, "2024-01-05", "2024-01-06"))
    assert "GreaterThanOrEqual(ts" in text and "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text


def test_cascade_joins_its_rows_once(spark):
    """One distinct list is what the dictionaries meet; the rows themselves are joined once and never enter Python."""
    jobs = views.table(spark, SF, "orders").select(
        F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("title"), F.array("o_orderstatus").alias("skills")
    )
    df = roles.decide(jobs, "title", "skills", views.taxonomy(spark), views.role_skill(spark))
    text = plan(df)
    assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text
    # scans that read the rows' own key: the row side of the one join back
    assert sum("o_orderkey" in line and "ReadSchema" in line for line in text.splitlines()) == 1


def test_payload_is_parsed_once_per_source(spark):
    df = normalize(payloads(spark, SF, "hirist")).filter("error IS NULL").select("job_id", "salary_min", "posted_at")
    assert plan(df).count("from_json(StructField(id") <= 4
