"""Properties of staging, feeds, graph and ranking operators."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from jobloom.operators import analytics, feeds, graph, staging
from jobloom.operators.normalize import normalize
from jobloom.operators.ranking import global_row_number
from jobloom.plans.catalog_records import all_payloads
from jobloom.sources import readers, sinks

SF = "/root/testdata/sf0.001"


def same(a, b) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("rows", [0, 1, 300, 6000])
def test_global_row_number(spark, rows):
    df = spark.range(rows).select((F.col("id") % 7).alias("n"), F.sha2(F.col("id").cast("string"), 256).alias("s"))
    ranked = global_row_number(df, [-F.col("n"), F.col("s")], "rank", splits=16).collect()
    ordered = sorted(ranked, key=lambda r: (-r["n"], r["s"]))
    assert [r["rank"] for r in ordered] == list(range(1, rows + 1))


def test_demand_tiers(spark):
    ranks = spark.range(1, 121).select("id", analytics.demand_tier(F.col("id")).alias("tier"))
    sizes = {r["tier"]: r["count"] for r in ranks.groupBy("tier").count().collect()}
    assert sizes == {"critical": 20, "high": 30, "medium": 50, "low": 20}


def brute_stop(rows, k, paged):
    streak, page = 0, None
    for seq, new, p in rows:
        if paged and p != page:
            streak, page = 0, p
        streak = 0 if new else streak + 1
        if streak >= k:
            return seq
    return None


@pytest.mark.parametrize("k", [1, 3, 7])
@pytest.mark.parametrize("paged", [False, True])
def test_streaks_against_brute_force(spark, k, paged):
    rng = random.Random(k)
    data = [(f, i * 3 + rng.randint(0, 2), rng.random() < 0.35, i // 10) for f in "abcd" for i in range(120)]
    data += [("hot", i, i % 40 == 0, i // 50) for i in range(2000)]
    df = spark.createDataFrame(data, "feed string, seq bigint, new boolean, page bigint")
    stops = feeds.streak_stops(df, "feed", "seq", "new", k, page="page" if paged else None, width=8)
    got = {r["feed"]: r["stop"] for r in stops.collect()}
    want = {}
    for feed in ("a", "b", "c", "d", "hot"):
        stop = brute_stop([(s, n, p) for f, s, n, p in data if f == feed], k, paged)
        if stop is not None:
            want[feed] = stop
    assert got == want


def test_normalize_keeps_every_row(spark):
    raw = all_payloads(spark, SF)
    out = normalize(raw)
    assert out.count() == raw.count()
    assert out.filter("error LIKE 'no parser%'").count() == raw.filter("source = 'workday'").count()


def test_unreadable_payload_is_an_error_row(spark):
    raw = spark.createDataFrame(
        [("naukri", "1", "{not json", "queued"), ("FOUNDIT", "2", '{"jobId": 2, "title": "t"}', "queued"), (None, "3", "{}", "queued")],
        "source string, external_id string, payload string, status string",
    ).withColumn("created_at", F.lit("2024-01-01").cast("timestamp"))
    got = {r["external_id"]: (r["error"], r["job_id"]) for r in normalize(raw).collect()}
    assert got["1"][0] and got["2"] == (None, "2") and got["3"][0] == "no parser for null"


def test_stage_twice_is_stage_once(spark):
    new = spark.createDataFrame(
        [("a", "1", 1), ("a", "1", 2), ("a", "2", 3), ("b", "1", 4), ("a", None, 5), ("a", "", 6)],
        "source string, external_id string, created_at int",
    )
    none = new.limit(0)
    once = staging.stage_raw(new, none)
    assert sorted((r["source"], r["external_id"], r["created_at"]) for r in once.collect()) == [("a", "1", 1), ("a", "2", 3), ("b", "1", 4)]
    assert staging.stage_raw(new, once).isEmpty()


def test_clean_batch_duplicates_in_batch(spark):
    payload = '{"jobId": "1", "title": "t", "createdDate": "%s"}'
    rows = [("naukri", "1", payload % "bad", "queued", 1), ("naukri", "1", payload % "2024-01-01", "queued", 2),
            ("naukri", "1", payload % "2024-01-02", "queued", 3), ("naukri", "2", payload % "2024-01-02", "completed", 4)]
    raw = spark.createDataFrame(rows, "source string, external_id string, payload string, status string, created_at int")
    raw = raw.withColumn("created_at", F.timestamp_seconds("created_at"))
    out = staging.clean_batch(raw, raw.selectExpr("'none' AS _id"))
    got = [(r["raw_status"], r["error"]) for r in out.orderBy("created_at").collect()]
    assert got == [("failed", "no posting date"), ("completed", None), ("duplicate", None)]


def test_upsert_with_itself_changes_nothing(spark):
    df = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert same(graph.upsert_snapshot(df, df, ["k"]), df)


def test_latest_and_batches(spark, tmp_path):
    path = str(tmp_path / "log")
    schema = "k BIGINT, v STRING"
    first = spark.createDataFrame([(1, "a"), (2, "a")], schema)
    second = spark.createDataFrame([(2, "b"), (3, "b")], schema)
    sinks.write_batch(first, path, 0)
    for _ in range(2):  # a replayed batch adds nothing
        sinks.write_batch(second, path, 1)
    state = sinks.current(sinks.read_batches(spark, path, schema), ["k"])
    assert sorted(map(tuple, state.collect())) == [(1, "a"), (2, "b"), (3, "b")]
    assert sinks.read_batches(spark, path, schema, before=1).count() == 2


def test_edges_have_their_nodes(spark):
    from jobloom.operators.normalize import graph_safe
    from jobloom.plans.catalog_graph import graph_jobs

    g = graph.build_graph(graph_safe(graph_jobs(spark, SF)), "2001-08-01")
    for edge, column, node, key in [
        ("edge_maps_to", "role_title", "node_role", "role_title"),
        ("edge_posted_by", "company", "node_company", "name"),
        ("edge_requires", "skill", "node_skill", "canonical"),
        ("edge_uses_tool", "tool", "node_tool", "name"),
        ("edge_maps_to", "job_key", "node_job", "job_key"),
    ]:
        assert g[edge].join(g[node], g[edge][column] == g[node][key], "left_anti").isEmpty()
    salary = g["edge_offers_salary"].join(g["node_salary"], ["min", "max"], "left_anti")
    assert salary.isEmpty()


def test_role_stats_weighs_companies(spark):
    jobs = spark.createDataFrame([(1, "2030-01-01"), (2, "2030-01-01"), (3, "2000-01-01")], "job_key int, e string")
    jobs = jobs.withColumn("expires_at", F.col("e").cast("timestamp_ntz"))
    maps = spark.createDataFrame([(1, "r"), (2, "r"), (3, "r")], "job_key int, role_title string")
    posted = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c")], "job_key int, company string")
    offers = spark.createDataFrame([(1, 10.0, 20.0), (2, 40.0, 80.0), (3, 900.0, 900.0)], "job_key int, min double, max double")
    row = analytics.role_stats(jobs, maps, posted, offers, "2024-01-01").first()
    # job 1 matches two companies and counts twice; job 3 is expired and loses its salary only
    assert (row["avg_min"], row["avg_max"], row["top_companies"]) == (20.0, 40.0, ["a", "b", "c"])


def test_strict_taxonomy_misses_unclean_terms(spark):
    texts = spark.createDataFrame([("tools", 1, '["Docker ", "jira"]')], "bucket string, precedence int, value string")
    loose = {r["skill"] for r in readers.taxonomy_from_text(texts).collect()}
    strict = {r["skill"] for r in readers.taxonomy_from_text(texts, strict=True).collect()}
    assert loose == {"docker", "jira"} and strict == {"Docker ", "jira"}


def test_role_skills_keep_order_and_repeats(spark):
    texts = spark.createDataFrame([('{"z": ["b", "a", "b"], "a": ["c"]}',)], "value string")
    rows = [tuple(r) for r in readers.role_skills_from_text(texts).collect()]
    assert rows == [("z", 0, "b"), ("z", 0, "a"), ("z", 0, "b"), ("a", 1, "c")]


def test_read_mark_of_new_feed(spark, tmp_path):
    assert str(readers.read_mark(spark, str(tmp_path / "none"), "f").first()["max_date"]) == "2000-01-01 00:00:00"


def test_bucketed_edges_join_without_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("job_key"), F.col("id").alias("x"))
    sinks.save_bucketed(df, "edge_a", "job_key", 4)
    sinks.save_bucketed(df, "edge_b", "job_key", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark.table("edge_a").join(spark.table("edge_b"), "job_key")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
