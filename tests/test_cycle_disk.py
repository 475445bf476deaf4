"""What a cycle shuffles: a job's rows are dealt once, digests as half their letters, and payloads stay where they lie."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from jobloom import schemas
from jobloom.functions.values import packed, unpacked
from jobloom.operators import analytics, deltas, graph, roles, staging
from jobloom.plans import counts, cycle, views
from jobloom.sources import readers, sinks, state


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def digest(n):
    return hashlib.sha256(str(n).encode()).hexdigest()


def test_packed_keys_come_back(spark):
    keys = [digest(1), digest(1).upper(), digest(2)[:62], digest(2) + "aa", "z" * 64, "0" * 64, "", "a", "ü", "\x01a", None]
    rows = spark.createDataFrame([(k,) for k in keys], "k STRING").select("k", packed(F.col("k")).alias("p"))
    found = rows.select("k", unpacked(F.col("p")).alias("back"), F.length("p").alias("n"), F.hex("p").alias("p")).collect()
    assert [r["back"] for r in found] == keys and found[0]["n"] == 33
    assert len({r["p"] for r in found}) == len(keys)


def test_tables_of_a_job_are_written_where_its_rows_lie(spark, tmp_path, monkeypatch):
    plans, write = {}, state._write
    monkeypatch.setattr(state, "_write", lambda rows, path: plans.update({path.split("/")[-2]: plan(rows)}) or write(rows, path))
    root = str(tmp_path)
    blank = spark.createDataFrame([], schemas.JOB)
    jobs = [(digest(i), f"{i}", "r" if i % 2 else "q", f"c{i % 3}", 1.0 * i) for i in range(40)]
    rows = spark.createDataFrame(jobs, "_id STRING, job_id STRING, role_title STRING, company_name STRING, salary_min DOUBLE")
    rows = rows.withColumns({"salary_max": F.col("salary_min"), "is_ingested": F.lit(False), "skills": F.expr("named_struct('technical', array('a', 'b'), 'tools', array('t'), 'soft', array())").cast(blank.schema["skills"].dataType)})
    sinks.write_batch(blank.unionByName(rows, allowMissingColumns=True), f"{root}/jobs", 0)
    assert cycle.ingest_jobs(spark, root, 0, "2024-01-01") == 40
    assert set(graph.BY_JOB) < set(plans) and all("Exchange" not in plans[name] for name in graph.BY_JOB)
    dealt = {}
    for e in state.manifest(spark, f"{root}/state", 0):
        if e["table"] in graph.BY_JOB and e["bucket"] is not None:
            for r in spark.read.parquet(f"{root}/state/{e['table']}/{e['folder']}/bucket={e['bucket']}").collect():
                dealt.setdefault(r["job_key"], set()).add(e["bucket"])
    assert len(dealt) == 40 and all(len(b) == 1 for b in dealt.values())
    assert state.read_state(spark, f"{root}/state", "edge_requires").count() == 80
    assert not state.folders(spark, f"{root}/pending")
    # a later batch is merged into the same buckets, also one that replaces a row
    later = {"edge_requires": spark.createDataFrame([(digest(0), "a"), (digest(0), "c"), (digest(99), "a")], "job_key STRING, skill STRING")}
    state.upsert_state(spark, later, graph.KEYS, f"{root}/state", 1)
    assert state.read_state(spark, f"{root}/state", "edge_requires").count() == 82


def test_states_of_older_manifests_keep_their_buckets(spark, tmp_path):
    """A manifest without `dealt_by` deals by all keys, and goes on so when asked for another way."""
    root, keys = str(tmp_path), {"links": ["id", "to"]}
    rows = spark.range(60).select(F.col("id").cast("string").alias("id"), F.lit("x").alias("to"))
    state.upsert_state(spark, {"links": rows}, keys, root, 0, buckets=4)
    path = f"{root}/_manifest/version=0"
    old = spark.createDataFrame(spark.read.parquet(path).drop("dealt_by").collect(), "table STRING, bucket INT, folder STRING, buckets INT, schema STRING")
    old.write.mode("overwrite").parquet(path)
    state.upsert_state(spark, {"links": rows.limit(20)}, keys, root, 1, by={"links": ["id"]}, dealt=("links",))
    assert state.read_state(spark, root, "links").count() == 60
    assert state.read_touched(spark, root, "links", rows, keys["links"], 1).count() == 60


def role_tables(spark):
    jobs = spark.createDataFrame([("a", "2025-01-01"), ("a", "2025-01-01"), ("b", "2023-01-01"), (None, "2025-01-01"), ("c", "2025-01-01")], "job_key STRING, e STRING")
    jobs = jobs.select("job_key", F.col("e").cast("timestamp_ntz").alias("expires_at"))
    maps = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("b", "x"), ("c", None), (None, "x"), (None, "z"), ("d", "y")], "job_key STRING, role_title STRING")
    posted = spark.createDataFrame([("a", "k1"), ("a", "k1"), ("a", "k2"), ("b", None), ("c", "k3"), (None, "k9"), ("e", "k1")], "job_key STRING, company STRING")
    offers = spark.createDataFrame([("a", 1.0, 3.0), ("a", 5.0, None), ("b", 9.0, 9.0), ("c", 0.0, 0.0), (None, 7.0, 7.0)], "job_key STRING, min DOUBLE, max DOUBLE")
    return jobs, maps, posted, offers


@pytest.mark.parametrize("ignore_zero", [False, True])
def test_role_stats_meet_in_one_shuffle_of_short_keys(spark, ignore_zero):
    jobs, maps, posted, offers = role_tables(spark)
    found = analytics.role_stats(jobs, maps, posted, offers, "2024-01-01", k=2, ignore_zero=ignore_zero)
    assert "job_key" not in "".join(x for x in plan(found).splitlines() if "Exchange" in x) and plan(found).count("Exchange hashpartitioning(_k") == 1
    means = {r["role_title"]: (r["avg_min"], r["avg_max"]) for r in analytics.role_salary_stats(jobs, maps, posted, offers, "2024-01-01", ignore_zero).collect()}
    best = {}
    for r in analytics.role_companies(maps, posted, 2).orderBy("rank").collect():
        best.setdefault(r["role_title"], []).append(r["company"])
    rows = {r["role_title"]: r for r in found.collect()}
    assert {name: (r["avg_min"], r["avg_max"]) for name, r in rows.items()} == means and set(rows) == {"x", "y", "z", None}
    assert {name: r["top_companies"] for name, r in rows.items()} == {name: best.get(name, []) if name else [] for name in rows}


def test_changed_jobs_are_what_a_count_and_a_merge_give(spark):
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    old = spark.createDataFrame([("a", ["r1"], ["s1"]), ("z", ["r9"], []), (None, ["r0"], ["s0"])], "job_key STRING, roles ARRAY<STRING>, skills ARRAY<STRING>").withColumn("expires_at", at("2024-01-01"))
    nodes = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), (None, 1)], "job_key STRING, batch BIGINT").withColumn("expires_at", F.when(F.col("batch") == 2, at("2024-03-01")).otherwise(at("2024-02-01")))
    maps = spark.createDataFrame([("a", "r2"), ("c", "r1"), ("c", "r1"), (None, "r1")], "job_key STRING, role_title STRING")
    needs = spark.createDataFrame([("a", "s1"), ("b", "s2"), (None, "s3")], "job_key STRING, skill STRING")
    dealt = lambda rows: state.shuffled(rows, ["job_key"], ["job_key"], 4)
    mine = deltas.changed_jobs(old, nodes, maps, needs, dealt)
    assert sum("Exchange" in x for x in plan(mine).splitlines()) == 1
    mine = mine.select(unpacked(F.col("job_key")).alias("job_key"), "was", "now")
    theirs = deltas.job_changes(old, deltas.counted_jobs(nodes, maps, needs))
    shown = lambda r: (r["job_key"], r["was"] and tuple(r["was"]), sorted(r["now"]["roles"]), sorted(r["now"]["skills"]), r["now"]["expires_at"])
    assert sorted(map(str, map(shown, mine.collect()))) == sorted(map(str, map(shown, theirs.collect())))


@pytest.mark.parametrize("most", [100, 1])
def test_only_rows_that_share_a_key_meet(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(cycle, "REPEATED_KEYS", most)
    ids = ["1", "2", "2", "3", "3", "3", "", None, "", "4"]
    rows = spark.createDataFrame([(i, str(n)) for n, i in enumerate(ids)], "external_id STRING, payload STRING")
    rows.select(F.lit("naukri").alias("source"), "external_id", "payload", F.lit("new").alias("status"), (F.lit(9) - F.col("payload").cast("int")).cast("timestamp").alias("created_at")).write.parquet(f"{tmp_path}/rows")
    raw = spark.read.parquet(f"{tmp_path}/rows")
    none = readers.no_rows(spark, schemas.RAW)
    found = cycle.staged_once(raw, none, f"{tmp_path}/repeated")
    assert sorted(map(str, found.select(*sorted(found.columns)).collect())) == sorted(map(str, staging.stage_raw(raw, none).select(*sorted(found.columns)).collect()))
    if most == 100:
        single = raw.filter("external_id IN ('1', '4')")
        assert plan(cycle.staged_once(single, none, f"{tmp_path}/none")).count("Exchange hashpartitioning") <= 1


def test_known_ids_travel_packed(spark):
    jobs = spark.createDataFrame([(digest(f"naukri{i}"),) for i in (1, 1, 2)] + [("plain",), (None,)], "_id STRING")
    raw = spark.createDataFrame([("naukri", "1", "queued"), ("naukri", "2", "failed"), ("naukri", None, "queued")], "source STRING, external_id STRING, status STRING")
    assert [r["_id"] for r in staging.known_ids(raw, jobs).collect()] == [digest("naukri1")]


def test_lists_are_looked_up_once(spark, monkeypatch):
    """What the distinct lists hold is read twice, and found only once."""
    seen, candidates = [], roles.candidate_roles
    monkeypatch.setattr(roles, "candidate_roles", lambda lists, *rest: seen.append(plan(lists)) or candidates(lists, *rest))
    rows = spark.createDataFrame([(1, ["React", "css"]), (2, ["zzz"]), (3, None)], "k INT, skills ARRAY<STRING>")
    found = roles.with_profiles(rows, "skills", views.taxonomy(spark), views.role_skill(spark)).collect()
    assert len(seen) == 1 and "Exchange" not in seen[0] and "Scan parquet" in seen[0]
    assert {r["k"]: [c["role"] for c in r["_candidates"] or []] for r in found} == {1: ["Frontend Developer"], 2: [], 3: []}


def test_counts_of_jobs_with_numbers_for_keys(spark, tmp_path):
    root = str(tmp_path)
    for batch, skill in enumerate("st"):
        nodes = spark.range(3).select(F.col("id").alias("job_key"), F.lit("2025-01-01").cast("timestamp_ntz").alias("expires_at"))
        tables = {
            "node_job": nodes,
            "edge_maps_to": nodes.select("job_key", F.lit("r").alias("role_title")),
            "edge_requires": nodes.select("job_key", F.lit(skill).alias("skill")),
        }
        sinks.write_graph(tables, f"{root}/graph", batch)
        counts.update_counts(spark, root, batch, "2024-01-01", buckets=4)
    assert sorted(map(tuple, counts.demand_counts(spark, root).collect())) == [("s", 3), ("t", 3)]
    assert sorted(map(tuple, counts.link_counts(spark, root).collect())) == [("r", "s", 3), ("r", "t", 3)]
