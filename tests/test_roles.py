"""The role cascade: golden rows, and dictionaries that are broadcast or shuffled."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from jobloom.operators import nearest, roles, skills
from jobloom.operators.lookup import distinct_lists, list_key
from jobloom.operators.nearest import nearest_roles
from jobloom.plans import views

GOLDEN = [
    (1, None, [], "Others", "no_data"),
    (2, "Senior Data Engineer", [], "Data Engineer", "title_priority"),
    (3, "Full Stack Developer", [], "Fullstack Developer", "title_priority"),
    (4, "DBA lead", [], "Database Engineer / DBA", "title_priority"),
    (5, "Store Keeper", ["communication"], "Near", "onet"),
    (6, "Programmer", ["react", "javascript", "css"], "Frontend Developer", "skills_and_title"),
    (7, "Programmer", ["react", "javascript", "css", "python"], "Fullstack Developer", "skills_and_title"),
    (8, "Engineer", ["sql", "kafka"], "Data Engineer", "skills_and_title"),
    (9, "Engineer", ["hibernate"], "Backend Developer", "skills_and_title"),
    (10, "HR analyst", ["recruitment", "payroll"], "HR Manager", "skills_and_title"),
    (11, "Talent analyst", ["recruitment", "payroll"], "HR / Talent Acquisition", "skills_and_title"),
    (12, "Data person", ["machine learning", "pandas"], "Data Scientist / ML Engineer", "low_confidence_ml"),
    (13, "Engineer", ["tensorflow"], "Data Scientist / ML Engineer", "low_confidence_ml"),
    (14, "Engineer", ["etl"], "Data Engineer", "low_confidence_data"),
    (15, "Engineer", ["kotlin"], "Software Engineer / Developer", "low_confidence"),
    (16, "Engineer", [], "Near", "onet"),
    # no vector for this row
    (17, "Store Keeper", [], "Others", "onet"),
]


@pytest.fixture(scope="module")
def tables(spark):
    jobs = spark.createDataFrame([r[:3] for r in GOLDEN], "k bigint, title string, skills array<string>")
    vectors = spark.createDataFrame([(r[0], [1.0, 0.1]) for r in GOLDEN if r[0] != 17], "key bigint, vector array<double>")
    role_vec = spark.createDataFrame(
        [("Far", 0, [0.0, 1.0]), ("Near", 1, [2.0, 0.0]), ("Twin of near", 2, [4.0, 0.0])],
        "role string, ord bigint, vector array<double>",
    )
    return jobs, vectors, role_vec


@pytest.fixture(params=["10m", "-1"])
def joins(spark, request):
    """Dictionaries small enough to broadcast, and joins by shuffle alone."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, request.param)
    yield request.param
    spark.conf.set(setting, before)


@pytest.mark.parametrize("partitions", [1, 5])
def test_golden_rows(spark, tables, joins, partitions):
    jobs, vectors, role_vec = tables
    out = roles.find_role(
        jobs.repartition(partitions), "k", "title", "skills", views.taxonomy(spark), views.role_skill(spark),
        role_vec, vectors,
    )
    got = {r["k"]: (r["role"], r["extracted_by"]) for r in out.collect()}
    assert got == {r[0]: r[3:] for r in GOLDEN}


def test_a_list_in_most_rows(spark, joins):
    """Nine tenths of the rows share one list: it is looked up once, and no row is lost or doubled."""
    jobs = spark.range(5000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, "Engineer").otherwise("Programmer").alias("title"),
        F.when(F.col("id") % 10 > 0, F.array(F.lit(" SQL"), F.lit("kafka"))).otherwise(F.array(F.lit("sql"), F.col("id").cast("string"))).alias("skills"),
        F.lit("kept").alias("skill"),
    )
    lists = distinct_lists(jobs, skills.canonical_terms("skills"))
    assert lists.count() == 501
    out = roles.decide(jobs, "title", "skills", views.taxonomy(spark), views.role_skill(spark))
    got = out.groupBy((F.col("k") % 10 > 0).alias("hot"), "role", "extracted_by").count().collect()
    assert {(r["role"], r["extracted_by"], r["count"]) for r in got if r["hot"]} == {("Data Engineer", "skills_and_title", 4500)}
    assert sum(r["count"] for r in got) == 5000 and out.filter("skill = 'kept'").count() == 5000


def test_list_keys_tell_lists_apart(spark):
    lists = [None, [], [""], [None], ["a"], ["a", "b"], ["b", "a"], ["a,b"], ["a", "a"], ["-"], ["", ""], ["null"], ["x" * 100_000]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "k int, s array<string>")
    keys = [r[0] for r in df.orderBy("k").select(list_key(F.col("s"))).collect()]
    assert keys[:2] == [None, None] and len({bytes(k) for k in keys[2:]}) == len(lists) - 2
    again = skills.classify_skills(df.unionByName(df), "s", views.taxonomy(spark), "found")
    assert again.count() == 2 * len(lists) and again.filter("k < 2 AND size(found.unknown) = 0").count() == 4
    assert skills.classify_skills(df.limit(0), "s", views.taxonomy(spark)).count() == 0


def test_classify_with_ties_and_repeated_keys(spark, joins):
    """Rows that share a key stay apart; null precedence loses, a tie goes by name."""
    df = spark.createDataFrame(
        [(1, [" Python", "JIRA", "python", "nope", "communication "]), (2, []), (3, None), (4, ["react"]), (4, ["python", None])],
        "k int, s array<string>",
    )
    taxonomy = spark.createDataFrame(
        [("python", "technical", 0), ("python", "tools", 1), ("jira", "tools", None), ("jira", "soft", 7),
         ("communication", "technical", 2), ("communication", "soft", 2), ("react", "technical", None)],
        "skill string, bucket string, precedence int",
    )
    rows = skills.classify_skills(df, "s", taxonomy).collect()
    by = {}
    for r in rows:
        by.setdefault(r["k"], []).append(r["skills"])
    first = by[1][0]
    assert first.technical == ["python", "python"] and first.tools == [] and first.unknown == ["nope"]
    assert first.soft == ["jira", "communication"]
    assert by[2][0].technical == [] and by[3][0].technical == []
    assert sorted(x.technical for x in by[4]) == [["python"], ["react"]]


def test_role_under_two_numbers_is_one_role(spark, joins):
    role_skill = spark.createDataFrame(
        [("Data Engineer", 5, "sql"), ("Data Engineer", 1, "kafka"), ("R", 2, "sql"), ("R", 2, "Sql"), ("R", 2, "x")],
        "role string, role_ord int, skill string",
    )
    jobs = spark.createDataFrame([(1, "Engineer", ["sql", "kafka"])], "k int, title string, skills array<string>")
    out = roles.decide(jobs, "title", "skills", views.taxonomy(spark), role_skill).first()
    assert (out["role"], out["extracted_by"]) == ("Data Engineer", "skills_and_title")


def test_repeated_vectors_and_embedder(spark, tables):
    jobs, vectors, role_vec = tables
    args = ("k", "title", "skills", views.taxonomy(spark), views.role_skill(spark), role_vec)
    out = roles.find_role(jobs, *args, vectors.union(vectors))
    assert out.count() == jobs.count()

    def stub(texts: list[str]) -> list[list[float]]:
        assert all(t for t in texts)
        return [[1.0, 0.1] if "Keeper" in t else [0.0, 2.0] for t in texts]

    got = {r["k"]: r["role"] for r in roles.find_role(jobs, *args, embedder=stub).filter("extracted_by = 'onet'").collect()}
    assert got == {5: "Near", 16: "Far", 17: "Near"}


def test_cascade_is_evaluated_once(spark, tables):
    jobs, vectors, role_vec = tables
    out = roles.find_role(jobs, "k", "title", "skills", views.taxonomy(spark), views.role_skill(spark), role_vec, vectors)
    text = out._jdf.queryExecution().optimizedPlan().toString()
    # the decided rows are written, and both the settled rows and the others are read from there
    assert text.count("low_confidence_ml") == 0 and text.count("extracted_by") > 0


def test_cells_out_of_reach_are_not_visited(spark):
    """Roles in far clusters: a row meets its own cell, then next to none of the others; the nearest role is still exact."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    role_rows = np.repeat(centres, 20, axis=0) + 0.05 * rng.normal(size=(240, 16))
    query_rows = centres[rng.integers(12, size=300)] + 0.05 * rng.normal(size=(300, 16))
    role_vec = spark.createDataFrame([(f"r{j}", j, v.tolist()) for j, v in enumerate(role_rows)], "role string, ord bigint, vector array<double>")
    queries = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(query_rows)], "k bigint, v array<double>")
    scores = query_rows @ (role_rows / np.linalg.norm(role_rows, axis=1, keepdims=True)).T
    assert {r["k"]: r["role"] for r in nearest_roles(queries, "k", "v", role_vec).collect()} == {i: f"r{j}" for i, j in enumerate(scores.argmax(axis=1))}
    index = nearest.index_roles(role_vec)
    units = [(i, (v / np.linalg.norm(v)).tobytes()) for i, v in enumerate(query_rows)]
    planned = index.plan(spark.createDataFrame(units, "rid long, unit binary"), 1)
    first = planned.selectExpr("rid", "unit", "explode(slice(cells, 1, first)) cell")
    found = nearest._best(index.match(first, 1), 1)
    visits, cells = nearest.second_visits(planned, found, 1).count(), len(index.cells)
    assert cells >= 10 and first.count() == 300 and visits < 0.2 * 300 * (cells - 1)


def test_hot_cell_is_many_groups(spark, monkeypatch):
    """Most rows are nearest to one cell, and one vector belongs to many roles: groups stay small, ties go to the first role."""
    monkeypatch.setattr(nearest, "GROUP_ROWS", 16)
    role_vec = spark.createDataFrame([(f"r{j:03}", j, [1.0, 0.0] if j < 90 else [0.0, 1.0 + j]) for j in range(100)], "role string, ord bigint, vector array<double>")
    queries = spark.createDataFrame([(i, [1.0, 0.001 * i]) for i in range(200)] + [(200, [0.0, 3.0])], "k bigint, v array<double>")
    found = {(r["k"], r["place"]): r["role"] for r in nearest_roles(queries, "k", "v", role_vec, k=2, block_bytes=64).collect()}
    assert len(found) == 402 and all(found[i, 1] == "r000" and found[i, 2] == "r001" for i in range(200)) and found[200, 1] == "r090"


@pytest.mark.parametrize("block_bytes", [64 * 1024 * 1024, 70])
def test_nearest_against_brute_force(spark, block_bytes):
    rng = np.random.default_rng(1)
    role_rows = rng.normal(size=(9, 4))
    query_rows = rng.normal(size=(30, 4))
    role_vec = spark.createDataFrame(
        [(f"r{i}", i, [float(x) for x in v]) for i, v in enumerate(role_rows)] + [("null", 50, None), ("short", 51, [1.0])],
        "role string, ord bigint, vector array<double>",
    )
    queries = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(query_rows)] + [(99, None), (100, [0.0] * 4), (None, None)],
        "k bigint, v array<double>",
    )
    got = {}
    for r in nearest_roles(queries, "k", "v", role_vec, k=2, block_bytes=block_bytes).collect():
        got.setdefault(r["k"], {})[r["place"]] = r["role"]
    unit = role_rows / np.linalg.norm(role_rows, axis=1, keepdims=True)
    scores = query_rows @ unit.T
    want = {i: {p + 1: f"r{j}" for p, j in enumerate(np.argsort(-s)[:2])} for i, s in enumerate(scores)}
    assert got == want


def test_roles_that_fit_one_block_move_no_rows(spark, monkeypatch):
    """Few roles go to every task: no cells, no shuffle of rows; bad vectors have no role, equal roles are taken in order."""
    monkeypatch.setattr(nearest, "index_roles", lambda *_: pytest.fail("rows are moved to cells"))
    role_vec = spark.createDataFrame(
        [("b", 2, [1.0, 0.0]), ("a", 1, [2.0, 0.0]), ("up", 3, [0.0, 1.0]), ("bad", 0, [0.0, 0.0]), ("short", 0, [1.0])],
        "role string, ord bigint, vector array<double>",
    )
    rows = [(1, [3.0, 0.1]), (1, [0.1, 2.0]), (2, None), (3, [None, 1.0]), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [1.0]), (None, [1.0, 0.0])]
    out = nearest_roles(spark.createDataFrame(rows, "k bigint, v array<float>"), "k", "v", role_vec, k=2)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    found = sorted((r["k"] or 0, r["place"], r["role"]) for r in out.collect())
    assert found == [(0, 1, "a"), (0, 2, "b"), (1, 1, "a"), (1, 1, "up"), (1, 2, "a"), (1, 2, "b")]


def test_repeated_keys_of_vectors_count_once(spark, monkeypatch):
    """The least vector of a key counts, whether its roles fit one block or not; only keys and names are shuffled for the others."""
    jobs = spark.createDataFrame([(k, "Store Keeper", []) for k in (1, 1, 2, 3, None)], "k bigint, title string, skills array<string>")
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (1, None), (2, [1.0, 0.0]), (3, None), (None, [1.0, 0.0])], "key bigint, vector array<double>")
    role_vec = spark.createDataFrame([("x", 1, [1.0, 0.0]), ("y", 2, [0.0, 1.0])], "role string, ord bigint, vector array<double>")
    want = [(0, "Others"), (1, "y"), (1, "y"), (2, "x"), (3, "Others")]
    for block in (roles.block_roles, lambda _: None):
        monkeypatch.setattr(roles, "block_roles", block)
        out = roles.find_role(jobs, "k", "title", "skills", views.taxonomy(spark), views.role_skill(spark), role_vec, vectors)
        assert sorted((r["k"] or 0, r["role"]) for r in out.collect()) == want


def test_no_role_vectors(spark, tables):
    jobs, vectors, role_vec = tables
    out = roles.find_role(
        jobs, "k", "title", "skills", views.taxonomy(spark), views.role_skill(spark), role_vec.limit(0), vectors
    )
    assert {r["role"] for r in out.filter("extracted_by = 'onet'").collect()} == {"Others"}


def test_unmatched_skills_need_the_last_branch(spark):
    df = spark.createDataFrame(
        [(1, "Data Engineer", "t", ["figma", "sql"], True), (2, "Data Engineer", "t", ["figma"], False), (3, "Near", "t", ["figma"], True)],
        "k int, role string, title string, technical array<string>, fell_through boolean",
    )
    rows = roles.unmatched_skills(df, "k", "title", views.role_skill(spark)).collect()
    assert [(r["k"], r["skill"]) for r in rows] == [(1, "figma")]
