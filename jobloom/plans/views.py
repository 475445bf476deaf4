"""The test tables seen as job-market tables, in Spark and as SQL for the oracle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobloom.functions.values import text_array
from jobloom.plans.fixtures import ROLE_ROWS, ROLE_SKILLS, TAXONOMY, TITLES, VOCAB, sql_list, sql_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tasks(spark: SparkSession) -> int:
    """Tasks for a step that makes much of few bytes, which Spark would otherwise deal out by bytes alone."""
    return max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))


def pick(values: list, n: Column) -> Column:
    """Element n of a literal list."""
    return F.get(text_array(values), n.cast("int"))


def literal(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A small dictionary as a local relation, whose size the planner knows."""
    return spark.sql(f"SELECT * FROM VALUES {sql_rows(rows)} AS t({columns})")


def job_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as jobs; the company is looked up by the queries that need it."""
    o = table(spark, sf_dir, "orders")
    salary_min = F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice"))
    return o.select(
        F.col("o_orderkey").alias("job_key"),
        F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("source"),
        F.col("o_orderpriority").alias("role_title"),
        salary_min.alias("salary_min"),
        (salary_min * 1.25).alias("salary_max"),
        F.col("o_orderdate").alias("posted_at"),
        (F.col("o_orderdate") + F.expr("INTERVAL 90 DAYS")).alias("expires_at"),
        (F.col("o_orderkey") % 5 == 0).alias("is_ingested"),
    )


V_JOBS = """v_jobs AS (
  SELECT o_orderkey AS job_key, o_custkey AS custkey, o_orderstatus AS source, o_orderpriority AS role_title,
         CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS salary_min,
         CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice * 1.25 END AS salary_max,
         o_orderdate AS posted_at, o_orderdate + INTERVAL 90 DAY AS expires_at,
         o_orderkey % 5 = 0 AS is_ingested
  FROM orders)"""


def maps_to_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_view(spark, sf_dir).select("job_key", "role_title")


def company_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(job_key, company) edges."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_name").alias("company"))
    return job_view(spark, sf_dir).select("job_key", "custkey").join(c, "custkey").select("job_key", "company")


V_COMPANY = """v_company AS (
  SELECT o_orderkey AS job_key, c_name AS company FROM orders JOIN customer ON o_custkey = c_custkey)"""


def salary_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_view(spark, sf_dir).filter("salary_min IS NOT NULL").select(
        "job_key", F.col("salary_min").alias("min"), F.col("salary_max").alias("max")
    )


def requires_view(spark: SparkSession, sf_dir: str, fine: bool = False) -> DataFrame:
    """Distinct (job_key, skill) edges from line items."""
    skill = F.concat_ws(" ", "p_name", "p_brand") if fine else F.col("p_name")
    part = table(spark, sf_dir, "part").select("p_partkey", F.lower(skill).alias("skill"))
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("job_key"), "l_partkey")
    return items.join(part, F.col("l_partkey") == F.col("p_partkey")).select("job_key", "skill").distinct()


V_REQUIRES = """v_requires AS (
  SELECT DISTINCT l_orderkey AS job_key, lower(p_name) AS skill
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

V_REQUIRES_FINE = """v_requires AS (
  SELECT DISTINCT l_orderkey AS job_key, lower(concat(p_name, ' ', p_brand)) AS skill
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def tool_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", F.lower("p_type").alias("tool"))
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("job_key"), "l_partkey")
    return items.join(part, F.col("l_partkey") == F.col("p_partkey")).select("job_key", "tool").distinct()


V_TOOLS = """v_tools AS (
  SELECT DISTINCT l_orderkey AS job_key, lower(p_type) AS tool
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def arrivals_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as record arrivals: is_new marks the first event of each (user, type)."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    firsts = (
        e.groupBy("user_id", "event_type").agg(F.min("event_id").alias("event_id"))
        .select("event_id", F.lit(True).alias("is_new"))
    )
    return e.join(firsts, "event_id", "left").select(
        "event_id",
        F.col("ts").alias("created_at"),
        F.col("user_id").cast("string").alias("location"),
        "user_id",
        F.col("event_type").alias("source"),
        F.coalesce("is_new", F.lit(False)).alias("is_new"),
    )


V_ARRIVALS = """v_arrivals AS (
  SELECT event_id, ts AS created_at, CAST(user_id AS VARCHAR) AS location, user_id, event_type AS source,
         event_id = min(event_id) OVER (PARTITION BY user_id, event_type) AS is_new
  FROM events)"""


def title_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("job_key"), pick(TITLES, key % len(TITLES)).alias("title")
    )


V_TITLES = f"""v_titles AS (
  SELECT o_orderkey AS job_key, ({sql_list(TITLES)})[CAST(o_orderkey % {len(TITLES)} AS INT) + 1] AS title
  FROM orders)"""


def basket_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles with the distinct skills of each job; a tenth of the jobs has none.

    A set of skills is bounded by the vocabulary, whatever the number of line items.
    """
    key = F.col("l_orderkey")
    skill = F.when(key % 10 != 0, pick(VOCAB, F.col("l_partkey") % len(VOCAB)))
    skills = (
        table(spark, sf_dir, "lineitem")
        .select(key.alias("job_key"), skill.alias("skill"))
        .groupBy("job_key")
        .agg(F.collect_set("skill").alias("skills"))
    )
    return (
        title_view(spark, sf_dir)
        .join(skills, "job_key", "left")
        .withColumn("skills", F.coalesce("skills", F.array().cast("array<string>")))
    )


V_BASKETS = f"""v_baskets AS (
  SELECT DISTINCT l_orderkey AS job_key, ({sql_list(VOCAB)})[CAST(l_partkey % {len(VOCAB)} AS INT) + 1] AS skill
  FROM lineitem WHERE l_orderkey % 10 <> 0)"""


def taxonomy(spark: SparkSession) -> DataFrame:
    return literal(spark, TAXONOMY, "skill, bucket, precedence")


V_TAXONOMY = f"""v_taxonomy AS (
  SELECT skill, min_by(bucket, precedence) AS bucket
  FROM (VALUES {sql_rows(TAXONOMY)}) t(skill, bucket, precedence) GROUP BY skill)"""


def role_skill(spark: SparkSession) -> DataFrame:
    return literal(spark, ROLE_ROWS, "role, role_ord, skill")


V_ROLE_SKILL = f"""v_role_skill AS (
  SELECT * FROM (VALUES {sql_rows(ROLE_ROWS)}) t(role, role_ord, skill))"""

#: Every so many vectors stands for a role; all others are vectors of jobs.
ROLE_EVERY = 25
ROLE_NAMES = list(ROLE_SKILLS)


def role_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known roles first, then invented ones."""
    place = (F.col("vec_id") / ROLE_EVERY).cast("bigint")
    name = F.coalesce(pick(ROLE_NAMES, place), F.concat(F.lit("Role "), place.cast("string")))
    return table(spark, sf_dir, "embeddings").filter(F.col("vec_id") % ROLE_EVERY == 0).select(
        name.alias("role"), place.alias("ord"), F.col("embedding").cast("array<double>").alias("vector")
    )


V_ROLE_VEC = f"""v_role_vec AS (
  SELECT coalesce(({sql_list(ROLE_NAMES)})[CAST(vec_id // {ROLE_EVERY} AS INT) + 1], 'Role ' || (vec_id // {ROLE_EVERY})) AS role,
         vec_id // {ROLE_EVERY} AS ord, CAST(embedding AS DOUBLE[]) AS vector
  FROM embeddings WHERE vec_id % {ROLE_EVERY} = 0)"""


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors that do not stand for a role."""
    return table(spark, sf_dir, "embeddings").filter(F.col("vec_id") % ROLE_EVERY != 0)


def job_vectors(spark: SparkSession, sf_dir: str, times: int = 1) -> DataFrame:
    """(key, vector): jobs go round the whole table; role vectors, and numbers past the table for `times` > 1, leave gaps."""
    v = item_vectors(spark, sf_dir).select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    size = table(spark, sf_dir, "embeddings").agg(F.max("vec_id") + 1).scalar()
    o = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), (F.col("o_orderkey") % (size * times)).alias("vec_id")
    )
    return o.join(v, "vec_id").select("key", "vector")


def nearest_sql(times: int = 1) -> str:
    """CTEs ending in v_near(job_key, role)."""
    return f"""{V_ROLE_VEC},
v_scored AS (
  SELECT e.vec_id, r.role, row_number() OVER (
           PARTITION BY e.vec_id
           ORDER BY list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), r.vector) DESC, r.ord) AS place
  FROM embeddings e, v_role_vec r WHERE e.vec_id % {ROLE_EVERY} <> 0),
v_near AS (
  SELECT o_orderkey AS job_key, s.role
  FROM orders JOIN v_scored s ON s.vec_id = o_orderkey % ((SELECT max(vec_id) + 1 FROM embeddings) * {times}) AND s.place = 1)"""
