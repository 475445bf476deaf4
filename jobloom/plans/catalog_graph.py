"""Catalogue: graph tables, analytics, upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.functions import dates
from jobloom.operators import analytics, graph
from jobloom.operators.staging import publish_view, retention_counts, scan_pending, mark
from jobloom.plans import views
from jobloom.plans.fixtures import AS_OF
from jobloom.plans.registry import query

DATE = "yyyy-MM-dd HH:mm:ss"


def text_time(column) -> "F.Column":
    return F.date_format(column, DATE)


@query(
    "role_skill_top20",
    f"""WITH {views.V_JOBS}, {views.V_REQUIRES},
    f AS (SELECT role_title, skill, count(*) AS frequency FROM v_jobs JOIN v_requires USING (job_key) GROUP BY ALL)
    SELECT role_title, skill, frequency,
           row_number() OVER (PARTITION BY role_title ORDER BY frequency DESC, skill) AS rank
    FROM f QUALIFY rank <= 20""",
)
def role_skill_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.role_skill_links(views.maps_to_view(spark, sf_dir), views.requires_view(spark, sf_dir))


_DEMAND = f"""WITH {views.V_JOBS}, {views.V_REQUIRES_FINE},
    f AS (SELECT skill, count(*) AS demand_count FROM v_requires JOIN v_jobs USING (job_key)
          WHERE expires_at > TIMESTAMP '{AS_OF}' GROUP BY skill),
    r AS (SELECT skill, demand_count, row_number() OVER (ORDER BY demand_count DESC, skill) AS demand_rank FROM f)"""


@query(
    "skill_demand_rank",
    f"""{_DEMAND} SELECT skill, demand_count, demand_rank,
      CASE WHEN demand_rank <= 20 THEN 'critical' WHEN demand_rank <= 50 THEN 'high'
           WHEN demand_rank <= 100 THEN 'medium' ELSE 'low' END AS demand_tier FROM r""",
)
def skill_demand_rank(spark, sf_dir):
    return analytics.skill_demand(
        views.job_view(spark, sf_dir), views.requires_view(spark, sf_dir, fine=True), AS_OF
    )


@query(
    "role_salary_stats",
    f"""WITH {views.V_JOBS} SELECT role_title,
      round(avg(CASE WHEN expires_at > TIMESTAMP '{AS_OF}' THEN salary_min END), 6) AS avg_min,
      round(avg(CASE WHEN expires_at > TIMESTAMP '{AS_OF}' THEN salary_max END), 6) AS avg_max
    FROM v_jobs GROUP BY role_title""",
)
def role_salary_stats(spark, sf_dir):
    stats = analytics.role_salary_stats(
        views.job_view(spark, sf_dir),
        views.maps_to_view(spark, sf_dir),
        views.company_view(spark, sf_dir),
        views.salary_view(spark, sf_dir),
        AS_OF,
    )
    return stats.select(
        "role_title", F.round("avg_min", 6).alias("avg_min"), F.round("avg_max", 6).alias("avg_max")
    )


@query(
    "role_top_companies",
    f"""WITH {views.V_JOBS}, {views.V_COMPANY},
    f AS (SELECT role_title, company, count(*) AS jobs FROM v_jobs JOIN v_company USING (job_key) GROUP BY ALL)
    SELECT role_title, company, jobs,
           row_number() OVER (PARTITION BY role_title ORDER BY jobs DESC, company) AS rank
    FROM f QUALIFY rank <= 10""",
)
def role_top_companies(spark, sf_dir):
    return analytics.role_companies(views.maps_to_view(spark, sf_dir), views.company_view(spark, sf_dir))


@query(
    "role_stats",
    f"""WITH {views.V_JOBS}, {views.V_COMPANY},
    f AS (SELECT role_title, company, count(*) AS jobs FROM v_jobs JOIN v_company USING (job_key) GROUP BY ALL),
    t AS (SELECT *, row_number() OVER (PARTITION BY role_title ORDER BY jobs DESC, company) AS rank
          FROM f QUALIFY rank <= 10),
    c AS (SELECT role_title, string_agg(company, '|' ORDER BY rank) AS top_companies FROM t GROUP BY role_title),
    s AS (SELECT role_title,
             round(avg(CASE WHEN expires_at > TIMESTAMP '{AS_OF}' THEN salary_min END), 6) AS avg_min,
             round(avg(CASE WHEN expires_at > TIMESTAMP '{AS_OF}' THEN salary_max END), 6) AS avg_max
          FROM v_jobs GROUP BY role_title)
    SELECT role_title, avg_min, avg_max, top_companies, '{AS_OF} 00:00:00' AS updated_at
    FROM s LEFT JOIN c USING (role_title)""",
)
def role_stats(spark, sf_dir):
    stats = analytics.role_stats(
        views.job_view(spark, sf_dir),
        views.maps_to_view(spark, sf_dir),
        views.company_view(spark, sf_dir),
        views.salary_view(spark, sf_dir),
        AS_OF,
    )
    return stats.select(
        "role_title",
        F.round("avg_min", 6).alias("avg_min"),
        F.round("avg_max", 6).alias("avg_max"),
        F.array_join("top_companies", "|").alias("top_companies"),
        text_time("updated_at").alias("updated_at"),
    )


@query(
    "job_hours_old",
    f"""WITH {views.V_JOBS} SELECT CAST(job_key AS VARCHAR) AS job_id,
      CAST(floor(epoch(TIMESTAMP '{AS_OF} 09:30:00' - posted_at) / 3600) AS BIGINT) AS hours_old,
      CAST(floor(epoch(TIMESTAMP '{AS_OF} 09:30:00' - posted_at) / 3600) AS BIGINT) % 24 AS hours_part
    FROM v_jobs WHERE posted_at IS NOT NULL AND expires_at > TIMESTAMP '{AS_OF} 09:30:00'
      AND posted_at <= TIMESTAMP '{AS_OF} 09:30:00'""",
)
def job_hours_old(spark, sf_dir):
    as_of = f"{AS_OF} 09:30:00"
    aged = analytics.hours_old(views.job_view(spark, sf_dir), as_of)
    part = dates.hours_since(F.col("posted_at"), dates.moment(as_of), "component")
    return aged.filter(F.col("posted_at") <= dates.moment(as_of)).select(
        F.col("job_key").cast("string").alias("job_id"), "hours_old", part.alias("hours_part")
    )


@query(
    "link_totals",
    f"""WITH {views.V_JOBS}, {views.V_REQUIRES},
    f AS (SELECT role_title, skill, count(*) AS frequency FROM v_jobs JOIN v_requires USING (job_key) GROUP BY ALL),
    t AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY role_title ORDER BY frequency DESC, skill) <= 20)
    SELECT count(*) AS total_links, count(DISTINCT role_title) AS roles, count(DISTINCT skill) AS skills FROM t""",
)
def link_totals(spark, sf_dir):
    return analytics.link_totals(role_skill_top20(spark, sf_dir))


@query(
    "source_counts",
    """SELECT CASE WHEN event_type IN ('error', '') THEN 'unknown' ELSE event_type END AS source, count(*) AS jobs
    FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20 12:00:00' GROUP BY 1""",
)
def source_counts(spark, sf_dir):
    e = views.table(spark, sf_dir, "events").select(
        F.col("ts").alias("created_at"), F.nullif("event_type", F.lit("error")).alias("source")
    )
    return analytics.source_counts(e, "2024-01-05", "2024-01-20 12:00:00")


@query(
    "cycle_report",
    """WITH c AS (SELECT event_type AS source, count(*) AS jobs FROM events
      WHERE ts >= TIMESTAMP '2024-01-20 00:30:00' AND ts < TIMESTAMP '2024-01-20 07:00:00' GROUP BY 1)
    SELECT source, CAST(jobs AS BIGINT) AS jobs FROM c
    UNION ALL SELECT NULL, CAST(coalesce(sum(jobs), 0) AS BIGINT) FROM c""",
)
def cycle_report(spark, sf_dir):
    e = views.table(spark, sf_dir, "events").select(F.col("ts").alias("created_at"), F.col("event_type").alias("source"))
    return analytics.cycle_report(e, "AFTERNOON", "2024-01-20T07:00:00")


_CYCLE_SQL = """SELECT strftime(ts + INTERVAL 330 MINUTE, '%Y-%m-%d') AS day,
      CASE WHEN hour(ts + INTERVAL 330 MINUTE) < 6 THEN 'MORNING'
           WHEN hour(ts + INTERVAL 330 MINUTE) < 13 THEN 'AFTERNOON' ELSE 'NIGHT' END AS cycle,
      event_type AS source, count(*) AS jobs FROM events GROUP BY ALL"""


@query("cycle_totals_by_day", _CYCLE_SQL)
def cycle_totals_by_day(spark, sf_dir):
    e = views.table(spark, sf_dir, "events").select("ts", F.col("event_type").alias("source"))
    return analytics.cycle_totals(e, "ts").withColumn("day", F.col("day").cast("string"))


@query(
    "source_breakdown_text",
    """WITH c AS (SELECT event_type AS source, count(*) AS jobs FROM events GROUP BY 1)
    SELECT string_agg('• ' || source || ': ' || jobs, chr(10) ORDER BY source) AS breakdown FROM c""",
)
def source_breakdown_text(spark, sf_dir):
    e = views.table(spark, sf_dir, "events")
    return analytics.report_text(e.groupBy(F.col("event_type").alias("source")).agg(F.count("*").alias("jobs")))


@query(
    "retention_delete",
    f"""WITH {views.V_JOBS} SELECT 'raw_jobs' AS table_name,
      count_if(o_orderstatus = 'F') AS deleted, count_if(o_orderstatus <> 'F') AS kept FROM orders
    UNION ALL SELECT 'jobs', count_if(is_ingested), count_if(NOT is_ingested) FROM v_jobs""",
)
def retention_delete(spark, sf_dir):
    raw = views.table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderstatus") == "F", "completed").otherwise("queued").alias("status")
    )
    return retention_counts(raw, views.job_view(spark, sf_dir))


def flag_view(spark, sf_dir):
    return views.job_view(spark, sf_dir).select(F.col("job_key").alias("_id"), "is_ingested")


@query(
    "pending_scan",
    "SELECT o_orderkey AS _id FROM orders WHERE o_orderkey % 5 <> 0 ORDER BY o_orderkey LIMIT 250",
)
def pending_scan(spark, sf_dir):
    return scan_pending(flag_view(spark, sf_dir), "is_ingested", limit=250).select("_id")


@query(
    "mark_ingested",
    """SELECT o_orderkey AS _id, o_orderkey % 5 = 0 OR o_orderkey IN
      (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R') AS is_ingested FROM orders""",
)
def mark_ingested(spark, sf_dir):
    written = views.table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("_id"))
    return mark(flag_view(spark, sf_dir), written, "is_ingested")


def graph_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs with every property the graph needs; several jobs share a salary node."""
    jobs = views.job_view(spark, sf_dir)
    company = views.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("company_name")
    )
    k = F.col("job_key")
    low = F.when(k % 4 != 0, F.floor(F.col("salary_min") / 10000) * 10000.0)
    return (
        jobs.join(company, "custkey", "left")
        .withColumn("salary_min", low)
        .withColumn("salary_max", F.when(k % 9 != 0, low * 2))
        .withColumn("job_id", k.cast("string"))
        .withColumn("_id", k)
        .withColumn("job_title", F.concat(F.lit("Job "), k.cast("string")))
        .withColumn("source_url", F.concat(F.lit("/job/"), k.cast("string")))
        .withColumn("difficulty_level", F.when(k % 3 == 0, "senior").otherwise("entry"))
        .withColumn("salary_currency", F.when(k % 2 == 0, "USD"))
        .withColumn("salary_period", F.when(k % 5 == 0, "monthly"))
        .withColumn("company_name", F.when(k % 8 != 0, F.col("company_name")))
        .withColumn("min_experience", (k % 7).cast("int"))
        .withColumn("max_experience", (k % 7 + 2).cast("int"))
        .withColumn("location", F.lit(None).cast("string"))
        .withColumn("location_state", F.lit(None).cast("string"))
        .withColumn("location_country", F.lit("India"))
        .withColumn("job_type", F.lit("fulltime"))
        .withColumn("work_mode", F.lit(None).cast("string"))
        .withColumn("industry", F.array(F.lit("IT"), F.lit(None).cast("string")))
        .withColumn("skills", F.struct(
            F.array(F.concat(F.lit(" Skill"), (k % 11).cast("string")), F.concat(F.lit("skill"), (k % 11).cast("string")), F.lit(" ")).alias("technical"),
            F.array(F.concat(F.lit("Tool"), (k % 6).cast("string"))).alias("tools"),
        ))
    )


def safe_jobs(spark, sf_dir):
    from jobloom.operators.normalize import graph_safe

    return graph_safe(graph_jobs(spark, sf_dir))


_G = """g AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS job_key, o_orderpriority AS role_title,
    CASE WHEN o_orderkey % 4 <> 0 THEN floor(o_totalprice / 10000) * 10000 END AS min,
    CASE WHEN o_orderkey % 9 <> 0 AND o_orderkey % 4 <> 0 THEN floor(o_totalprice / 10000) * 20000 END AS max,
    CASE WHEN o_orderkey % 2 = 0 THEN 'USD' ELSE 'INR' END AS currency,
    CASE WHEN o_orderkey % 5 = 0 THEN 'monthly' ELSE 'year' END AS period,
    CASE WHEN o_orderkey % 3 = 0 THEN 'senior' ELSE 'entry' END AS difficulty_level,
    CASE WHEN o_orderkey % 8 <> 0 THEN c_name END AS company, o_orderdate
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey)"""


@query(
    "graph_job_nodes",
    f"""WITH {_G} SELECT job_key, 'Job ' || job_key AS title, '/job/' || job_key AS source_url,
      '{AS_OF} 00:00:00' AS created_at, strftime(TIMESTAMP '{AS_OF}' + INTERVAL 21 DAY, '%Y-%m-%d %H:%M:%S') AS expires_at,
      strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS posted_at, k % 7 AS min_experience, k % 7 + 2 AS max_experience,
      'IT' AS industry FROM g""",
)
def graph_job_nodes(spark, sf_dir):
    nodes = graph.job_nodes(safe_jobs(spark, sf_dir), AS_OF, key="job_id")
    return nodes.select(
        "job_key", "title", "source_url",
        text_time("created_at").alias("created_at"),
        text_time("expires_at").alias("expires_at"),
        text_time("posted_at").alias("posted_at"),
        F.col("min_experience").cast("bigint").alias("min_experience"),
        F.col("max_experience").cast("bigint").alias("max_experience"),
        F.array_join("industry", "|").alias("industry"),
    )


@query(
    "graph_role_nodes",
    f"WITH {_G} SELECT role_title, arg_max(difficulty_level, k) AS difficulty_level FROM g GROUP BY 1",
)
def graph_role_nodes(spark, sf_dir):
    return graph.role_nodes(safe_jobs(spark, sf_dir))


@query(
    "graph_role_edges", f"WITH {_G} SELECT DISTINCT job_key, role_title FROM g"
)
def graph_role_edges(spark, sf_dir):
    return graph.maps_to(safe_jobs(spark, sf_dir), "job_id")


@query(
    "graph_company_edges",
    f"WITH {_G} SELECT DISTINCT job_key, company FROM g WHERE company IS NOT NULL",
)
def graph_company_edges(spark, sf_dir):
    return graph.posted_by(safe_jobs(spark, sf_dir), "job_id")


@query(
    "graph_skill_edges",
    "SELECT CAST(o_orderkey AS VARCHAR) AS job_key, 'skill' || (o_orderkey % 11) AS skill FROM orders",
)
def graph_skill_edges(spark, sf_dir):
    return graph.terms_of(safe_jobs(spark, sf_dir), "graph_skills", "skill", "job_id")


@query(
    "graph_tool_edges",
    "SELECT CAST(o_orderkey AS VARCHAR) AS job_key, 'tool' || (o_orderkey % 6) AS tool FROM orders",
)
def graph_tool_edges(spark, sf_dir):
    return graph.terms_of(safe_jobs(spark, sf_dir), "graph_tools", "tool", "job_id")


@query(
    "graph_salary_nodes",
    f"""WITH {_G} SELECT min, max, arg_max(currency, k) AS currency, arg_max(period, k) AS period
    FROM g WHERE min IS NOT NULL AND max IS NOT NULL GROUP BY min, max""",
)
def graph_salary_nodes(spark, sf_dir):
    return graph.salary_nodes(safe_jobs(spark, sf_dir))


@query(
    "graph_salary_edges",
    f"WITH {_G} SELECT DISTINCT job_key, min, max FROM g WHERE min IS NOT NULL AND max IS NOT NULL",
)
def graph_salary_edges(spark, sf_dir):
    return graph.offers_salary(safe_jobs(spark, sf_dir), "job_id")


@query(
    "graph_upsert",
    """SELECT o_orderkey AS job_key,
      CASE WHEN o_orderkey % 3 = 0 THEN 'new' ELSE 'old' END || o_orderstatus AS title,
      CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END AS hours_old
    FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0""",
)
def graph_upsert(spark, sf_dir):
    o = views.table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    old = o.filter(k % 2 == 0).select(
        k.alias("job_key"), F.concat(F.lit("old"), "o_orderstatus").alias("title"), F.col("o_totalprice").alias("hours_old")
    )
    new = o.filter(k % 3 == 0).select(k.alias("job_key"), F.concat(F.lit("new"), "o_orderstatus").alias("title"))
    return graph.upsert_snapshot(old, new, ["job_key"], keep=["hours_old"])


@query(
    "publish_view",
    """SELECT CAST(o_orderkey AS VARCHAR) AS job_id, o_orderstatus AS source, 'Job ' || o_orderkey AS job_title,
      ' Skill' || (o_orderkey % 11) || '|skill' || (o_orderkey % 11) || '| ' AS technical, 0 AS n_soft,
      'Tool' || (o_orderkey % 6) AS tools, 1 AS n_industry, 23 AS n_fields
    FROM orders WHERE o_orderkey % 5 <> 0""",
)
def publish_view_query(spark, sf_dir):
    jobs = graph_jobs(spark, sf_dir)
    none = F.lit(None).cast("array<string>")
    jobs = (
        scan_pending(jobs.withColumnRenamed("is_ingested", "is_published"), "is_published")
        .withColumn("skills", F.struct("skills.technical", "skills.tools", none.alias("soft")))
        .withColumn("industry", F.array(F.lit("IT")))
        .withColumn("description", F.lit(""))
        .withColumn("expiry_at", F.col("expires_at"))
    )
    view = publish_view(jobs)
    return view.select(
        "job_id", "source", "job_title",
        F.array_join("skills.technical", "|").alias("technical"),
        F.size("skills.soft").cast("bigint").alias("n_soft"),
        F.array_join("skills.tools", "|").alias("tools"),
        F.size("industry").cast("bigint").alias("n_industry"),
        F.lit(len(view.columns)).cast("bigint").alias("n_fields"),
    )
