"""Jobs as node and edge tables, and their upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobloom.fixed_values import GRAPH_EXPIRY_DAYS
from jobloom.functions import dates


def latest(df: DataFrame, keys: list[str], seq: str | Column) -> DataFrame:
    """Last write per key. A partial maximum in each task keeps hot keys small."""
    rest = [c for c in df.columns if c not in keys]
    order = F.col(seq) if isinstance(seq, str) else seq
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return picked.select(*keys, "_row.*")


def written(jobs: DataFrame, key: str = "_id") -> Column:
    """Order of writes: the times the rows have, then the key, so that no two jobs tie."""
    times = [c for c in ("updated_at", "created_at") if c in jobs.columns]
    return F.struct(*times, key)


def job_nodes(jobs: DataFrame, as_of, expiry_days: int = GRAPH_EXPIRY_DAYS, key: str = "_id") -> DataFrame:
    """Job properties; creation and expiry count from this write."""
    now = dates.moment(as_of)
    return jobs.select(
        F.col(key).alias("job_key"),
        F.col("job_title").alias("title"),
        "source", "source_url",
        now.alias("created_at"),
        "posted_at",
        dates.add_days(now, expiry_days).alias("expires_at"),
        "min_experience", "max_experience", "location", "location_state", "location_country",
        "job_type", "work_mode", "industry",
    )


def role_nodes(jobs: DataFrame, seq: Column | None = None) -> DataFrame:
    """(role_title, difficulty_level): the level of the last job written."""
    seq = written(jobs) if seq is None else seq
    rows = jobs.filter(F.col("role_title").isNotNull()).select("role_title", "difficulty_level", seq.alias("_seq"))
    return latest(rows, ["role_title"], "_seq").drop("_seq")


def _edges(rows: DataFrame, key: str) -> DataFrame:
    """Edges once each. `_id` is unique among job rows, so its edges need no shuffle."""
    return rows if key == "_id" else rows.distinct()


def maps_to(jobs: DataFrame, key: str = "_id") -> DataFrame:
    rows = jobs.filter(F.col("role_title").isNotNull())
    return _edges(rows.select(F.col(key).alias("job_key"), "role_title"), key)


def posted_by(jobs: DataFrame, key: str = "_id") -> DataFrame:
    rows = jobs.filter(F.col("company_name").isNotNull())
    return _edges(rows.select(F.col(key).alias("job_key"), F.col("company_name").alias("company")), key)


def terms_of(jobs: DataFrame, terms: str, name: str, key: str = "_id") -> DataFrame:
    """Edges from each job to its distinct skills or tools."""
    rows = jobs.select(F.col(key).alias("job_key"), F.explode(F.array_distinct(terms)).alias(name))
    return _edges(rows, key)


def offers_salary(jobs: DataFrame, key: str = "_id") -> DataFrame:
    """Edges to salary nodes; half-open salaries have none."""
    rows = jobs.filter(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull())
    return _edges(
        rows.select(F.col(key).alias("job_key"), F.col("salary_min").alias("min"), F.col("salary_max").alias("max")),
        key,
    )


def whole_salaries(jobs: DataFrame) -> DataFrame:
    """Jobs that may enter the graph: a salary has both ends, or there is none."""
    return jobs.filter(F.col("salary_min").isNull() | F.col("salary_max").isNotNull())


def salary_nodes(jobs: DataFrame, seq: Column | None = None) -> DataFrame:
    """(min, max, currency, period): currency and period of the last job written."""
    seq = written(jobs) if seq is None else seq
    rows = jobs.filter(F.col("salary_min").isNotNull() & F.col("salary_max").isNotNull()).select(
        F.col("salary_min").alias("min"),
        F.col("salary_max").alias("max"),
        F.col("salary_currency").alias("currency"),
        F.col("salary_period").alias("period"),
        seq.alias("_seq"),
    )
    return latest(rows, ["min", "max"], "_seq").drop("_seq")


def endpoint(edges: DataFrame, column: str, name: str) -> DataFrame:
    """Node table of one edge end."""
    return edges.select(F.col(column).alias(name)).distinct()


KEYS = {
    "node_job": ["job_key"],
    "node_role": ["role_title"],
    "node_company": ["name"],
    "node_skill": ["canonical"],
    "node_tool": ["name"],
    "node_salary": ["min", "max"],
    "edge_maps_to": ["job_key", "role_title"],
    "edge_posted_by": ["job_key", "company"],
    "edge_requires": ["job_key", "skill"],
    "edge_uses_tool": ["job_key", "tool"],
    "edge_offers_salary": ["job_key", "min", "max"],
}


#: Tables with a row or more for each job: they are dealt by the job alone, so a job's rows lie in the same bucket of all of them.
BY_JOB = {name: ["job_key"] for name, keys in KEYS.items() if keys[0] == "job_key"}

#: Columns of job rows (and of `graph_safe`) that nodes and edges are made of.
JOB_COLUMNS = (
    "_id", "source", "source_url", "job_title", "role_title", "company_name", "min_experience", "max_experience", "difficulty_level",
    "salary_min", "salary_max", "salary_currency", "salary_period", "location", "location_state", "location_country", "job_type",
    "work_mode", "industry", "posted_at", "created_at", "updated_at", "graph_skills", "graph_tools",
)


def build_graph(jobs: DataFrame, as_of, key: str = "_id", seq: Column | None = None) -> dict[str, DataFrame]:
    """All node and edge tables of a set of `graph_safe` jobs, keyed as in KEYS.

    Jobs with half a salary are held back. `key` identifies a job in the graph: its
    unique `_id`, or a column such as "job_id" that several rows may share; then the
    last row in `seq` order counts, which is the order of writes unless given.
    """
    jobs = whole_salaries(jobs)
    seq = written(jobs) if seq is None else seq
    newest = jobs
    if key != "_id":
        newest = latest(jobs.withColumn("_w", seq), [key], "_w").drop("_w").select(*jobs.columns)
    company, skill, tool = (
        posted_by(jobs, key),
        terms_of(jobs, "graph_skills", "skill", key),
        terms_of(jobs, "graph_tools", "tool", key),
    )
    return {
        "node_job": job_nodes(newest, as_of, key=key),
        "node_role": role_nodes(jobs, seq),
        "node_company": endpoint(company, "company", "name"),
        "node_skill": endpoint(skill, "skill", "canonical"),
        "node_tool": endpoint(tool, "tool", "name"),
        "node_salary": salary_nodes(jobs, seq),
        "edge_maps_to": maps_to(jobs, key),
        "edge_posted_by": company,
        "edge_requires": skill,
        "edge_uses_tool": tool,
        "edge_offers_salary": offers_salary(jobs, key),
    }


def upsert_snapshot(old: DataFrame, new: DataFrame, keys: list[str], keep: list[str] | None = None) -> DataFrame:
    """`old` with the rows of `new` inserted or put in their place; both unique by key.

    Only old rows without a new version are kept, so the large old side meets the
    new keys alone: a small increment is broadcast by size and the old side is not
    shuffled. `keep` lists columns the new write does not set; they survive.
    """
    kept = keep or []
    if kept:
        new = new.drop(*kept).join(old.select(*keys, *kept), keys, "left")
    untouched = old.join(new.select(*keys), keys, "left_anti")
    return untouched.unionByName(new, allowMissingColumns=True).select(*dict.fromkeys([*old.columns, *new.columns]))
