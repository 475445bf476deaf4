"""Analytics over the graph tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.fixed_values import CYCLE_ZONE, DEMAND_TIERS
from jobloom.functions import dates
from jobloom.functions.text import report_line
from jobloom.operators.feeds import in_range
from jobloom.operators.ranking import global_row_number, top_per_group


def active(jobs: DataFrame, as_of) -> DataFrame:
    return jobs.filter(F.col("expires_at") > dates.moment(as_of))


def role_skill_links(maps_to: DataFrame, requires: DataFrame, k: int = 20) -> DataFrame:
    """(role_title, skill, frequency, rank): top k skills of each role; expiry plays no part."""
    pairs = (
        maps_to.join(requires, "job_key").groupBy("role_title", "skill").agg(F.count("*").alias("frequency"))
    )
    return top_links(pairs, k)


def top_links(pairs: DataFrame, k: int = 20) -> DataFrame:
    """(role_title, skill, frequency, rank): top k of counted pairs for each role."""
    return top_per_group(pairs, ["role_title"], [F.desc("frequency"), F.asc("skill")], k)


def demand_tier(rank: Column) -> Column:
    out = F.lit("low")
    for tier, last in reversed(DEMAND_TIERS):
        out = F.when(rank <= last, F.lit(tier)).otherwise(out)
    return out


def skill_demand(jobs: DataFrame, requires: DataFrame, as_of) -> DataFrame:
    """(skill, demand_count, demand_rank, demand_tier) over active jobs."""
    counts = (
        requires.join(active(jobs, as_of).select("job_key"), "job_key", "left_semi")
        .groupBy("skill")
        .agg(F.count("*").alias("demand_count"))
    )
    return ranked_demand(counts)


def ranked_demand(counts: DataFrame) -> DataFrame:
    """(skill, demand_count) with the rank over all skills and its tier."""
    ranked = global_row_number(counts, [-F.col("demand_count"), F.col("skill")], "demand_rank")
    return ranked.withColumn("demand_tier", demand_tier(F.col("demand_rank")))


def role_salary_stats(
    jobs: DataFrame, maps_to: DataFrame, posted_by: DataFrame, offers: DataFrame, as_of, ignore_zero: bool = False
) -> DataFrame:
    """(role_title, avg_min, avg_max): averages over the salaries of active jobs.

    Every job counts for its role; expired jobs only lose their salary. A job with
    several companies weighs once per company, as the optional matches multiply.
    """
    live = offers.join(active(jobs, as_of).select("job_key"), "job_key", "left_semi")
    if ignore_zero:
        live = live.filter((F.col("min") > 0) | (F.col("max") > 0))
    per_job = live.groupBy("job_key").agg(
        *[agg(c).alias(f"{c}_{n}") for c in ("min", "max") for n, agg in (("sum", F.sum), ("n", F.count))]
    )
    companies = posted_by.groupBy("job_key").agg(F.count("*").alias("weight"))
    rows = (
        maps_to.join(per_job, "job_key", "left")
        .join(companies, "job_key", "left")
        .withColumn("weight", F.coalesce("weight", F.lit(1)))
    )

    def mean(c: str) -> Column:
        w = F.col("weight")
        return (F.sum(F.col(f"{c}_sum") * w) / F.nullif(F.sum(F.col(f"{c}_n") * w), F.lit(0))).alias(f"avg_{c}")

    return rows.groupBy("role_title").agg(mean("min"), mean("max"))


def role_companies(
    maps_to: DataFrame, posted_by: DataFrame, k: int = 10, active_jobs: DataFrame | None = None
) -> DataFrame:
    """(role_title, company, jobs, rank): companies with most jobs per role.

    Companies of expired jobs count too, unless `active_jobs` is given.
    """
    if active_jobs is not None:
        posted_by = posted_by.join(active_jobs.select("job_key"), "job_key", "left_semi")
    counts = (
        maps_to.join(posted_by, "job_key").groupBy("role_title", "company").agg(F.count("*").alias("jobs"))
    )
    return top_per_group(counts, ["role_title"], [F.desc("jobs"), F.asc("company")], k)


def _key_digest(key: Column) -> Column:
    """Half a SHA-256: keys meet under 16 bytes, as a digest in hex hardly compresses when it is shuffled."""
    return F.substring(F.unhex(F.sha2(key.cast("string").cast("binary"), 256)), 1, 16)


def _role_facts(jobs: DataFrame, maps_to: DataFrame, posted_by: DataFrame, offers: DataFrame, as_of) -> DataFrame:
    """(role_title, companies, active, sums and numbers of min and max) of each role of a job: the four tables meet in one shuffle.

    Only roles may come without a key, and then have nothing else.
    """
    amounts = {c: offers.schema[c].dataType for c in ("min", "max")}
    keyed = F.col("job_key").isNotNull()

    def part(df: DataFrame, kind: str, name: str | None = None) -> DataFrame:
        text = F.col(name) if name else F.lit(None)
        numbers = [(F.col(c) if kind == "salary" else F.lit(None)).cast(t).alias(c) for c, t in amounts.items()]
        return df.select(_key_digest(F.col("job_key")).alias("_k"), F.lit(kind).alias("_kind"), text.cast("string").alias("name"), *numbers)

    rows = (
        part(maps_to, "role", "role_title")
        .unionByName(part(posted_by.filter(keyed), "company", "company"))
        .unionByName(part(offers.filter(keyed), "salary"))
        .unionByName(part(active(jobs, as_of).filter(keyed), "active"))
    )
    of_job, kind = Window.partitionBy("_k"), F.col("_kind")
    facts = rows.repartition("_k").withColumns({
        # a struct, as a company may be null and still counts
        "companies": F.collect_list(F.when(kind == "company", F.struct("name"))).over(of_job),
        "active": F.max(kind == "active").over(of_job),
        **{f"{c}_{n}": agg(c).over(of_job) for c in amounts for n, agg in (("sum", F.sum), ("n", F.count))},
    })
    return facts.filter(kind == "role").withColumnRenamed("name", "role_title").drop("_k", "_kind", *amounts)


def role_stats(jobs, maps_to, posted_by, offers, as_of, k: int = 10, ignore_zero: bool = False) -> DataFrame:
    """(role_title, avg_min, avg_max, top_companies, updated_at), as `role_salary_stats` and `role_companies` have them."""
    if ignore_zero:
        offers = offers.filter((F.col("min") > 0) | (F.col("max") > 0))
    facts = _role_facts(jobs, maps_to, posted_by, offers, as_of)
    sums = [f"{c}_{n}" for c in ("min", "max") for n in ("sum", "n")]
    entry = "struct<paid:boolean,company:string,n:bigint," + ",".join(f"{c}:{facts.schema[c].dataType.simpleString()}" for c in sums) + ">"
    none = F.lit(None)
    # a job's salaries weigh once for each of its companies
    weight = F.greatest(F.size("companies"), F.lit(1)).cast("bigint")
    paid = F.struct(F.lit(True), none, weight, *[F.when(F.col("active"), F.col(c)) for c in sums]).cast(entry)
    hired = F.transform("companies", lambda c: F.struct(F.lit(False), c["name"], F.lit(1), *[none for _ in sums]).cast(entry))
    rows = facts.select("role_title", F.inline(F.concat(F.array(paid), hired)))
    totals = rows.groupBy("role_title", "paid", "company").agg(F.sum("n").alias("jobs"), *[F.sum(F.col(c) * F.col("n")).alias(c) for c in sums])
    # the row of the salaries comes first
    ranked = top_per_group(totals, ["role_title"], [F.desc("paid"), F.desc("jobs"), F.asc("company")], k + 1)
    mean = lambda c: F.max(F.when(F.col("paid"), F.col(f"{c}_sum") / F.nullif(f"{c}_n", F.lit(0)))).alias(f"avg_{c}")
    found = ranked.groupBy("role_title").agg(mean("min"), mean("max"), F.array_sort(F.collect_list(F.when(~F.col("paid"), F.struct("rank", "company")))).alias("c"))
    named = F.when(F.col("role_title").isNotNull(), F.transform("c", lambda x: x["company"]))
    return found.select(
        "role_title", "avg_min", "avg_max",
        F.coalesce(named, F.array().cast("array<string>")).alias("top_companies"),
        dates.moment(as_of).alias("updated_at"),
    )


def hours_old(jobs: DataFrame, as_of, mode: str = "elapsed") -> DataFrame:
    """Active jobs with a posting date, and their age in whole hours."""
    return (
        active(jobs, as_of)
        .filter(F.col("posted_at").isNotNull())
        .withColumn("hours_old", dates.hours_since(F.col("posted_at"), dates.moment(as_of), mode))
    )


def link_totals(links: DataFrame) -> DataFrame:
    return links.agg(
        F.count("*").alias("total_links"),
        F.count_distinct("role_title").alias("roles"),
        F.count_distinct("skill").alias("skills"),
    )


def source_counts(df: DataFrame, start, end, ts: str = "created_at") -> DataFrame:
    """(source, jobs) of rows created in [start, end); a missing source counts as unknown."""
    name = F.coalesce(F.nullif("source", F.lit("")), F.lit("unknown"))
    return in_range(df, ts, start, end).groupBy(name.alias("source")).agg(F.count("*").alias("jobs"))


def cycle_report(df: DataFrame, label: str, as_of, ts: str = "created_at", zone: str = CYCLE_ZONE) -> DataFrame:
    """(source, jobs) of the cycle so far, and the total in the row with no source."""
    counts = source_counts(df, dates.cycle_start(label, as_of, zone), as_of, ts)
    return counts.rollup("source").agg(F.coalesce(F.sum("jobs"), F.lit(0)).alias("jobs"))


def report_text(counts: DataFrame) -> DataFrame:
    """One row: the source lines in name order, one per line. `counts` has one row per source."""
    lines = F.array_sort(F.collect_list(F.struct("source", "jobs")))
    return counts.agg(
        F.array_join(F.transform(lines, lambda r: report_line(r["source"], r["jobs"])), "\n").alias("breakdown")
    )


def cycle_totals(df: DataFrame, ts: str = "created_at", zone: str = CYCLE_ZONE) -> DataFrame:
    """(day, cycle, source, jobs) by local day and cycle."""
    local = dates.local_time(F.col(ts), zone)
    return (
        df.withColumn("_local", local)
        .groupBy(
            dates.day_key(F.col("_local")).alias("day"),
            dates.cycle_label(F.col("_local")).alias("cycle"),
            "source",
        )
        .agg(F.count("*").alias("jobs"))
    )
