"""Catalogue: raw records, feeds, dates, ranges and the normalisers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from jobloom.functions import dates, text, values
from jobloom.operators import staging
from jobloom.operators.normalize import (
    enrich_experience, graph_safe, is_detail_page, normalize, normalize_source, with_job_id,
)
from jobloom.plans import views
from jobloom.plans.registry import query
from jobloom.sources import readers

STAMP = "yyyy-MM-dd HH:mm:ss"
AS_OF = "2001-08-01"


def stamp(column: Column) -> Column:
    return F.date_format(column, STAMP)


def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as raw records, known by the hash of their whole text."""
    return views.table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.sha2("text", 256).alias("external_id"), F.col("text").alias("payload")
    )


@query(
    "job_ids_sha256",
    "SELECT doc_id, sha256(source || CAST(doc_id AS VARCHAR)) AS _id FROM documents",
)
def job_ids_sha256(spark, sf_dir):
    raw = views.table(spark, sf_dir, "documents").select(
        "doc_id", "source", F.col("doc_id").cast("string").alias("external_id")
    )
    return with_job_id(raw).select("doc_id", "_id")


@query(
    "raw_scan_valid_ids",
    """SELECT doc_id, coalesce(CASE WHEN doc_id % 3 <> 0 THEN CAST(doc_id AS VARCHAR) END,
        CASE WHEN doc_id % 2 <> 0 THEN 'alt' || doc_id END) AS external_id
    FROM documents WHERE (doc_id % 3 <> 0 AND doc_id <> 0) OR doc_id % 2 <> 0""",
)
def raw_scan_valid_ids(spark, sf_dir):
    key = F.col("doc_id")
    raw = views.table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(key % 3 != 0, key.cast("string")).otherwise(F.lit("0")).alias("jobId"),
        F.when(key % 2 != 0, F.concat(F.lit("alt"), key.cast("string"))).otherwise(F.lit("")).alias("jobID2"),
    )
    return readers.valid_ids(raw, "jobId", "jobID2").select("doc_id", "external_id")


@query(
    "stage_raw_dedup",
    """WITH d AS (SELECT doc_id, source, sha256(text) AS external_id FROM documents)
    SELECT doc_id, source, external_id, 'queued' AS status FROM d
    WHERE (source, external_id) NOT IN (SELECT (source, external_id) FROM d WHERE doc_id % 2 = 0)
    QUALIFY row_number() OVER (PARTITION BY source, external_id ORDER BY doc_id) = 1""",
)
def stage_raw_dedup(spark, sf_dir):
    docs = raw_documents(spark, sf_dir)
    staged = staging.stage_raw(docs, docs.filter("doc_id % 2 = 0"), order=("doc_id",))
    return staged.select("doc_id", "source", "external_id", "status")


@query(
    "stage_counts",
    """WITH d AS (SELECT doc_id, source, sha256(text) AS external_id FROM documents),
    n AS (SELECT DISTINCT source, external_id FROM d
          WHERE (source, external_id) NOT IN (SELECT (source, external_id) FROM d WHERE doc_id % 2 = 0))
    SELECT (SELECT count(*) FROM n) AS inserted, (SELECT count(*) FROM d) - (SELECT count(*) FROM n) AS duplicates""",
)
def stage_counts(spark, sf_dir):
    docs = raw_documents(spark, sf_dir)
    staged = staging.stage_raw(docs, docs.filter("doc_id % 2 = 0"), order=("doc_id",))
    return staging.stage_counts(docs, staged)


# ---- raw payloads built from orders, one shape per source ----

SKILL_TEXTS = [" React, javascript ,CSS,,", "sql,kafka", "", "Communication"]




def payloads(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """(source, external_id, payload, status, created_at) of one source, from orders."""
    o = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    k = F.col("o_orderkey")
    kt = k.cast("string")
    day = F.col("o_orderdate")
    price = F.col("o_totalprice")
    millis = F.unix_millis(day.cast("timestamp"))
    dmy = F.date_format(day, "dd-MM-yyyy")
    no_text = F.lit(None).cast("string")

    def when_mod(n: int, value: Column, other: Column | None = None) -> Column:
        return F.when(k % n == 0, value) if other is None else F.when(k % n == 0, value).otherwise(other)

    if source == "naukri":
        shared = [
            kt.alias("jobId"),
            F.concat(F.lit("Job "), kt).alias("title"),
            F.when(k % 7 != 0, F.concat(F.lit("/job/"), kt)).alias("jdURL"),
            F.concat(F.lit("Company "), F.col("o_custkey").cast("string")).alias("companyName"),
            views.pick(SKILL_TEXTS, k % 4).alias("tagsAndSkills"),
            when_mod(11, F.lit("abc"), (k % 9).cast("string")).alias("minimumExperience"),
            (k % 9 + 3).alias("maximumExperience"),
            F.concat(F.lit("<p>Order <b>"), kt, F.lit("</b></p>")).alias("jobDescription"),
            F.array(
                F.struct(F.lit("experience").alias("type"), F.lit("x").alias("label")),
                F.struct(F.lit("location").alias("type"), F.concat(F.lit("City "), (k % 6).cast("string")).alias("label")),
            ).alias("placeholders"),
            F.struct(
                when_mod(4, F.lit(0.0), price).alias("minimumSalary"),
                (price * 2).alias("maximumSalary"),
                when_mod(2, F.lit("USD")).alias("currency"),
            ).alias("salaryDetail"),
        ]
        as_number = F.to_json(F.struct(*shared, millis.alias("createdDate")))
        as_text = F.to_json(
            F.struct(*shared, F.when(k % 13 != 0, when_mod(2, dmy, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss'Z'"))).alias("createdDate"))
        )
        payload = F.when((k % 3 == 0) & (k % 13 != 0), as_number).otherwise(as_text)
    elif source == "foundit":
        payload = F.to_json(F.struct(
            k.alias("jobId"),
            F.concat(F.lit("Raw "), kt).alias("title"),
            when_mod(3, F.lit(""), F.concat(F.lit("Clean "), kt)).alias("cleanedJobTitle"),
            when_mod(5, F.lit(""), F.concat(F.lit("/j/"), kt)).alias("jdUrl"),
            F.lit("Fallback").alias("companyName"),
            F.struct(F.when(k % 4 != 0, F.concat(F.lit("Co "), (k % 10).cast("string"))).alias("name")).alias("company"),
            F.when(k % 6 != 0, F.array(
                F.struct(F.lit("").alias("city"), F.lit("India").alias("country")),
                F.struct(F.concat(F.lit("City "), (k % 5).cast("string")).alias("city"), F.lit("Nepal").alias("country")),
            )).alias("locations"),
            F.array(F.lit("IT"), F.lit(""), F.lit("IT"), F.concat(F.lit("Ind"), (k % 3).cast("string"))).alias("industries"),
            F.array(F.struct(F.lit("React").alias("text")), F.struct(no_text.alias("text"))).alias("itSkills"),
            F.array(F.struct(F.lit("SQL").alias("text")), F.struct(F.lit("React").alias("text"))).alias("skills"),
            F.struct((k % 5).alias("years")).alias("minimumExperience"),
            F.struct((k % 5 + 2).alias("years")).alias("maximumExperience"),
            F.struct(
                F.when(k % 3 == 0, price).alias("absoluteValue"),
                F.when(k % 3 == 1, price).alias("absoluteMonthlyValue"),
                when_mod(2, F.lit("USD")).alias("currency"),
            ).alias("minimumSalary"),
            F.struct(F.lit(0.0).alias("absoluteValue"), (price * 2).alias("absoluteMonthlyValue")).alias("maximumSalary"),
            when_mod(10, F.lit("soon"), millis.cast("string")).alias("postedAt"),
            F.when(k % 2 == 0, F.array(F.lit("Permanent"), F.lit("Contract"))).alias("employmentTypes"),
        ))
    elif source == "hirist":
        payload = F.to_json(F.struct(
            k.alias("id"),
            F.concat(F.lit("Job "), kt).alias("title"),
            F.concat(F.lit("https://x/"), kt).alias("jobDetailUrl"),
            F.array(F.struct(no_text.alias("name")), F.struct(F.concat(F.lit("City "), (k % 5).cast("string")).alias("name"))).alias("location"),
            F.array(F.struct(F.lit("Kafka").alias("name")), F.struct(F.lit("").alias("name"))).alias("tags"),
            F.when(k % 4 != 0, k % 7).alias("min"),
            (k % 7 + 1).alias("max"),
            F.when(k % 3 != 0, F.lit(0.0)).otherwise(price).alias("minSal"),
            F.when(k % 6 == 0, price * 2).alias("maxSal"),
            F.when(k % 5 != 0, millis).alias("createdTime"),
            (k % 2).alias("workFromHome"),
            F.struct(
                F.concat(F.lit("Co "), (k % 10).cast("string")).alias("companyName"),
                F.struct(F.when(k % 3 != 0, F.lit("IT")).alias("primaryIndustry")).alias("ambitionBoxInfo"),
            ).alias("companyData"),
        ))
    elif source == "instahyre":
        payload = F.to_json(F.struct(
            k.alias("id"),
            when_mod(3, F.lit(""), F.concat(F.lit("Job "), kt)).alias("title"),
            F.concat(F.lit("Seen "), kt).alias("candidate_title"),
            F.concat(F.lit("https://y/"), kt).alias("public_url"),
            views.pick(["Pune and Goa/Mumbai | Delhi", "Chandigarh", None, " | "], k % 4).alias("locations"),
            F.array(F.lit("Docker"), F.lit("SQL"), F.lit("Docker")).alias("keywords"),
            F.struct(F.concat(F.lit("Co "), (k % 10).cast("string")).alias("company_name")).alias("employer"),
            F.struct((k % 6).alias("min"), F.when(k % 2 == 0, k % 6 + 2).alias("max")).alias("experience"),
        ))
    elif source == "internshala":
        payload = F.to_json(F.struct(
            k.alias("id"),
            F.concat(F.lit("Job "), kt).alias("title"),
            F.concat(F.lit("https://z/"), kt).alias("url"),
            F.concat(F.lit("Co "), (k % 10).cast("string")).alias("company"),
            F.array(F.struct(F.lit(" Python ").alias("skill")), F.struct(F.lit(" ").alias("skill"))).alias("skills_required"),
            F.when(k % 3 != 0, F.array(F.concat(F.lit("City "), (k % 5).cast("string")))).alias("city"),
            when_mod(4, F.lit("Nepal")).alias("country"),
            F.when(k % 2 == 0, F.concat(F.lit("<b>"), kt, F.lit("</b>"))).alias("description"),
            F.when(k % 5 == 0, F.lit("content")).alias("content"),
            F.lit("about us").alias("company_description"),
            _salary_text(k, "-").alias("salary"),
            F.when(k % 3 != 0, F.lit(" IT , ,Sales")).alias("category"),
            views.pick(["Full time", "Part time", "Internship", "Contract", "Night"], k % 5).alias("working_hours"),
            F.when(k % 4 != 0, F.concat((k % 9).cast("string"), F.lit(" year(s)"))).alias("experience"),
            dmy.alias("date"),
        ))
    else:
        payload = F.to_json(F.struct(
            k.alias("id"),
            F.concat(F.lit("Intern "), kt).alias("title"),
            F.when(k % 2 == 0, F.concat(F.lit("https://i/"), kt)).alias("url"),
            F.lit("").alias("company"),
            _salary_text(k, " - ").alias("stipend"),
            dmy.alias("date"),
            F.when(k % 3 != 0, F.array(F.concat(F.lit("City "), (k % 5).cast("string")))).alias("locations"),
            F.when(k % 3 != 0, F.lit("IT,Sales")).alias("category"),
            views.pick(["Full time", "Internship", "Part time", "Night"], k % 4).alias("working_hours"),
            F.when(k % 3 == 0, F.lit("Internship contract")).alias("contract"),
            (k % 2).alias("work_from_home"),
        ))
    return o.select(
        F.lit(source).alias("source"),
        kt.alias("external_id"),
        payload.alias("payload"),
        F.lit("queued").alias("status"),
        (day + F.expr("INTERVAL 1 DAY")).cast("timestamp").alias("created_at"),
    )


def _salary_text(k: Column, dash: str) -> Column:
    low = F.concat(k.cast("string"), F.lit(",000"))
    high = F.concat((k + 5).cast("string"), F.lit(",000"))
    body = F.concat(low, F.lit(dash), high)
    return (
        F.when(k % 4 == 0, F.concat(F.lit("INR "), body, F.lit(" /year")))
        .when(k % 4 == 1, F.concat(body, F.lit(" /Month")))
        .when(k % 4 == 2, F.concat(F.lit("USD "), body))
        .otherwise(F.lit("Competitive"))
    )


def flat_job(df: DataFrame, *columns: str) -> DataFrame:
    """Chosen job columns as plain text and numbers; years that may be missing are doubles."""
    out = []
    for c in columns:
        col = F.col(c)
        if c in ("posted_at", "expiry_at"):
            col = stamp(col)
        elif c in ("industry", "skills_raw"):
            col = F.array_join(col, "|")
        elif c in ("min_experience", "max_experience"):
            col = col.cast("double")
        out.append(col.alias(c))
    return df.select(*out)


_ALL = (
    "external_id", "job_id", "source", "source_url", "job_title", "company_name", "min_experience",
    "max_experience", "difficulty_level", "salary_min", "salary_max", "salary_currency", "salary_period",
    "location", "location_country", "job_type", "work_mode", "industry", "description", "posted_at",
    "expiry_at", "skills_raw", "error",
)

_DAY = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"
_LATER = "strftime(o_orderdate + INTERVAL {} DAY, '%Y-%m-%d %H:%M:%S')"
_K = "CAST(o_orderkey AS VARCHAR)"


_NUMBERS = ("min_experience", "max_experience", "salary_min", "salary_max")


def _oracle(**fields: str) -> str:
    exprs = [
        f"CAST({fields.get(c, 'NULL')} AS {'DOUBLE' if c in _NUMBERS else 'VARCHAR'}) AS {c}" for c in _ALL
    ]
    return "SELECT " + ",\n  ".join(exprs) + " FROM orders"


_NAUKRI_YEARS = "CASE WHEN o_orderkey % 11 <> 0 AND o_orderkey % 9 <> 0 THEN o_orderkey % 9 END"

ORACLE = {
    "naukri": _oracle(
        external_id=_K, job_id=_K, source="'naukri'",
        source_url=f"CASE WHEN o_orderkey % 7 <> 0 THEN 'https://www.naukri.com/job/' || {_K} END",
        job_title=f"'Job ' || {_K}", company_name="'Company ' || o_custkey",
        min_experience=_NAUKRI_YEARS, max_experience="o_orderkey % 9 + 3",
        difficulty_level=f"CASE WHEN ({_NAUKRI_YEARS}) > 6 THEN 'senior' WHEN ({_NAUKRI_YEARS}) > 2 THEN 'mid' ELSE 'entry' END",
        salary_min="CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END", salary_max="o_totalprice * 2",
        salary_currency="CASE WHEN o_orderkey % 2 = 0 THEN 'USD' ELSE 'INR' END", salary_period="'year'",
        location="'City ' || (o_orderkey % 6)",
        description=f"' Order  ' || {_K} || '  '",
        posted_at=f"CASE WHEN o_orderkey % 13 <> 0 THEN {_DAY} END",
        expiry_at=f"CASE WHEN o_orderkey % 13 <> 0 THEN {_LATER.format(90)} END",
        skills_raw="(['React|javascript|CSS||', 'sql|kafka', '', 'Communication'])[CAST(o_orderkey % 4 AS INT) + 1]",
        error="CASE WHEN o_orderkey % 13 = 0 THEN 'no posting date' END",
    ),
    "foundit": _oracle(
        external_id=_K, job_id=_K, source="'foundit'",
        source_url=f"CASE WHEN o_orderkey % 5 <> 0 THEN 'https://www.foundit.in/j/' || {_K} END",
        job_title=f"CASE WHEN o_orderkey % 3 = 0 THEN 'Raw ' ELSE 'Clean ' END || {_K}",
        company_name="CASE WHEN o_orderkey % 4 <> 0 THEN 'Co ' || (o_orderkey % 10) ELSE 'Fallback' END",
        min_experience="o_orderkey % 5", max_experience="o_orderkey % 5 + 2",
        salary_min="CASE WHEN o_orderkey % 3 < 2 THEN o_totalprice ELSE 0 END",
        salary_max="CASE WHEN o_orderkey % 3 = 0 THEN 0 ELSE o_totalprice * 2 END",
        salary_currency="CASE WHEN o_orderkey % 2 = 0 THEN 'USD' ELSE 'INR' END",
        salary_period="CASE WHEN o_orderkey % 3 = 0 THEN 'yearly' ELSE 'monthly' END",
        location="CASE WHEN o_orderkey % 6 <> 0 THEN 'City ' || (o_orderkey % 5) END",
        location_country="'India'",
        job_type="CASE WHEN o_orderkey % 2 = 0 THEN 'contract' END",
        industry="'IT|Ind' || (o_orderkey % 3)", description="''",
        posted_at=f"CASE WHEN o_orderkey % 10 <> 0 THEN {_DAY} END",
        expiry_at=f"CASE WHEN o_orderkey % 10 <> 0 THEN {_LATER.format(90)} END",
        skills_raw="'React|SQL'",
    ),
    "hirist": _oracle(
        external_id=_K, job_id=_K, source="'hirist'", source_url=f"'https://x/' || {_K}",
        job_title=f"'Job ' || {_K}", company_name="'Co ' || (o_orderkey % 10)",
        min_experience="CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 7 END", max_experience="o_orderkey % 7 + 1",
        salary_min="CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END",
        salary_max="CASE WHEN o_orderkey % 6 = 0 THEN o_totalprice * 2 END",
        salary_currency="'INR'", salary_period="CASE WHEN o_orderkey % 3 = 0 THEN 'yearly' END",
        location="'City ' || (o_orderkey % 5)", location_country="'India'",
        job_type="CASE WHEN o_orderkey % 2 = 0 THEN 'fulltime' ELSE 'remote' END",
        industry="CASE WHEN o_orderkey % 3 <> 0 THEN 'IT' END",
        posted_at=f"CASE WHEN o_orderkey % 5 <> 0 THEN {_DAY} ELSE {_LATER.format(1)} END",
        expiry_at=f"CASE WHEN o_orderkey % 5 <> 0 THEN {_LATER.format(90)} ELSE {_LATER.format(91)} END",
        skills_raw="'Kafka'",
    ),
    "instahyre": _oracle(
        external_id=_K, job_id=_K, source="'instahyre'", source_url=f"'https://y/' || {_K}",
        job_title=f"CASE WHEN o_orderkey % 3 = 0 THEN 'Seen ' ELSE 'Job ' END || {_K}",
        company_name="'Co ' || (o_orderkey % 10)",
        min_experience="o_orderkey % 6", max_experience="CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey % 6 + 2 END",
        salary_currency="'INR'",
        location="(['Pune', 'Chandigarh', NULL, NULL])[CAST(o_orderkey % 4 AS INT) + 1]", location_country="'India'",
        posted_at=_LATER.format(1), expiry_at=_LATER.format(91), skills_raw="'Docker|SQL'",
    ),
    "internshala": _oracle(
        external_id=_K, job_id=_K, source="'internshala-jobs'", source_url=f"'https://z/' || {_K}",
        job_title=f"'Job ' || {_K}", company_name="'Co ' || (o_orderkey % 10)",
        min_experience="CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 9 END",
        max_experience="CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 9 END",
        difficulty_level="CASE WHEN o_orderkey % 4 <> 0 AND o_orderkey % 9 > 6 THEN 'senior' WHEN o_orderkey % 4 <> 0 AND o_orderkey % 9 > 2 THEN 'mid' ELSE 'entry' END",
        salary_min="CASE WHEN o_orderkey % 4 < 3 THEN CAST(o_orderkey * 1000 AS DOUBLE) END",
        salary_max="CASE WHEN o_orderkey % 4 < 3 THEN CAST((o_orderkey + 5) * 1000 AS DOUBLE) END",
        salary_currency="(['INR', 'INR', 'USD', NULL])[CAST(o_orderkey % 4 AS INT) + 1]",
        salary_period="(['yearly', 'monthly', NULL, NULL])[CAST(o_orderkey % 4 AS INT) + 1]",
        location="CASE WHEN o_orderkey % 3 <> 0 THEN 'City ' || (o_orderkey % 5) END",
        location_country="CASE WHEN o_orderkey % 4 = 0 THEN 'Nepal' ELSE 'India' END",
        job_type="(['fulltime', 'parttime', 'internship', 'contract', 'fulltime'])[CAST(o_orderkey % 5 AS INT) + 1]",
        work_mode="'onsite'", industry="CASE WHEN o_orderkey % 3 <> 0 THEN 'IT|Sales' END",
        description=f"CASE WHEN o_orderkey % 2 = 0 THEN ' ' || {_K} || ' ' WHEN o_orderkey % 5 = 0 THEN 'content' ELSE 'about us' END",
        posted_at=_DAY, expiry_at=_LATER.format(90), skills_raw="'Python'",
    ),
    "internshala-internships": _oracle(
        external_id=_K, job_id=_K, source="'internshala-internships'",
        source_url=f"CASE WHEN o_orderkey % 2 = 0 THEN 'https://i/' || {_K} ELSE '' END",
        job_title=f"'Intern ' || {_K}",
        salary_min="CASE WHEN o_orderkey % 4 < 3 THEN CAST(o_orderkey * 1000 AS DOUBLE) END",
        salary_max="CASE WHEN o_orderkey % 4 < 3 THEN CAST((o_orderkey + 5) * 1000 AS DOUBLE) END",
        salary_currency="(['INR', 'INR', 'USD', NULL])[CAST(o_orderkey % 4 AS INT) + 1]",
        salary_period="(['yearly', 'monthly', NULL, NULL])[CAST(o_orderkey % 4 AS INT) + 1]",
        location="CASE WHEN o_orderkey % 3 <> 0 THEN 'City ' || (o_orderkey % 5) END", location_country="'India'",
        job_type="CASE o_orderkey % 4 WHEN 0 THEN 'fulltime' WHEN 1 THEN 'internship' WHEN 2 THEN 'parttime' ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'internship' END END",
        work_mode="CASE WHEN o_orderkey % 2 = 1 THEN 'remote' END",
        industry="CASE WHEN o_orderkey % 3 <> 0 THEN 'IT|Sales' ELSE '' END",
        posted_at=_DAY, expiry_at=_LATER.format(30), skills_raw="''",
    ),
}


def _add_normalizer(source: str) -> None:
    @query(f"normalize_{source.replace('-', '_')}", ORACLE[source])
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return flat_job(normalize_source(payloads(spark, sf_dir, source), source), *_ALL)


for _source in ORACLE:
    _add_normalizer(_source)


def all_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for source in ORACLE:
        part = payloads(spark, sf_dir, source)
        out = part if out is None else out.unionByName(part)
    unknown = payloads(spark, sf_dir, "hirist").withColumn("source", F.lit("workday"))
    return out.unionByName(unknown)


@query(
    "normalize_all",
    "\nUNION ALL ".join(
        f"SELECT external_id, job_id, source, job_title, salary_min, posted_at, error FROM ({sql})"
        for sql in ORACLE.values()
    )
    + f"\nUNION ALL SELECT {_K}, NULL, NULL, NULL, NULL, NULL, 'no parser for workday' FROM orders",
)
def normalize_all(spark, sf_dir):
    out = normalize(all_payloads(spark, sf_dir))
    return flat_job(out, "external_id", "job_id", "source", "job_title", "salary_min", "posted_at", "error")


_CLEAN = f"""WITH r AS (
      SELECT o_orderkey AS k, CASE WHEN o_orderkey % 17 = 0 THEN '' ELSE {_K} END AS external_id,
        o_orderkey % 13 = 0 AS broken, o_orderkey % 6 = 0 AS known FROM orders WHERE o_orderkey % 5 <> 0)
    SELECT k, CASE WHEN external_id = '' THEN 'failed' WHEN known THEN 'duplicate'
                   WHEN broken THEN 'failed' ELSE 'completed' END AS raw_status,
      CASE WHEN external_id = '' THEN 'Missing externalId' WHEN known THEN NULL
           WHEN broken THEN 'no posting date' END AS error
    FROM r"""


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Naukri payloads cleaned: some without id, some normalised before, some undated."""
    raw = payloads(spark, sf_dir, "naukri").withColumn("k", F.col("external_id").cast("bigint"))
    jobs = with_job_id(raw.filter("k % 6 = 0")).select("_id")
    raw = raw.withColumn("status", F.when(F.col("k") % 5 == 0, "completed").otherwise("queued")).withColumn(
        "external_id", F.when(F.col("k") % 17 == 0, "").otherwise(F.col("external_id"))
    )
    return staging.clean_batch(raw, jobs)


@query("clean_status", _CLEAN)
def clean_status(spark, sf_dir):
    return cleaned(spark, sf_dir).select("k", "raw_status", "error")


@query(
    "quarantine_rows",
    f"SELECT 'naukri' AS raw_source, CASE WHEN error = 'Missing externalId' THEN '' ELSE CAST(k AS VARCHAR) END AS external_id, error FROM ({_CLEAN}) WHERE raw_status = 'failed'",
)
def quarantine_rows(spark, sf_dir):
    return staging.quarantine(cleaned(spark, sf_dir))


@query(
    "replay_failed",
    """SELECT CAST(o_orderkey AS VARCHAR) AS external_id,
      CASE WHEN o_orderstatus = 'F' AND o_totalprice > 250000 THEN 'queued' WHEN o_orderstatus = 'F' THEN 'failed'
           ELSE 'completed' END AS status FROM orders""",
)
def replay_failed(spark, sf_dir):
    raw = views.table(spark, sf_dir, "orders").select(
        F.lit("naukri").alias("source"),
        F.col("o_orderkey").cast("string").alias("external_id"),
        F.when(F.col("o_orderstatus") == "F", "failed").otherwise("completed").alias("status"),
        "o_totalprice",
    )
    chosen = raw.filter("o_totalprice > 250000")
    return staging.replay(raw, chosen).select("external_id", "status")


@query(
    "explode_feed",
    f"""SELECT 'hirist' AS source, o_orderkey // 50 AS page, nullif({_K}, '0') AS external_id, 'Job ' || {_K} AS title
    FROM orders WHERE (o_orderkey // 50) % 4 < 3""",
)
def explode_feed(spark, sf_dir):
    """Pages of 50 records under one of three keys; every fourth page has none."""
    page = F.floor(F.col("o_orderkey") / 50).alias("page")
    key = F.col("o_orderkey")
    record = F.struct(key.alias("id"), F.concat(F.lit("Job "), key.cast("string")).alias("title"))
    pages = (
        views.table(spark, sf_dir, "orders")
        .select(page, record.alias("record"))
        .groupBy("page")
        .agg(F.collect_list("record").alias("records"))
    )
    wrapped = [F.to_json(F.struct(F.col("records").alias(name))) for name in ("jobs", "data", "results", "other")]
    body = F.get(F.array(*wrapped), (F.col("page") % 4).cast("int"))
    records = readers.explode_feed(pages.select("page", body.alias("body")), "hirist")
    return records.select("source", "page", "external_id", F.get_json_object("payload", "$.title").alias("title"))


# ---- scalar helpers over whole tables ----


@query(
    "parse_posted_date",
    f"SELECT o_orderkey, CASE o_orderkey % 5 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE {_DAY} END AS posted_at FROM orders",
)
def parse_posted_date(spark, sf_dir):
    day = F.col("o_orderdate")
    raw = F.get(
        F.array(
            F.unix_millis(day.cast("timestamp")).cast("string"),
            F.date_format(day, "dd-MM-yyyy"),
            F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"),
            F.lit("abc"),
            F.lit(None).cast("string"),
        ),
        (F.col("o_orderkey") % 5).cast("int"),
    )
    return views.table(spark, sf_dir, "orders").select(
        "o_orderkey", stamp(dates.parse_posted_date(raw)).alias("posted_at")
    )


@query(
    "expiry_and_difficulty",
    f"""SELECT l_orderkey, l_linenumber, {_LATER.format(90)} AS expiry_at,
      CASE WHEN p_size > 6 THEN 'senior' WHEN p_size > 2 THEN 'mid' ELSE 'entry' END AS difficulty_level
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
)
def expiry_and_difficulty(spark, sf_dir):
    items = views.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    part = views.table(spark, sf_dir, "part").select("p_partkey", "p_size")
    rows = items.join(orders, items.l_orderkey == orders.o_orderkey).join(part, items.l_partkey == part.p_partkey)
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        stamp(dates.add_days(F.col("o_orderdate"), 90)).alias("expiry_at"),
        values.difficulty_of(F.col("p_size")).alias("difficulty_level"),
    )


@query(
    "parse_salary_range",
    """WITH t AS (SELECT p_partkey,
        CASE p_partkey % 4 WHEN 0 THEN 'INR ' || p_size || ',000-' || (p_size + 5) || ',500 /year'
          WHEN 1 THEN p_size || '000 - ' || (p_size + 5) || '000 /month'
          WHEN 2 THEN 'Rs ' || p_size || '-' || (p_size + 1) ELSE 'none' END AS s FROM part)
    SELECT p_partkey,
      CASE WHEN regexp_matches(s, '[0-9,]+-[0-9,]+') THEN coalesce(nullif(regexp_extract(s, '([A-Za-z]+)?\\s?([\\d,]+)-([\\d,]+)', 1), ''), 'INR') END AS currency,
      TRY_CAST(replace(regexp_extract(s, '([A-Za-z]+)?\\s?([\\d,]+)-([\\d,]+)', 2), ',', '') AS DOUBLE) AS low,
      TRY_CAST(replace(regexp_extract(s, '([A-Za-z]+)?\\s?([\\d,]+)-([\\d,]+)', 3), ',', '') AS DOUBLE) AS high,
      TRY_CAST(replace(regexp_extract(s, '([A-Za-z]+)?\\s?([\\d,]+)\\s*-\\s*([\\d,]+)', 2), ',', '') AS DOUBLE) AS spaced_low,
      CASE WHEN regexp_matches(s, '[0-9,]+\\s*-\\s*[0-9,]+') THEN
        CASE WHEN contains(s, 'year') THEN 'yearly' WHEN contains(s, 'month') THEN 'monthly' END END AS spaced_period
    FROM t""",
)
def parse_salary_range(spark, sf_dir):
    size = F.col("p_size")

    def plus(n: int) -> Column:
        return (size + n).cast("string")

    s = F.get(
        F.array(
            F.concat(F.lit("INR "), plus(0), F.lit(",000-"), plus(5), F.lit(",500 /year")),
            F.concat(plus(0), F.lit("000 - "), plus(5), F.lit("000 /month")),
            F.concat(F.lit("Rs "), plus(0), F.lit("-"), plus(1)),
            F.lit("none"),
        ),
        (F.col("p_partkey") % 4).cast("int"),
    )
    strict, spaced = text.salary_range(F.col("s")), text.salary_range(F.col("s"), spaced=True)
    return views.table(spark, sf_dir, "part").select("p_partkey", s.alias("s")).select(
        "p_partkey",
        strict["currency"].alias("currency"),
        strict["min"].cast("double").alias("low"),
        strict["max"].cast("double").alias("high"),
        spaced["min"].cast("double").alias("spaced_low"),
        spaced["period"].alias("spaced_period"),
    )


@query(
    "extract_experience",
    """WITH t AS (SELECT p_partkey, p_size AS n, p_partkey % 5 AS m FROM part)
    SELECT p_partkey, n AS min, CAST(CASE m WHEN 0 THEN n + 2 WHEN 1 THEN NULL ELSE n END AS DOUBLE) AS max, n AS first_number
    FROM t WHERE m < 3
    UNION ALL SELECT p_partkey, 3, 5, n FROM t WHERE m = 3""",
)
def extract_experience(spark, sf_dir):
    """Records joined with their pages; pages without a range drop the record."""
    n = F.col("p_size").cast("string")
    body = F.get(
        F.array(
            F.concat(F.lit("Needs "), n, F.lit(" - "), (F.col("p_size") + 2).cast("string"), F.lit(" Years")),
            F.concat(n, F.lit("+ yrs")),
            F.concat(n, F.lit(" YEARS")),
            F.concat(n, F.lit("+ years, 3-5 yrs")),
            F.lit("Fresher"),
        ),
        (F.col("p_partkey") % 5).cast("int"),
    )
    part = views.table(spark, sf_dir, "part")
    pages = part.select(F.concat(F.lit("/p/"), "p_partkey").alias("url"), body.alias("html"))
    records = part.select("p_partkey", "p_size", F.concat(F.lit("/p/"), "p_partkey").alias("url"))
    first = text.first_int(F.concat(F.lit("about "), F.col("p_size").cast("string"), F.lit(" or 7")))
    return enrich_experience(records, pages).select(
        "p_partkey", "experience.min", F.col("experience.max").cast("double").alias("max"), first.alias("first_number")
    )


@query(
    "split_locations",
    """SELECT n_nationkey, unnest(CASE n_nationkey % 3
        WHEN 0 THEN [n_name, 'Goa', 'Sandhill'] WHEN 1 THEN [n_name, 'Delhi', 'Pune'] ELSE [n_name] END) AS place
    FROM nation""",
)
def split_locations(spark, sf_dir):
    name = F.col("n_name")
    raw = F.get(
        F.array(
            F.concat(name, F.lit(" AND Goa/Sandhill")),
            F.concat(name, F.lit(" | Delhi ,, Pune|")),
            F.concat(F.lit("\t"), name, F.lit(" ")),
        ),
        (F.col("n_nationkey") % 3).cast("int"),
    )
    return views.table(spark, sf_dir, "nation").select(
        "n_nationkey", F.explode(text.split_locations(raw)).alias("place")
    )


@query(
    "strip_html",
    "SELECT page_id, md5(regexp_replace(html, '<[^>]*>', ' ', 'g')) AS text_hash FROM pages",
)
def strip_html(spark, sf_dir):
    return views.table(spark, sf_dir, "pages").select(
        "page_id", F.md5(text.strip_tags(F.col("html"))).alias("text_hash")
    )


@query(
    "valid_detail_pages",
    "SELECT page_id, url FROM pages WHERE contains(html, 'script') AND contains(html, '</body>') AND length(html) > 5000",
)
def valid_detail_pages(spark, sf_dir):
    ok = is_detail_page(F.col("html"), ("script", "</body>"), 5000)
    return views.table(spark, sf_dir, "pages").filter(ok).select("page_id", "url")


TYPE_LISTS = [["Permanent"], ["Full time", "Contract"], ["Internship"], ["Freelance"], [], ["Part", "Contract"], ["CONTRACT"]]


@query(
    "job_type_canonical",
    """SELECT o_orderkey, (['fulltime', 'fulltime', 'internship', NULL, NULL, 'parttime', 'contract'])[CAST(o_orderkey % 7 AS INT) + 1] AS job_type
    FROM orders""",
)
def job_type_canonical(spark, sf_dir):
    lists = F.array(*[F.array(*[F.lit(t) for t in ts]).cast("array<string>") for ts in TYPE_LISTS])
    types = F.get(lists, (F.col("o_orderkey") % 7).cast("int"))
    return views.table(spark, sf_dir, "orders").select("o_orderkey", values.job_type_of(types).alias("job_type"))


@query(
    "date_shapes",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN strftime(o_orderdate + INTERVAL 1 HOUR, '%Y-%m-%dT%H:%M:%S.') ||
        CASE WHEN o_orderkey % 4 = 2 THEN '250Z' ELSE '000Z' END END AS iso,
      CAST(o_orderkey AS DOUBLE) AS n, strftime(o_orderdate + INTERVAL 390 MINUTE, '%d/%m/%Y %H:%M') AS local_time
    FROM orders""",
)
def date_shapes(spark, sf_dir):
    at = F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR")
    k = F.col("o_orderkey")
    iso = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    parts = F.struct(
        F.year(at).alias("year"), F.month(at).alias("month"), F.day(at).alias("day"), F.hour(at).alias("hour"),
        F.lit(250_000_000).alias("nanosecond"),
    )
    doc = F.to_json(F.struct(
        F.when(k % 4 == 0, iso).alias("text"),
        F.when(k % 4 == 1, F.struct(iso.alias("$date"))).alias("wrapped"),
        F.when(k % 4 == 2, parts).alias("parts"),
        F.when(k % 2 == 0, k).alias("plain"),
        F.when(k % 2 == 1, F.struct(k.cast("string").alias("$numberLong"))).alias("long"),
    ))
    shape = F.from_json("doc", f"{dates.DATE_SHAPES}, plain BIGINT, long STRUCT<`$numberLong`: STRING>")
    return (
        views.table(spark, sf_dir, "orders")
        .select("o_orderkey", at.alias("at"), doc.alias("doc"))
        .withColumn("d", shape)
        .select(
            "o_orderkey",
            dates.any_date(F.col("d")).alias("iso"),
            dates.unwrap_long(F.col("d.plain"), F.col("d.long")).alias("n"),
            dates.render_in_zone(F.col("at"), pattern="dd/MM/yyyy HH:mm").alias("local_time"),
        )
    )


@query(
    "graph_safe_jobs",
    """SELECT CAST(o_orderkey AS VARCHAR) AS job_id, 'skill' || (o_orderkey % 11) AS skills, 'tool' || (o_orderkey % 6) AS tools,
      CASE WHEN o_orderkey % 2 = 0 THEN 'USD' ELSE 'INR' END AS salary_currency,
      CASE WHEN o_orderkey % 5 = 0 THEN 'monthly' ELSE 'year' END AS salary_period, 1 AS n_industry FROM orders""",
)
def graph_safe_jobs(spark, sf_dir):
    from jobloom.plans.catalog_graph import graph_jobs

    return graph_safe(graph_jobs(spark, sf_dir)).select(
        "job_id",
        F.array_join("graph_skills", "|").alias("skills"),
        F.array_join("graph_tools", "|").alias("tools"),
        "salary_currency",
        "salary_period",
        F.size("industry").cast("bigint").alias("n_industry"),
    )
