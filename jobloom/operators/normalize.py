"""Raw records to one job schema.

Every source is a set of column expressions over its parsed payload. `normalize`
evaluates all of them in one pass over the raw table: each row's payload is parsed
with its own source's schema only, and no source needs a scan of its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache, lru_cache
from typing import Callable

from pyspark.sql import Column, DataFrame, functions as F

from jobloom import fixed_values as fixed, schemas
from jobloom.functions import dates, text, values
from jobloom.operators.lookup import computed_once

Resting = Callable[[Column], Column]
Fields = dict[str, Column | Resting]

#: What a parser may leave for its functions of the job; not among the columns of the result.
_NOTES = "years DOUBLE, salary_text STRING, period STRING, industries ARRAY<STRING>, unreadable STRING"


@dataclass(frozen=True)
class Parser:
    """Payload schema of a source and its field expressions.

    `fields(p, fallback)` gets the parsed payload struct and the time to use when
    the payload has no posting date; fields it leaves out are null. A field that
    rests on others is a function of the job: it reads what is there, while an
    expression used for two fields is worked out twice. Notes (`_NOTES`) are for these
    functions only.
    """

    schema: str
    fields: Callable[[Column, Column], Fields]


PARSERS: dict[str, Parser] = {}


def register(source: str, schema: str) -> Callable:
    def add(fields: Callable[[Column, Column], Fields]) -> Callable:
        PARSERS[source] = Parser(schema, fields)
        return fields

    return add


@cache
def _missing(error: str, *needed: str) -> Resting:
    def of(job: Column) -> Column:
        gap = F.lit(False)
        for name in needed:
            gap = gap | job[name].isNull()
        return F.when(gap, F.lit(error))

    return of


@cache
def _expiry(days: int) -> Resting:
    return lambda job: dates.add_days(job["posted_at"], days)


@cache
def _same_as(name: str) -> Resting:
    return lambda job: job[name]


@cache
def _salary_part(name: str) -> Resting:
    return lambda job: text.salary_parts(job["salary_text"], job["period"])[name]


def _industry(job: Column) -> Column:
    return values.null_if_empty(job["industries"])


def _salary_fields(salary: Column, spaced: bool = False) -> Fields:
    """Salary of a free text: the range is looked for once and read by each field."""
    return {
        "salary_text": text.salary_match(salary, spaced),
        "period": text.salary_period(salary),
        "salary_min": _salary_part("min"),
        "salary_max": _salary_part("max"),
        "salary_currency": _salary_part("currency"),
        "salary_period": _salary_part("period"),
    }


@register("naukri", schemas.PAYLOADS["naukri"])
def _naukri(p: Column, fallback: Column) -> Fields:
    place = values.find_first(p["placeholders"], lambda x: x["type"] == "location")
    return {
        "job_id": p["jobId"],
        "source": F.lit("naukri"),
        "source_url": text.with_prefix("https://www.naukri.com", p["jdURL"]),
        "job_title": p["title"],
        "company_name": p["companyName"],
        "years": values.number_or_null(p["minimumExperience"]),
        "min_experience": lambda job: job["years"].cast("int"),
        "max_experience": values.number_or_null(p["maximumExperience"]).cast("int"),
        "difficulty_level": lambda job: values.difficulty_of(job["years"]),
        "salary_min": values.number_or_null(p["salaryDetail"]["minimumSalary"]),
        "salary_max": values.number_or_null(p["salaryDetail"]["maximumSalary"]),
        "salary_currency": text.first_text(p["salaryDetail"]["currency"], F.lit("INR")),
        "salary_period": F.lit("year"),
        "location": place["label"],
        "description": text.strip_tags(p["jobDescription"]),
        "posted_at": dates.parse_posted_date(p["createdDate"]),
        "expiry_at": _expiry(fixed.JOB_EXPIRY_DAYS),
        "skills_raw": text.split_list(p["tagsAndSkills"], keep_blank=True),
        "role_text": p["title"],
        "error": _missing("no posting date", "posted_at"),
    }


@register("foundit", schemas.PAYLOADS["foundit"])
def _foundit(p: Column, fallback: Column) -> Fields:
    title = text.first_text(p["cleanedJobTitle"], p["title"])
    low, high = p["minimumSalary"], p["maximumSalary"]
    year = [values.zero_default(s["absoluteValue"]) for s in (low, high)]
    month = [values.zero_default(s["absoluteMonthlyValue"]) for s in (low, high)]
    yearly = (year[0] > 0) | (year[1] > 0)
    monthly = (month[0] > 0) | (month[1] > 0)
    posted = dates.parse_posted_date(p["postedAt"])
    countries = F.array_distinct(values.pluck(p["locations"], "country"))
    skills = F.concat(values.pluck(p["itSkills"], "text"), values.pluck(p["skills"], "text"))
    return {
        "job_id": text.first_text(p["jobId"]),
        "source": F.lit("foundit"),
        "source_url": text.with_prefix("https://www.foundit.in", text.blank_to_null(p["jdUrl"])),
        "job_title": title,
        "company_name": text.first_text(p["company"]["name"], p["companyName"]),
        "min_experience": p["minimumExperience"]["years"],
        "max_experience": p["maximumExperience"]["years"],
        "salary_min": F.when(yearly, year[0]).otherwise(month[0]),
        "salary_max": F.when(yearly, year[1]).otherwise(month[1]),
        "salary_currency": text.first_text(low["currency"], F.lit("INR")),
        "salary_period": F.when(yearly, F.lit("yearly")).when(monthly, F.lit("monthly")),
        "location": values.first_of(values.pluck(p["locations"], "city")),
        "location_country": F.coalesce(values.first_of(countries), F.lit("India")),
        "job_type": values.job_type_of(p["employmentTypes"]),
        "industries": F.array_distinct(values.pluck(p["industries"])),
        "industry": _industry,
        "description": F.coalesce(p["description"], F.lit("")),
        "posted_at": posted,
        "expiry_at": _expiry(fixed.JOB_EXPIRY_DAYS),
        "skills_raw": F.array_distinct(skills),
        "role_text": title,
    }


@register("hirist", schemas.PAYLOADS["hirist"])
def _hirist(p: Column, fallback: Column) -> Fields:
    salary = [F.nullif(p["minSal"], F.lit(0.0)), F.nullif(p["maxSal"], F.lit(0.0))]
    posted = F.coalesce(dates.parse_posted_date(p["createdTime"]), fallback)
    industry = text.blank_to_null(p["companyData"]["ambitionBoxInfo"]["primaryIndustry"])
    on_site = F.coalesce(p["workFromHome"], F.lit("")).isin("", "0", "false")
    return {
        "job_id": p["id"],
        "source": F.lit("hirist"),
        "source_url": p["jobDetailUrl"],
        "job_title": p["title"],
        "company_name": p["companyData"]["companyName"],
        "min_experience": p["min"],
        "max_experience": p["max"],
        "salary_min": salary[0],
        "salary_max": salary[1],
        "salary_currency": F.lit("INR"),
        "salary_period": F.when(salary[0].isNotNull() | salary[1].isNotNull(), F.lit("yearly")),
        "location": values.first_of(values.pluck(p["location"], "name")),
        "location_country": F.lit("India"),
        "job_type": F.when(on_site, F.lit("fulltime")).otherwise(F.lit("remote")),
        "industry": F.when(industry.isNotNull(), F.array(industry)),
        "posted_at": posted,
        "expiry_at": _expiry(fixed.JOB_EXPIRY_DAYS),
        "skills_raw": values.pluck(p["tags"], "name"),
        "role_text": text.first_text(p["title"], p["jobdesignation"]),
    }


@register("instahyre", schemas.PAYLOADS["instahyre"])
def _instahyre(p: Column, fallback: Column) -> Fields:
    title = text.first_text(p["title"], p["candidate_title"])
    posted = F.coalesce(dates.parse_posted_date(p["createdAt"]), fallback)
    return {
        "job_id": p["id"],
        "source": F.lit("instahyre"),
        "source_url": p["public_url"],
        "job_title": title,
        "company_name": p["employer"]["company_name"],
        "min_experience": p["experience"]["min"],
        "max_experience": p["experience"]["max"],
        "salary_currency": F.lit("INR"),
        "location": values.first_of(text.split_locations(p["locations"])),
        "location_country": F.lit("India"),
        "posted_at": posted,
        "expiry_at": _expiry(fixed.JOB_EXPIRY_DAYS),
        "skills_raw": F.array_distinct(values.array_or_empty(p["keywords"])),
        "role_text": title,
    }


@register("internshala", schemas.PAYLOADS["internshala"])
def _internshala(p: Column, fallback: Column) -> Fields:
    posted = dates.parse_posted_date(p["date"])
    hours = F.lower(p["working_hours"])
    job_type = text.first_keyword(
        hours,
        [("full", "fulltime"), ("part", "parttime"), ("intern", "internship"), ("contract", "contract")],
    )
    skills = F.filter(
        F.transform(p["skills_required"], lambda s: text.squeeze(s["skill"])),
        lambda s: s.isNotNull() & (s != ""),
    )
    return {
        "job_id": p["id"],
        "source": F.lit("internshala-jobs"),
        "source_url": p["url"],
        "job_title": p["title"],
        "company_name": p["company"],
        "min_experience": text.first_int(p["experience"]),
        "max_experience": _same_as("min_experience"),
        "difficulty_level": lambda job: values.difficulty_of(job["min_experience"]),
        **_salary_fields(p["salary"]),
        "location": values.first_of(p["city"]),
        "location_country": text.first_text(p["country"], F.lit("India")),
        "job_type": F.coalesce(job_type, F.lit("fulltime")),
        "work_mode": F.lit("onsite"),
        "industries": text.split_list(p["category"]),
        "industry": _industry,
        "description": F.coalesce(
            text.strip_tags(text.blank_to_null(p["description"])),
            text.first_text(p["content"], p["company_description"]),
            F.lit(""),
        ),
        "posted_at": posted,
        "expiry_at": _expiry(fixed.JOB_EXPIRY_DAYS),
        "skills_raw": values.array_or_empty(skills),
        "role_text": p["title"],
    }


@register("internshala-internships", schemas.PAYLOADS["internshala-internships"])
def _internship(p: Column, fallback: Column) -> Fields:
    posted = dates.parse_posted_date(p["date"])
    by_hours = text.first_keyword(
        F.lower(p["working_hours"]), [("full", "fulltime"), ("intern", "internship"), ("part", "parttime")]
    )
    by_contract = F.when(F.lower(p["contract"]).contains("intern"), F.lit("internship"))
    return {
        "job_id": p["id"],
        "source": F.lit("internshala-internships"),
        "source_url": F.coalesce(p["url"], F.lit("")),
        "job_title": text.blank_to_null(p["title"]),
        "company_name": text.blank_to_null(p["company"]),
        "min_experience": text.first_int(p["experience"]),
        "max_experience": _same_as("min_experience"),
        **_salary_fields(p["stipend"], spaced=True),
        "location": values.first_of(p["locations"]),
        "location_country": F.lit("India"),
        "job_type": F.coalesce(by_hours, by_contract),
        "work_mode": F.when(p["work_from_home"] == 1, F.lit("remote")),
        "industry": text.split_list(p["category"]),
        "description": text.blank_to_null(p["description"]),
        "posted_at": posted,
        "expiry_at": _expiry(fixed.INTERNSHIP_EXPIRY_DAYS),
        "skills_raw": values.no_strings(),
        "wants_role": F.lit(False),
    }


def _kinds(ddl: str) -> dict[str, str]:
    from pyspark.sql.types import StructType

    return {f.name: f.dataType.simpleString() for f in StructType.fromDDL(ddl).fields}


@lru_cache(maxsize=256)
def _job_struct(app: str, parser: Parser, payload: str, as_of) -> tuple[Column, dict[str, Resting]]:
    """A parser's struct over one payload column and what rests on it, built once per application.

    Micro-batches ask for the same expressions again and again, and building them
    takes longer than planning them.
    """
    p = F.col(payload)
    found = {"wants_role": F.lit(True), "error": F.lit(None), **parser.fields(p, _fallback_time(as_of))}
    no_id = p.isNull() | (F.coalesce(found["job_id"], F.lit("")) == "")
    no_title = F.coalesce(found["job_title"], F.lit("")) == ""
    found["unreadable"] = F.when(no_id, F.lit("no job id")).when(no_title, F.lit("no job title"))
    resting = {n: f for n, f in found.items() if not isinstance(f, Column)}
    return F.struct(
        *[
            (F.lit(None) if n in resting else found.get(n, F.lit(None))).cast(kind).alias(n)
            for n, kind in _kinds(f"{schemas.PARSED}, {_NOTES}").items()
        ]
    ), resting


def _fallback_time(as_of) -> Column:
    times = [F.col("created_at").cast("timestamp")]
    if as_of is not None:
        times.append(dates.moment(as_of).cast("timestamp"))
    return F.coalesce(*times)


def normalize_source(raw: DataFrame, source: str, as_of=None) -> DataFrame:
    """Raw rows of one source as job columns, next to the raw columns."""
    return normalize(raw.filter(F.lower("source") == source), as_of, [source])


def normalize(raw: DataFrame, as_of=None, sources: list[str] | None = None) -> DataFrame:
    """All raw rows as job columns, in one pass; rows that fail carry an `error`.

    Row count is kept: an unknown source or an unreadable payload is an error
    row, not a lost one. Columns of `raw` named like job columns are replaced.
    """
    parsers = {s: PARSERS[s] for s in (sources or PARSERS)}
    payloads = {name: f"_p{i}" for i, name in enumerate(parsers)}
    app = raw.sparkSession.sparkContext.applicationId
    site = F.col("_site")
    jobs, rules = F, {}
    for name, parser in parsers.items():
        struct, resting = _job_struct(app, parser, payloads[name], as_of)
        jobs = jobs.when(site == name, struct)
        for field, rule in resting.items():
            rules.setdefault(field, {}).setdefault(rule, []).append(name)
    carried = [c for c in raw.columns if c != "payload"]
    # Two plain projections: the optimizer keeps them apart, since a parsed payload is read many times, but takes
    # both through a union of sources, where only a branch's own parser is left of every choice.
    parsed = raw.select(*carried, "payload", F.lower("source").alias("_site")).select(
        *carried,
        "_site",
        *[F.when(site == n, F.from_json("payload", parsers[n].schema)).alias(p) for n, p in payloads.items()],
    )
    parsed = computed_once(parsed, tuple(payloads.values()), _job=jobs)
    kinds = _kinds(schemas.PARSED)
    out = {n: F.col(f"_job.{n}") for n in kinds}
    for field, by_rule in rules.items():
        choice = F
        for rule, names in by_rule.items():
            choice = choice.when(site.isin(names), rule(F.col("_job")).cast(kinds[field]))
        out[field] = choice.otherwise(out[field])
    no_parser = F.concat(F.lit("no parser for "), F.coalesce("source", F.lit("null")))
    error = F.coalesce(F.col("_job.unreadable"), out["error"])
    out["error"] = F.when(F.col("_job").isNull(), no_parser).otherwise(error)
    kept = [c for c in raw.columns if c not in (*kinds, "payload")]
    return parsed.select(F.col("source").alias("raw_source"), *kept, *[c.alias(n) for n, c in out.items()])


def with_job_id(df: DataFrame, source: str = "source", external_id: str = "external_id") -> DataFrame:
    """Add `_id`, the hash of source and external id."""
    return df.withColumn("_id", F.sha2(F.concat(source, external_id), 256))


def has_id(*ids: str) -> Column:
    """First id that is neither null, empty nor zero."""
    return F.coalesce(*[F.when(~F.col(i).isin("", "0"), F.col(i)) for i in ids])


def is_detail_page(html: Column, markers: tuple[str, ...], min_len: int) -> Column:
    test = F.length(html) > min_len
    for marker in markers:
        test = test & html.contains(marker)
    return F.coalesce(test, F.lit(False))


def enrich_experience(records: DataFrame, pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Add experience struct(min, max) read from each record's page; records without one are dropped.

    The range is taken out of the page before the join, so page bodies are not shuffled.
    """
    found = (
        pages.select(F.col("url").alias(url), text.experience_range(F.col(html)).alias("experience"))
        .filter(F.col("experience").isNotNull())
        .dropDuplicates([url])
    )
    return records.join(found, url)


def graph_safe(jobs: DataFrame) -> DataFrame:
    """Job columns as graph properties: canonical distinct skills and tools, defaults filled."""

    def terms(column: str) -> Column:
        canon = F.transform(F.col(column), text.canonical)
        return values.array_or_empty(F.array_distinct(F.filter(canon, lambda s: s != "")))

    return (
        jobs.withColumn("graph_skills", terms("skills.technical"))
        .withColumn("graph_tools", terms("skills.tools"))
        .withColumn("industry", values.array_or_empty(F.filter("industry", lambda v: v.isNotNull())))
        .withColumn("salary_currency", text.first_text(F.col("salary_currency"), F.lit("INR")))
        .withColumn("salary_period", text.first_text(F.col("salary_period"), F.lit("year")))
    )
