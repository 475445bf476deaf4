"""Table schemas and the payload schema of each source, as DDL text.

Identifiers and free-form dates are STRING: `from_json` hands numbers over as
their digits, so numeric and textual ids meet in one type.
"""

from __future__ import annotations

RAW = (
    "source STRING, external_id STRING, payload STRING, status STRING, created_at TIMESTAMP"
)

SKILLS = "STRUCT<technical: ARRAY<STRING>, tools: ARRAY<STRING>, soft: ARRAY<STRING>>"

JOB = (
    "_id STRING, job_id STRING, source STRING, source_url STRING, job_title STRING, "
    f"role_title STRING, extracted_by STRING, company_name STRING, skills {SKILLS}, "
    "min_experience INT, max_experience INT, difficulty_level STRING, "
    "salary_min DOUBLE, salary_max DOUBLE, salary_currency STRING, salary_period STRING, "
    "location STRING, location_state STRING, location_country STRING, job_type STRING, "
    "work_mode STRING, industry ARRAY<STRING>, description STRING, "
    "posted_at TIMESTAMP, expiry_at TIMESTAMP, is_published BOOLEAN, is_ingested BOOLEAN, "
    "created_at TIMESTAMP, updated_at TIMESTAMP"
)

# Columns a source parser fills; the rest of JOB is added by later steps.
PARSED = (
    "job_id STRING, source STRING, source_url STRING, job_title STRING, company_name STRING, "
    "min_experience INT, max_experience INT, difficulty_level STRING, "
    "salary_min DOUBLE, salary_max DOUBLE, salary_currency STRING, salary_period STRING, "
    "location STRING, location_state STRING, location_country STRING, job_type STRING, "
    "work_mode STRING, industry ARRAY<STRING>, description STRING, "
    "posted_at TIMESTAMP, expiry_at TIMESTAMP, "
    "skills_raw ARRAY<STRING>, role_text STRING, wants_role BOOLEAN, error STRING"
)

PAYLOADS = {
    "naukri": (
        "jobId STRING, title STRING, jdURL STRING, companyName STRING, tagsAndSkills STRING, "
        "minimumExperience STRING, maximumExperience STRING, createdDate STRING, "
        "jobDescription STRING, placeholders ARRAY<STRUCT<type: STRING, label: STRING>>, "
        "salaryDetail STRUCT<minimumSalary: DOUBLE, maximumSalary: DOUBLE, currency: STRING>"
    ),
    "foundit": (
        "jobId STRING, title STRING, cleanedJobTitle STRING, jdUrl STRING, "
        "companyName STRING, company STRUCT<name: STRING>, "
        "locations ARRAY<STRUCT<city: STRING, country: STRING>>, industries ARRAY<STRING>, "
        "itSkills ARRAY<STRUCT<text: STRING>>, skills ARRAY<STRUCT<text: STRING>>, "
        "minimumExperience STRUCT<years: INT>, maximumExperience STRUCT<years: INT>, "
        "minimumSalary STRUCT<absoluteValue: DOUBLE, absoluteMonthlyValue: DOUBLE, currency: STRING>, "
        "maximumSalary STRUCT<absoluteValue: DOUBLE, absoluteMonthlyValue: DOUBLE, currency: STRING>, "
        "postedAt STRING, description STRING, employmentTypes ARRAY<STRING>"
    ),
    "hirist": (
        "id STRING, title STRING, jobdesignation STRING, jobDetailUrl STRING, "
        "location ARRAY<STRUCT<name: STRING>>, tags ARRAY<STRUCT<name: STRING>>, "
        "min INT, max INT, minSal DOUBLE, maxSal DOUBLE, createdTime STRING, workFromHome STRING, "
        "companyData STRUCT<companyName: STRING, ambitionBoxInfo: STRUCT<primaryIndustry: STRING>>"
    ),
    "instahyre": (
        "id STRING, title STRING, candidate_title STRING, public_url STRING, locations STRING, "
        "keywords ARRAY<STRING>, employer STRUCT<company_name: STRING>, "
        "experience STRUCT<min: INT, max: INT>, createdAt STRING"
    ),
    "internshala": (
        "id STRING, title STRING, url STRING, company STRING, "
        "skills_required ARRAY<STRUCT<skill: STRING>>, city ARRAY<STRING>, country STRING, "
        "description STRING, content STRING, company_description STRING, salary STRING, "
        "category STRING, working_hours STRING, experience STRING, date STRING"
    ),
    "internshala-internships": (
        "id STRING, title STRING, url STRING, company STRING, stipend STRING, experience STRING, "
        "date STRING, locations ARRAY<STRING>, category STRING, working_hours STRING, "
        "contract STRING, work_from_home INT, description STRING"
    ),
}

# The key that holds the records in one fetched page, per source.
FEED_KEYS = {
    "naukri": ("jobDetails",),
    "foundit": ("data",),
    "instahyre": ("objects",),
    "internshala": ("common",),
    "internshala-internships": ("common",),
    "hirist": ("jobs", "data", "results"),
}
