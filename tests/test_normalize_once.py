"""What a job field rests on is worked out once, and gives what working it out for each field gave."""

import re

import pytest
from pyspark.sql import functions as F

from jobloom.functions import text
from jobloom.operators.normalize import PARSERS, normalize

SCHEMA = "source string, external_id string, payload string, status string, created_at timestamp"


def plan(df) -> str:
    conf = df.sparkSession.conf
    conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.unset("spark.sql.debug.maxToStringFields")


def test_dates_and_ranges_are_worked_out_once(spark):
    df = normalize(spark.createDataFrame([], SCHEMA))
    found = plan(df)
    assert found.count("-?\\d{5,}") == len(PARSERS)  # posted_at; expiry_at and error read the column
    assert found.count("([A-Za-z]+)?") == 2  # one search for each source with a salary text


def test_union_of_sources_has_one_parser_a_branch(spark):
    raw = [
        spark.range(3).select(
            F.lit(s).alias("source"), F.col("id").cast("string").alias("external_id"),
            F.to_json(F.struct("id")).alias("payload"), F.current_timestamp().alias("created_at"),
        )
        for s in PARSERS
    ]
    both = raw[0]
    for part in raw[1:]:
        both = both.unionByName(part)
    above, branches = plan(normalize(both)).split("Union")
    assert "struct(job_id" not in above and branches.count("struct(job_id") == len(PARSERS)


TEXTS = [
    "INR 3,00,000-5,00,000 /year", "Rs 10,000 - 15,000 /Month", "12-15-18 years", "abc-1-2", "-", "1 -2", "a1-2b3-4", "no range",
    "up to-date 5-6", ",-,", "x ,-7", "1-", "USD 5-6", "USD  5-6", "é5-6", "", "5 6 -  7 month", "Competitive - 10,000-20,000", None,
]


@pytest.mark.parametrize("spaced", [False, True])
def test_salary_range_against_groups(spark, spaced):
    gap = f"{text.SPACE}*" if spaced else ""
    one = re.compile(rf"([A-Za-z]+)?{text.SPACE}?([0-9,]+){gap}-{gap}([0-9,]+)")

    def want(t):
        hit = one.search(t) if t is not None else None
        if not hit:
            return (None, None, None, None)
        amount = [int(g.replace(",", "")) if g.replace(",", "") else None for g in hit.groups()[1:]]
        low = t.lower()
        return (hit[1] or "INR", *amount, "yearly" if "year" in low else "monthly" if "month" in low else None)

    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    got = df.select("i", text.salary_range(F.col("t"), spaced).alias("s")).orderBy("i").collect()
    assert [tuple(r["s"]) for r in got] == [want(t) for t in TEXTS]


def test_fields_that_rest_on_others(spark):
    at = "2024-01-01 00:00:00"
    rows = [
        ("naukri", "1", '{"jobId": 1, "title": "t", "minimumExperience": "6.5", "createdDate": "05-02-2024"}'),
        ("Naukri", "2", '{"jobId": 2, "title": "t", "minimumExperience": "abc", "createdDate": "soon"}'),
        ("naukri", "3", '{"jobId": 3, "createdDate": "soon"}'),
        ("internshala", "4", '{"id": 4, "title": "t", "experience": "3 years", "salary": "USD 5,000-6,000 /month", "date": "05-02-2024", "category": " , "}'),
        ("internshala", "5", '{"id": 5, "title": "t", "salary": "Competitive /year", "description": "", "content": "c", "category": "a, b"}'),
        ("internshala-internships", "6", '{"id": 6, "title": "t", "stipend": "5,000 - 6,000", "date": "2024-02-05"}'),
        ("foundit", "7", '{"jobId": 7, "title": "t", "industries": [""], "itSkills": [{"text": "a"}, null, {"text": ""}]}'),
        ("foundit", "8", None),
        ("workday", "9", "{}"),
    ]
    raw = spark.createDataFrame([(s, i, p, "queued") for s, i, p in rows], "source string, external_id string, payload string, status string")
    out = normalize(raw.withColumn("created_at", F.lit(at).cast("timestamp")))
    got = {
        r[0]: tuple(r[1:])
        for r in out.select(
            "external_id", "min_experience", "max_experience", "difficulty_level", "salary_min", "salary_max", "salary_currency",
            "salary_period", "industry", "description", F.date_format("expiry_at", "yyyy-MM-dd"), "error",
        ).collect()
    }
    assert got["1"] == (6, None, "senior", None, None, "INR", "year", None, None, "2024-05-05", None)
    assert got["2"] == (None, None, "entry", None, None, "INR", "year", None, None, None, "no posting date")
    assert got["3"][-1] == "no job title"
    assert got["4"] == (3, 3, "mid", 5000.0, 6000.0, "USD", "monthly", None, "", "2024-05-05", None)
    assert got["5"] == (None, None, "entry", None, None, None, None, ["a", "b"], "c", None, None)
    assert got["6"] == (None, None, None, 5000.0, 6000.0, "INR", None, [], None, "2024-03-06", None)
    assert got["7"][7] is None and got["8"][-1] == "no job id" and got["9"][-1] == "no parser for workday"
    assert out.filter("external_id = '7'").first()["skills_raw"] == ["a"]
