"""Golden values of the column helpers."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobloom.functions import dates, text, values


def one(spark, column, **inputs):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()] or ["id"])
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("31-12-2024", dt.datetime(2024, 12, 31)),
        ("1700000000000", dt.datetime(2023, 11, 14, 22, 13, 20)),
        ("2024-03-01T10:00:00Z", dt.datetime(2024, 3, 1, 10)),
        ("2024-03-01T10:00:00+05:30", dt.datetime(2024, 3, 1, 4, 30)),
        ("abc", None),
        ("10:30", None),
        ("45-13-2024", None),
        ("", None),
        (None, None),
    ],
)
def test_posted_date(spark, raw, want):
    got = one(spark, dates.parse_posted_date(F.lit(raw).cast("string")).cast("timestamp_ntz"))
    assert got == want


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("Needs 3 - 5 Years", (3, 5)),
        ("4+ yrs", (4, None)),
        ("2 years", (2, 2)),
        ("10+ years, 3-5 yrs", (3, 5)),
        ("Fresher", None),
    ],
)
def test_experience(spark, raw, want):
    got = one(spark, text.experience_range(F.lit(raw)))
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize(
    ("raw", "spaced", "want"),
    [
        ("INR 3,00,000-5,00,000 /year", False, ("INR", 300000, 500000, "yearly")),
        ("12000-15000 /month", False, ("INR", 12000, 15000, "monthly")),
        ("Rs 10,000 - 15,000 /month", False, (None, None, None, None)),
        ("Rs 10,000 - 15,000 /month", True, ("Rs", 10000, 15000, "monthly")),
    ],
)
def test_salary(spark, raw, spaced, want):
    assert tuple(one(spark, text.salary_range(F.lit(raw), spaced))) == want


def test_locations(spark):
    assert one(spark, text.split_locations(F.lit("Pune and Goa/Mumbai | Delhi"))) == ["Pune", "Goa", "Mumbai", "Delhi"]
    assert one(spark, text.split_locations(F.lit("Chandigarh"))) == ["Chandigarh"]
    assert one(spark, text.split_locations(F.lit(None).cast("string"))) == []


def test_squeeze_takes_every_space(spark):
    assert one(spark, text.squeeze(F.lit("\t  a b ﻿　\n"))) == "a b"


@pytest.mark.parametrize(
    ("types", "want"),
    [(["Permanent"], "fulltime"), (["Full time", "Contract"], "fulltime"), (["Internship"], "internship"),
     (["Freelance"], None), ([], None)],
)
def test_job_type(spark, types, want):
    arr = F.array(*[F.lit(t) for t in types]).cast("array<string>")
    assert one(spark, values.job_type_of(arr)) == want


@pytest.mark.parametrize(("years", "want"), [(None, "entry"), (2, "entry"), (3, "mid"), (6, "mid"), (7, "senior")])
def test_difficulty(spark, years, want):
    assert one(spark, values.difficulty_of(F.lit(years).cast("int"))) == want


@pytest.mark.parametrize(("raw", "want"), [("0", None), ("4", 4.0), ("abc", None), (None, None)])
def test_number_or_null(spark, raw, want):
    assert one(spark, values.number_or_null(F.lit(raw).cast("string"))) == want


def test_cycle_start_is_local():
    zone = "Asia/Kolkata"
    assert dates.cycle_start("MORNING", "2024-01-20T07:00:00", zone) == dt.datetime(2024, 1, 19, 18, 30)
    assert dates.cycle_start("AFTERNOON", "2024-01-20T07:00:00", zone) == dt.datetime(2024, 1, 20, 0, 30)
    assert dates.cycle_start("NIGHT", "2024-01-20T07:00:00", zone) == dt.datetime(2024, 1, 20, 7, 30)


def test_job_id(spark):
    from jobloom.operators.normalize import with_job_id

    df = spark.createDataFrame([("naukri", "123")], "source string, external_id string")
    assert with_job_id(df).first()["_id"] == "765c65326b8faae9134703b46e4d4e6ab11c76b198d42a420ad1e9455a1c8ba0"


@pytest.mark.parametrize(("period", "want"), [("year", "yearly"), ("yearly", "yearly"), ("monthly", "monthly"), (None, None)])
def test_one_period(spark, period, want):
    assert one(spark, values.one_period(F.lit(period).cast("string"))) == want
