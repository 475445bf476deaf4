"""Skill classification against a caller-supplied taxonomy(skill, bucket, precedence)."""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from jobloom.fixed_values import CATEGORIES
from jobloom.functions.text import canonical
from jobloom.functions.values import array_or_empty
from jobloom.operators.lookup import attach, distinct_lists
from jobloom.operators.ranking import global_row_number


def one_bucket(taxonomy: DataFrame) -> DataFrame:
    """One row per skill: the bucket of the lowest precedence wins, nulls last, then the first by name."""
    rank = F.struct(F.col("precedence").isNull(), "precedence", "bucket")
    return taxonomy.groupBy("skill").agg(F.min_by("bucket", rank).alias("bucket"))


def union_buckets(*buckets: DataFrame) -> DataFrame:
    """All (skill, bucket, precedence) rows of several bucket lists, once each."""
    out = buckets[0]
    for b in buckets[1:]:
        out = out.unionByName(b)
    return out.distinct()


def canonical_terms(skills: str) -> Column:
    """Canonical skills of a row in their order; empty for null."""
    return F.transform(array_or_empty(F.col(skills)), canonical)


def bucket_lists(lists: DataFrame, taxonomy: DataFrame, out: str) -> DataFrame:
    """(_list, out): the terms of every distinct list with their buckets, in their order."""
    known = one_bucket(taxonomy).select(F.col("skill").alias("_known"), "bucket")
    terms = lists.select("_list", F.posexplode("_terms").alias("_pos", "skill"))
    tagged = terms.join(known, F.col("skill") == F.col("_known"), "left")
    return (
        tagged.groupBy("_list")
        .agg(F.array_sort(F.collect_list(F.struct("_pos", "skill", "bucket"))).alias("_all"))
        .select("_list", F.transform("_all", lambda e: F.struct(e["skill"].alias("skill"), e["bucket"].alias("bucket"))).alias(out))
    )


def no_buckets() -> Column:
    return F.array().cast("array<struct<skill:string,bucket:string>>")


def with_buckets(df: DataFrame, skills: str, taxonomy: DataFrame, out: str = "skill_buckets") -> DataFrame:
    """Add array<struct(skill, bucket)>: canonical skills in their order, bucket null if unknown."""
    terms = canonical_terms(skills)
    found = bucket_lists(distinct_lists(df, terms), taxonomy, out)
    return attach(df, terms, found).withColumn(out, F.coalesce(out, no_buckets()))


def names(tagged: Column, bucket: str | None = None) -> Column:
    """Skills of one bucket, or of any bucket."""
    keep = F.filter(
        tagged, lambda e: e["bucket"].isNotNull() if bucket is None else e["bucket"] == bucket
    )
    return F.transform(keep, lambda e: e["skill"])


def filter_valid_skills(df: DataFrame, skills: str, taxonomy: DataFrame, out: str = "valid_skills") -> DataFrame:
    """Canonical skills found in the taxonomy; order and repeats kept."""
    tagged = with_buckets(df, skills, taxonomy, "_tagged")
    return tagged.withColumn(out, names(F.col("_tagged"))).drop("_tagged")


def classify_skills(df: DataFrame, skills: str, taxonomy: DataFrame, out: str = "skills") -> DataFrame:
    """struct(technical, tools, soft, unknown) of each row's skills."""
    tagged = with_buckets(df, skills, taxonomy, "_tagged")
    t = F.col("_tagged")
    unknown = F.transform(F.filter(t, lambda e: e["bucket"].isNull()), lambda e: e["skill"])
    return tagged.withColumn(
        out, F.struct(*[names(t, b).alias(b) for b in CATEGORIES], unknown.alias("unknown"))
    ).drop("_tagged")


def unknown_terms(terms: DataFrame, term: str, taxonomy: DataFrame) -> DataFrame:
    """(term, n): canonical terms in no bucket with their number of uses.

    Counting comes first, so the join sees each distinct term once.
    """
    counted = (
        terms.select(canonical(F.col(term)).alias("term"))
        .filter(F.col("term") != "")
        .groupBy("term")
        .agg(F.count("*").alias("n"))
    )
    known = taxonomy.select(F.col("skill").alias("term")).distinct()
    return counted.join(known, "term", "left_anti")


def apply_classification(
    taxonomy: DataFrame, classified: DataFrame, asked: DataFrame | None = None
) -> DataFrame:
    """Taxonomy plus valid (skill, category) answers, each pair once.

    An answer counts when its category exists, the skill was asked for and the
    skill got exactly one category.
    """
    ok = (
        classified.filter(F.col("category").isin(*CATEGORIES))
        .groupBy("skill")
        .agg(F.min("category").alias("bucket"), F.max("category").alias("other"))
        .filter(F.col("bucket") == F.col("other"))
        .select("skill", "bucket")
    )
    if asked is not None:
        ok = ok.join(asked.select("skill").distinct(), "skill", "left_semi")
    rank = F.element_at(
        F.create_map(*[x for i, c in enumerate(CATEGORIES) for x in (F.lit(c), F.lit(i))]),
        F.col("bucket"),
    )
    added = ok.withColumn("precedence", rank)
    return (
        taxonomy.select("skill", "bucket", "precedence")
        .unionByName(added)
        .groupBy("skill", "bucket")
        .agg(F.min("precedence").alias("precedence"))
    )


def skill_roles_long(items: DataFrame) -> DataFrame:
    """(skill, roles[]) to one row per (skill, role)."""
    return items.select("skill", F.explode("roles").alias("role"))


def chunk(df: DataFrame, term: str, size: int) -> DataFrame:
    """Number distinct terms in their order and cut them into batches of `size`."""
    numbered = global_row_number(df, [F.col(term)], "row")
    return numbered.select(
        term,
        (F.col("row") - 1).alias("idx"),
        F.floor((F.col("row") - 1) / F.lit(size)).cast("bigint").alias("batch"),
    )


def batches(df: DataFrame, term: str, size: int) -> DataFrame:
    """One row per batch of at most `size` terms."""
    return (
        chunk(df, term, size)
        .groupBy("batch")
        .agg(F.array_sort(F.collect_list(F.struct("idx", term))).alias("t"))
        .select("batch", F.transform("t", lambda e: e[term]).alias("terms"))
    )


def classify_terms(
    df: DataFrame,
    term: str,
    classifier: Callable[[list[str]], list[tuple[str, str]]],
    size: int = 25,
) -> DataFrame:
    """(skill, category) from a caller's batch classifier.

    The classifier gets lists of at most `size` terms, one call per batch.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [r for terms in frame["terms"] for r in classifier(list(terms))]
            yield pd.DataFrame(rows, columns=["skill", "category"])

    return batches(df, term, size).select("terms").mapInPandas(run, "skill string, category string")
