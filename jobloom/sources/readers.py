"""Readers: raw records, fetched pages, dictionaries, backlog and marks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

from jobloom import schemas
from jobloom.functions import dates
from jobloom.functions.text import canonical, squeeze
from jobloom.operators.normalize import has_id

FIRST_MARK = "2000-01-01"
MARKS = "feed STRING, max_date TIMESTAMP_NTZ"


def no_rows(spark: SparkSession, schema) -> DataFrame:
    """A table the planner knows to be empty: what is joined with it is not shuffled."""
    return spark.createDataFrame([], schema).filter(F.lit(False))


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A parquet table, or no rows when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, schema)


def read_raw(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Staged raw records: identity columns and the payload as JSON text."""
    return spark.read.schema(schemas.RAW).format(fmt).load(path)


def external_id(source: str, payload: Column) -> Column:
    """Record id by source, null when missing."""
    paths = {"naukri": ["$.jobId"], "foundit": ["$.jobId", "$.jobID"]}.get(source, ["$.id"])
    return F.coalesce(
        *[
            F.when(~F.get_json_object(payload, p).isin("", "0"), F.get_json_object(payload, p))
            for p in paths
        ]
    )


def explode_feed(pages: DataFrame, source: str, body: str = "body") -> DataFrame:
    """One row per record of the fetched pages: source, external_id, payload."""
    keys = schemas.FEED_KEYS[source]
    shape = ", ".join(f"`{k}` ARRAY<STRING>" for k in keys)
    parsed = F.from_json(body, shape)
    kept = [c for c in pages.columns if c != body]
    records = pages.withColumn("_page", parsed).select(
        *kept, F.explode(F.coalesce(*[F.col(f"_page.{k}") for k in keys])).alias("payload")
    )
    return records.withColumn("source", F.lit(source)).withColumn(
        "external_id", external_id(source, F.col("payload"))
    )


def valid_ids(raw: DataFrame, *ids: str) -> DataFrame:
    """Rows with a usable id, taken from the first of `ids` that has one."""
    return raw.withColumn("external_id", has_id(*ids)).filter(F.col("external_id").isNotNull())


def taxonomy_from_text(texts: DataFrame, strict: bool = False) -> DataFrame:
    """(skill, bucket, precedence) from rows (bucket, precedence, value = JSON list).

    Terms are lower-cased and trimmed. `strict` keeps them as written, so that terms
    which are not canonical never match.
    """
    term = F.explode(F.from_json("value", "array<string>"))
    long = texts.select(term.alias("skill"), "bucket", "precedence")
    if not strict:
        long = long.withColumn("skill", canonical(F.col("skill")))
    return long.filter(F.col("skill") != "").distinct()


def load_taxonomy(spark: SparkSession, paths: dict[str, str], strict: bool = False) -> DataFrame:
    """Read one JSON list per bucket; earlier buckets win."""
    parts = [
        spark.read.text(path, wholetext=True).select(
            F.lit(bucket).alias("bucket"), F.lit(i).alias("precedence"), "value"
        )
        for i, (bucket, path) in enumerate(paths.items())
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return taxonomy_from_text(out, strict)


def role_skills_from_text(texts: DataFrame) -> DataFrame:
    """(role, role_ord, skill) from a JSON object role -> list; order and repeats kept."""
    entries = F.map_entries(F.from_json("value", "map<string,array<string>>"))
    return texts.select(F.posexplode(entries).alias("role_ord", "entry")).select(
        F.col("entry.key").alias("role"), "role_ord", F.explode("entry.value").alias("skill")
    )


def load_role_skills(spark: SparkSession, path: str) -> DataFrame:
    return role_skills_from_text(spark.read.text(path, wholetext=True))


def load_role_vectors(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """(role, ord, vector); a JSON file is one list of {role, vector}."""
    if fmt == "parquet":
        return spark.read.parquet(path).select("role", "ord", F.col("vector").cast("array<double>").alias("vector"))
    items = F.from_json("value", "array<struct<role:string,vector:array<double>>>")
    return spark.read.text(path, wholetext=True).select(F.posexplode(items).alias("ord", "r")).select(
        "r.role", F.col("ord").cast("bigint").alias("ord"), "r.vector"
    )


def read_term_backlog(spark: SparkSession, path: str) -> DataFrame:
    """Terms of a backlog, one per line; blank lines dropped."""
    term = squeeze(F.col("value")).alias("term")
    return spark.read.text(path).select(term).filter(F.col("term") != "")


def read_mark(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """One row: (feed, max_date), the first mark when the feed is new."""
    marks = read_or_empty(spark, path, MARKS).filter(F.col("feed") == feed)
    return marks.agg(
        F.coalesce(F.max("max_date"), dates.moment(FIRST_MARK)).alias("max_date")
    ).select(F.lit(feed).alias("feed"), "max_date")
