"""Sinks. Tables written in steps are logs of batches: a batch owns its folder, so
writing it again replaces it and nothing is added twice."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.operators.graph import KEYS, latest
from jobloom.operators.staging import first_copies
from jobloom.sources.readers import read_or_empty

# Tables of one graph batch written at the same time; they do not depend on each other.
WRITERS = 4


#: Ids are digests in hex, of which this codec keeps half the bytes; the default keeps all.
CODEC = "zstd"


def write_batch(df: DataFrame, path: str, batch: int) -> None:
    df.write.mode("overwrite").option("compression", CODEC).parquet(f"{path}/batch={batch}")


def read_batches(spark: SparkSession, path: str, schema: str, before: int | None = None) -> DataFrame:
    """Rows of all batches with their `batch` number, or of those before one."""
    df = read_or_empty(spark, path, f"{schema}, batch BIGINT")
    return df if before is None else df.filter(F.col("batch") < before)


def current(log: DataFrame, keys: list[str]) -> DataFrame:
    """Latest row per key of a batch log; rows that are all key are just distinct."""
    if set(log.columns) == {*keys, "batch"}:
        return log.select(*keys).distinct()
    return latest(log, keys, "batch").drop("batch")


def write_jobs(jobs: DataFrame, path: str, batch: int, existing: DataFrame | None = None) -> None:
    """Append job rows whose `_id` is not there yet, each `_id` once."""
    jobs = first_copies(jobs, ["_id"], ["_id"])
    fresh = jobs if existing is None else jobs.join(existing.select("_id"), "_id", "left_anti")
    write_batch(fresh, path, batch)


def commit(spark: SparkSession, root: str, batch: int) -> None:
    """Mark a batch of the tables under `root` as whole; readers skip batches without the mark."""
    write_batch(spark.range(1), f"{root}/_committed", batch)


def committed(spark: SparkSession, root: str, before: int | None = None) -> list[int]:
    """Numbers of the whole batches under `root`, in order: one small row per batch."""
    marks = read_batches(spark, f"{root}/_committed", "id BIGINT", before).select("batch").distinct()
    return sorted(r["batch"] for r in marks.collect())


def _write_all(tables: dict[str, tuple[DataFrame, str]], batch: int) -> None:
    with ThreadPoolExecutor(WRITERS) as pool:
        for write in [pool.submit(write_batch, df, path, batch) for df, path in tables.values()]:
            write.result()


def write_graph(graph: dict[str, DataFrame], root: str, batch: int) -> None:
    """Append one batch of every node and edge table, a few tables at a time, and mark it as whole."""
    _write_all({name: (df, f"{root}/{name}") for name, df in graph.items()}, batch)
    commit(next(iter(graph.values())).sparkSession, root, batch)


def read_graph(
    spark: SparkSession, root: str, names: list[str] | None = None, columns: dict[str, list[str]] | None = None
) -> dict[str, DataFrame]:
    """Current state of node and edge tables from the log of whole batches; `columns` lists what is needed of a table.

    Choose columns here and not later: the latest-row step carries all it is given.
    """
    chosen = columns or {}
    whole = committed(spark, root)
    tables = {}
    for name in names or KEYS:
        log = spark.read.parquet(f"{root}/{name}").filter(F.col("batch").isin(whole))
        wanted = dict.fromkeys([*KEYS[name], *chosen[name], "batch"]) if name in chosen else log.columns
        tables[name] = current(log.select(*wanted), KEYS[name])
    return tables


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Save an edge table bucketed by key, so joins on the key need no shuffle."""
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(table)


def write_published(view: DataFrame, path: str, batch: int) -> None:
    write_batch(view, path, batch)


def write_jdbc(view: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Hand a published view to a database; nested skills go as JSON text."""
    flat = view.withColumn("skills", F.to_json("skills")).withColumn("industry", F.to_json("industry"))
    flat.write.mode("append").jdbc(url, table, properties=properties)


def write_term_backlog(terms: DataFrame, path: str, term: str = "term") -> None:
    terms.select(F.col(term).alias("value")).distinct().write.mode("append").text(path)


def write_unmatched_skills(unmatched: DataFrame, path: str, key: str, title: str) -> None:
    """One JSON line {role, skills, title} per row of the cascade."""
    lines = (
        unmatched.groupBy(key, "role", title)
        .agg(F.array_sort(F.collect_list("skill")).alias("skills"))
        .select(F.to_json(F.struct("role", "skills", F.col(title).alias("title"))).alias("value"))
    )
    lines.write.mode("append").text(path)


def save_mark(mark: DataFrame, path: str) -> None:
    """Replace the mark of the feeds in `mark(feed, max_date)`; other feeds stay."""
    (
        mark.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("feed")
        .parquet(path)
    )
