"""Helpers the operators share: tables settled in the shared folder, row keys, slices of Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.session import scratch_dir

#: Stands for a null id where an id is a join key.
NO_ID = -(2**63)


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once per Spark context.

    Workers then need not have it installed or on their path. The archive is made on
    the driver; Spark's own file distribution takes it to the executors.
    """
    context = spark.sparkContext
    if getattr(context, "_jobloom_sent", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="jobloom-")) / "jobloom.zip"
    with zipfile.ZipFile(archive, "w") as files:
        for source in sorted(package.rglob("*.py")):
            files.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._jobloom_sent = True


def settle(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back.

    Lineage ends there: a lost executor costs the tasks of one step, and what
    is read twice is computed once.
    """
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ids_and_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names; other columns cannot clash. Sends the package along."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def digest(text: Column) -> Column:
    """SHA-256 of the UTF-8 bytes as 32 bytes; a null text counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def keep_rows(docs: DataFrame, keepers: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose id and text digest are in `keepers` (doc_id, digest), one for each of these.

    Every key stands for one row, so no copy group can gather in a task: groups
    were reduced to their keeper before. Of rows with equal id and text the one with the least other
    columns, written as JSON, stays. Rows travel as one struct, so no column of theirs clashes with a helper.
    """
    quoted = {c: F.col(f"`{c}`") for c in docs.columns}
    rest = [x for c, x in quoted.items() if c not in (id_col, text_col)]
    order = F.to_json(F.struct(*rest)) if rest else F.lit("")
    marked = docs.select(F.struct(*quoted.values()).alias("row"), order.alias("least"), F.coalesce(quoted[id_col].cast("long"), F.lit(NO_ID)).alias("key"), digest(quoted[text_col]).alias("sha"))
    wanted = keepers.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("key"), F.col("digest").alias("sha"))
    kept = marked.join(wanted, ["key", "sha"], "left_semi").groupBy("key", "sha").agg(F.min_by("row", "least").alias("row"))
    return kept.select("row.*")


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", chars: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into slices of about `chars` characters with their texts as strings; null is empty.

    A text longer than that is a slice by itself, never cut.
    """
    for batch in batches:
        texts = [x or "" for x in batch.column(column).to_pylist()]
        start, held = 0, 0
        for end, text in enumerate(texts):
            if held and held + len(text) > chars:
                yield batch.slice(start, end - start), texts[start:end]
                start, held = end, 0
            held += len(text)
        if start < len(texts):
            yield batch.slice(start), texts[start:]
