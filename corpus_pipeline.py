"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm import exactdedup, packing, secrets, simhash, toxicity
from jobloom.llm.common import keep_rows, settle, ship


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches the threshold go; the classifier is fitted on labelled rows of these documents.

    Without labels of both classes nothing can be told apart and nothing goes. Null and empty texts get the score of a text
    without words; texts are scored whole; repeated rows share a score, so all or none of them go; no documents give none.
    """
    ship(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    if not isinstance(model, toxicity.Model):
        return docs
    return docs.where(toxicity.score(F.col("text"), model) < toxicity.THRESHOLD)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id goes on; of its repeats, one.

    Null and empty texts are equal, a null doc_id is below all others, texts are compared whole, other columns go along under any name.
    """
    ship(spark)
    found = exactdedup.deduplicate(spark, docs)
    return keep_rows(docs, found.where("kept").select("doc_id", "digest"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each SimHash component (3-word shingles, 3 bits), the row with the smallest doc_id goes on; of its repeats, one.

    Null and empty texts, and texts without words, share fingerprint zero and are linked like any others; texts count whole.
    """
    ship(spark)
    found = simhash.near_duplicates(spark, docs, size=3)
    return keep_rows(docs, found.where("keep").select("doc_id", "digest"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every found secret is replaced by its kind in brackets; documents without any stay as they are.

    No row goes, repeats and null ids included; a null text stays null. `n_chars` follows the text where there is such a column.
    """
    ship(spark)
    clean = docs.withColumn("text", secrets.redacted(F.col("text")))
    if "n_chars" not in docs.columns:
        return clean
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return clean.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), length))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of at most 1024 tokens: a row per piece; null and empty texts are their end token."""
    ship(spark)
    return packing.pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2, special=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", exact_dedup),
    ("SimHash near-dedup", near_dedup),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]

#: SQL can express neither the classifier nor the automaton; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(spark, stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
