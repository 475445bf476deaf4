"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm import bpe, collocations, epsgrid, exactdedup, packing, pii, prefixtrie, quality, secrets, simhash, tokencounts, toxicity, urlfilter
from jobloom.llm.common import ship


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The contract's rules (fixed values).
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(spark, _table(spark, sf_dir, "pages"), URL_RULES)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(spark, _table(spark, sf_dir, "documents"))
    return found.select("doc_id", "fingerprint", "component_id")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; a token that crosses a line break goes to the line with most of it."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokencounts.count(_table(spark, sf_dir, "documents"), path, fields=("text",), rule="most", special=True)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack(spark, _table(spark, sf_dir, "documents"), path, capacity=1024, end_id=2, special=True)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exactdedup.deduplicate(spark, _table(spark, sf_dir, "documents"))
    return found.withColumn("text_sha256", F.lower(F.hex("digest"))).drop("digest")


OP6_SQL = """
SELECT doc_id, max(doc_id) OVER copies AS keep_id, count(*) OVER copies AS group_size,
       doc_id = max(doc_id) OVER copies AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW copies AS (PARTITION BY coalesce(text, ''))
"""


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(spark, _table(spark, sf_dir, "documents"))


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judge(spark, _table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(spark, _table(spark, sf_dir, "documents"))


def op12_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return epsgrid.near_duplicates(spark, _table(spark, sf_dir, "embeddings"))


def op13_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.trie(spark, _table(spark, sf_dir, "conversations"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = (op1_url_filters, op2_simhash_near_dedup, op3_token_counts, op4_byte_bpe, op5_best_fit_packing, op6_exact_dedup, op7_toxicity, op8_pii, op9_secret_scans, op10_quality_rules, op11_phrase_collocations, op12_embedding_near_dedup, op13_conversation_prefix_trie)
    return {f.__name__: f for f in made}


def oracle_sql() -> dict[str, str]:
    return {"op1_url_filters": urlfilter.sql(URL_RULES), "op6_exact_dedup": OP6_SQL, "op10_quality_rules": quality.sql(), "op11_phrase_collocations": collocations.sql(), "op12_embedding_near_dedup": epsgrid.sql(), "op13_conversation_prefix_trie": prefixtrie.sql()}
