"""Registered queries on the smallest tables: SQL where there is some, and the pipeline against its stages by brute force."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import check  # noqa: E402

import corpus_pipeline  # noqa: E402
from jobloom.llm import queries, secrets, toxicity  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", list(queries.oracle_sql()))
def test_query_agrees_with_sql(spark, name):
    mine = queries.queries()[name](spark, SF_DIR).toPandas()
    theirs = check.connect(SF_DIR).sql(queries.oracle_sql()[name]).df()
    assert sorted(mine.columns) == sorted(theirs.columns) and check.rows(mine) == check.rows(theirs)


def test_whole_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    for name in ("op2_simhash_near_dedup", "op4_byte_bpe", "op6_exact_dedup", "op7_toxicity", "op8_pii", "op9_secret_scans", "op10_quality_rules"):
        assert queries.queries()[name](spark, SF_DIR).select("doc_id").distinct().count() == docs


def test_pipeline_stages(spark):
    """Each stage's output against a plain version of it, over all rows the stage before kept."""
    from test_packing import check as check_packing
    from test_simhash import classes, plain_fingerprint

    raw = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    before = raw
    outs = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, before, SF_DIR)
        rows = [tuple(r) for r in after.collect()]
        outs[name] = rows
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == raw.columns
            before = spark.createDataFrame(rows, raw.schema)
    everything = [tuple(r) for r in raw.collect()]
    model = toxicity.fit(raw, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    score = model.scorer()
    clean = [r for r in everything if score(r[1] or "") < toxicity.THRESHOLD]
    assert sorted(outs["toxicity"]) == sorted(clean)
    last = {}
    for r in clean:
        last[r[1]] = max(last.get(r[1], -1), r[0])
    assert sorted(outs["exact dedup"]) == sorted(r for r in clean if last[r[1]] == r[0])
    fps = {r[0]: plain_fingerprint(r[1]) for r in outs["exact dedup"]}
    reach = classes(sorted(set(fps.values())))
    least = {}
    for i, f in fps.items():
        least[reach[f]] = min(least.get(reach[f], i), i)
    assert sorted(outs["SimHash near-dedup"]) == sorted(r for r in outs["exact dedup"] if r[0] in set(least.values()))
    scanner = secrets.Scanner()
    for old, new in zip(sorted(outs["SimHash near-dedup"]), sorted(outs["secret scans"]), strict=True):
        assert (old[0], *old[2:4]) == (new[0], *new[2:4]) and new[4] == len(new[1])
        assert (old == new) == (not scanner.spans(old[1]))
    packed = corpus_pipeline.best_fit_packing(spark, before, SF_DIR).collect()
    check_packing(packed, [(r[0], r[1]) for r in outs["secret scans"]], 1024)
    assert len(packed) == corpus_pipeline.run(spark, SF_DIR).count()


def test_pipeline_on_awkward_rows(spark, awkward, tmp_path):
    docs = awkward.selectExpr("doc_id", "text", "kind lang", "key source", "no n_chars")
    empty = docs.limit(0)
    spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for frame in (docs, empty):
        now = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, str(tmp_path))
            assert now.columns == docs.columns
        corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).count()


def test_pipeline_without_labels_of_both_classes_and_with_other_columns(spark, tmp_path):
    """Nothing is judged toxic then; no stage needs a column beside doc_id and text, and none loses one."""
    rows = [(1, "token=abcdefgh one two", "k"), (2, "token=abcdefgh one two", "l"), (3, None, "m"), (None, "other words here", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `__key` string")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns and now.count() == (4 if name == "toxicity" else 3)
    assert "token=abcdefgh" not in str(now.collect())
