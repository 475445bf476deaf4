"""Exact dedup: the hash is minimal and perfect, groups are those of a plain dictionary."""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np

from jobloom.llm import common, exactdedup
from jobloom.llm.common import keep_rows


def digests(n: int, salt: str = "") -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.sha256(f"{salt}{i}".encode()).digest() for i in range(n)), np.uint8).reshape(-1, 32)


def test_minimal_perfect_hash():
    for n in (1, 2, 63, 5000):
        rows = digests(n)
        sizes, bits, slots = exactdedup.build(rows)
        assert sorted(slots.tolist()) == list(range(n))
        assert (exactdedup.look_up(rows, sizes, bits) == slots).all()
        others = digests(2000, "other")
        found = exactdedup.look_up(others, sizes, bits)
        by_slot = rows[np.argsort(slots)]
        assert not any(at >= 0 and (by_slot[at] == other).all() for at, other in zip(found, others, strict=True))


def test_groups(spark, rng):
    rows = [(i, rng.choice(["a", "b", "c", "", None, f"t{i % 40}", f"u{i}"])) for i in range(600)]
    rng.shuffle(rows)
    before, exactdedup.PER_SHARD = exactdedup.PER_SHARD, 20
    found = exactdedup.deduplicate(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    exactdedup.PER_SHARD = before
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    wanted = {i: (max(g), len(g), i == max(g), hashlib.sha256(t.encode()).digest()) for t, g in groups.items() for i in g}
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, bytes(r.digest)) for r in found} == wanted and len(found) == len(rows)


def test_awkward_rows(spark, awkward, nothing):
    found = exactdedup.deduplicate(spark, awkward).collect()
    kept = sorted(((r.doc_id, r.group_size) for r in found if r.kept), key=str)
    assert len(found) == awkward.count()
    assert kept == sorted([(8, 3), (3, 3), (4, 1), (6, 3), (7, 1), (8, 1), (9, 1)], key=str)
    assert exactdedup.deduplicate(spark, nothing).count() == 0
    only = spark.createDataFrame([(None, "x"), (None, "x")], "doc_id long, text string")
    assert sorted((r.group_size, r.kept) for r in exactdedup.deduplicate(spark, only).collect()) == [(2, False), (2, True)]


def test_rows_kept(spark, awkward):
    found = exactdedup.deduplicate(spark, awkward)
    kept = keep_rows(awkward, found.where("kept").select("doc_id", "digest"))
    assert kept.columns == awkward.columns
    assert sorted((r.text or "") for r in kept.collect()) == sorted({r.text or "" for r in awkward.collect()})


def test_kept_rows_have_all_columns_under_any_name(spark):
    """Names that helpers might use, a dot in a name, a map; of rows with equal id and text always the same one stays."""
    rows = [(1, "a", "x", 1, {"k": 1}), (1, "a", "w", 2, {"k": 1}), (2, "a", "y", 3, {"k": 2}), (None, None, "z", 4, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `__sha` string, `key.x` long, row map<string,int>")
    found = exactdedup.deduplicate(spark, docs).where("kept").select("doc_id", "digest")
    for frame in (docs, docs.repartition(5)):
        kept = common.keep_rows(frame, found)
        assert kept.columns == docs.columns
        assert sorted(((r[0], r[2]) for r in kept.collect()), key=str) == [(2, "y"), (None, "z")]
    once = common.keep_rows(docs, found.limit(0).unionByName(docs.select("doc_id", common.digest(docs.text).alias("digest"))))
    assert sorted(((r[0], r[2]) for r in once.collect()), key=str) == [(1, "w"), (2, "y"), (None, "z")]
