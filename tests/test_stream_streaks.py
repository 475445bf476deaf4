"""Streaks as stream state: any split into batches gives the cut of the whole table."""

from __future__ import annotations

import random

import pytest

from jobloom.operators.feeds import cut_at_streak
from jobloom.sources import sinks
from jobloom.streaming import jobs as streams

SCHEMA = "feed STRING, seq BIGINT, page BIGINT, fresh BOOLEAN"


@pytest.mark.parametrize("page", [None, "page"])
def test_batches_cut_like_the_whole(spark, tmp_path, page):
    rng, root = random.Random(5), str(tmp_path)
    rows = [(f"f{n}", i, i // 7, rng.random() < 0.2 + n / 10) for n in range(6) for i in range(60)]
    cuts = {f"f{n}": sorted(rng.sample(range(60), 3)) for n in range(6)}
    odd = [(None, 3, 0, True), ("f0", None, 0, True)]
    for part in range(4):
        some = [r for r in rows if sum(r[1] >= c for c in cuts[r[0]]) == part] + (odd if part == 1 else [])
        # positions behind those of the batch before are late
        some += [("f5", 0, 0, True)] if part == 3 else []
        spark.createDataFrame(some, SCHEMA).coalesce(1).write.parquet(f"{root}/landing/{part}")
        read = streams.file_stream(spark, f"{root}/landing/*", spark.createDataFrame([], SCHEMA).schema)
        streams.streak_stream(read, "feed", "seq", "fresh", 4, root, page, width=8).awaitTermination()
    whole = cut_at_streak(spark.createDataFrame(rows, SCHEMA), "feed", "seq", "fresh", 4, page)
    taken = sinks.read_batches(spark, f"{root}/taken", SCHEMA).drop("batch").collect()
    left = sinks.read_batches(spark, f"{root}/left_out", f"{SCHEMA}, reason STRING").collect()
    assert sorted(map(tuple, taken)) == sorted(map(tuple, whole.collect()))
    assert 0 < len(taken) < len(rows) and len(taken) + len(left) == len(rows) + 3
    reasons = sorted(r.reason for r in left if r.reason != "stopped")
    assert reasons[:2] == ["incomplete"] * 2 and reasons[2:] in ([], ["late"])
