"""Set-overlap join: whole results against brute force, few candidates from hot items."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from jobloom.operators import overlap
from jobloom.operators.overlap import overlap_candidates, overlap_join


def brute(rows, groups, least):
    bags = {}
    for name, item in groups:
        if name is not None and item is not None:
            bags.setdefault(name, Counter())[item] += 1
    return sorted(
        (key, name, n) for key, items in rows for name, bag in bags.items()
        if (n := sum(bag[i] for i in set(items or []) - {None})) >= least
    )


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_whole_result_on_random_bags(spark, least):
    rng = random.Random(least)
    words = [f"w{i}" for i in range(30)]
    pick = lambda n: [words[min(int(rng.expovariate(0.15)), 29)] for _ in range(n)]
    rows = [(i % 190, pick(rng.randint(0, 9)) + rng.choice([[], [None]])) for i in range(200)] + [(900, None), (None, words)]
    groups = [(f"g{g}", w) for g in range(40) for w in pick(rng.randint(1, 8))] + [(None, "w1"), ("g1", None)]
    mine = overlap_join(
        spark.createDataFrame(rows, "k int, items array<string>"), "k", "items",
        spark.createDataFrame(groups, "g string, w string"), "g", "w", least,
    )
    same = lambda found: sorted(found, key=lambda r: (r[0] is None, *[str(x) for x in r]))
    assert same(map(tuple, mine.collect())) == same(brute([r for r in rows if r[0] is not None], groups, least) + [
        (None, *r[1:]) for r in brute([(0, words)], groups, least)
    ])


@pytest.mark.parametrize("item_entries, list_items", [(6, 4096), (512, 3), (0, 0), (512, 4096)])
def test_lookup_and_prefixes_agree(spark, monkeypatch, item_entries, list_items):
    """Lists with common items, long ones and all others: whichever way each is counted, the pairs are all there, with their whole sums."""
    monkeypatch.setattr(overlap, "ITEM_ENTRIES", item_entries)
    monkeypatch.setattr(overlap, "LIST_ITEMS", list_items)
    rng = random.Random(7)
    rows = [(i, [rng.randint(0, 40) for _ in range(rng.randint(0, 6))]) for i in range(150)]
    groups = [(rng.randint(0, 25), min(rng.randint(0, 60), rng.randint(0, 60))) for _ in range(400)] + [(3, 5)] * 4
    mine = overlap_join(
        spark.createDataFrame(rows, "k long, items array<long>"), "k", "items", spark.createDataFrame(groups, "g long, w long"), "g", "w", 2
    )
    assert sorted(map(tuple, mine.collect())) == brute(rows, groups, 2)


def test_rare_items_move_no_pairs(spark, monkeypatch):
    """Lists whose items few groups hold are counted where they are: no row for each pair is shuffled."""
    monkeypatch.setattr(overlap, "_pairs", lambda *_: pytest.fail("pairs are shuffled"))
    left = spark.createDataFrame([(1, ["a", "b"]), (2, ["b"])], "k int, items array<string>")
    right = spark.createDataFrame([("g", "a"), ("g", "b"), ("h", "b"), ("h", "b")], "g string, w string")
    assert sorted(map(tuple, overlap_join(left, "k", "items", right, "g", "w").collect())) == [(1, "g", 2), (1, "h", 2), (2, "h", 2)]


def test_hot_items_make_no_candidates_by_themselves(spark):
    """Every row and every group holds one hot item; only the few that share a rare one as well are looked at."""
    rows = [(i, ["hot", f"r{i}"]) for i in range(3000)]
    groups = [(f"g{g}", w) for g in range(300) for w in ("hot", f"r{g * 7}", f"x{g}")]
    left, right = spark.createDataFrame(rows, "k int, items array<string>"), spark.createDataFrame(groups, "g string, w string")
    assert overlap_candidates(left, "items", right, "g", "w").count() == 300
    found = overlap_join(left, "k", "items", right, "g", "w").collect()
    assert sorted(map(tuple, found)) == sorted((g * 7, f"g{g}", 2) for g in range(300))


def test_empty_sides_and_equal_lists(spark):
    left = spark.createDataFrame([(1, ["a", "b"]), (2, ["b", "a", "a"]), (1, ["a", "b"])], "k int, items array<string>")
    right = spark.createDataFrame([("g", "a"), ("g", "b")], "g string, w string")
    assert sorted(map(tuple, overlap_join(left, "k", "items", right, "g", "w").collect())) == [(1, "g", 2), (1, "g", 2), (2, "g", 2)]
    assert overlap_candidates(left, "items", right, "g", "w").count() == 1
    assert overlap_join(left.limit(0), "k", "items", right, "g", "w").count() == 0
    assert overlap_join(left, "k", "items", right.limit(0), "g", "w").count() == 0
    with pytest.raises(ValueError):
        overlap_join(left, "k", "items", right, "g", "w", 0)
