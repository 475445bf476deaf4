"""Embedding near-duplicates against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest

from jobloom.llm import epsgrid


def plain(rows, threshold):
    """Sorted (vec_id, n_links, component_id, kept) from all pairs."""
    units = [None if r[2] is None else epsgrid.unit(r[1]) for r in rows]
    links = {i: {j for j, v in enumerate(units) if i != j and v is not None and u is not None and rows[i][2] == rows[j][2] and len(u) == len(v) and math.fsum(u * v) >= threshold} for i, u in enumerate(units)}
    out = []
    for i, row in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((row[0], len(links[i]), least, row[0] is not None and row[0] == least))
    return sorted(out, key=str)


def mine(spark, rows, threshold=0.93):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return sorted((tuple(r) for r in epsgrid.near_duplicates(spark, frame, threshold=threshold).collect()), key=str)


def invented(n, dims, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(max(1, n // 12), dims))
    picked = centres[rng.integers(len(centres), size=n)] + spread * rng.normal(size=(n, dims)) * rng.random((n, 1))
    return [(i, v.tolist(), int(rng.integers(3))) for i, v in enumerate(picked)]


@pytest.mark.parametrize(("dims", "size"), [(3, 64), (16, 16_000_000), (16, 8)])
def test_equals_all_pairs(spark, monkeypatch, dims, size):
    """Also with intervals of a few vectors, so that pairs of intervals over several levels are needed."""
    monkeypatch.setattr(epsgrid, "BLOCK", 5)
    monkeypatch.setattr(epsgrid, "INTERVAL_BYTES", size)
    rows = invented(400, dims, dims)
    found = mine(spark, rows)
    assert found == plain(rows, 0.93) and sum(r[1] for r in found) > 400


def test_distant_blocks_are_skipped():
    """In a plane nearly everything is skipped; nothing near is lost."""
    angles = np.sort(np.random.default_rng(3).random(4000)) * 2 * math.pi
    v = np.stack([np.cos(angles), np.sin(angles)], axis=1)
    eps, links = math.sqrt(2 - 2 * 0.9999), []
    at = epsgrid._turned(v, np.eye(2))
    join = epsgrid.Sequences(v, v, at, at, True, eps, lambda i, j, c: links.extend(zip(*(np.nonzero(c >= 0.9999) + np.array([[i], [j]])), strict=True)))
    join.join()
    assert {(x, y) for x, y in links if x < y} == {(x, y) for x, y in zip(*np.nonzero(v @ v.T >= 0.9999), strict=True) if x < y}
    assert join.multiplied < 0.3 * 4000 * 4000 / 2 < join.skipped


def test_hot_vector_and_chain(spark):
    """A third of all rows are copies, another third near copies; a chain links far ends into one component."""
    rng = np.random.default_rng(5)
    base = rng.normal(size=24)
    rows = [(i, base.tolist(), 1) for i in range(300)] + [(300 + i, (base + 0.05 * rng.normal(size=24)).tolist(), 1) for i in range(300)]
    rows += [(600 + i, [math.cos(0.3 * i), math.sin(0.3 * i)], 2) for i in range(9)]
    found = mine(spark, rows)
    assert found == plain(rows, 0.93)
    assert {r[2] for r in found if 600 <= r[0]} == {600} and max(r[1] for r in found) == 599


def test_awkward_rows(spark):
    nan, inf = math.nan, math.inf
    rows = [
        (1, [1.0, 2.0], 1), (1, [1.0, 2.0], 1), (2, [2.0, 4.0], 1), (3, [2.0, 4.0], None), (None, [1.0, 2.0], 1), (None, [0.5, -2.0], 1), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1),
        (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [None, 1.0], 1), (10, [1e200, 2e200], 1), (11, [1e-300, 2e-300], 1), (12, [1.0, 2.0, 0.0], 1), (13, [-1.0, -2.0], 1), (14, [1.0], 1), (15, [3.0], 1),
    ]
    assert mine(spark, rows) == plain(rows, 0.93)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    clash = frame.selectExpr("*", "vec_id seq", "label part", "1 unit", "'x' dims", "2 root")
    assert sorted((tuple(r) for r in epsgrid.near_duplicates(spark, clash).collect()), key=str) == plain(rows, 0.93)
    assert epsgrid.near_duplicates(spark, frame.limit(0)).count() == 0
    assert epsgrid.near_duplicates(spark, frame.where("vec_id = 4")).collect()[0]["kept"] is True


def test_threshold_must_be_a_cosine(spark):
    with pytest.raises(ValueError):
        epsgrid.near_duplicates(spark, spark.range(1), threshold=0)
