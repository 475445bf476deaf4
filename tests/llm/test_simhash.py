"""SimHash near-dedup against comparing all fingerprints."""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import xxhash

from conftest_llm import texts
from jobloom.llm import simhash


def plain_fingerprint(text: str) -> int:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    words = [w for w in __import__("re").split("[ \t\n\x0b\x0c\r]+", lower) if w]
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps: list[int]) -> dict[int, int]:
    """Smallest fingerprint that each reaches, all pairs compared."""
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


def test_fingerprint(rng):
    for text in texts(rng, 60, 0, 40) + ["", " \t", "ÄÖ Ab", "a b", "A\x85b c d", "x\u00a0y z w"]:
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_variants_lose_no_link(rng):
    fps = set()
    for centre in range(12):
        base = rng.getrandbits(64) if centre else 1 << 16
        block = rng.randrange(4)
        for _ in range(150 if centre < 3 else 20):
            value = base
            for _ in range(rng.randint(0, 5)):
                value ^= 1 << (rng.randrange(64) if rng.random() < 0.4 else block * 16 + rng.randrange(16))
            fps.add(value)
    fps = sorted(fps)
    signed = np.array(fps, np.uint64)
    rows = []
    for block in range(simhash.BLOCKS):
        aside = 0xFFFF << (16 * block)
        rest = (signed & np.uint64(~aside & (2**64 - 1))) ^ np.uint64(block << (16 * block))
        rows += [(rest ^ np.uint64(flip)).view(np.int64) for flip in [0] + [1 << b for b in range(64) if not aside >> b & 1]]
    keys, members = np.concatenate(rows), np.tile(signed.view(np.int64), len(rows))
    order = np.argsort(keys, kind="stable")
    keys, members = keys[order], members[order]
    for pairwise in (4, 48, 10_000):
        before, simhash.PAIRWISE = simhash.PAIRWISE, pairwise
        batches = (pa.RecordBatch.from_arrays([pa.array(keys[i : i + 997]), pa.array(members[i : i + 997])], ["key", "fp"]) for i in range(0, len(keys), 997))
        links = [(a, b) for x in simhash.verify(batches) for a, b in zip(x[0].to_pylist(), x[1].to_pylist(), strict=True)]
        simhash.PAIRWISE = before
        root = {f: f for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            x, y = find(a % 2**64), find(b % 2**64)
            root[max(x, y)] = min(x, y)
        assert {f: find(f) for f in fps} == classes(fps)


def test_components(spark, rng):
    base = texts(rng, 40, 60, 90)
    rows = []
    for text in base:
        words = text.split()
        rows.append(text)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = "zulu"
            rows.append(" ".join(words))
    rows += ["", None, " "] + base[:5]
    rng.shuffle(rows)
    found = simhash.near_duplicates(spark, spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")).collect()
    fps = {r.doc_id: int(r.fingerprint, 16) for r in found}
    assert fps == {i: plain_fingerprint(t or "") for i, t in enumerate(rows)}
    reach = classes(sorted(set(fps.values())))
    least = {}
    for i, f in fps.items():
        least[reach[f]] = min(least.get(reach[f], i), i)
    assert {r.doc_id: r.component_id for r in found} == {i: least[reach[f]] for i, f in fps.items()}
    assert sorted(r.doc_id for r in found if r.keep) == sorted(set(least.values()))


def test_awkward_rows(spark, awkward, nothing):
    found = simhash.near_duplicates(spark, awkward).collect()
    assert len(found) == awkward.count()
    assert {r.fingerprint for r in found if r.doc_id in (2, 3, 4)} == {"0" * 16} and {r.component_id for r in found if r.doc_id in (2, 3, 4)} == {2}
    assert [r.component_id for r in found if r.doc_id in (1, 8)].count(1) == 2
    assert simhash.near_duplicates(spark, nothing).count() == 0
