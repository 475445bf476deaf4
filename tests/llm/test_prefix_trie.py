"""The prefix trie against a plain dictionary of prefixes."""

from __future__ import annotations

import hashlib
import zlib

import pytest

from jobloom.llm import prefixtrie


def plain(rows):
    turns: dict[int, list] = {}
    for c, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        turns.setdefault(c, []).append((role or "", text or ""))
    nodes: dict[tuple, list] = {}
    ends: dict[tuple, list] = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        whole = tuple(turns.get(c - int(abs(c) % 5) * (1 if c >= 0 else -1), [])[:h] + turns[c][h:])
        for d in range(len(whole) + 1):
            nodes.setdefault(whole[:d], []).append(c)
        ends.setdefault(whole, []).append(c)
    sums = {p: [0, 0, 0] for p in nodes}
    for p in nodes:
        if p:
            sums[p[:-1]][0] += 1
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            sums[p[:d]][1] += sums[p][0] == 0
            sums[p[:d]][2] += (len(members) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(
        (min(m), len(p), min(nodes[p[:-1]]) if p else -1, len(m), *sums[p], hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in nodes.items()
    )


def mine(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = [tuple(r) for r in prefixtrie.trie(spark, frame).collect()]
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in found)


def invented(rng, n, longest):
    rows = []
    for c in range(n):
        for t in range(rng.randint(1, longest if c % 7 == 0 else 6)):
            rows.append((c * rng.choice([1, 1, 3]), t, rng.choice(["user", "assistant"]) if t > 2 else "user", rng.choice(["yes", "no", "é"]) * (1 + t % 3)))
    return rows


@pytest.mark.parametrize("longest", [5, 30, 90])
def test_equals_a_dictionary(spark, rng, longest):
    """Up to three levels of blocks."""
    rows = invented(rng, 120, longest)
    assert mine(spark, rows) == plain(rows)


def test_long_shared_conversations(spark):
    """Equal to a block's end, one turn over it, one long conversation with many copies, ends at the ends of blocks of every level."""
    lengths = [1, 7, 8, 9, 16, 63, 64, 65, 72, 128, 200, 64, 8]
    rows = [(5 * i, t, "user", f"turn {t}" if (i, t) != (10, 130) else "other") for i, n in enumerate(lengths) for t in range(n)]
    rows += [(1000 + 5 * i, t, "user", f"turn {t}") for i in range(40) for t in range(3)]
    rows += [(-5 * i, t, "bot", "x") for i in range(1, 4) for t in range(i)]
    assert mine(spark, rows) == plain(rows)


def test_awkward_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "bot", "b"), (2, None, "", ""), (None, 1, "user", "lost"), (3, 5, "user", "z" * 50_000), (4, 1, "ab", "c"), (6, 1, "a", "bc"), (-7, 2, "user", "minus"), (2**60, 1, "user", "a")]
    rows += [(10 + i, 0, "user", "same") for i in range(50)]
    assert mine(spark, rows) == plain(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 pos", "2 id", "'q' digest", "3 seq", "4 i")
    assert prefixtrie.trie(spark, frame).count() == len(plain(rows))
    assert prefixtrie.trie(spark, frame.limit(0)).count() == 0
    assert prefixtrie.trie(spark, frame.where("conv_id IS NULL")).count() == 0


def test_only_turnless_conversations(spark):
    """Conversation 4 is cut to nothing: its base is absent and all its turns are among the first h."""
    absent = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows = [(absent, 0, "user", "a")]
    found = mine(spark, rows)
    assert found == plain(rows) and len(found) == 1 and found[0][4:6] == (0, 1)
