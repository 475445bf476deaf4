"""Packing: whole, in order, within capacity, near the least number of sequences."""

from __future__ import annotations

import zlib
from itertools import combinations_with_replacement

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from conftest_llm import texts
from jobloom.llm import hf_ids, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def check(rows: list, docs: list[tuple], capacity: int) -> int:
    """Every document whole and in pieces as asked; sequences gapless; the number of sequences."""
    made = library()
    wanted = []
    for doc_id, text in docs:
        ids = made.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for k, (lo, hi) in enumerate(zip(cuts, cuts[1:], strict=False)):
            wanted.append((doc_id, k, lo, hi - lo, zlib.crc32(np.array(ids[lo:hi], "<u4").tobytes())))
    key = lambda r: tuple((x is not None, x or 0) for x in r)
    assert sorted([tuple(r)[:5] for r in rows], key=key) == sorted(wanted, key=key)
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert all(n <= capacity for n in ends.values())
    return len(ends)


def test_ids_are_the_librarys(rng):
    read, made = hf_ids.reader(PATH), library()
    parts = ["the", " ", "  ", "\n", "é", "漢", "'s", "<|endoftext|>", "\u2003", "\x85", "9", "-", " " * 6000, "\U0001f600"]
    for _ in range(300):
        text = "".join(rng.choices(parts, k=rng.randint(0, 20)))
        assert read(text).tolist() == made.encode(text, add_special_tokens=False).ids
    other = hf_ids.reader(public_tokenizers.path("word_bpe_49k.json"))
    assert other("Hello you").tolist() == Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode("Hello you", add_special_tokens=False).ids


def test_fullest_combination(rng):
    for _ in range(200):
        counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(rng.randint(1, 5))}
        room = rng.randint(0, 60)
        chosen = packing.fullest(counts, room, rng.random() < 0.5)
        assert sum(chosen) <= room and all(chosen.count(x) <= counts[x] for x in chosen)
        best = max(sum(c) for k in range(sum(counts.values()) + 1) for c in combinations_with_replacement(sorted(counts), k) if sum(c) <= room and all(c.count(x) <= counts[x] for x in c))
        assert sum(chosen) == best


def first_fit_decreasing(counts: dict[int, int], capacity: int) -> int:
    rooms: list[int] = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            at = next((k for k, room in enumerate(rooms) if room >= length), None)
            if at is None:
                rooms.append(capacity - length)
            else:
                rooms[at] -= length
    return len(rooms)


def test_plan_places_every_piece_once(rng):
    counts = {rng.randint(1, 100): rng.randint(1, 50) for _ in range(60)}
    bins = packing.plan(counts, 100)
    placed = {}
    for chosen, times in bins:
        assert sum(chosen) <= 100
        for length in chosen:
            placed[length] = placed.get(length, 0) + times
    assert placed == counts
    assert sum(times for _, times in bins) <= first_fit_decreasing(counts, 100)


def test_many_short_pieces_leave_no_slack(rng):
    counts = {}
    for _ in range(50_000):
        length = min(1024, int(rng.lognormvariate(5.6, 0.9)) + 1)
        counts[length] = counts.get(length, 0) + 1
    bins = packing.plan(counts, 1024)
    assert sum(times for _, times in bins) <= -(-sum(k * n for k, n in counts.items()) // 1024) + 5


def test_packs_documents(spark, rng):
    docs = list(enumerate(texts(rng, 300, 0, 300)))
    found = packing.pack(spark, spark.createDataFrame(docs, "doc_id long, text string").repartition(7), PATH, capacity=128).collect()
    n = check(found, docs, 128)
    assert n <= 1.05 * sum(r.length for r in found) / 128 + 2


def test_awkward_rows(spark, awkward, nothing):
    found = packing.pack(spark, awkward, PATH).collect()
    check(found, [(r.doc_id, r.text) for r in awkward.collect()], 1024)
    assert packing.pack(spark, nothing, PATH).count() == 0
