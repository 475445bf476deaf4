"""Byte-level BPE against the tiktoken library, and back."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
import tiktoken

from jobloom.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


def test_words_and_long_words(library, rng):
    coder = bpe.coder(PATH, PATTERN)
    long = ["a" * 1000, "=-" * 300, " " * 513, "é" * 400] + ["".join(rng.choices(letters, k=rng.randint(256, 700))) for letters in ("ab", "aeth", "etaoinshrdlu", "=-*", "漢字かな") for _ in range(3)]
    for word in long:
        assert coder._merge([word.encode()], bpe._MERGE_LONG)[0].tolist() == library._core_bpe.encode_single_piece(word.encode())
    short = ["".join(rng.choices("etaoinshrdlucmé", k=rng.randint(1, 40))) for _ in range(500)]
    tokens, counts = coder._merge([w.encode() for w in short], bpe._MERGE)
    assert tokens.tolist() == [t for w in short for t in library._core_bpe.encode_single_piece(w.encode())] and (counts > 0).all()


def test_any_text(library, rng):
    coder = bpe.coder(PATH, PATTERN)
    parts = ["the", "cat", "  ", "\n", " ", "\n ", "é", "漢", "1", "23", "!", "'s", "'", "\t", "\x1c", "\u00a0", "\u2003", "x" * 300, "<|endoftext|>", "\r\n", "\U0001f600"]
    rows = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(400)]
    ids, bounds = coder.encode(rows)
    for text, lo, hi in zip(rows, bounds[:-1], bounds[1:], strict=True):
        assert ids[lo:hi].tolist() == library.encode_ordinary(text)
    assert coder.decode(ids, bounds) == [t.encode() for t in rows]


def test_stores_that_start_anew(library):
    coder = bpe.Coder(bpe.read_ranks(PATH), PATTERN)
    coder.chunks.limit, store = 3, bpe.STORE
    bpe.STORE = (3, 3)
    for text in ("one two three four", "two five six", "one seven, eight", ""):
        ids, bounds = coder.encode([text, text])
        assert ids[: bounds[1]].tolist() == library.encode_ordinary(text) == ids[bounds[1] :].tolist()
    bpe.STORE = store


def test_round_trip_of_awkward_rows(spark, awkward, nothing, library):
    found = bpe.round_trip(awkward, PATH, PATTERN).collect()
    wanted = []
    for row in awkward.collect():
        ids = library.encode_ordinary(row.text or "")
        wanted.append((row.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((row.text or "").encode()).hexdigest()))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(map(tuple, found), key=key) == sorted(wanted, key=key)
    back = bpe.decode(bpe.encode(awkward, PATH, PATTERN), PATH, PATTERN)
    assert sorted(bytes(r.bytes).decode() for r in back.collect()) == sorted(r.text or "" for r in awkward.collect())
    assert bpe.round_trip(nothing, PATH, PATTERN).count() == 0


def test_unknown_ids_are_errors():
    import numpy as np

    with pytest.raises(ValueError):
        bpe.coder(PATH, PATTERN).decode(np.array([60000], np.int32), np.array([0, 1]))
