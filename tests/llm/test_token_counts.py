"""Token counts against the library's offsets, a token at a time."""

from __future__ import annotations

from functools import cache

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from jobloom.llm import hf_ids, tokencounts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["the", " cat", "\n", "\n\n", " \n", "é", "漢字", "\U0001f600", "'s", ".\n", "  ", "12", "<|endoftext|>", "x" * 40, " "]


@cache
def library() -> Tokenizer:
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def offsets(text: str) -> list[tuple[int, int]]:
    return library().encode(text, add_special_tokens=False).offsets


def plain(text: str, bounds: list[int], rule: str) -> list[float]:
    counts = [0.0] * (len(bounds) - 1)
    for start, end in offsets(text):
        shares = [max(0, min(end, hi) - max(start, lo)) for lo, hi in zip(bounds, bounds[1:], strict=False)]
        inside = [k for k, n in enumerate(shares) if n]
        if rule == "split":
            for k in inside:
                counts[k] += shares[k] / sum(shares)
        else:
            counts[{"first": inside[0], "last": inside[-1], "most": shares.index(max(shares))}[rule]] += 1
    return counts


def test_spans_are_the_librarys(rng):
    read = hf_ids.spans(PATH)
    for _ in range(300):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 20)))
        starts, ends = read(text)
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == offsets(text)
    other = public_tokenizers.path("word_bpe_49k.json")
    starts, ends = hf_ids.spans(other)("Hello  you")
    assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == Tokenizer.from_file(other).encode("Hello  you", add_special_tokens=False).offsets


@pytest.mark.parametrize("rule", tokencounts.RULES)
def test_fields_and_lines(spark, rng, rule):
    rows = [(i, *("".join(rng.choices(PARTS, k=rng.randint(0, 9))) for _ in range(2))) for i in range(80)] + [(80, None, "a\n"), (81, "", ""), (None, "\n\n", None)]
    docs = spark.createDataFrame(rows, "doc_id long, title string, text string")
    found: dict = {}
    for r in tokencounts.count(docs, PATH, ("title", "text"), rule).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert len(found) == len(rows)
    for doc_id, title, text in rows:
        title, text = title or "", text or ""
        whole = f"{title}\n{text}"
        got = sorted(found[doc_id], key=lambda r: (r.field != "title", r.section))
        bounds = [0, *(r.end for r in got)]
        assert [r.start for r in got] == bounds[:-1] and bounds[-1] == len(whole)
        pieces = [whole[r.start : r.end] for r in got]
        assert "".join(pieces) == whole and all("\n" not in p[:-1] for p in pieces if p not in (f"{title}\n"[-len(p) :],))
        assert [r.n_tokens for r in got] == pytest.approx(plain(whole, bounds, rule))


def test_awkward_rows(spark, awkward, nothing):
    rows = tokencounts.count(awkward, PATH).collect()
    assert len([r for r in rows if r.section == 0]) == awkward.count()
    total = sum(len(offsets(r.text or "")) for r in awkward.collect())
    assert sum(r.n_tokens for r in rows) == total
    assert tokencounts.count(nothing, PATH).count() == 0
    with pytest.raises(ValueError):
        tokencounts.count(nothing, PATH, rule="other")
