"""Collocations against counting every phrase in a dictionary."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from jobloom.llm import collocations as co

FEW = "the of and in data set model tree".split()


def plain(rows, least, most):
    """(lang, rank, phrase, a, l, r, n, score) by counting everything."""
    counts: dict[str, Counter] = {}
    for lang, text in rows:
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            for i in range(len(words)):
                for k in range(1, 6):
                    if i + k <= len(words):
                        counts.setdefault("und" if lang is None else lang, Counter())[tuple(words[i : i + k])] += 1
    out = set()
    for lang, found in counts.items():
        n = sum(a for p, a in found.items() if len(p) == 1)
        candidates = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        covered = {p[i:j] for p, a in candidates.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and found[p[i:j]] <= a}
        best = []
        for p, a in candidates.items():
            if p not in covered:
                score, k = min((1000 * a * n // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        out |= {(lang, i, p.decode(), -a, left, right, n, -score) for i, (score, a, p, left, right) in enumerate(sorted(best)[:most], 1)}
    return out


def mine(spark, rows, least, most):
    docs = spark.createDataFrame([(i, t, lang) for i, (lang, t) in enumerate(rows)], "doc_id long, text string, lang string")
    found = [tuple(r) for r in co.collocations(spark, docs, least, most).collect()]
    assert len(found) == len(set(found))
    return set(found)


def invented(rng, n):
    out = []
    for _ in range(n):
        words = rng.choices(FEW, weights=[9, 7, 6, 5, 2, 2, 1, 1], k=rng.randint(0, 60))
        text = " ".join(words)
        for mark in (".", ",", "\n", "\t", "  ", "?!", "\x0b", "\x01", "\x85"):
            if rng.random() < 0.4 and text:
                at = rng.randrange(len(text))
                text = text[:at] + mark + text[at:]
        out.append((rng.choice(["en", "en", "en", "de", None, ""]), text.title() if rng.random() < 0.2 else text))
    return out


@pytest.mark.parametrize("part", [150, 1_000_000])
def test_equals_counting(spark, rng, monkeypatch, part):
    """Also with parts so small that most phrases run over several."""
    monkeypatch.setattr(co, "PART_ROWS", part)
    rows = invented(rng, 400)
    assert mine(spark, rows, 5, 40) == plain(rows, 5, 40)


def test_small_slices_and_a_full_bitmap(spark, rng, monkeypatch):
    monkeypatch.setattr(co, "MOST_BITS", 64)
    rows = invented(rng, 150)
    assert mine(spark, rows, 3, 2000) == plain(rows, 3, 2000)


def test_hot_phrase_and_ties(spark):
    """One line in a third of all rows, equal scores, a phrase inside a longer one that is found as often."""
    rows = [("en", "all the same words, again and again")] * 300 + [("en", f"left{i % 3} right{i % 3}") for i in range(300)] + [("en", f"filler {i}") for i in range(300)]
    found = mine(spark, rows, 100, 2000)
    assert found == plain(rows, 100, 2000)
    assert [r[2] for r in sorted(found)[:2]] == ["left0 right0", "left1 right1"] and "the same words" not in {r[2] for r in found}


def test_awkward_rows(spark, awkward, nothing):
    clash = awkward.withColumnsRenamed({"key": "lang", "kind": "phrase", "digest": "n", "no": "w1"})
    expected = plain([(r["lang"], r["text"]) for r in clash.collect()], 100, 2000)
    assert {tuple(r) for r in co.collocations(spark, clash).collect()} == expected and expected
    assert co.collocations(spark, nothing.withColumn("lang", nothing["extra"])).count() == 0


def test_products_pass_64_bits(spark):
    big = 3 * 10**12
    row = spark.range(1).selectExpr(f"{big}L a", f"{big * 5}L n", f"{big + 7}L l", f"{big + 1}L r")
    score = row.select(co._score(row.a, row.n, row.l, row.r)).first()[0]
    assert score == 1000 * big * big * 5 // ((big + 7) * (big + 1))
