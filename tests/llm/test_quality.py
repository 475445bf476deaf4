"""Quality rules: measures against plain Python, the estimate against a plain loop, and the plan."""

from __future__ import annotations

import math
import re
from collections import Counter

import pytest
from conftest_llm import texts
from pyspark.sql import functions as F

from jobloom.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text: str) -> tuple:
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_measures(spark, awkward, rng):
    rows = []
    for text in texts(rng, 150, 0, 60):
        words = text.split()
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            words[at:at] = words[: rng.randint(0, 30)] + ["\n"]
        rows.append((rng.choice([" ", "  ", "\t", "\r\n"])).join(words) + rng.choice(["", "#|", " !", "é x"]))
    rows += ["a " * 8, "a " * 9, "a b c d e f g h " * 2, "\n\n", "x\n x\nx", "\x1c \x85", "  a"]
    rows += [r.text or "" for r in awkward.collect()]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(rows)], "doc_id long, text string, words string")
    found = quality.judge(spark, docs).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found}
    assert got == {i: plain(t) for i, t in enumerate(rows)} and len(found) == len(rows)
    assert not any(r.kept and r.base_failed for r in found)


def test_estimate_is_a_plain_loop(spark, rng):
    m = len(quality.RULES)
    counts = Counter(tuple(rng.choices((1, 0, -1), (7, 2, 1), k=m)) for _ in range(500))
    rates, prior = [list(quality.GUESS) for _ in range(m)], quality.PRIOR
    n = sum(counts.values())

    def posterior(votes):
        odds = math.log(prior / (1 - prior))
        for v, (gg, gb, bg, bb) in zip(votes, rates, strict=True):
            odds += max(0, math.log(gg / gb)) if v == 1 else min(0, math.log(bg / bb)) if v == -1 else 0
        return 1 / (1 + math.exp(-odds))

    for _ in range(quality.ROUNDS):
        q = {v: posterior(v) for v in counts}
        good = sum(c * q[v] for v, c in counts.items())
        share = lambda j, vote, on_good: sum(c * (q[v] if on_good else 1 - q[v]) for v, c in counts.items() if v[j] == vote)
        rates = [[(share(j, vote, on) + g * quality.WEIGHT) / ((good if on else n - good) + quality.WEIGHT) for (vote, on), g in zip(((1, True), (1, False), (-1, True), (-1, False)), quality.GUESS, strict=True)] for j in range(m)]
        prior = min(quality.SHARES[1], max(quality.SHARES[0], good / n))
    frame = spark.createDataFrame([(list(v), c) for v, c in counts.items()], "votes array<int>, n long")
    found = {tuple(r.votes): r.posterior for r in quality.estimate(frame).collect()}
    assert found.keys() == counts.keys() and all(abs(found[v] - posterior(v)) < 1e-9 for v in counts)


@pytest.mark.parametrize("share", [0.01, 0.05, 0.1])
@pytest.mark.parametrize("size", [2_000, 2_000_000])
def test_planted_junk_is_dropped_at_every_share(spark, share, size):
    """Documents good by four rules, of which some are bad by one junk rule alone: the guesses do not outvote the data."""
    names = list(quality.RULES)
    clean = [1 if x in ("length", "word_length", "endings", "variety", "no_junk") else 0 for x in names]
    for rule in ("symbols", "capitals", "repeats"):
        junk = [-1 if x == rule else 0 if x == "no_junk" else v for x, v in zip(names, clean, strict=True)]
        frame = spark.createDataFrame([(clean, int(size * (1 - share))), (junk, int(size * share))], "votes array<int>, n long")
        found = {tuple(r.votes): r.posterior for r in quality.estimate(frame).collect()}
        assert found[tuple(junk)] < 0.25 and found[tuple(clean)] > 0.9


def test_planted_rates_are_recovered(spark, rng):
    """Votes drawn for known classes: the estimate finds the share of good ones and each rule's rates, unlike the guesses as they are."""
    m, share = len(quality.RULES), 0.7
    planted = [(0.95, 0.15, 0.03, 0.8) if j < 4 else (0.9, 0.05, 0.05, 0.85) for j in range(m)]
    counts = Counter()
    for _ in range(20_000):
        good = rng.random() < share
        counts[good, tuple(1 if (x := rng.random()) < (r[0] if good else r[1]) else -1 if x < (r[0] + r[2] if good else r[1] + r[3]) else 0 for r in planted)] += 1
    frame = spark.createDataFrame([(list(v), n) for (_, v), n in counts.items()], "votes array<int>, n long").groupBy("votes").agg(F.sum("n").alias("n"))
    model = quality.fitted(frame).first()["model"]
    assert abs(model["prior"] - share) < 0.02
    for rates, true in zip(model["rates"], planted, strict=True):
        assert all(abs(a - b) < 0.03 for a, b in zip(rates, true, strict=True))
    found = {tuple(r.votes): r.posterior >= 0.5 for r in quality.estimate(frame).collect()}
    assert sum(n for (good, v), n in counts.items() if found[v] == good) > 0.995 * 20_000


def test_long_texts_and_texts_without_words(spark):
    docs = spark.createDataFrame([(1, "word again " * 300_000), (2, None), (3, " \n"), (None, "one"), (None, "one")], "doc_id long, text string")
    found = quality.judge(spark, docs).collect()
    assert len(found) == 5 and all(r.base_failed and not r.kept for r in found)
    assert next(r.n_repeat_words for r in found if r.doc_id == 1) == 600_000


def test_junk_goes_and_clean_texts_stay(spark, rng):
    clean = [". ".join(texts(rng, 6, 8, 12)) + "." for _ in range(200)]
    clean = [" ".join(w + rng.choice("abcdefgh") + str(rng.randint(0, 9)) for w in t.split()) + "." for t in clean]
    junk = [" | ".join(t.split()) for t in clean[:15]] + [t.upper().replace(" ", "!! ") for t in clean[15:30]]
    docs = spark.createDataFrame(list(enumerate(clean + junk)), "doc_id long, text string")
    kept = {r.doc_id for r in quality.judge(spark, docs).where("kept").collect()}
    assert kept == set(range(len(clean)))


def test_nothing_and_no_python_in_the_plan(spark, awkward, nothing):
    assert quality.judge(spark, nothing).count() == 0
    plan = quality.measures(awkward)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
