"""Toxicity: held-out accuracy, what it learns from, defined results without labels."""

from __future__ import annotations

import zlib

from conftest_llm import texts
from jobloom.llm import toxicity

INSULTS = ["blockheaded", "nincompoop", "scoundrelly", "dunderhead"]


def corpus(rng, n: int = 600):
    docs, labels = [], []
    for i, text in enumerate(texts(rng, n, 60, 200)):
        toxic = i % 6 == 0
        words = text.split()
        for _ in range(3 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        docs.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy_and_equal_scores(spark, rng):
    docs, labels = corpus(rng)
    extra = [(10_000, docs[0][1], "fr", "other"), (10_001, "", "en", "s"), (10_002, None, None, None), (None, docs[0][1], "en", "s")]
    frame = spark.createDataFrame(docs + extra, "doc_id long, text string, lang string, source string")
    truth = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = toxicity.classify(frame, truth).collect()
    assert len(rows) == len(docs) + len(extra)
    by = {r.doc_id: r for r in rows}
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    out = [(by[i].predicted, t) for i, _, t in labels if by[i].held_out]
    assert sum(p == t for p, t in out) / len(out) > 0.98 and sum(p for p, t in out if t) / sum(t for _, t in out) > 0.9
    assert by[10_000].score == by[0].score == by[None].score
    assert by[10_001].score == by[10_002].score < 0.5 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels]
    again = toxicity.classify(frame, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int")).collect()
    assert {(r.doc_id, r.score) for r in again} == {(r.doc_id, r.score) for r in rows}


def test_without_labels(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.classify(awkward, none).collect()
    assert len(rows) == awkward.count() and {r.score for r in rows} == {0.0}
    one = spark.createDataFrame([(i, 1) for i in range(9)] + [(None, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    assert {r.score for r in toxicity.classify(awkward, one).collect()} == {1.0}
    assert toxicity.classify(nothing, one).count() == 0


def test_phrases_of_ordinary_words(rng):
    """Toxic texts differ in the order of words alone, with blanks between them or without."""
    words = [f"w{a}{b}" for a in "abcdefghij" for b in ("ol", "en", "ir", "ut", "ask")]
    phrases = [rng.sample(words, 4) for _ in range(3)]
    rows = []
    for i in range(1500):
        text = rng.choices(words, k=rng.randint(60, 200))
        for _ in range(6 * (i % 6 == 0)):
            at = rng.randrange(len(text))
            text[at:at] = rng.choice(phrases)
        rows.append((i, text, int(i % 6 == 0)))
    for blank in (" ", ""):
        cut = [(i, blank.join(t), y) for i, t, y in rows]
        score = toxicity.fit_texts(cut[:1200]).scorer()
        found = [(score(t) >= toxicity.THRESHOLD, y) for _, t, y in cut[1200:]]
        assert sum(p == y for p, y in found) / len(found) > 0.87 and sum(p for p, y in found if y) / sum(y for _, y in found) > 0.4


def test_windows():
    assert toxicity.windows("A b, c.\n\nÉ") == [b" a ", b" b ", b" c ", " É ".encode()]
    assert b"".join(w.strip() for w in toxicity.windows("x" * 1000)) == b"x" * 1000
