"""Personal data: base formats against plain expressions, the bootstrap on planted contexts."""

from __future__ import annotations

import hashlib
import os
import re
import subprocess
import sys

from conftest_llm import WORDS
from jobloom.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text: str) -> list[tuple[str, int, int]]:
    out = []
    for kind, rule in PLAIN.items():
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {"email": lambda: True, "ip": lambda m=m: all(int(x) <= 255 for x in m[0].split(".")), "card": lambda d=digits: 16 <= len(d) <= 19 and pii.luhn(d), "phone": lambda d=digits: 8 <= len(d) <= 15}[kind]
            if fine():
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans(rng):
    parts = ["a", "b.c", "@", ".", "x-y", "_", "%", "é", "漢", "1", "22", "255", "256", "007", " ", "-", "+", "4111111111111111", "(", ")", "\n", "0", "999", "..", "5500005555555559", "+1 ", "٣"]
    for _ in range(20_000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 24)))
        assert pii.base_spans(text) == plain(text)


def test_long_texts_in_linear_time():
    for text in ("1" * 300_000, "a" * 300_000 + "@", "1." * 150_000, "+1 " * 100_000, "a@" * 150_000, "1 " * 150_000):
        pii.identifiers(text, pii.base_spans(text))


def test_bootstrap_finds_planted_identifiers(spark, rng):
    rows = []
    for i in range(40):
        rows.append(f"{' '.join(rng.choices(WORDS, k=8))} please call number +1 (555) {rng.randint(100, 999)}-{rng.randint(1000, 9999)} {rng.choice(WORDS)}")
    planted = [f"{' '.join(rng.choices(WORDS, k=5))} please call number {7_000_000 + i} today" for i in range(2)]
    others = [f"{' '.join(rng.choices(WORDS, k=5))} order {rng.randint(10_000, 99_999)} {rng.choice(WORDS)}" for _ in range(30)]
    texts = rows + planted + others + rows[:1] * 50
    found = pii.find(spark, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(found) == len(texts)
    for r in found:
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in plain(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and r.n_phone == base.count("phone")
        added = 40 <= r.doc_id < 42
        start = texts[r.doc_id].find("70000")
        assert r.spans == (f"phone:{start}:{start + 7}" if added else base)


def test_groups_of_digits_are_one_identifier():
    cases = {
        "card no 4556 7375 8689 9857 end": ["4556 7375 8689 9857"], "phone 555 123 4567.": ["555 123 4567"], "phone (555) 123-4567 x": ["(555) 123-4567"],
        "555.123.4567": ["555.123.4567"], "year 1999. 2000 men": ["1999", "2000"], "1234, 5678": ["1234", "5678"], "ab-1234 5678": ["ab-1234", "5678"], "1 2 3": [], "x 12 34ab": [],
        "mail a@b 1234 a@c": ["a@b", "1234", "a@c"], "1111 " * 30: ["1111 " * 29 + "1111"],
    }
    for text, wanted in cases.items():
        assert [text[s:e] for s, e in pii.identifiers(text, pii.base_spans(text))] == wanted
    text = "see +1 555 123 4567 or 1234 then 12 34"
    assert [text[s:e] for s, e in pii.identifiers(text, pii.base_spans(text))] == ["1234", "12 34"]


def test_identifiers_with_blanks_are_found(spark, rng):
    rows = [f"{' '.join(rng.choices(WORDS, k=8))} please call number +1 (555) {rng.randint(100, 999)}-{rng.randint(1000, 9999)} {rng.choice(WORDS)}" for _ in range(40)]
    rows += [f"{' '.join(rng.choices(WORDS, k=5))} please call number 555 123 4567 today"]
    found = {r.doc_id: r.spans for r in pii.find(spark, spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    start = rows[40].find("555")
    assert found[40] == f"phone:{start}:{start + 12}"


def test_rounds_go_on_until_nothing_is_new(spark):
    """A chain in which pattern k shares its identifiers with the patterns before and after it: the fifth is trusted in round nine, some rounds add none."""
    sizes = (20_000, 3000, 450, 70, 10)
    seen = [("phone" if k == 0 else None, f"v{k}.{i}", [f"p{k - 1} _", f"p{k} _"][k == 0 :]) for k, n in enumerate(sizes) for i in range(n)]
    frame = spark.createDataFrame(seen, "kind string, value string, patterns array<string>")
    found = {(r.pattern, r.kind) for r in pii.trusted_patterns(spark, frame).collect()}
    assert found == {(f"p{k} _", "phone") for k in range(5)}


def test_pattern_of_two_kinds_is_not_trusted(spark):
    seen = [(kind, f"{kind}{i}", ["w _", f"w _ {kind}"]) for i in range(10) for kind in ("email", "ip")] + [(None, "x1", ["w _"])]
    found = pii.trusted_patterns(spark, spark.createDataFrame(seen, "kind string, value string, patterns array<string>")).collect()
    assert sorted((r.pattern, r.kind) for r in found) == [("w _ email", "email"), ("w _ ip", "ip")]


def test_awkward_rows(spark, awkward, nothing):
    rows = pii.find(spark, awkward).collect()
    assert len(rows) == awkward.count() and {r.spans for r in rows} == {""}
    assert pii.find(spark, nothing).count() == 0


def test_long_identifiers_and_long_neighbours(spark):
    """Identifiers of 70 digits, groups far wider than that and words of thousands of characters beside a span are taken whole."""
    word = "w" * 5000
    seeds = [(i, f"please call number +44 20 79{i:02} 0{i:03} now") for i in range(30)]
    rows = [*seeds, (100, f"please call number {'7' * 70} now"), (101, f"please call number {' '.join(['123456'] * 20)} now")]
    rows += [(200 + i, f"{word} {'v' * 3000} a{i}@b.example then") for i in range(30)] + [(300, f"{word} {'v' * 3000} {'k9' * 50}")]
    found = {r.doc_id: r.spans for r in pii.find(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[100] == "phone:19:89" and found[101] == f"phone:19:{19 + 20 * 7 - 1}" and found[300] == "email:8002:8102"


def test_contexts_are_whole_words_as_split(rng):
    for _ in range(300):
        text = "".join(rng.choice(["a", "B7", " ", "  ", "\n", "(", "\x85", "12"]) for _ in range(30))
        start = rng.randrange(len(text))
        end = rng.randrange(start + 1, len(text) + 1)
        fold = lambda x: re.sub("[0-9]", "0", x.lower()).split()
        before, after = fold(text[:start])[-2:], fold(text[end:])[:1]
        assert pii.Contexts(text).patterns(start, end) == [f"{' '.join(before)} _", f"{' '.join(before[-1:])} _ {' '.join(after)}"]


def test_operators_run_from_another_folder(tmp_path):
    """Workers get the package from the operator itself, wherever the driver was started."""
    code = f"import sys; sys.path.insert(0, {os.getcwd()!r})\n" + """
from jobloom.session import get_spark
from jobloom.llm import pii, prefixtrie
spark = get_spark(master="local[2]", **{"spark.sql.shuffle.partitions": "2"})
docs = spark.createDataFrame([(1, "a@b.example")], "doc_id long, text string")
assert pii.find(spark, docs).first().n_email == 1
sys.stdout.write("fine")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240, check=False)
    assert done.stdout.endswith("fine"), done.stderr[-2000:]
