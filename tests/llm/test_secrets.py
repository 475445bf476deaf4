"""Secret scans against plain expressions."""

from __future__ import annotations

import hashlib
import re

import pytest

from jobloom.llm import secrets
from jobloom.llm.automaton import Automaton, longest

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def plain(text: str) -> list[tuple[str, int, int]]:
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(k, s, e) for s, _, e, k in sorted(out)]


PARTS = ["password", "Secret", "TOKEN", "api_key", "apikey", "api", "=", ":", " ", '"', "'", "abc", "0b96a8c8d79c4a5085c919", "deadbeef00", "AKIA", "ABCDEFGH12", "ZZ99", "é", "漢", "\n", "ſecret", "toKen", "xoxb-", "ghp_", "a" * 30, "..", "/"]


def test_base_spans(rng):
    scanner = secrets.Scanner()
    for _ in range(6000):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 25)))
        assert [x for x in scanner.spans(text) if x[0] in ("assign", "access", "hex")] == plain(text)


@pytest.mark.parametrize("rule", ["ab*c", "(?:a|bc)+d?", "[a-c]{2,4}x", "a{3,}", "(?i:ab)c", "x?y?z"])
def test_automaton_is_the_expression(rule, rng):
    anywhere, there, back = Automaton([rule], anywhere=True), Automaton([rule]), Automaton([rule], reverse=True)
    for _ in range(300):
        text = "".join(rng.choices("abcdxyzABC", k=rng.randint(0, 12)))
        state, ends = anywhere.start, set()
        for i, byte in enumerate(text.encode()):
            state = anywhere.step[state + byte]
            if anywhere.accepts[state >> 8]:
                ends.add(i + 1)
        spans = {(i, j) for i in range(len(text) + 1) for j in range(i, len(text) + 1) if re.fullmatch(rule, text[i:j])}
        assert ends == {j for i, j in spans if j > 0}
        for at in range(len(text) + 1):
            assert longest(there, text.encode(), at, len(text)) == max((j - i for i, j in spans if i == at), default=-1)
            assert longest(back, text.encode(), at, 0, back=True) == max((j - i for i, j in spans if j == at), default=-1)


def test_minimal():
    assert Automaton(["(?:a|b)c", "x"]).states == Automaton(["[ab]c", "x"]).states


def test_scan_and_redact(spark, awkward, nothing):
    pem = "-----BEGIN RSA PRIVATE KEY-----"
    texts = ['x token = "abcdef123456" y', f"a {pem} b", "clean text", "ghp_" + "Zq" * 18, "é AKIA" + "A1" * 8, "password: " + "0a" * 20]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in secrets.scan(docs).collect()}
    for i, text in enumerate(texts):
        base = ",".join(f"{k}:{s}:{e}" for k, s, e in plain(text))
        assert rows[i].base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    assert [rows[i].spans for i in (1, 2, 3, 4)] == [f"pem:2:{2 + len(pem)}", "", "github:0:40", "access:2:22"]
    assert (rows[0].n_assign, rows[4].n_access, rows[5].n_hex, rows[5].n_assign) == (1, 1, 1, 1)
    clean = [r.c for r in docs.select("doc_id", secrets.redacted(docs.text).alias("c")).orderBy("doc_id").collect()]
    assert clean == ['x [assign]" y', "a [pem] b", "clean text", "[github]", "é [access]", "[assign]"]
    assert secrets.scan(awkward).count() == awkward.count() and secrets.scan(nothing).count() == 0
    assert sorted(str(r[0]) for r in awkward.select(secrets.redacted(awkward.text)).collect()) == sorted(str(r.text) for r in awkward.collect())
