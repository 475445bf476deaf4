"""Secret scans: every rule in one automaton, one pass over the bytes of a text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm.automaton import Automaton, longest
from jobloom.llm.common import ids_and_texts, ship, slices


@dataclass(frozen=True)
class Rule:
    """`seen` is what the common pass finds: the shortest telling part, from a match's first character on. `whole` is the
    match, leftmost and longest; one with fewer than `least` characters, without its `head` if there is one, is dropped."""

    kind: str
    seen: str
    whole: str
    least: int = 0
    head: str = ""


_WORD = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?"
#: The contract's three kinds, in its order.
BASE = (
    Rule("assign", _WORD + "[A-Za-z0-9+/_.=-]", _WORD + "[A-Za-z0-9+/_.=-]+", 6, _WORD),
    Rule("access", "AKIA[A-Z0-9]", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]{24}", "[0-9a-f]+", 24),
)
#: What the method adds: formats that are told by their own letters.
MORE = (
    Rule("github", "gh[opsur]_[A-Za-z0-9]", "gh[opsur]_[A-Za-z0-9]+", 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("pem", "-----BEGIN[A-Z\x20]*\x20PRIVATE\x20KEY-----", "-----BEGIN[A-Z\x20]*\x20PRIVATE\x20KEY-----"),
)


class Scanner:
    """The rules' automata: one of all for the pass, and per rule one back to its start and one on to its end."""

    def __init__(self, rules: tuple[Rule, ...] = BASE + MORE):
        self.rules = rules
        self.all = Automaton([r.seen for r in rules], anywhere=True)
        self.back = [Automaton([r.whole], reverse=True) for r in rules]
        self.on = [Automaton([r.whole]) for r in rules]
        self.head = [Automaton([r.head]) if r.head else None for r in rules]

    def spans(self, text: str) -> list[tuple[str, int, int]]:
        """(kind, start, end) in code points, by start, then in the order of the rules."""
        data = text.encode("utf-8", "surrogatepass")
        step, first, state = self.all.step, self.all.first, self.all.start
        hits = []
        for at, byte in enumerate(data):
            state = step[state + byte]
            if state >= first:
                hits.append((at, state))
        if not hits:
            return []
        ends, found = [0] * len(self.rules), []
        for at, state in hits:
            for k in self.all.accepts[state >> 8]:
                if at < ends[k]:
                    continue
                length = longest(self.back[k], data, at + 1, ends[k], back=True)
                if length < 0:
                    continue
                start = at + 1 - length
                end = ends[k] = start + longest(self.on[k], data, start, len(data))
                skip = longest(self.head[k], data, start, end) if self.head[k] else 0
                if end - start - skip >= self.rules[k].least:
                    found.append((start, k, end))
        wide = len(text) != len(data)
        point = (lambda x: len(data[:x].decode("utf-8", "surrogatepass"))) if wide else (lambda x: x)
        return [(self.rules[k].kind, point(s), point(e)) for s, k, e in sorted(found)]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = BASE + MORE) -> DataFrame:
    """doc_id, n_<kind> of each base rule, base_sha256, spans: a row per document.

    base_sha256 is of the base spans, `spans` has all, as kind:start:end joined by commas.
    Null and empty texts have no spans; repeated rows and null ids are rows of their own;
    texts are read whole, however long; no documents give no rows.
    """
    base = [r.kind for r in rules if r in BASE]
    names = ["doc_id", *(f"n_{k}" for k in base), "base_sha256", "spans"]
    scanner = Scanner(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            rows = []
            for text in texts:
                spans = scanner.spans(text)
                mine = ",".join(f"{k}:{s}:{e}" for k, s, e in spans if k in base)
                counts = [sum(k == kind for k, _, _ in spans) for kind in base]
                rows.append((*counts, hashlib.sha256(mine.encode()).hexdigest(), ",".join(f"{k}:{s}:{e}" for k, s, e in spans)))
            columns = list(zip(*rows, strict=True))
            arrays = [pa.array(c, pa.int64()) for c in columns[:-2]] + [pa.array(c, pa.string()) for c in columns[-2:]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names)

    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in base) + ", base_sha256 string, spans string"
    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, schema)


def redacted(text: Column, rules: tuple[Rule, ...] = BASE + MORE) -> Column:
    """`text` with every found span replaced by [kind]; spans that overlap are one. Null stays null, clean texts stay the same."""
    ship(SparkSession.active())
    scanner = Scanner(rules)

    def clean(value: str) -> str:
        spans = scanner.spans(value)
        out, last = [], 0
        for kind, start, end in spans:
            if start >= last:
                out.append(value[last:start] + f"[{kind}]")
            last = max(last, end)
        return "".join(out) + value[last:]

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([None if x is None else clean(x) for x in texts.to_pylist()], pa.string())

    return run(text)
