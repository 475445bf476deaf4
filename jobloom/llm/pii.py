"""Personal data: base formats, and a bootstrap over the contexts they are seen in.

Base matches are seeds. The words around a seed are lexical patterns; a pattern also
takes other identifiers (tokens with enough digits, groups of digits with blanks between them, or an @). Patterns and the
identifiers they take form a graph, scored in rounds: a pattern is as good as the share
of its identifiers that are known to be of one kind, an identifier is as good as its best
pattern. Rounds end when no pattern's trust moves. Patterns that end above `CONFIDENT` give their unknown identifiers a kind: the spans added.
The graph has one edge per pattern and identifier, so copies of a text add nothing to it.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm.common import ids_and_texts, settle, slices

KINDS = ("email", "ip", "card", "phone")
#: Trust is kept to so many decimals: it never falls, so rounds end when no pattern's trust is another than before.
DECIMALS = 6
#: Identifiers a pattern needs, weight of an unseen wrong one, and the confidence from which a pattern is trusted.
SUPPORT, SMOOTHING, CONFIDENT = 4, 1.0, 0.8
#: Digits an unknown identifier needs. Nothing is bounded by length; longer names than `WHOLE` stand as their hash in the graph.
DIGITS, WHOLE = 4, 200

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Digit runs are taken whole: a match that begins inside one would have begun at its start.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"\S+")
_TOKEN = re.compile(r"[^\x20\x09-\x0D]*+")
#: Digits with the signs that base forms have among them, and what joins two such groups: no dot before a blank, which ends a sentence.
_GROUP, _GAP = re.compile(r"\+?[0-9][0-9().-]*"), re.compile(r"[\x20()-]+")
_EDGE = "\"'(),;:.!?[]{}<>|#="


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A match has one @: the local part reaches back to the end of the last match at most."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            last = found.end()
        at = text.find("@", max(at + 1, last))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as in `KINDS`, then start."""
    found = [("email", *span) for span in _emails(text)]
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def _named(value: str) -> str:
    return value if len(value) <= WHOLE else hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


class Contexts:
    """Patterns of the spans of one text: the two words before a span, and the word before with the word after.

    Words are whole; what touches a span in its own word counts as one of them. Digits stand as 0.
    """

    def __init__(self, text: str):
        self.text = text
        self.words = [m.span() for m in _WORD.finditer(text)]
        self.starts = [s for s, _ in self.words]

    def _word(self, start: int, end: int) -> str:
        return _DIGIT.sub("0", self.text[start:end].lower())

    def patterns(self, start: int, end: int) -> list[str]:
        k = bisect.bisect_left(self.starts, start)
        before = [self._word(s, min(e, start)) for s, e in self.words[max(0, k - 2) : k]]
        j = bisect.bisect_right(self.starts, end) - 1
        if j >= 0 and self.words[j][1] > end:
            after = [self._word(end, self.words[j][1])]
        else:
            after = [self._word(*w) for w in self.words[j + 1 : j + 2]]
        return [_named(f"{' '.join(before)} _"), _named(f"{' '.join(before[-1:])} _ {' '.join(after)}")]


def _joined_groups(text: str, groups: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Groups of digits beside one another as one span, however many."""
    if len(groups) > 1:
        start, end = groups[0][0], groups[-1][1]
        opened = text[start - 1 : start] == "(" and ")" in text[start:end]
        groups = [(start - opened, end)]
    return [(s, e) for s, e in groups if sum(c in "0123456789" for c in text[s:e]) >= DIGITS]


def identifiers(text: str, base: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Spans that look like identifiers and touch no base span: other tokens, and runs of digit groups that `_GAP` joins."""
    taken = sorted((s, e) for _, s, e in base)
    found, groups, at, k = [], [], 0, 0
    for m in re.finditer(r"[0-9@]", text):
        if m.start() < at:
            continue
        start = m.start()
        while start > at and text[start - 1] not in " \t\n\x0b\x0c\r":
            start -= 1
        at = _TOKEN.match(text, m.start()).end()
        token = text[start:at]
        start += len(token) - len(token.lstrip(_EDGE))
        token = token.strip(_EDGE)
        end = start + len(token)
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if not (k == len(taken) or taken[k][0] >= end):
            continue
        if _GROUP.fullmatch(token):
            if groups and not (token[0] != "+" and _GAP.fullmatch(text, groups[-1][1], start)):
                found += _joined_groups(text, groups)
                groups = []
            groups.append((start, end))
        elif "@" in token[1:-1] or sum(c in "0123456789" for c in token) >= DIGITS:
            found.append((start, end))
    return sorted(found + _joined_groups(text, groups)) if groups else sorted(found)


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_SEEN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))])
ROWS = "doc_id long, base array<struct<kind:string,start:long,end:long>>, seen array<struct<kind:string,start:long,end:long,value:string,patterns:array<string>>>, base_sha256 string"


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in slices(batches):
        base_rows, seen_rows, digests = [], [], []
        for text in texts:
            base = base_spans(text) if "@" in text or _DIGIT.search(text) else []
            both = [(k, s, e) for k, s, e in base] + ([(None, s, e) for s, e in identifiers(text, base)] if base or _DIGIT.search(text) or "@" in text else [])
            base_rows.append([{"kind": k, "start": s, "end": e} for k, s, e in base])
            contexts = Contexts(text) if both else None
            seen_rows.append([{"kind": k, "start": s, "end": e, "value": _named(text[s:e].lower()), "patterns": contexts.patterns(s, e)} for k, s, e in both])
            digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
        arrays = [batch.column("doc_id"), pa.array(base_rows, pa.list_(_SPAN)), pa.array(seen_rows, pa.list_(_SEEN)), pa.array(digests, pa.string())]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "base", "seen", "base_sha256"])


def trusted_patterns(spark: SparkSession, seen: DataFrame) -> DataFrame:
    """(pattern, kind) of the patterns that end above `CONFIDENT`, from rows (kind or null, value, patterns).

    A value that is a base match anywhere is known; one of two kinds counts for both.
    Patterns with fewer than `SUPPORT` identifiers can never be trusted and leave before any join.
    """
    pairs = seen.select(F.explode("patterns").alias("pattern"), "value").distinct()
    sizes = pairs.groupBy("pattern").agg(F.count("*").alias("n")).where(F.col("n") >= SUPPORT)
    edges = settle(spark, pairs.join(sizes, "pattern"), "pattern_edges")
    known = seen.where(F.col("kind").isNotNull()).select("value", "kind").distinct().withColumn("trust", F.lit(1.0))
    known = settle(spark, known.join(edges, "value", "left_semi"), "pii_seeds")
    believed, before = known, None
    while True:
        scores = edges.join(believed, "value").groupBy("pattern", "kind").agg(F.sum("trust").alias("hits"), F.max("n").alias("n"))
        good = scores.withColumn("trust", F.round(F.col("hits") / (F.col("n") + SMOOTHING), DECIMALS)).where((F.col("hits") >= SUPPORT) & (F.col("trust") >= CONFIDENT))
        patterns = settle(spark, good.select("pattern", "kind", "trust"), "pii_patterns")
        moved = patterns if before is None else patterns.join(before, ["pattern", "kind", "trust"], "left_anti")
        if moved.isEmpty():
            break
        before = patterns
        fresh = edges.select("pattern", "value").join(patterns, "pattern").groupBy("value", "kind").agg(F.max("trust").alias("trust"))
        believed = settle(spark, known.union(fresh.join(known, "value", "left_anti")), "pii_instances")
    return patterns.groupBy("pattern").agg(F.max_by("kind", F.struct("trust", "kind")).alias("kind"))


def find(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_<kind> and base_sha256 of the base spans, spans with the added ones: a row per document.

    Null and empty texts have no spans; repeated rows and null ids are rows of their own; no documents give no rows.
    Texts are read whole, tokens and the words around them too, however long. A span that several trusted patterns take has the kind that most of them give, then the first in `KINDS`.
    """
    read = ids_and_texts(docs, id_col, text_col).mapInArrow(_read, ROWS).withColumn("no", F.monotonically_increasing_id())
    rows = settle(spark, read, "pii_rows")
    seen = rows.select("no", F.explode("seen").alias("s")).select("no", "s.*")
    patterns = trusted_patterns(spark, seen)
    unknown = seen.where(F.col("kind").isNull()).select("no", "start", "end", F.explode("patterns").alias("pattern"))
    rank = F.array_position(F.lit(list(KINDS)), F.col("kind"))
    votes = unknown.join(patterns, "pattern").groupBy("no", "start", "end", rank.alias("rank")).agg(F.count("*").alias("n"))
    best = votes.groupBy("no", "start", "end").agg(F.min_by("rank", F.struct(-F.col("n"), F.col("rank"))).alias("rank"))
    added = best.groupBy("no").agg(F.collect_list(F.struct("rank", "start", "end")).alias("added"))
    span = lambda s: F.struct(F.array_position(F.lit(list(KINDS)), s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"))
    all_of = F.array_sort(F.concat(F.transform("base", span), F.coalesce("added", F.array().cast("array<struct<rank:long,start:long,end:long>>"))))
    text = F.array_join(F.transform(all_of, lambda s: F.concat_ws(":", F.get(F.lit(list(KINDS)), (s["rank"] - 1).cast("int")), s["start"], s["end"])), ",")
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{kind}')) as long)").alias(f"n_{kind}") for kind in KINDS]
    return rows.join(added, "no", "left").select("doc_id", *counts, "base_sha256", text.alias("spans"))
