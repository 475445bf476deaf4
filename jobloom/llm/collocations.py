"""Phrase collocations: a multikey three-way quicksort of suffix pointers, routed by leading words.

Every position of a text is a suffix of up to five words of its piece. Three steps count the phrases:

1. Words are counted exactly, and word pairs by a 64-bit hash. A pair that is too rare ends the suffixes
   that cross it: a phrase is never more frequent than a pair in it. A clash of hashes only keeps a suffix longer.
2. What is left of the suffixes is routed by leading words: equal suffixes of a slice of texts fall to one row with a
   weight, and `repartitionByRange` cuts the global order of suffixes into parts of even size, so a hot
   leading word is spread over as many parts as it needs.
3. Each part sorts pointers to its suffixes: three-way partitions by one word at a time, down to the maximum
   depth. The weight of an equal partition is its phrase's count; a partition whose weight cannot
   reach the least count is given up. Phrases that begin a part's first or last suffix may go on
   in the next part: their counts are added up over the parts.

Memory: a slice of texts, or one part (about a million rows). A word pair in a third of all rows is at most one row for each
slice. The kept pairs travel as a bitmap whose size follows their measured number up to 64 MB; beyond that it
lets more suffixes through and the result stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobloom.llm.common import settle, ship, slices

MOST_WORDS = 5
#: Characters of a slice of texts, suffix rows of a part, bits of the bitmap for each kept pair and at most.
SLICE_CHARS, PART_ROWS, PAIR_BITS, MOST_BITS = 8_000_000, 1_000_000, 16, 2**29
_WORDS = [f"w{k}" for k in range(1, MOST_WORDS + 1)]
_COUNT_SCHEMA = "lang string, word string, pair long, n long"
_SUFFIX_SCHEMA = "lang string, " + ", ".join(f"{w} string" for w in _WORDS) + ", n long"
_PHRASE_SCHEMA = "lang string, phrase string, n long"

#: No word holds an upper-case ASCII letter after folding, so one of them stands for the end of a piece.
_BREAK = b"A"
_FOLD = bytes(32 if c == 9 else 65 if chr(c) in ".,;:!?\n\x0b\x0c\r" else c + 32 if 65 <= c <= 90 else c for c in range(256))


class _Ids(dict):
    """Numbers words in the order in which they are first met; 0 ends a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = found = len(self)
        return found


def _tokens(texts: list[str]) -> tuple[np.ndarray, list[bytes]]:
    """The word numbers of all texts in a row, 0 after each piece, and the words by number."""
    ids = _Ids()
    ids[_BREAK] = 0
    parts = (x.encode("utf-8", "surrogatepass").translate(_FOLD).replace(_BREAK, b" A ") for x in texts)
    row = b" A ".join(parts).split()  # no other white space is left
    held = np.fromiter(map(ids.__getitem__, row), dtype=np.int64, count=len(row))
    return np.concatenate([[0], held, [0]]), list(ids)


def _mixed(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One 64-bit hash for two."""
    x = first * np.uint64(0x9E3779B97F4A7C15) ^ (second + np.uint64(0x7F4A7C15F39CC060)) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ x >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)


def _pairs(row: np.ndarray, words: list[bytes], lang: str) -> tuple[np.ndarray, np.ndarray]:
    """Where a word and the next one stand in one piece, and the hash of each such pair under its lang."""
    seed = xxhash.xxh64_intdigest(lang.encode())
    hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in words], dtype=np.uint64)
    at = np.flatnonzero((row[:-1] > 0) & (row[1:] > 0))
    return at, _mixed(hashes[row[at]], hashes[row[at + 1]])


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    for part, texts in slices(batches, chars=SLICE_CHARS):
        groups: dict[str, list[str]] = {}
        for lang, text in zip(part.column("lang").to_pylist(), texts, strict=True):
            groups.setdefault(lang, []).append(text)
        yield from groups.items()


def _counter():
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _by_lang(batches):
            row, words = _tokens(texts)
            counts = np.bincount(row, minlength=len(words))
            pairs, times = np.unique(_pairs(row, words, lang)[1], return_counts=True)
            n = len(words) - 1
            yield pa.record_batch({
                "lang": pa.array([lang] * (n + 1), pa.string()), "word": pa.array([*[w.decode("utf-8", "replace") for w in words[1:]], None], pa.string()),
                "pair": pa.nulls(n + 1, pa.int64()), "n": pa.array(np.append(counts[1:], counts[1:].sum()), pa.int64()),
            })
            for start in range(0, len(pairs), 500_000):
                some = pairs[start : start + 500_000].view(np.int64)
                yield pa.record_batch({"lang": pa.nulls(len(some), pa.string()), "word": pa.nulls(len(some), pa.string()), "pair": pa.array(some), "n": pa.array(times[start : start + 500_000], pa.int64())})

    return count


def _bitmap(pairs: DataFrame) -> np.ndarray:
    """The kept pairs as a bitmap by the low bits of their hashes, put together from pieces that tasks have set."""
    bits = min(MOST_BITS, 1 << max(12, (PAIR_BITS * pairs.count()).bit_length()))
    wide = min(bits, 2**19)

    def piece(rows: pa.Table) -> pa.Table:
        held = np.zeros(wide, dtype=np.uint8)
        held[rows.column("slot").to_numpy() % wide] = 1
        return pa.table({"at": rows.column("piece")[:1], "held": pa.array([np.packbits(held, bitorder="little").tobytes()])})

    slots = pairs.select(F.col("pair").bitwiseAND(F.lit(bits - 1)).alias("slot")).distinct()
    made = slots.withColumn("piece", F.expr(f"slot div {wide}")).groupBy("piece").applyInArrow(piece, "at long, held binary").collect()
    held = np.zeros(bits // 8, dtype=np.uint8)
    for row in made:
        held[row["at"] * wide // 8 : (row["at"] + 1) * wide // 8] = np.frombuffer(row["held"], dtype=np.uint8)
    return held


def _suffixer(bitmap):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = bitmap.value
        mask = np.uint64(len(held) * 8 - 1)
        for lang, texts in _by_lang(batches):
            row, words = _tokens(texts)
            order = sorted(range(len(words)), key=words.__getitem__)
            rank = np.empty(len(words), dtype=np.int64)
            rank[order] = np.arange(len(words))
            at, pairs = _pairs(row, words, lang)
            slot = pairs & mask
            at = at[(held[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0]
            goes = np.zeros(len(row) + MOST_WORDS, dtype=bool)
            goes[at] = True
            columns, alive = [rank[row[at]] + 1], np.ones(len(at), dtype=bool)
            for k in range(1, MOST_WORDS):
                alive = alive & goes[at + k - 1]
                columns.append(np.where(alive, rank[row[np.minimum(at + k, len(row) - 1)]] + 1, 0))
            wide = len(words) + 1
            left, right = columns[0] * wide * wide + columns[1] * wide + columns[2], columns[3] * wide + columns[4]
            sort = np.lexsort((right, left))
            left, right = left[sort], right[sort]
            if not len(sort):
                continue
            first = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])))
            times = np.diff(np.append(first, len(sort)))
            names = pa.array([None, *[words[i].decode("utf-8", "replace") for i in order]], pa.string())
            picked = [names.take(pa.array(c[sort[first]])) for c in columns]
            whole = pa.record_batch([pa.array([lang] * len(first), pa.string()), *picked, pa.array(times, pa.int64())], names=["lang", *_WORDS, "n"])
            yield from (whole.slice(i, 100_000) for i in range(0, len(first), 100_000))

    return cut


def _sorter(least: int):
    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        weight = table.column("n").to_numpy()
        columns, names = [], []
        for name in ("lang", *_WORDS):
            coded = pc.dictionary_encode(table.column(name).combine_chunks().fill_null("") if name != "lang" else table.column(name).combine_chunks())
            columns.append(coded.indices.to_numpy(zero_copy_only=False))
            names.append(coded.dictionary.to_pylist())
        del table, held
        # the empty word stands for the end of a suffix and sorts first, as null does in Spark
        edges = {_prefix(columns, names, pick, depth) for pick in (min, max) for depth in range(3, len(columns) + 1)}
        found: dict[tuple[str, ...], int] = {}
        for codes in {_codes(names, e) for e in edges if "" not in e[1:]}:
            same = np.logical_and.reduce([c == k for c, k in zip(columns, codes, strict=False)])
            found[tuple(names[i][k] for i, k in enumerate(codes))] = int(weight[same].sum())
        whole = set(found)
        for key, total in _partitions(columns, names, weight, least):
            if key not in whole:
                found[key] = total
        yield pa.record_batch({"lang": pa.array([k[0] for k in found], pa.string()), "phrase": pa.array([" ".join(k[1:]) for k in found], pa.string()), "n": pa.array(list(found.values()), pa.int64())})

    return sort


def _prefix(columns: list[np.ndarray], names: list[list[str]], pick, depth: int) -> tuple[str, ...]:
    """The first `depth` keys of the least or greatest row."""
    rows, key = np.arange(len(columns[0])), []
    for codes, words in zip(columns[:depth], names, strict=False):
        there = np.unique(codes[rows])
        best = pick(there.tolist(), key=lambda c: words[c].encode("utf-8", "surrogatepass"))
        rows = rows[codes[rows] == best]
        key.append(words[best])
    return tuple(key)


def _codes(names: list[list[str]], key: tuple[str, ...]) -> tuple[int, ...]:
    return tuple(words.index(word) for words, word in zip(names, key, strict=False))


def _partitions(columns: list[np.ndarray], names: list[list[str]], weight: np.ndarray, least: int) -> Iterator[tuple[tuple[str, ...], int]]:
    """Multikey three-way quicksort of pointers: (lang and words, weight) of every equal partition of two words or more."""
    rng = np.random.default_rng(1)
    stack = [(np.arange(len(weight)), 0)]
    while stack:
        pointers, depth = stack.pop()
        codes = columns[depth][pointers]
        pivot = codes[rng.integers(len(codes))]
        equal = codes == pivot
        for side in ((codes < pivot), (codes > pivot)):
            rest = pointers[side]
            if len(rest) and weight[rest].sum() >= least:
                stack.append((rest, depth))
        same = pointers[equal]
        total = int(weight[same].sum())
        if total < least or depth and not names[depth][pivot]:
            continue
        if depth >= 2:
            yield tuple(names[i][columns[i][same[0]]] for i in range(depth + 1)), total
        if depth + 1 < len(columns):
            stack.append((same, depth + 1))


def phrase_counts(spark: SparkSession, docs: DataFrame, least: int = 100, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all phrases of one to five words found `least` times or more, and (lang, n) of all words.

    A null lang is `und`, a null text empty. Repeated rows count each; document ids are not read.
    An empty table gives two empty tables.
    """
    ship(spark)
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    counted = texts.mapInArrow(_counter(), _COUNT_SCHEMA).groupBy("lang", "word", "pair").agg(F.sum("n").alias("n"))
    counted = settle(spark, counted.where((F.col("n") >= least) | F.isnull("word") & F.isnull("pair")), "counts")
    bitmap = spark.sparkContext.broadcast(_bitmap(counted.where("pair IS NOT NULL").select("pair")))
    suffixes = settle(spark, texts.mapInArrow(_suffixer(bitmap), _SUFFIX_SCHEMA), "suffixes")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), suffixes.count() // PART_ROWS + 1)
    phrases = suffixes.repartitionByRange(parts, "lang", *_WORDS).mapInArrow(_sorter(least), _PHRASE_SCHEMA)
    phrases = phrases.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    words = counted.where("word IS NOT NULL").select("lang", F.col("word").alias("phrase"), "n")
    totals = counted.where("word IS NULL AND pair IS NULL").select("lang", "n")
    return settle(spark, words.unionByName(phrases), "phrases"), totals


def _score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)) in decimals: the products pass 64 bits."""
    wide = "decimal(38,0)"
    top = (a.cast("decimal(18,0)") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(22,0)") * n.cast("decimal(16,0)")
    return F.call_function("div", top.cast(wide), (left.cast("decimal(18,0)") * right.cast("decimal(18,0)")).cast(wide))


def collocations(spark: SparkSession, docs: DataFrame, least: int = 100, most: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each lang's `most` best phrases of two to five words.

    Texts are lower-cased in A-Z and cut into pieces at `.,;:!?` and line breaks, pieces into words at blanks and tabs.
    A phrase found `a` times (at least `least`) is scored at the cut whose score floor(1000 a n / (l r)) is lowest, l and r being
    the counts of its two parts and n all words of the lang; ties go to the shortest first part. A phrase inside a
    longer one that is found as often is left out. Ranks go by score and count (both descending), then by the
    phrase's bytes, so there are no ties. Null texts, empty texts and texts without words add nothing; a null lang is
    `und`; repeated rows count each; an empty table gives no rows.
    """
    counts, totals = phrase_counts(spark, docs, least, text_col, lang_col)
    words = F.split("phrase", " ", -1)
    found = counts.withColumn("words", words).where(F.size("words") > 1).withColumnRenamed("n", "a")
    # a longer phrase found as often implies one longer by a single word that is, too
    longer = found.where(F.size("words") > 2)
    inner = longer.select("lang", "a", F.explode(F.array(F.expr("array_join(slice(words, 1, size(words) - 1), ' ')"), F.expr("array_join(slice(words, 2, size(words) - 1), ' ')"))).alias("phrase"))
    kept = found.join(inner.distinct(), ["lang", "phrase", "a"], "left_anti")
    cuts = kept.select("lang", "phrase", "a", "words", F.explode(F.expr("sequence(1, size(words) - 1)")).alias("k"))
    cuts = cuts.withColumns({"first": F.expr("array_join(slice(words, 1, k), ' ')"), "rest": F.expr("array_join(slice(words, k + 1, size(words) - k), ' ')")}).drop("words")
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    scored = scored.withColumn("score", _score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def sql(least: int = 100, most: int = 2000, longest: int = MOST_WORDS) -> str:
    """The same in DuckDB: every phrase of every piece is a row."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, '{upper}', '{upper.lower()}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), spots AS (
    SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words
), grams AS (
    SELECT lang, array_to_string(w[i : i + k - 1], ' ') AS phrase, k
    FROM spots, (SELECT unnest(range(1, {longest + 1})) AS k) sizes WHERE i + k - 1 <= len(w)
), every AS MATERIALIZED (
    SELECT lang, phrase, k, count(*) AS a FROM grams GROUP BY ALL
), totals AS (
    SELECT lang, sum(a)::BIGINT AS n FROM every WHERE k = 1 GROUP BY lang
), f AS MATERIALIZED (
    SELECT lang, phrase, k, a, string_split(phrase, ' ') AS w FROM every WHERE a >= {least}
), inside AS MATERIALIZED (
    SELECT DISTINCT lang, array_to_string(w[s : s + size - 1], ' ') AS phrase, a
    FROM f, (SELECT unnest(range(2, {longest})) AS size) sizes, (SELECT unnest(range(1, {longest})) AS s) starts
    WHERE size < k AND s + size - 1 <= k
), kept AS (
    SELECT * FROM f WHERE k > 1 AND NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = f.lang AND i.phrase = f.phrase AND i.a >= f.a)
), parts AS MATERIALIZED (
    SELECT lang, phrase, a, cut, array_to_string(w[1 : cut], ' ') AS first, array_to_string(w[cut + 1 : k], ' ') AS rest
    FROM kept, (SELECT unnest(range(1, {longest})) AS cut) sizes WHERE cut < k
), lefts AS MATERIALIZED (
    SELECT parts.*, f.a AS l FROM parts JOIN f ON f.lang = parts.lang AND f.phrase = first
), cuts AS (
    SELECT lefts.lang, lefts.phrase, lefts.a, cut, l, f.a AS r, n, ((1000::HUGEINT * lefts.a * n) // (l::HUGEINT * f.a))::BIGINT AS score
    FROM lefts JOIN f ON f.lang = lefts.lang AND f.phrase = rest JOIN totals ON totals.lang = lefts.lang
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best
) WHERE rank <= {most}
"""
