"""Byte-level BPE by recursive queries: DuckDB merges and decodes inside each Spark task.

A word (one match of the split pattern) is rows of (position, token), first its
bytes. A recursive query joins neighbouring tokens with the merge table and contracts the
leftmost pair of least rank of every word at once, until no pair merges. Decoding
joins tokens with their bytes and aggregates these in order of position. A task
encodes each different word once; Spark deals the documents to tasks.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from jobloom.llm.chunks import ChunkEncoder, runs
from jobloom.llm.common import ids_and_texts, ship, slices

#: Words in one query; words and chunks kept with their tokens in a worker (about).
WORDS, STORE = 100_000, (1_200_000, 800_000)
#: Bytes from which a word's equal pairs are contracted together where that changes nothing.
LONG = 256
#: Ids decoded in one query, about.
TOKENS = 500_000
MEMORY = "300MB"

#: A row's place is its word's number and its position in ten bits; a pair's key is its rank and both positions.
_MERGE = """
WITH RECURSIVE state(done, place, token) AS (
    SELECT false, (word::BIGINT << 10) + pos, token FROM start
    UNION ALL
    (WITH pair AS (
        SELECT place, token, lead(token) OVER places AS after, lead(place) OVER places AS next
        FROM state WHERE NOT done WINDOW places AS (ORDER BY place)),
    ranked AS (
        SELECT place, token, place >> 10 AS word, (rank::BIGINT << 20) + ((place & 1023) << 10) + (next & 1023) AS key
        FROM pair LEFT JOIN merges ON merges.pair = token::BIGINT * 65536 + after AND next >> 10 = place >> 10),
    leftmost AS (SELECT word, min(key) AS least_key FROM ranked GROUP BY word)
    SELECT least_key IS NULL, place, CASE WHEN key = least_key THEN (key >> 20)::INT ELSE token END
    FROM ranked JOIN leftmost USING (word)
    WHERE least_key IS NULL OR place & 1023 <> least_key & 1023)
)
SELECT (place >> 10)::INT AS word, token FROM state WHERE done ORDER BY place
"""

#: As above for long words: pairs of a calm rank (no token that holds the merged bytes ranks before it) are all contracted
#: in one step, every other one of a run of overlapping pairs, as taking the leftmost again and again would.
_MERGE_LONG = """
WITH RECURSIVE state(done, word, pos, token) AS (
    SELECT false, word, pos, token FROM start
    UNION ALL
    SELECT NOT any_pair, word, pos, CASE WHEN taken THEN rank ELSE token END
    FROM (
        SELECT *, lag(taken, 1, false) OVER (PARTITION BY word ORDER BY pos) AS gone
        FROM (
            SELECT *, least_rank IS NOT NULL AS any_pair,
                   hit AND (CASE WHEN calm THEN row_number() OVER (PARTITION BY word, run ORDER BY pos) % 2 = 1 ELSE pos = first_hit END) AS taken
            FROM (
                SELECT *, min(CASE WHEN hit THEN pos END) OVER (PARTITION BY word) AS first_hit,
                       sum(CASE WHEN hit AND NOT before THEN 1 ELSE 0 END) OVER (PARTITION BY word ORDER BY pos ROWS UNBOUNDED PRECEDING) * 2 + hit::INT AS run
                FROM (
                    SELECT *, coalesce(rank = least_rank, false) AS hit,
                           coalesce(lag(rank) OVER (PARTITION BY word ORDER BY pos) = least_rank, false) AS before
                    FROM (
                        SELECT *, min(rank) OVER (PARTITION BY word) AS least_rank
                        FROM (
                            SELECT word, pos, token, m.rank AS rank, m.calm AS calm
                            FROM (SELECT word, pos, token, lead(token) OVER (PARTITION BY word ORDER BY pos) AS after FROM state WHERE NOT done) AS pair
                            LEFT JOIN merges AS m ON m.pair = pair.token::BIGINT * 65536 + pair.after
                        )
                    )
                )
            )
        )
    )
    WHERE NOT gone
)
SELECT word, token FROM state WHERE done ORDER BY word, pos
"""

_DECODE = """
SELECT text, {} FROM (
    SELECT text, list_aggregate(list(bytes ORDER BY pos), 'string_agg', '') AS bytes
    FROM tokens JOIN vocabulary USING (token) GROUP BY text
)
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks from a file of base64 and number per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Coder:
    """Encoder and decoder of one vocabulary and split pattern; `words` queries run on one thread in bounded memory."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.split = regex.compile(pattern).findall
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY})
        pairs = [(a * 65536 + b, rank, rank) for token, rank in ranks.items() for i in range(1, len(token)) if (a := ranks.get(token[:i])) is not None and (b := ranks.get(token[i:])) is not None]
        restless = {inner for token, rank in ranks.items() for i in range(len(token)) for j in range(i + 1, len(token) + 1) if (inner := ranks.get(token[i:j])) is not None and inner > rank}
        self._load("merges", {"pair": pa.array([p for p, _, _ in pairs], pa.int64()), "rank": pa.array([r for _, r, _ in pairs], pa.int32()), "calm": pa.array([r not in restless for _, r, _ in pairs])})
        self.names = {rank: str(rank) for rank in ranks.values()}
        self._load("vocabulary", {"token": pa.array(list(ranks.values()), pa.int32()), "bytes": [token.hex() for token in ranks]})
        self._clear()
        self.chunks = ChunkEncoder(self._encode_chunks, STORE[1])

    def _load(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _merge(self, words: list[bytes], query: str) -> tuple[np.ndarray, np.ndarray]:
        """Flat tokens of the words, and how many each has."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        number = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        pos = (np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)).astype(np.int32)
        self.db.register("start", pa.table({"word": number, "pos": pos, "token": self.byte[flat]}))
        found = self.db.sql(query).to_arrow_table()
        self.db.unregister("start")
        return found["token"].to_numpy().astype(np.int32), np.bincount(found["word"].to_numpy(), minlength=len(words))

    def _learn(self, words: list[str]) -> None:
        """Merge words not seen yet, in slices of `WORDS`; long ones by themselves."""
        coded = [(w, w.encode("utf-8", "surrogatepass")) for w in words]
        short = [x for x in coded if len(x[1]) < LONG]
        parts = [(short[lo : lo + WORDS], _MERGE) for lo in range(0, len(short), WORDS)]
        for part, query in parts + [([x], _MERGE_LONG) for x in coded if len(x[1]) >= LONG]:
            tokens, counts = self._merge([data for _, data in part], query)
            first = len(self.ends) - 1
            self.known.update(zip((w for w, _ in part), range(first, first + len(part)), strict=True))
            self.tokens = np.concatenate([self.tokens, tokens])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.tokens, self.ends = np.empty(0, np.int32), np.zeros(1, np.int64)

    def _encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > STORE[0]:
            self._clear()
        cut = list(map(self.split, chunks))
        words = list(chain.from_iterable(cut))
        found = list(map(self.known.get, words))
        if None in found:
            self._learn(list(dict.fromkeys(w for w, code in zip(words, found, strict=True) if code is None)))
            found = list(map(self.known.__getitem__, words))
        codes = np.array(found, np.int64)
        tokens, ends = runs(self.tokens, self.ends, codes)
        last = np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut)))
        return tokens, np.diff(ends[last], prepend=0)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts and the bounds of each."""
        return self.chunks.encode(texts)

    def _decoded(self, ids: np.ndarray, bounds: np.ndarray, value: str) -> dict:
        """`value` (SQL over the hex of the bytes) of each run of ids, in slices of about `TOKENS` ids; runs are never cut."""
        found, lo = {}, 0
        if not self.names.keys() >= set(np.unique(ids).tolist()):
            raise ValueError("an id is not in the vocabulary")
        while lo < len(bounds) - 1:
            hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + TOKENS, "right")) - 1)
            lengths = np.diff(bounds[lo : hi + 1])
            pos = np.arange(bounds[hi] - bounds[lo]) - np.repeat(bounds[lo:hi] - bounds[lo], lengths)
            part = {"text": np.repeat(np.arange(lo, hi, dtype=np.int32), lengths), "pos": pos.astype(np.int32), "token": ids[bounds[lo] : bounds[hi]]}
            self.db.register("tokens", pa.table(part))
            found |= self.db.sql(_DECODE.format(value)).fetchall()
            lo = hi
        return found

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """Bytes of each run of ids; an id outside the vocabulary is an error."""
        rows = self._decoded(ids, bounds, "from_hex(bytes)")
        return [rows.get(i, b"") for i in range(len(bounds) - 1)]

    def decoded_digests(self, ids: np.ndarray, bounds: np.ndarray) -> list[str]:
        """SHA-256 (hex) of the decoded bytes of each run of ids."""
        rows = self._decoded(ids, bounds, "sha256(from_hex(bytes))")
        empty = hashlib.sha256(b"").hexdigest()
        return [rows.get(i, empty) for i in range(len(bounds) - 1)]


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(path: str, pattern: str) -> Coder:
    """One coder per worker process, vocabulary and pattern."""
    if (path, pattern) not in _CODERS:
        _CODERS[path, pattern] = Coder(read_ranks(path), pattern)
    return _CODERS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids array<int>: a row per document; null and empty texts have no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            ids, bounds = coder(path, pattern).encode(texts)
            rows = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), rows], ["doc_id", "ids"])

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, bytes binary: a row per row of ids; null ids decode to no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x or [] for x in batch.column("ids").to_pylist()]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in rows], dtype=np.int64)])
            ids = np.fromiter((i for row in rows for i in row), np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(coder(path, pattern).decode(ids, bounds), pa.binary())], ["doc_id", "bytes"])

    ship(encoded.sparkSession)
    return encoded.selectExpr(f"cast(`{id_col}` as long) as doc_id", f"cast(`{ids_col}` as array<int>) as ids").mapInArrow(run, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoded, then decoded from the ids, a row per document.

    Whole texts; null and empty ones have 0 tokens and the digests of nothing.
    Repeated rows and null ids are rows of their own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        for batch, texts in slices(batches):
            work = coder(path, pattern)
            ids, bounds = work.encode(texts)
            listed = [" ".join(map(work.names.__getitem__, ids[lo:hi].tolist())) for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            arrays = [pa.array(np.diff(bounds), pa.int64()), pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed]), pa.array(work.decoded_digests(ids, bounds), pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names)

    return ids_and_texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
