"""Best-fit packing of token sequences by minimum bin slack.

Token counts have at most `capacity` different values, so the work of packing is a
table of counts by length, however many documents there are. Each bin is seeded
with the longest length left; a bitset subset-sum over the lengths still available
finds the fullest combination that goes with it, and the combination is removed,
as many times at once as the counts allow (the next bins would get the same one).
Pieces then take the places of their length in order of a number that Spark gives them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobloom.llm.common import ids_and_texts, settle, slices
from jobloom.llm.hf_ids import reader

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"
PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, special: bool = False) -> DataFrame:
    """Pieces of every document: `PIECES`, where (part, nth) numbers the pieces of one length in a task.

    A document over `capacity` tokens is cut so that only its first piece may be shorter.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        encode = reader(tokenizer_path, special)
        for batch, texts in slices(batches):
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                row = np.append(encode(text), np.uint32(end_id)).astype("<u4")
                start, piece = 0, 0
                end = len(row) % capacity or capacity
                while start < len(row):
                    length = end - start
                    rows.append((doc_id, piece, start, length, zlib.crc32(row[start:end].tobytes()), part, int(seen[length])))
                    seen[length] += 1
                    start, end, piece = end, end + capacity, piece + 1
            columns = list(zip(*rows, strict=True)) or [[]] * 7
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32", "part", "nth")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.mapInArrow(pieces, PIECES)


def fullest(counts: dict[int, int], room: int, long_first: bool = True) -> list[int]:
    """Lengths, each at most `counts` times, with the largest sum up to `room`; of such combinations one of long (or short) lengths.

    Bit s of a set says that sum s can be reached. A length that is there c times
    goes in as groups of 1, 2, 4, ... copies, and the sets are walked back from the best sum.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=long_first):
        copies, group = min(counts[length], room // length), 1
        while copies > 0:
            group = min(group, copies)
            steps.append((length, group, reach))
            reach |= (reach << (length * group)) & mask
            copies -= group
            group *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, group, before in reversed(steps):
        if not before >> total & 1:
            chosen += [length] * group
            total -= length * group
    return chosen


def _plan(counts: dict[int, int], capacity: int, long_first: bool) -> list[tuple[list[int], int]]:
    left = {length: n for length, n in counts.items() if n > 0}
    bins = []
    while left:
        seed = max(left)
        left[seed] -= 1
        chosen = [seed, *fullest({k: n for k, n in left.items() if n}, capacity - seed, long_first)]
        left[seed] += 1
        need = {length: chosen.count(length) for length in set(chosen)}
        times = min(left[length] // n for length, n in need.items())
        for length, n in need.items():
            left[length] -= n * times
            if not left[length]:
                del left[length]
        bins.append((chosen, times))
    return bins


def plan(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """(lengths in one bin, number of such bins) until every counted piece has a place.

    Where several combinations are fullest, long lengths first keep the short ones
    for later bins; with few pieces the other choice can be better. The plan with fewer bins is taken.
    """
    return min((_plan(counts, capacity, order) for order in (True, False)), key=lambda bins: sum(times for _, times in bins))


def places(bins: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """Per length, rows (first rank, first sequence, offset): ranks from there on take one sequence after another."""
    rows: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for chosen, times in bins:
        offset = 0
        for length in chosen:
            rows.setdefault(length, []).append((used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + times
            offset += length
        sequence += times
    return {length: np.array(x, np.int64) for length, x in rows.items()}


def pack(spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", special: bool = False) -> DataFrame:
    """Pack whole documents into sequences of at most `capacity` tokens: `PACKED`, one row per piece.

    Null and empty texts are the end token alone. With `special`, added tokens of the file are found in the texts. Rows that repeat are documents of their own; a null id stays null.
    Empty input gives no rows. Only the counts by length (at most `capacity` rows) and the plan made of them
    (each bin kind uses up a length or leaves fewer copies of it than it needs) reach the driver.
    """
    cut = cut_pieces(ids_and_texts(docs, id_col, text_col), tokenizer_path, capacity, end_id, special)
    pieces = settle(spark, cut, "pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = settle(spark, by_part.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))), "piece_ranks")
    counts = {r.length: r.n for r in first.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(plan(counts, capacity))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for value in np.unique(length):
                mine, rows = length == value, table[int(value)]
                at = rows[np.searchsorted(rows[:, 0], rank[mine], "right") - 1]
                sequence[mine], offset[mine] = at[:, 1] + rank[mine] - at[:, 0], at[:, 2]
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = pieces.join(first.select("length", "part", "first"), ["length", "part"]).withColumn("rank", F.col("first") + F.col("nth"))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, PACKED)
