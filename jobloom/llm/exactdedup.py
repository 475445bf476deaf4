"""Exact dedup against a history held in a minimal perfect hash.

Distinct digests of the history are dealt to shards by their first bytes; each shard
is a minimal perfect hash in levels of bit sets: a digest that is alone at its place in a
level sits there, the others go on to the next level, and the rank of its bit is its
slot. Slots hold the full digest, the winner's locator and the copies so far. New
digests are grouped first, then looked up: one whose bytes equal its slot's is a repeat,
any other is a nonmember and a group of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm.common import digest, ids_and_texts, settle

#: Digests in a shard, about; a shard is what one task holds.
PER_SHARD = 50_000
#: Places per digest in a level.
ROOM = 2
INDEX = "shard int, sizes array<long>, bits array<binary>, digests binary, ids array<long>, nos array<long>, copies array<long>"
GROUPS = "digest binary, id long, no long, copies long"


def _words(digests: np.ndarray) -> np.ndarray:
    """Four 64-bit words per digest, from an array of 32-byte rows."""
    return digests.view("<u8").reshape(-1, 4)


def _place(words: np.ndarray, level: int, size: int) -> np.ndarray:
    mixed = (words[:, level % 4] ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ (mixed >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


def build(digests: np.ndarray) -> tuple[list[int], list[np.ndarray], np.ndarray]:
    """Level sizes, level bits and each digest's slot, for distinct digests as rows of 32 bytes; slots fill 0..n-1."""
    words, slots = _words(digests), np.empty(len(digests), np.int64)
    left, sizes, bits, below = np.arange(len(digests)), [], [], 0
    while len(left):
        size = max(64, ROOM * len(left))
        at = _place(words[left], len(sizes), size)
        alone = np.bincount(at, minlength=size) == 1
        ranks = np.cumsum(alone) - 1
        settled = alone[at]
        slots[left[settled]] = below + ranks[at[settled]]
        below += int(alone.sum())
        sizes.append(size)
        bits.append(alone)
        left = left[~settled]
    return sizes, bits, slots


def look_up(digests: np.ndarray, sizes: list[int], bits: list[np.ndarray]) -> np.ndarray:
    """Slot of each digest, or -1 where no level holds its place; a nonmember may get a slot, so compare the bytes."""
    words, slots = _words(digests), np.full(len(digests), -1, np.int64)
    left, below = np.arange(len(digests)), 0
    for level, (size, held) in enumerate(zip(sizes, bits, strict=True)):
        at = _place(words[left], level, size)
        hit = held[at]
        slots[left[hit]] = below + (np.cumsum(held) - 1)[at[hit]]
        below += int(held.sum())
        left = left[~hit]
    return slots


def _rows(column: pa.ChunkedArray) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.uint8).reshape(-1, 32)


def _group(rows: DataFrame) -> DataFrame:
    """One row per digest: the winner (largest id, null lowest, then largest row number) and the copies."""
    best = F.max(F.struct("id", "no"))
    return rows.groupBy("digest").agg(best.alias("best"), F.sum("copies").alias("copies")).select("digest", "best.id", "best.no", "copies")


def _sharded(groups: DataFrame, shards: int) -> DataFrame:
    return groups.withColumn("shard", (F.conv(F.substring(F.hex("digest"), 1, 8), 16, 10).cast("long") % shards).cast("int"))


def index(groups: DataFrame, shards: int) -> DataFrame:
    """`INDEX`: a row per shard that has digests; `groups` is (digest, id, no, copies) with distinct digests."""

    def shard(table: pa.Table) -> pa.Table:
        digests = _rows(table["digest"])
        sizes, bits, slots = build(digests)
        by_slot = np.argsort(slots)
        take = table.take(pa.array(by_slot))
        packed = [np.packbits(b).tobytes() for b in bits]
        values = [table["shard"][0].as_py(), sizes, packed, digests[by_slot].tobytes(), take["id"].to_pylist(), take["no"].to_pylist(), take["copies"].to_pylist()]
        kinds = [pa.int32(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.binary(), *[pa.list_(pa.int64())] * 3]
        names = ["shard", "sizes", "bits", "digests", "ids", "nos", "copies"]
        return pa.table([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

    return _sharded(groups, shards).groupBy("shard").applyInArrow(shard, INDEX)


def resolve(groups: DataFrame, history: DataFrame, shards: int) -> DataFrame:
    """Groups of the new rows looked up in the index: `GROUPS` of everything, members merged with their slot."""

    def shard(new: pa.Table, held: pa.Table) -> pa.Table:
        names, kinds = ["digest", "id", "no", "copies"], [pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        new = new.select(names)
        if not held.num_rows:
            return new.cast(pa.schema(list(zip(names, kinds, strict=True))))
        slot = held.to_pylist()[0]
        known = np.frombuffer(slot["digests"], np.uint8).reshape(-1, 32)
        bits = [np.unpackbits(np.frombuffer(b, np.uint8), count=n).astype(bool) for b, n in zip(slot["bits"], slot["sizes"], strict=True)]
        ids, nos, copies = slot["ids"], slot["nos"], slot["copies"]
        fresh = []
        if new.num_rows:
            digests = _rows(new["digest"])
            slots = look_up(digests, slot["sizes"], bits)
            member = (slots >= 0) & (known[slots] == digests).all(axis=1)
            for row, at, same in zip(new.to_pylist(), slots.tolist(), member.tolist(), strict=True):
                if not same:
                    fresh.append(tuple(row.values()))
                    continue
                copies[at] += row["copies"]
                order = lambda i, no: (i is not None, i or 0, no)
                ids[at], nos[at] = max((ids[at], nos[at]), (row["id"], row["no"]), key=lambda x: order(*x))
        rows = [*zip((known[i].tobytes() for i in range(len(known))), ids, nos, copies, strict=True), *fresh]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return _sharded(groups, shards).groupBy("shard").cogroup(history.groupBy("shard")).applyInArrow(shard, GROUPS)


def deduplicate(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, digest): one row per document, dropped ones too.

    Texts are equal when identical; null counts as empty. The row with the largest
    doc_id stays (null ids lowest); of rows that repeat the id too, one. The history is the part of the
    documents whose id lies in the lower half of the id range, the rest are new; both
    give one result. Copies are counted before any shuffle, so each shard holds distinct
    digests; shard numbers follow the count of these. Empty input gives no rows.
    """
    read = ids_and_texts(docs, id_col, text_col).select(F.col("doc_id").alias("id"), digest(F.col("text")).alias("digest"))
    rows = settle(spark, read.withColumn("no", F.monotonically_increasing_id()).withColumn("copies", F.lit(1).cast("long")), "digests")
    low, high = rows.agg(F.min("id"), F.max("id")).first()
    middle = low + (high - low) // 2 if low is not None else 0
    old = F.coalesce(F.col("id") <= middle, F.lit(False))
    history = settle(spark, _group(rows.where(old)), "history")
    new = settle(spark, _group(rows.where(~old)), "new_digests")
    shards = max(history.count(), new.count()) // PER_SHARD + 1
    table = settle(spark, index(history, shards), "hash_index")
    found = resolve(new, table, shards)
    groups = settle(spark, found.select("digest", F.col("id").alias("keep_id"), F.col("no").alias("keep_no"), F.col("copies").alias("group_size")), "copy_groups")
    return rows.join(groups, "digest").select(F.col("id").alias("doc_id"), "keep_id", "group_size", (F.col("no") == F.col("keep_no")).alias("kept"), "digest")
