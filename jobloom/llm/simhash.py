"""SimHash near-duplicates by ball hashing that meets in the middle.

A fingerprint and its near twin share a variant half way: with three bits of
difference, one flip from each side leaves one bit. That odd bit is absorbed by
a mask: the 64 bits are four blocks, and if the bits of some block are set aside the
rest differs in at most two places whenever the block holds one of the three. So
every distinct fingerprint emits, for each block set aside, all variants of the rest
within one flip (4 x 49); variants are shuffled, and fingerprints that collide are
verified by their full distance. No link within `RADIUS` is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobloom.llm.common import digest, ids_and_texts, settle
from jobloom.llm.components import components

RADIUS = 3
BLOCKS, WIDTH = 4, 16
SEED = 42
#: Members of a variant up to which colliding pairs are verified pair by pair; above, by looking up neighbours.
PAIRWISE = 48


def fingerprint(text: str, size: int = 3) -> int:
    """64 bits: each set if it is set in over half of the shingles' XXH64.

    Words are runs of other than ASCII white space, A-Z lower-cased; `size` words make
    a shingle, repeats count. Fewer words make one shingle of all; no words give 0.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    ones, n = np.zeros(64, np.int64), len(words) - size + 1
    for lo in range(0, n, 50_000):
        part = words[lo : min(lo + 50_000, n) + size - 1]
        grams = zip(*(part[i:] for i in range(size)), strict=False)
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams), np.uint64)
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, fp long): a row per document; null and empty texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(x.as_py() or "", size) for x in batch.column("text")), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("digest"), pa.array(fps.view(np.int64))], ["doc_id", "digest", "fp"])

    read = ids_and_texts(docs, id_col, text_col).withColumn("digest", digest(F.col("text")))
    return read.mapInArrow(run, "doc_id long, digest binary, fp long")


def _signed(value: int) -> int:
    return value - 2**64 if value >= 2**63 else value


def _variants(fp: Column) -> Column:
    """Array of keys: per block set aside, the rest of `fp` and all its single flips; the block's bits hold its number."""
    made = []
    for block in range(BLOCKS):
        aside = ((1 << WIDTH) - 1) << (block * WIDTH)
        rest = fp.bitwiseAND(F.lit(_signed(~aside & (2**64 - 1)))).bitwiseXOR(F.lit(_signed(block << (block * WIDTH))))
        made.append(rest)
        made += [rest.bitwiseXOR(F.lit(_signed(1 << bit))) for bit in range(64) if not aside >> bit & 1]
    return F.array(*made)


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64)) <= RADIUS


def pairwise(fps: np.ndarray) -> np.ndarray:
    """Links (a, b) among a few fingerprints, each pair compared."""
    i, j = np.triu_indices(len(fps), 1)
    near = _near(fps[i], fps[j])
    return np.stack([fps[i][near], fps[j][near]], axis=1)


def neighbours(fps: np.ndarray, key: int) -> np.ndarray:
    """Links among the many members of one variant, without comparing all pairs.

    Outside the block set aside, members are the variant itself or one flip away, so any two
    differ there in two bits at most. Members equal in the block are linked in a star. One
    differing bit in the block always leaves a link, so the stars' centres are joined. Two need
    a member that is the variant itself; three, two such members: these are looked up. Pairs that
    are alike outside but are not the variant itself meet so in a variant of their own.
    Members are bounded by the key (2^16 x 49).
    """
    links = []
    for block in range(BLOCKS):
        at_block = np.uint64(block * WIDTH)
        if key >> (block * WIDTH) & ((1 << WIDTH) - 1) != block:
            continue
        aside = np.uint64(((1 << WIDTH) - 1) << (block * WIDTH))
        far = np.bitwise_count((fps.view(np.uint64) ^ np.uint64(key)) & ~aside)
        mine = fps[far <= 1]
        if not len(mine):
            continue
        values, first, of = np.unique((mine.view(np.uint64) & aside) >> at_block, return_index=True, return_inverse=True)
        centre = mine[first]
        itself = np.zeros(len(values), bool)
        itself[of[far[far <= 1] == 0]] = True
        links.append(np.stack([mine, centre[of]], axis=1))
        for bits in (1, 2, 3):
            if bits > 1 and not itself.any():
                break
            for flips in combinations(range(WIDTH), bits):
                other = values ^ np.uint64(sum(1 << x for x in flips))
                at = np.minimum(np.searchsorted(values, other), len(values) - 1)
                hit = values[at] == other
                if bits > 1:
                    hit &= itself
                if bits > 2:
                    hit &= itself[at]
                links.append(np.stack([centre[hit], centre[at[hit]]], axis=1))
    return np.concatenate(links)


def forest(links: np.ndarray) -> np.ndarray:
    """As few links that join the same fingerprints."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for a, b in links.tolist():
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            kept.append((a, b))
    return np.array(kept, np.int64).reshape(-1, 2)


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (key, fp) sorted by key, the links among the members of each key: (a, b)."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        found = [np.empty((0, 2), np.int64)]
        pair = starts[sizes == 2]
        a, b = fps[pair], fps[pair + 1] if len(pair) else fps[pair]
        found.append(np.stack([a, b], axis=1)[_near(a, b)])
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            members = fps[start : start + size]
            key = int(keys[start]) & (2**64 - 1)
            found.append(forest(pairwise(members) if size <= PAIRWISE else neighbours(members, key)))
        out = np.concatenate(found)
        out = np.unique(np.sort(out[out[:, 0] != out[:, 1]], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(out[:, 0]), pa.array(out[:, 1])], ["a", "b"])

    for batch in batches:
        keys, fps = batch.column("key").to_numpy(), batch.column("fp").to_numpy()
        if not len(keys):
            continue
        last = int(np.searchsorted(keys, keys[-1]))
        if last:
            held.append((keys[:last], fps[:last]))
            yield links(*map(np.concatenate, zip(*held, strict=True)))
            held = []
        held.append((keys[last:], fps[last:]))
    if held:
        yield links(*map(np.concatenate, zip(*held, strict=True)))


def near_duplicates(spark: SparkSession, docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id, digest, keep): one row per document.

    component_id is the smallest non-null doc_id that links of `RADIUS` or fewer bits
    reach; keep marks one row of each component (smallest doc_id, then digest). Copies
    share a fingerprint and are reduced to it before any variant is made. Repeated rows
    and null ids are rows of their own; empty input gives no rows.
    """
    rows = settle(spark, fingerprints(docs, size, id_col, text_col), "fingerprints")
    groups = settle(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.min(F.struct("doc_id", "digest")).alias("least"), F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "digest"))).alias("named")), "fingerprint_groups")
    variants = groups.select(F.explode(_variants(F.col("fp"))).alias("key"), "fp").repartition("key").sortWithinPartitions("key")
    roots = components(spark, variants.mapInArrow(verify, "a long, b long"))
    joined = groups.join(roots, groups.fp == roots.node, "left").withColumn("root", F.coalesce("root", "fp"))
    best = joined.groupBy("root").agg(F.min("low").alias("component_id"), F.coalesce(F.min("named"), F.min("least")).alias("best"))
    of_fp = settle(spark, joined.select("fp", "root").join(best, "root").select("fp", "component_id", "best"), "fingerprint_components")
    out = rows.join(of_fp, "fp")
    keep = F.struct("doc_id", "digest").eqNullSafe(F.col("best"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "digest", keep.alias("keep"))
