"""Embedding near-duplicates by an epsilon grid order join.

Cosine `threshold` of unit vectors is a distance eps = sqrt(2 - 2 threshold). Per group (label):

1. Equal vectors fall to one class with a multiplicity, so copies never meet each other.
2. Classes are turned onto the leading principal axes of all vectors (a turn keeps distances, and leaving axes out only
   shortens them), put into grid cells of width eps and sorted by label and cells over the cluster.
3. The sequence of a label is cut into intervals of bounded bytes, each with the box of its coordinates; the length
   of what the leading axes leave out is one more coordinate. From one interval for all of a label downwards, pairs of
   intervals are split in eight by eight and those further apart than eps are left out.
4. Each pair of lowest intervals that is left is one task's group: the sequences are joined recursively, halves whose
   boxes are further apart than eps are skipped, small blocks are multiplied out in double precision.

A task returns a row for each of its vectors that has a link, with its number of links and a spanning star; pairs are never
rows, and no cap holds links back. Work is what the boxes leave: vectors without structure (isotropic in many dimensions) are
compared block by block within their label.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobloom.llm.common import settle, ship
from jobloom.llm.components import components

#: Leading axes of the grid, bytes of an interval's vectors, children of an interval, vectors of a block multiplied out.
AXES, INTERVAL_BYTES, FAN, BLOCK = 8, 16_000_000, 8, 256
#: Boxes count as distant only beyond this much more than eps, which is far over the rounding of the turn.
SLACK = 1e-6


def unit(vector) -> np.ndarray | None:
    """The vector at length one in double precision; None if null, empty, zero or not finite throughout."""
    if vector is None or not len(vector):
        return None
    v = np.array([math.nan if x is None else x for x in vector], dtype=np.float64)
    top = np.abs(v).max()
    if not np.isfinite(top) or top == 0:
        return None
    v /= top
    return v / math.sqrt(float(v @ v))


def _normaliser():
    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [unit(v) for v in batch.column("vector").to_pylist()]
            raw = [None if u is None else u.tobytes() for u in vectors]
            yield pa.record_batch({"id": batch.column("id"), "label": batch.column("label"), "unit": pa.array(raw, pa.binary()), "dims": pa.array([0 if u is None else len(u) for u in vectors], pa.int32())})

    return normalise


def _matrix(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), dtype=np.float64).reshape(len(raw), -1)


def _products(dims: int):
    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            if batch.num_rows:
                m = _matrix(batch.column("unit").to_pylist())
                total += m.T @ m
        i, j = np.triu_indices(dims)
        yield pa.record_batch({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "s": pa.array(total[i, j])})

    return products


def principal_axes(units: DataFrame, dims: int) -> np.ndarray:
    """dims x AXES: leading eigenvectors of the second moments of all vectors of `dims` components.

    Tasks send sums only; the driver gets dims * (dims + 1) / 2 of them, however many vectors there are.
    """
    sums = units.where(F.col("dims") == dims).select("unit").mapInArrow(_products(dims), "i int, j int, s double")
    rows = sums.groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    whole = np.zeros((dims, dims))
    whole[rows.i, rows.j] = rows.s
    whole[rows.j, rows.i] = rows.s
    values, vectors = np.linalg.eigh(whole)
    return np.ascontiguousarray(vectors[:, np.argsort(-values)[:AXES]])


def _turned(m: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Coordinates on the leading axes and the length of the rest; vectors of another length keep their first components."""
    lead = m @ axes if m.shape[1] == len(axes) else m[:, :AXES]
    rest = np.sqrt(np.maximum(0.0, (m * m).sum(axis=1) - (lead * lead).sum(axis=1)))
    out = np.zeros((len(m), AXES + 1))
    out[:, : lead.shape[1]], out[:, AXES] = lead, rest
    return out


def _placer(axes, eps: float):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            at = np.zeros((batch.num_rows, AXES + 1))
            raw = batch.column("unit").to_pylist()
            for d in np.unique(dims):
                rows = np.flatnonzero(dims == d)
                at[rows] = _turned(_matrix([raw[i] for i in rows]), axes.value)
            columns = {n: batch.column(n) for n in ("label", "dims", "unit", "copies", "least")}
            columns["cell"] = pa.array(np.floor(at[:, :AXES] / eps).astype(np.int64).tolist(), pa.list_(pa.int64()))
            columns["at"] = pa.array(at.tolist(), pa.list_(pa.float64()))
            yield pa.record_batch(columns)

    return place


def _in_sequence(spark: SparkSession, classes: DataFrame, eps: float, axes: np.ndarray, dims: int) -> DataFrame:
    """Classes in grid order: seq (a number that grows along the order), label, ..., part (interval of the label's sequence)."""
    size = max(BLOCK, INTERVAL_BYTES // (8 * max(dims, 1)))
    placed = classes.mapInArrow(_placer(spark.sparkContext.broadcast(axes), eps), "label string, dims int, unit binary, copies long, least long, cell array<long>, at array<double>")
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), classes.count() // size)
    order = ["label", "dims", "cell", "unit"]
    row = settle(spark, placed.repartitionByRange(shards, *order).sortWithinPartitions(*order).withColumn("seq", F.monotonically_increasing_id()), "order")
    row = row.withColumn("shard", F.shiftright("seq", 33))
    held = row.groupBy("label", "dims", "shard").agg(F.count("*").alias("n"), F.min("seq").alias("start"))
    before = Window.partitionBy("label", "dims").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    row = row.join(held, ["label", "dims", "shard"])
    return row.withColumn("part", F.expr(f"(before + seq - start) div {size}")).drop("shard", "start", "before", "cell")


def _near_parts(spark: SparkSession, boxes: DataFrame, eps: float) -> DataFrame:
    """(label, dims, a, b), a <= b: pairs of intervals whose boxes are not provably further apart than eps."""
    top = boxes.agg(F.max("part")).first()[0]
    levels = [boxes.withColumnRenamed("part", "node")]
    while top:
        top //= FAN
        up = levels[-1].groupBy("label", "dims", F.expr(f"node div {FAN}").alias("node"))
        levels.append(up.agg(*[F.min(f"lo{i}").alias(f"lo{i}") for i in range(AXES + 1)], *[F.max(f"hi{i}").alias(f"hi{i}") for i in range(AXES + 1)]))
    keys = ["label", "dims"]
    pairs = levels.pop().select(*keys, F.col("node").alias("a"), F.col("node").alias("b"))
    reach = (eps + SLACK) ** 2
    while levels:
        below = levels.pop().withColumn("up", F.expr(f"node div {FAN}"))
        left = below.select(*keys, F.col("up").alias("a"), F.col("node").alias("a2"), *[F.col(f"{e}{i}").alias(f"a{e}{i}") for e in ("lo", "hi") for i in range(AXES + 1)])
        right = below.select(*keys, F.col("up").alias("b"), F.col("node").alias("b2"), *[F.col(f"{e}{i}").alias(f"b{e}{i}") for e in ("lo", "hi") for i in range(AXES + 1)])
        gaps = [F.greatest(F.col(f"alo{i}") - F.col(f"bhi{i}"), F.col(f"blo{i}") - F.col(f"ahi{i}"), F.lit(0.0)) for i in range(AXES + 1)]
        apart = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0])
        pairs = pairs.join(left, [*keys, "a"]).join(right, [*keys, "b"]).where((F.col("a2") <= F.col("b2")) & (apart <= reach))
        pairs = settle(spark, pairs.select(*keys, F.col("a2").alias("a"), F.col("b2").alias("b")), "pairs")
    return pairs


class Sequences:
    """The recursive join of two sequences of vectors; with `same`, of one with itself."""

    def __init__(self, left: np.ndarray, right: np.ndarray, at_left: np.ndarray, at_right: np.ndarray, same: bool, eps: float, found: Callable) -> None:
        self.sides, self.at, self.same, self.reach, self.found = (left, right), (at_left, at_right), same, (eps + SLACK) ** 2, found
        self.multiplied = self.skipped = 0

    def _box(self, side: int, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        part = self.at[side][start:end]
        return part.min(axis=0), part.max(axis=0)

    def join(self) -> None:
        """Walk the halves of both sequences; a stack stands for the recursion."""
        if not len(self.sides[0]) or not len(self.sides[1]):
            return
        stack = [(0, len(self.sides[0]), 0, len(self.sides[1]))]
        while stack:
            a, b, c, d = stack.pop()
            if self.same and d <= a:  # met from the other side
                continue
            (lo, hi), (lo2, hi2) = self._box(0, a, b), self._box(1, c, d)
            gap = np.maximum(0.0, np.maximum(lo - hi2, lo2 - hi))
            if float(gap @ gap) > self.reach:
                self.skipped += (b - a) * (d - c)
            elif b - a <= BLOCK and d - c <= BLOCK:
                self.multiplied += (b - a) * (d - c)
                self.found(a, c, self.sides[0][a:b] @ self.sides[1][c:d].T)
            elif self.same and (a, b) == (c, d):
                m = (a + b) // 2
                stack += [(a, m, a, m), (a, m, m, b), (m, b, m, b)]
            else:
                halves = [(a, (a + b) // 2), ((a + b) // 2, b)] if b - a > BLOCK else [(a, b)]
                others = [(c, (c + d) // 2), ((c + d) // 2, d)] if d - c > BLOCK else [(c, d)]
                stack += [(*x, *y) for x in halves for y in others]


def _rooted(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node reachable from each of n nodes over the edges a-b."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for end in (root[a], root[b], a, b):
            np.minimum.at(new, end, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def _joiner(threshold: float, eps: float):
    def link(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("seq")
        a, b = rows.column("a")[0].as_py(), rows.column("b")[0].as_py()
        part, at = rows.column("part").to_numpy(), np.array(rows.column("at").to_pylist(), dtype=np.float64)
        seq, copies = rows.column("seq").to_numpy(), rows.column("copies").to_numpy()
        m = _matrix(rows.column("unit").to_pylist())
        first, second = np.flatnonzero(part == a), np.flatnonzero(part == b)
        links, edges = np.zeros(len(seq), dtype=np.int64), [np.empty((2, 0), dtype=np.int64)]

        def found(i: int, j: int, cosines: np.ndarray) -> None:
            x, y = np.nonzero(cosines >= threshold)
            x, y = first[x + i], second[y + j]
            if a == b:
                x, y = x[x < y], y[x < y]
            if not len(x):
                return
            np.add.at(links, x, copies[y])
            np.add.at(links, y, copies[x])
            there, ends = np.unique(np.concatenate([x, y]), return_inverse=True)
            root = there[_rooted(len(there), ends[: len(x)], ends[len(x) :])]
            edges.append(np.stack([there, root])[:, there != root])

        Sequences(m[first], m[second], at[first], at[second], a == b, eps, found).join()
        ends = np.concatenate(edges, axis=1)
        root = _rooted(len(seq), ends[0], ends[1])
        some = np.flatnonzero(links)
        return pa.table({"seq": seq[some], "links": links[some], "root": seq[root[some]]})

    return link


def near_duplicates(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for each row of `vectors`, in blocks of equal labels.

    Two rows link if their labels are equal and not null, their vectors have the same number of components, and the cosine is at least
    `threshold` in double precision. Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, nor do rows with a null label: their n_links is 0 and their component is their own id. Copies link like any
    others; repeated ids are rows of their own. A component's id is its smallest id that is not null (null if all are);
    `kept` marks rows whose id it is, so repeats of that id are all kept. Rows with a null id are never kept.
    Other columns are not read; an empty table gives no rows. A component may be larger than a task: links are settled as stars.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be over 0 and at most 1")
    ship(spark)
    eps = math.sqrt(2 - 2 * threshold)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    units = settle(spark, rows.mapInArrow(_normaliser(), "id long, label string, unit binary, dims int"), "units")
    alone = F.isnull("label") | F.isnull("unit")
    classes = settle(spark, units.where(~alone).groupBy("label", "dims", "unit").agg(F.count("*").alias("copies"), F.min("id").alias("least")), "classes")
    common = classes.groupBy("dims").count().orderBy(F.desc("count"), "dims").first()
    if common is None:
        return units.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"), F.isnotnull("id").alias("kept"))
    dims = common["dims"]
    sequence = settle(spark, _in_sequence(spark, classes, eps, principal_axes(classes, dims), dims), "sequence")
    boxes = sequence.groupBy("label", "dims", "part").agg(*[F.min(F.col("at")[i]).alias(f"lo{i}") for i in range(AXES + 1)], *[F.max(F.col("at")[i]).alias(f"hi{i}") for i in range(AXES + 1)])
    pairs = _near_parts(spark, settle(spark, boxes, "boxes"), eps)
    sides = pairs.select("label", "dims", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("part"))
    groups = sequence.select("label", "dims", "part", "seq", "unit", "at", "copies").join(sides, ["label", "dims", "part"])
    linked = settle(spark, groups.groupBy("label", "dims", "a", "b").applyInArrow(_joiner(threshold, eps), "seq long, links long, root long"), "links")
    counts = linked.groupBy("seq").agg(F.sum("links").alias("links"))
    roots = components(spark, linked.select(F.col("seq").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("seq"), "root")
    told = sequence.select("seq", "label", "dims", "unit", "copies", "least").join(counts, "seq", "left").join(roots, "seq", "left")
    told = settle(spark, told.withColumn("root", F.coalesce("root", "seq")), "told")
    smallest = told.groupBy("root").agg(F.min("least").alias("component_id"))
    told = told.join(smallest, "root").select("label", "dims", "unit", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = units.where(~alone).join(told, ["label", "dims", "unit"]).select("id", "n_links", "component_id")
    out = out.unionByName(units.where(alone).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return out.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def sql(threshold: float = 0.93) -> str:
    """The same in DuckDB for ids that are not null: links of all pairs of a label, then reachability."""
    return f"""
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), usable AS (
    SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
    WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), links AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= {threshold}
), reach AS (
    SELECT vec_id, vec_id AS other FROM v
    UNION
    SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.other
), component AS (
    SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
), counts AS (
    SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, v.vec_id = component_id AS kept
FROM v JOIN component USING (vec_id) LEFT JOIN counts USING (vec_id)
"""
