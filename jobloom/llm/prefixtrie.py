"""A trie of conversation prefixes by fixed-length block hashing.

Eight turns make a block, eight blocks a block of the next level, and so on until one block holds the longest conversation. A
prefix is named by the digests of the whole blocks that make it up, largest first, so conversations share a name exactly
if they share the prefix, and every name needs at most eight digests of each level: no step walks a conversation turn
by turn, and none gathers more than eight rows, however long a conversation is.

Conversations are grouped by successive blocks first: equal blocks after equal prefixes fall to one row with a count. Turns
are looked at inside these rows only. Where all conversations that reach a block go on with the same one, its turns are nodes
as they stand; where siblings diverge, the turn prefixes of the different blocks are grouped anew.

Sums over subtrees use the same levels: upwards, each node adds what lies below it within its block of every level;
downwards, the sums of the nodes at the end of a block are added to those inside it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobloom.llm.common import settle, ship

FAN = 8
#: The name of the empty prefix.
ROOT = hashlib.sha256(b"").digest()[:16]
_EMPTY = hashlib.sha256(b"").hexdigest()


def _name(data: str) -> str:
    """16 bytes of the SHA-256 of a binary SQL expression."""
    return f"substring(unhex(sha2({data}, 256)), 1, 16)"


def ordered_turns(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """(conv_id, pos from 0, digest, bytes) of rows (conv_id, turn, role, text), in order of turn, nulls first, then role and text.

    Positions come from one global order cut into ranges, so a conversation may be spread over many tasks.
    """
    rows = rows.where("conv_id IS NOT NULL").withColumns({"role": F.coalesce("role", F.lit("")), "text": F.coalesce("text", F.lit(""))})
    order = ["conv_id", "turn", "role", "text"]
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    numbered = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).withColumn("seq", F.monotonically_increasing_id())
    digest = F.expr(_name("concat(cast(octet_length(role) as string), ':', role, text)"))
    held = settle(spark, numbered.select("conv_id", "seq", digest.alias("digest"), F.octet_length("text").cast("long").alias("bytes")), "turns")
    held = held.withColumn("shard", F.shiftright("seq", 33))
    starts = held.groupBy("conv_id", "shard").agg(F.count("*").alias("n"), F.min("seq").alias("start"))
    before = Window.partitionBy("conv_id").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return held.join(starts, ["conv_id", "shard"]).select("conv_id", F.expr("before + seq - start").alias("pos"), "digest", "bytes")


def rebuilt(spark: SparkSession, conversations: DataFrame, every: int = 5, spread: int = 9) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) and (conv_id, pos, digest, bytes) of conversations that begin as another one does.

    Conversation c takes the first h = crc32(c) % `spread` turns of c - c % `every`, then its own turns after the first h.
    """
    turns = settle(spark, ordered_turns(spark, conversations), "positions")
    h = F.crc32(F.col("conv_id").cast("string")) % spread
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own")).withColumns({"h": h, "base": F.expr(f"conv_id - conv_id % {every}")})
    lengths = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    convs = convs.join(lengths, "base", "left").withColumn("taken", F.least("h", F.coalesce("there", F.lit(0))))
    convs = settle(spark, convs.withColumn("length", F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))), "convs")
    first = turns.where(F.col("pos") < spread - 1).withColumnRenamed("conv_id", "base").join(convs.select("conv_id", "base", "h"), "base").where("pos < h")
    rest = turns.where(F.col("pos") >= h).join(convs.select("conv_id", "h", "taken"), "conv_id").withColumn("pos", F.expr("taken + pos - h"))
    columns = ["conv_id", "pos", "digest", "bytes"]
    return convs.select("conv_id", "length"), first.select(columns).unionByName(rest.select(columns))


def _levels(spark: SparkSession, turns: DataFrame, lengths: DataFrame, height: int) -> tuple[DataFrame, list[DataFrame]]:
    """Lowest blocks with the names of their ends; and for each level from 1 the named ends of whole blocks.

    A block row has conv_id, i (its number in the level), name (of the prefix before it), after (of the prefix that it
    ends, null if it isn't whole); the lowest also digests, bytes and what the block's digest is.
    """
    at = F.col("pos")
    parts = turns.groupBy("conv_id", F.expr(f"pos div {FAN}").alias("i")).agg(F.array_sort(F.collect_list(F.struct(at, "digest", "bytes"))).alias("turns"))
    lowest = parts.select("conv_id", "i", F.col("turns.digest").alias("digests"), F.col("turns.bytes").alias("bytes"))
    joined = "aggregate(digests, cast('' as binary), (a, x) -> concat(a, x))"
    lowest = settle(spark, lowest.withColumn("digest", F.expr(_name(joined))), "blocks")
    stack = [lowest]
    for _ in range(1, height):
        up = stack[-1].groupBy("conv_id", F.expr(f"i div {FAN}").alias("up")).agg(F.array_sort(F.collect_list(F.struct("i", "digest"))).alias("kids"))
        up = up.select("conv_id", F.col("up").alias("i"), F.col("kids.digest").alias("digests"))
        stack.append(settle(spark, up.withColumn("digest", F.expr(_name(joined))), "blocks"))
    named = lengths.where("length > 0").select("conv_id", F.lit(0).cast("long").alias("i"), F.lit(ROOT).alias("name"), F.lit(None).cast("binary").alias("after"))
    ends: list[DataFrame] = []
    for level in range(height - 1, 0, -1):
        rows = stack[level].join(named, ["conv_id", "i"]).join(lengths, "conv_id").withColumn("ids", F.expr(_ids()))
        kids = rows.select("conv_id", "length", "ids", "after", "i", F.posexplode("digests").alias("m", "kid"))
        whole = F.expr(f"({FAN} * i + m + 1) * {FAN**level} <= length")
        after = F.when(whole, F.when(F.col("m") == FAN - 1, F.col("after")).otherwise(F.expr("ids[m + 1]")))
        named = kids.select("conv_id", F.expr(f"{FAN} * i + m").alias("i"), F.expr("ids[m]").alias("name"), after.alias("after"), F.expr("slice(ids, 1, m + 1)").alias("line"), (F.col("m") < FAN - 1).alias("inner"))
        named = settle(spark, named, "named")
        ends.insert(0, named.where("after IS NOT NULL").groupBy(F.col("after").alias("id")).agg(F.first("line").alias("line"), F.first("inner").alias("inner")))
        named = named.select("conv_id", "i", "name", "after")
    return lowest.join(named, ["conv_id", "i"]), ends


def _ids() -> str:
    """Names of the prefixes before each of a block's digests and after the last; that after a full block is not used."""
    return f"transform(sequence(0, size(digests)), m -> if(m = 0, name, {_name('aggregate(slice(digests, 1, m), name, (a, x) -> concat(a, x))')}))"


def _plus(spark: SparkSession, sums: DataFrame, senders: DataFrame, line: str) -> DataFrame:
    """Every node's sums and those of the senders whose line holds it."""
    sent = senders.join(sums, "id").select(F.explode(F.expr(line)).alias("id"), "leaves", "saved")
    return settle(spark, sums.unionByName(sent).groupBy("id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")), "sums")


def subtree_sums(spark: SparkSession, own: DataFrame, ends: list[DataFrame]) -> DataFrame:
    """(id, leaves, saved) added up over every node's subtree; `ends` has for each level the line of nodes above a block's end."""
    sums = own
    for level in ends:
        sums = _plus(spark, sums, level.where("inner"), "line")
    for level in reversed(ends):
        sums = _plus(spark, sums, level.where("NOT inner"), f"slice(line, 2, {FAN - 1})")
    return sums


def _hasher():
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done: list[tuple[bytes, str]] = []
            for node, ids in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if node != now:
                    if state is not None:
                        done.append((now, state.hexdigest()))
                    now, state = node, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if done:
                yield pa.record_batch({"id": pa.array([x[0] for x in done], pa.binary()), "ends": pa.array([x[1] for x in done])})
        if state is not None:
            yield pa.record_batch({"id": pa.array([now], pa.binary()), "ends": pa.array([state.hexdigest()])})

    return run


def _hashed(ends: DataFrame) -> DataFrame:
    """(id, ends): SHA-256 of the conv_ids of each node in numeric order.

    Runs of 4,096 ids are put into text side by side; what follows one another is only the hash over the runs, which holds one at a time.
    """
    run = ends.groupBy("id", F.shiftright("conv_id", 12).alias("run")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    return run.repartition("id").sortWithinPartitions("id", "run").select("id", "ids").mapInArrow(_hasher(), "id binary, ends string")


def build(spark: SparkSession, lengths: DataFrame, turns: DataFrame) -> DataFrame:
    """The trie of conversations (conv_id, length) and their turns (conv_id, pos, digest, bytes): a row for each node.

    id (16 bytes), conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    longest, convs, least = lengths.agg(F.max("length"), F.count("*"), F.min("conv_id")).first()
    height = 1
    while FAN**height <= (longest or 0):
        height += 1
    blocks, ends = _levels(spark, turns, lengths, height)
    blocks = settle(spark, blocks, "prefixes")
    grouped = blocks.groupBy("name", "after", "digest", "i").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("digests").alias("digests"), F.first("bytes").alias("bytes"))
    grouped = settle(spark, grouped, "grouped")
    siblings = grouped.groupBy("name").agg((F.count("*") > 1).alias("diverge"))
    spots = grouped.join(siblings, "name").withColumn("ids", F.expr(_ids())).select("*", F.posexplode("digests").alias("m", "turn"))
    node = F.when(F.col("m") == FAN - 1, F.col("after")).otherwise(F.expr("ids[m + 1]"))
    spots = spots.select(node.alias("id"), F.expr("ids[m]").alias("parent"), F.expr(f"{FAN} * i + m + 1").alias("depth"), "n_convs", "conv_id", F.expr("bytes[m]").alias("bytes"), F.expr("slice(ids, 1, m + 1)").alias("line"), (F.col("m") < FAN - 1).alias("inner"), "diverge")
    spots = settle(spark, spots, "spots")
    kept = [F.first(c).alias(c) for c in ("parent", "depth", "bytes", "line", "inner")]
    refined = spots.where("diverge").groupBy("id").agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), *kept)
    nodes = settle(spark, refined.unionByName(spots.where("NOT diverge").drop("diverge")), "nodes")

    top = lengths.groupBy().agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    top = top.select(F.lit(ROOT).alias("id"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), F.col("n_convs"), "conv_id", F.lit(0).cast("long").alias("bytes"))
    every = nodes.drop("line", "inner").unionByName(top)
    children = nodes.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children"))
    every = settle(spark, every.join(children, "id", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "every")
    own = every.select("id", (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    sums = subtree_sums(spark, own, [nodes.select("id", "line", "inner"), *ends])

    last = lengths.where("length > 0").select("conv_id", F.expr(f"(length - 1) div {FAN}").alias("i"))
    over = F.coalesce("after", F.expr(_name("aggregate(digests, name, (a, x) -> concat(a, x))")))
    stops = blocks.join(last, ["conv_id", "i"]).select(over.alias("id"), "conv_id").unionByName(lengths.where("length = 0").select(F.lit(ROOT).alias("id"), "conv_id"))

    above = every.select(F.col("id").alias("parent"), F.col("conv_id").alias("above"))
    out = every.join(sums, "id").join(_hashed(stops), "id", "left").join(above.where(F.col("parent") != F.lit(ROOT)), "parent", "left")
    parent = F.when(F.col("parent") == F.lit(ROOT), F.lit(least).cast("long")).otherwise(F.col("above"))
    return out.select("id", "conv_id", "depth", parent.alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"))


def trie(spark: SparkSession, conversations: DataFrame, every: int = 5, spread: int = 9) -> DataFrame:
    """The prefix trie of the rebuilt conversations (see `rebuilt`), a row for each node from the root on.

    Turns are ordered by turn (null first), ties by role and text; null roles and texts count as empty; repeated rows are turns of their own.
    Rows without a conv_id belong to no conversation and are left out. Conversations may be turnless after rebuilding and
    are then members of the root alone. Texts count whole. Other columns are not read. An empty table gives no rows.
    The SHA-256 of a node's ends is one hash over all of them, so its last step follows one another, with a run of ids in memory.
    """
    ship(spark)
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    return build(spark, *rebuilt(spark, rows, every, spread)).drop("id")


def sql(every: int = 5, spread: int = 9) -> str:
    """The same in DuckDB with every prefix of every conversation as a row; CRC-32 is spelt out bit by bit."""
    return f"""
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
           coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
    SELECT conv_id, conv_id - conv_id % {every} AS base, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ord(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])) AS bits
    FROM (SELECT DISTINCT conv_id FROM turns)
), convs AS (
    SELECT conv_id, base, xor(list_reduce(list_concat([4294967295::BIGINT], bits), lambda a, b: xor(xor(a, b) >> 1, (xor(a, b) & 1) * 3988292384::BIGINT)), 4294967295) % {spread} AS h FROM ids
), begun AS (
    SELECT c.conv_id, t.pos, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.pos < c.h
), taken AS (
    SELECT conv_id, count(*) AS k FROM begun GROUP BY conv_id
), whole AS (
    SELECT * FROM begun
    UNION ALL
    SELECT t.conv_id, coalesce(k, 0) + t.pos - c.h, t.role, t.text FROM turns t JOIN convs c USING (conv_id) LEFT JOIN taken USING (conv_id) WHERE t.pos >= c.h
), lists AS (
    SELECT conv_id, list(sha256(concat(len(role), ':', role, text)) ORDER BY pos) AS turns, list(strlen(text) ORDER BY pos) AS sizes FROM whole GROUP BY conv_id
), paths AS MATERIALIZED (
    SELECT conv_id, d AS depth, sha256(array_to_string(turns[1 : d], ',')) AS node, sha256(array_to_string(turns[1 : d - 1], ',')) AS parent, sizes[d] AS bytes, d = len(turns) AS ends
    FROM lists, unnest(range(1, len(turns) + 1)) AS steps(d)
    UNION ALL
    SELECT conv_id, 0, sha256(''), NULL, 0, conv_id NOT IN (SELECT conv_id FROM lists) FROM convs
), nodes AS MATERIALIZED (
    SELECT node, depth, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS own,
           sha256(coalesce(string_agg(CASE WHEN ends THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM paths GROUP BY node, depth
), kids AS (
    SELECT parent AS node, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
), marked AS MATERIALIZED (
    SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN kids USING (node, depth)
), sums AS (
    SELECT p.node, p.depth, sum((m.n_children = 0)::INT) AS n_leaves, sum(m.own) AS saved FROM marked m JOIN paths p ON p.conv_id = m.conv_id AND p.depth <= m.depth GROUP BY ALL
)
SELECT m.conv_id, m.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, m.ends_sha256
FROM marked m JOIN sums USING (node, depth) LEFT JOIN marked up ON up.node = m.parent AND up.depth = m.depth - 1
"""
