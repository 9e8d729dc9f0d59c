"""Prefix trie of conversations, from sorted turn arrays.

A conversation's turns become 16-byte digests, one behind another, so conversations with a common beginning are
neighbours once these strings are sorted over the whole table (range partitions, each sorted). Digests in
common with the neighbour before are the LCP, and a stack of open nodes swept over the LCPs gives the LCP intervals, which
are the nodes of the trie: a node is closed where the LCP falls below its depth. What is open at either end of a partition
(prefixes of its first and its last row) is handed over as a stack; a sweep over these stacks, in
order of the partitions, joins the parts of nodes that reach over boundaries. It sees a row for each
open node of a partition, never one for each conversation. Members that end at such a node go their own way, as ordered chunks
that one task reads on, a chunk at a time.

Defined cases: rows with a null conv_id belong to no conversation and are left out; turns of a conversation with equal numbers are
ordered by role, then by the digest of role and text; a null role or text counts as empty; repeated rows are turns each; a
conversation without turns left ends at the root; an empty table gives no node; other columns, of any
name, are left out.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise
from .mixing import WORD
from .sharding import crc32_sql

#: Conversations that share a beginning stand within so many ids, and share this many turns less one at most.
BLOCK, MOST_SHARED = 20, 4
#: Bytes of a turn's digest, and of a node's name.
WIDTH = 16
#: Ids of a chunk of members.
CHUNK = 1 << 16
BATCH = 8192

NODE = "node binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, turn binary, ends_sha256 string"
#: side 0: a closed node; 1: open to the left, 2: to both sides or the right; 3: a chunk of members' ids.
SWEPT = NODE + ", side int, part int, place int, words long, ends array<long>"
NODE_TYPES = [pa.binary(), pa.binary(), *[pa.int64()] * 6, pa.binary(), pa.string()]
SWEPT_TYPES = [*NODE_TYPES, pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64())]


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def _batches(rows: Iterator[tuple], schema: str, types: list) -> Iterator[pa.RecordBatch]:
    held = []

    def batch() -> pa.RecordBatch:
        made = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), types, strict=True)]
        held.clear()
        return pa.RecordBatch.from_arrays(made, _names(schema))

    for row in rows:
        held.append(row)
        if len(held) >= BATCH:
            yield batch()
    if held:
        yield batch()


class Node:
    """An open node: what is known of it and of its closed descendants."""

    __slots__ = ("chunked", "conv_id", "ends", "leaves", "n", "name", "n_children", "saved", "turn", "words")

    def __init__(self, name: bytes, turn: bytes, words: int):
        self.name, self.turn, self.words = name, turn, words
        self.n = self.n_children = self.leaves = self.saved = 0
        self.conv_id: int | None = None
        self.ends = array("q")
        self.chunked = False

    def add(self, other: Node) -> None:
        """Another part of the same node."""
        self.n += other.n
        self.n_children += other.n_children
        self.leaves += other.leaves
        self.saved += other.saved
        self.conv_id = other.conv_id if self.conv_id is None else min(self.conv_id, other.conv_id)

    def close(self, parent: Node | None, depth: int) -> tuple:
        """The whole node's row; its parent gets what it counts of its subtree."""
        leaves = self.leaves or 1
        saved = self.saved + (self.n - 1) * self.words
        if parent is not None:
            parent.n_children += 1
            parent.leaves += leaves
            parent.saved += saved
        ended = None if self.chunked else hashlib.sha256(",".join(map(str, self.ends)).encode()).hexdigest()
        return self.name, parent.name if parent else None, depth, self.conv_id, self.n, self.n_children, leaves, saved, self.turn, ended


ROOT = hashlib.md5(b"").digest()


def child_name(parent: bytes, turn: bytes) -> bytes:
    return hashlib.md5(parent + turn).digest()


def common(a: bytes, b: bytes) -> int:
    """Turns that two conversations begin with in common: the first differing byte, by halving."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    if a[: high * WIDTH] == b[: high * WIDTH]:
        return high
    while low < high:
        mid = (low + high + 1) // 2
        if a[low * WIDTH : mid * WIDTH] == b[low * WIDTH : mid * WIDTH]:
            low = mid
        else:
            high = mid - 1
    return low


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of a sorted partition: the closed ones, and the stacks that are open at its ends."""
    part = TaskContext.get().partitionId()

    def open_rows(side: int, node: Node, parent: bytes | None, depth: int) -> Iterator[tuple]:
        yield node.name, parent, depth, node.conv_id, node.n, node.n_children, node.leaves, node.saved, node.turn, None, side, part, depth, node.words, None
        for k in range(0, len(node.ends), CHUNK):
            yield node.name, None, depth, *[None] * 7, 3, part, k // CHUNK, None, node.ends[k : k + CHUNK].tolist()

    def rows() -> Iterator[tuple]:
        first = before = None
        stack: list[Node] = []
        shared = 0  # turns in common with the first row
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("conv_id", "turns", "words"))
            for conv_id, turns, words in zip(*columns, strict=True):
                if first is None:
                    first, shared, stack, depth = turns, len(turns) // WIDTH, [Node(ROOT, b"", 0)], 0
                else:
                    depth = common(before, turns)
                while len(stack) - 1 > depth:
                    at = len(stack) - 1
                    node, parent = stack.pop(), stack[-1]
                    if at <= shared:
                        yield from open_rows(1, node, parent.name, at)
                    else:
                        yield *node.close(parent, at), 0, part, at, None, None
                shared = min(shared, depth) if before is not None else shared
                for at in range(depth, len(turns) // WIDTH):
                    turn = turns[at * WIDTH : (at + 1) * WIDTH]
                    stack.append(Node(child_name(stack[-1].name, turn), turn, words[at]))
                for node in stack:
                    node.n += 1
                    if node.conv_id is None or conv_id < node.conv_id:
                        node.conv_id = conv_id
                stack[-1].ends.append(conv_id)
                before = turns
        for at, node in enumerate(stack):
            yield from open_rows(2, node, stack[at - 1].name if at else None, at)

    return _batches(rows(), SWEPT, SWEPT_TYPES)


def _stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes that reach over the ends of partitions, from their stacks in order: part, then side, then depth.

    A partition's rows are its prefixes of the first row (side 1, or 2 where the last row has them too), then the rest of its last
    row's. A part continues the open node of the same depth if all above it did and the turn is the same.
    """

    def put(stack: list[Node], depth: int, got: Node) -> Iterator[tuple]:
        if depth < len(stack) and stack[depth].name == got.name:
            stack[depth].add(got)
            return
        yield from fold(stack, depth)
        stack.append(got)

    def fold(stack: list[Node], depth: int) -> Iterator[tuple]:
        while len(stack) > depth:
            node = stack.pop()
            yield node.close(stack[-1] if stack else None, len(stack))

    def rows() -> Iterator[tuple]:
        stack: list[Node] = []
        for batch in batches:
            for x in batch.to_pylist():
                got = Node(x["node"], x["turn"], x["words"])
                got.n, got.n_children, got.leaves, got.saved, got.conv_id, got.chunked = x["n_convs"], x["n_children"], x["n_leaves"], x["saved_tokens"], x["conv_id"], True
                yield from put(stack, x["depth"], got)
        yield from fold(stack, 0)

    return _batches(rows(), NODE, NODE_TYPES)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, ends_sha256 of chunks of ids that come sorted by node, part and place."""

    def rows() -> Iterator[tuple]:
        name, state, some = None, None, False
        for batch in batches:
            for node, ids in zip(batch["node"].to_pylist(), batch["ends"].to_pylist(), strict=True):
                if node != name:
                    if name is not None:
                        yield name, state.hexdigest()
                    name, state, some = node, hashlib.sha256(), False
                state.update((b"," if some else b"") + ",".join(map(str, ids)).encode())
                some = True
        if name is not None:
            yield name, state.hexdigest()

    return _batches(rows(), "node binary, ends_sha256 string", [pa.binary(), pa.string()])


def turn_digest(role: Column, text: Column) -> Column:
    """16 bytes for a role and a text."""
    return F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))


def turn_arrays(conversations: DataFrame) -> DataFrame:
    """conv_id, turns (binary: digests one behind another), words (array<int>: words of each turn's text). Texts are not shuffled."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").alias("turn"), role.alias("role"), turn_digest(role, text).alias("digest"), F.regexp_count(text, F.lit(WORD)).alias("words")).alias("t"),
    )
    ordered = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return ordered.select("conv_id", F.array_join(F.transform("t", lambda t: F.hex(t["digest"])), "").alias("hex"), F.col("t.words").alias("words")).select(
        "conv_id", F.unhex("hex").alias("turns"), "words"
    )


def shared_turns(conv_id: Column) -> Column:
    return (F.crc32(conv_id.cast("string").cast("binary")) % MOST_SHARED).cast("int")


def rebuilt(arrays: DataFrame, block: int = BLOCK) -> DataFrame:
    """turn_arrays in which each conversation begins with the first turns of the one that begins its block of ids, instead of as many of its own."""
    base = arrays.where(F.col("conv_id") % block == 0).select(
        F.col("conv_id").alias("base"), F.substring("turns", 1, WIDTH * MOST_SHARED).alias("base_turns"), F.slice("words", 1, MOST_SHARED).alias("base_words")
    )
    own = arrays.withColumn("base", F.col("conv_id") - F.col("conv_id") % block).withColumn("h", shared_turns(F.col("conv_id")))
    head = F.coalesce(F.expr(f"substring(base_turns, 1, h * {WIDTH})"), F.lit(b""))
    tail = F.expr(f"substring(turns, h * {WIDTH} + 1)")
    none = F.array().cast("array<int>")
    words = F.concat(F.coalesce(F.expr("slice(base_words, 1, h)"), none), F.expr("slice(words, h + 1, size(words))"))
    return own.join(base, "base", "left").select("conv_id", F.concat(head, tail).alias("turns"), words.alias("words"))


def prefix_trie(arrays: DataFrame, partitions: int | None = None) -> DataFrame:
    """The nodes of the trie of turn arrays, with their parents' conv_id.

    A node is (conv_id, depth): the first `depth` turns of that conversation, which is the smallest of its members. `turn`
    is the digest of its last turn.
    """
    spark = arrays.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    arrays = materialise(arrays, "turn-arrays")
    sorted_ = arrays.repartitionByRange(parts, "turns", "conv_id").sortWithinPartitions("turns", "conv_id")
    swept = materialise(sorted_.mapInArrow(_sweep, SWEPT), "swept")
    stacks = swept.where("side in (1, 2)").select(*_names(NODE), "side", "part", "words")
    # of a partition's first row, the prefixes that the last row has too come first, then the others, then the rest of the last row's
    split = F.min(F.when(F.col("side") == 1, F.col("depth"))).over(Window.partitionBy("part"))
    turn = F.when((F.col("side") == 2) & (split.isNull() | (F.col("depth") < split)), 0).when(F.col("side") == 1, 1).otherwise(2)
    one = stacks.withColumn("path", turn).repartition(1).sortWithinPartitions("part", "path", "depth").drop("path")
    wide = materialise(one.mapInArrow(_stitch, NODE), "stitched")
    chunks = swept.where("side = 3").select("node", "part", "place", "ends")
    hashed = chunks.repartition(parts, "node").sortWithinPartitions("node", "part", "place").select("node", "ends").mapInArrow(_hashed, "node binary, ends_sha256 string")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    wide = wide.drop("ends_sha256").join(hashed, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", none))
    nodes = swept.where("side = 0").select(*_names(NODE)).unionByName(wide)
    above = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return nodes.join(above, "parent", "left").drop("parent", "node")


def turns_of(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """nodes with role and text of their last turn, found by its digest; the root has none."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.select(turn_digest(role, text).alias("turn"), role.alias("role"), text.alias("text"))
    return nodes.join(turns.groupBy("turn").agg(F.first("role").alias("role"), F.first("text").alias("text")), "turn", "left")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    return prefix_trie(rebuilt(turn_arrays(conversations))).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def trie_sql() -> str:
    """The same in DuckDB: every prefix of every rebuilt conversation as a list."""
    hashed = crc32_sql("cast(conv_id AS VARCHAR)")
    return rf"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), keyed AS (
  SELECT *, conv_id - conv_id % {BLOCK} AS base, cast({hashed} % {MOST_SHARED} AS BIGINT) AS h FROM own
), rebuilt AS (
  SELECT k.conv_id, list_concat(coalesce(b.turns, [])[1:k.h], k.turns[k.h + 1:]) AS turns FROM keyed k LEFT JOIN own b ON k.base = b.conv_id
), prefixes AS (
  SELECT conv_id, len(turns) AS n, d AS depth, turns[1:d] AS p FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(cast(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '') AS ends
  FROM prefixes GROUP BY p, depth
), kids AS (
  SELECT p[1:depth - 1] AS up, depth - 1 AS above, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), full_nodes AS (
  SELECT n.*, coalesce(k.n_children, 0) AS n_children, CASE WHEN n.depth = 0 THEN 0 ELSE (n.n_convs - 1) * len(regexp_extract_all(n.p[n.depth].t, '[^ 	-]+')) END AS saved
  FROM nodes n LEFT JOIN kids k ON n.p = k.up AND n.depth = k.above
), below AS (
  SELECT p[1:d] AS top, d AS depth, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM full_nodes) GROUP BY ALL
)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, cast(b.n_leaves AS BIGINT) AS n_leaves, cast(b.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN below b ON n.p = b.top AND n.depth = b.depth LEFT JOIN nodes u ON n.depth > 0 AND u.p = n.p[1:n.depth - 1] AND u.depth = n.depth - 1"""
