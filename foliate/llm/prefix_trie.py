"""A trie of conversation prefixes, from vertical bitmaps.

The conversations are cut into shards of neighbouring ids. A shard's index holds a bitset of
conversations for each pair (position, turn). A node's bitset, intersected with the
postings of the next position, gives its children, depth first; the bits that have no next
turn are the conversations that end in the node. Bit counts, end lists and sums over
subtrees of a shard's trie are rows, keyed by a digest of the node's whole prefix, and the
shards' rows of one node add up.

What only holds for a node once, not once per shard (that it is a leaf, the bytes of its
last text), is counted in the shard of its smallest member. That shard has all of the node's
ancestors, so sums over subtrees are again sums over shards.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b, sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from foliate.llm.frames import written

#: Conversations in a shard, which is the width of its bitsets.
SHARD = 1024
#: Consecutive conversations that share a history, and how many heads of it there are.
FAMILY, HEADS = 5, 9
KEY_BYTES = 16

_LOCAL = "shard bigint, seq int, parent int, key binary, parent_key binary, depth int, least bigint, n_convs bigint, n_bytes bigint, weighed bigint, ends array<bigint>"


def turn_digest(role: str | Column, text: str | Column) -> Column:
    """What tells turns apart: 16 bytes of the SHA-256 over the role's length, the role and the text. Nulls are empty."""
    role, text = (F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in (role, text))
    return F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * KEY_BYTES))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``n`` from 1, ``turn`` (a digest) and ``n_bytes`` of the text, without the texts.

    Null turns come first; rows of equal turn follow each other by their digests. Rows without
    a conversation id belong to no conversation and are left out.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("at"),
        turn_digest(F.col("role").cast("string"), F.col("text").cast("string")).alias("turn"), F.octet_length(text).cast("bigint").alias("n_bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("at").asc_nulls_first(), "turn")
    return rows.select("conv_id", F.row_number().over(order).cast("bigint").alias("n"), "turn", "n_bytes")


def as_they_are(numbered: DataFrame) -> DataFrame:
    """Trie rows of the conversations themselves."""
    return _marked(numbered, F.array(F.struct("conv_id", "n", "turn", "n_bytes")))


def with_shared_history(numbered: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """Trie rows of conversations that each start with a head of the first one of their family.

    Conversation c takes the first h turns of conversation c - c mod ``family``, then its own
    behind its first h, with h = crc32(c) mod ``heads``. A turn knows all conversations that
    need it, so nothing is joined: heads of conversations that are not there lack a mark and go.
    """
    def head(of: Column) -> Column:
        return F.crc32(of.cast("string").cast("binary")) % heads

    c, n = F.col("conv_id"), F.col("n")
    first = F.pmod(c, F.lit(family)) == 0
    own = F.when(first | (n > head(c)), F.array(F.struct(c.alias("conv_id"), F.when(first, n).otherwise(n + heads).alias("n"), "turn", "n_bytes")))
    others = F.filter(F.transform(F.sequence(F.lit(1), F.lit(family - 1)), lambda i: F.try_add(c, i)), lambda to: n <= head(to))
    heirs = F.when(first & (n < heads), F.transform(others, lambda to: F.struct(to.alias("conv_id"), n.alias("n"), F.col("turn").alias("turn"), F.col("n_bytes").alias("n_bytes"))))
    none = F.array().cast("array<struct<conv_id:bigint,n:bigint,turn:binary,n_bytes:bigint>>")
    return _marked(numbered, F.concat(F.coalesce(own, none), F.coalesce(heirs, none)))


def _marked(numbered: DataFrame, rows: Column) -> DataFrame:
    """The rows of each turn, and per conversation one without a turn (n = 0) that says that it is there."""
    mark = F.when(F.col("n") == 1, F.array(F.struct("conv_id", F.lit(0).cast("bigint").alias("n"), F.lit(None).cast("binary").alias("turn"), F.lit(0).cast("bigint").alias("n_bytes"))))
    none = F.array().cast("array<struct<conv_id:bigint,n:bigint,turn:binary,n_bytes:bigint>>")
    return numbered.select(F.inline(F.concat(F.coalesce(mark, none), rows)))


def node_key(parent: bytes, turn: bytes) -> bytes:
    return blake2b(parent + turn, digest_size=KEY_BYTES).digest()


ROOT = blake2b(b"", digest_size=KEY_BYTES).digest()


@dataclass
class Node:
    """A node of a shard's trie; ``members`` is the bitset of the shard's conversations in it, ``ends`` of those that end here."""

    parent: int
    key: bytes
    depth: int
    members: int
    n_bytes: int
    ends: int = 0
    weighed: int = 0


@dataclass
class Shard:
    """The vertical index of some conversations: bit i stands for ``ids[i]``."""

    ids: list[int] = field(default_factory=list)
    turns: list[list[bytes]] = field(default_factory=list)
    postings: dict[tuple[int, bytes], int] = field(default_factory=dict)
    sizes: dict[tuple[int, bytes], int] = field(default_factory=dict)

    def add(self, conv_id: int, turns: list[tuple[bytes, int]]) -> None:
        bit = 1 << len(self.ids)
        self.ids.append(conv_id)
        self.turns.append([t for t, _ in turns])
        for place, (turn, n_bytes) in enumerate(turns):
            at = (place, turn)
            self.postings[at] = self.postings.get(at, 0) | bit
            self.sizes[at] = n_bytes

    def members(self, bits: int) -> list[int]:
        """The ids of a bitset, ascending."""
        found = []
        while bits:
            low = bits & -bits
            found.append(self.ids[low.bit_length() - 1])
            bits ^= low
        return found

    def nodes(self) -> list[Node]:
        """All nodes in depth-first order, parents before children, with sums of bytes times members over subtrees."""
        found: list[Node] = []
        stack = [Node(-1, ROOT, 0, (1 << len(self.ids)) - 1, 0)] if self.ids else []
        while stack:
            node = stack.pop()
            at = len(found)
            found.append(node)
            rest = node.members
            while rest:
                turns = self.turns[(rest & -rest).bit_length() - 1]
                if len(turns) == node.depth:
                    node.ends |= rest & -rest
                    rest &= rest - 1
                    continue
                place = (node.depth, turns[node.depth])
                child = node.members & self.postings[place]
                stack.append(Node(at, node_key(node.key, place[1]), node.depth + 1, child, self.sizes[place]))
                rest &= ~child
        for node in reversed(found):
            node.weighed += node.members.bit_count() * node.n_bytes
            if node.parent >= 0:
                found[node.parent].weighed += node.weighed
        return found


def _columns(batch: pa.RecordBatch, names: str) -> Iterator[tuple]:
    return zip(*(batch.column(c).to_pylist() for c in names.split()), strict=True)


def _shard_rows(batches: Iterator[pa.RecordBatch], width: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The nodes of each shard of conversations that come sorted by id and place."""
    shard, current, there, turns = Shard(), None, False, []

    def rows() -> pa.RecordBatch:
        nodes = shard.nodes()
        made = [
            (shard.ids[0], i, n.parent, n.key, nodes[n.parent].key if i else None, n.depth, shard.ids[(n.members & -n.members).bit_length() - 1], n.members.bit_count(), n.n_bytes, n.weighed, shard.members(n.ends))
            for i, n in enumerate(nodes)
        ]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), schema, strict=True)], schema=schema)

    for batch in batches:
        for conv_id, turn, n_bytes in _columns(batch, "conv_id turn n_bytes"):
            if conv_id != current:
                if there:
                    shard.add(current, turns)
                    if len(shard.ids) == width:
                        yield rows()
                        shard = Shard()
                current, there, turns = conv_id, False, []
            if turn is None:
                there = True
            else:
                turns.append((turn, n_bytes))
    if there:
        shard.add(current, turns)
    if shard.ids:
        yield rows()


def shard_nodes(rows: DataFrame, width: int = SHARD) -> DataFrame:
    """The nodes of every shard's trie, written once: which conversations share a shard must not change afterwards."""
    schema = T.StructType.fromDDL(_LOCAL)
    arrow = to_arrow_schema(schema)
    ranged = rows.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "n")
    return written(ranged.mapInArrow(lambda batches: _shard_rows(batches, width, arrow), schema), "trie")


_SUMMED = "key binary, shard bigint, ends array<bigint>, n_leaves bigint, once bigint, owner boolean, depth int, least bigint, parent_least bigint, n_convs bigint, n_children bigint, weighed bigint"


def _subtree_sums(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Per node of each shard, sums over its subtree of what this shard counts for all; rows come sorted by shard and place."""
    held: list[list] = []
    current = None

    def rows() -> pa.RecordBatch:
        for row in reversed(held):
            if row[2] >= 0:
                held[row[2]][4] += row[4]
                held[row[2]][5] += row[5]
        made = [(key, current, ends, leaves, once, owner, depth, least, held[parent][8] if parent >= 0 else None, *rest) for _, key, parent, ends, leaves, once, owner, depth, least, *rest in held]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made, strict=True), schema, strict=True)], schema=schema)

    for batch in batches:
        for shard, seq, key, parent, ends, owner, depth, least, n_convs, n_children, weighed, n_bytes in _columns(batch, "shard seq key parent ends owner depth least n_convs n_children weighed n_bytes"):
            if shard != current:
                if held:
                    yield rows()
                held, current = [], shard
            held.append([seq, key, parent, ends, int(owner and not n_children), n_bytes if owner else 0, owner, depth, least, n_convs, n_children, weighed])
    if held:
        yield rows()


_NODES = "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string"


def _merged(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """One row per node of rows that come sorted by key and shard. The end lists pass through the digest and are not kept."""
    current, facts, leaves, once, ends, any_ends = None, None, 0, 0, sha256(), False

    def row() -> tuple:
        depth, least, parent_least, n_convs, n_children, weighed = facts
        return least, depth, parent_least, n_convs, n_children, leaves, weighed - once, ends.hexdigest()

    for batch in batches:
        done = []
        for key, listed, n_leaves, n_once, owner, *own in _columns(batch, "key ends n_leaves once owner depth least parent_least n_convs n_children weighed"):
            if key != current:
                if current is not None:
                    done.append(row())
                current, facts, leaves, once, ends, any_ends = key, None, 0, 0, sha256(), False
            if owner:
                facts = own
            leaves += n_leaves
            once += n_once
            if listed:
                ends.update(("," if any_ends else "").encode() + ",".join(map(str, listed)).encode())
                any_ends = True
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), schema, strict=True)], schema=schema)
    if current is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row(), schema, strict=True)], schema=schema)


def prefix_trie(rows: DataFrame, width: int = SHARD) -> DataFrame:
    """One row per node of the trie over the conversations of ``rows`` (see ``as_they_are`` and ``with_shared_history``).

    ``conv_id`` is the node's smallest member, ``parent_conv_id`` the parent's (root: null);
    ``saved_tokens`` sums, over the subtree, the bytes of a node's last text times its members
    but one; ``ends_sha256`` is the digest of the ids that end here, ascending. A conversation
    without turns ends in the root. Without conversations there are no rows. Repeated rows are
    repeated turns; other columns are not read; texts of any length are digested whole.

    A task holds the digests of one shard's turns, so at least those of one conversation. A
    node has at most one row per shard, also when a third of all conversations pass through it.
    """
    local = shard_nodes(rows, width)
    nodes = local.groupBy("key").agg(F.min("parent_key").alias("above"), F.min("least").alias("node_least"), F.sum("n_convs").alias("all_convs"), F.sum("weighed").alias("all_weighed"))
    children = nodes.groupBy(F.col("above").alias("parent_key")).agg(F.count("*").alias("children"))
    facts = nodes.join(children, F.col("key") == F.col("parent_key"), "left").drop("parent_key", "above")
    summed, out = T.StructType.fromDDL(_SUMMED), T.StructType.fromDDL(_NODES)
    of_sums, of_nodes = to_arrow_schema(summed), to_arrow_schema(out)
    known = local.join(facts, "key").select(
        "shard", "seq", "key", "parent", "ends", (F.col("least") == F.col("node_least")).alias("owner"), "depth", F.col("node_least").alias("least"),
        F.col("all_convs").alias("n_convs"), F.coalesce("children", F.lit(0)).cast("bigint").alias("n_children"), F.col("all_weighed").alias("weighed"), "n_bytes",
    )
    by_shard = known.repartition("shard").sortWithinPartitions("shard", "seq").mapInArrow(lambda batches: _subtree_sums(batches, of_sums), summed)
    return by_shard.repartition("key").sortWithinPartitions("key", "shard").mapInArrow(lambda batches: _merged(batches, of_nodes), out)
