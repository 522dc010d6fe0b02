"""Prefix trie of conversations from ternary search trees per range shard.

1. A conversation is its sequence of turn keys (128-bit hashes of role and text)
   and text lengths.  Equal sequences are one *path* with a number of members, so
   that no conversation however frequent is a hot group afterwards.
2. Paths are sorted into range shards of a bounded number of turns.  A shard's
   keys become small numbers in the order of the keys (its dictionary), and its
   paths are inserted into a ternary search tree, the median first, then the
   medians of both halves, so that every node's siblings are a balanced binary
   tree.
3. A stack traversal accumulates members, children, leaves and savings from the
   deepest nodes up.  Only prefixes of a shard's first or last path can also be
   nodes of other shards: these stay open, all others are final.
4. Open nodes of neighbouring shards are merged in groups, round after round.  A
   merged group has again a first and a last path, whose prefixes stay open until
   one group is left.  A task holds the open nodes of ``fan`` shards.
5. A final node below an open one learns its parent's smallest member in a join.
"""

from __future__ import annotations

import collections
import hashlib
import itertools
import operator
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

KEY_BYTES = 16
#: turns a range shard (on average) and shards merged into one
SHARD_TURNS = 100_000
FAN = 32
#: open nodes up to which they are broadcast to their children (some 40 bytes each)
BROADCAST_NODES = 200_000

_NODE = ("conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
         "saved_tokens bigint, ends string, node binary, parent binary, chars bigint, shard bigint, first boolean, "
         "last boolean, open boolean")
_NAMES = [part.split()[0] for part in _NODE.split(", ")]
_NO_ENDS = hashlib.sha256().hexdigest()


def turn_key(role: Column, text: Column) -> Column:
    """128 bits of a turn's role and text, the role's length first."""
    return F.unhex(F.substring(F.sha2(F.concat(
        F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * KEY_BYTES))


def turn_sequences(turns: DataFrame) -> DataFrame:
    """``conv_id, turns`` (array of ``key, chars`` by turn, null first; turns of
    one number by their keys) of rows ``conv_id, turn, role, text``.  Null roles
    and texts are empty; rows without a ``conv_id`` belong to no conversation.
    A conversation is one row, 24 bytes a turn."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    keyed = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint").alias("turn"),
        turn_key(role, text).alias("key"), F.length(text).cast("bigint").alias("chars"))
    return keyed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), "key", "chars"))).alias(
        "turns")).select("conv_id", F.transform("turns", lambda t: F.struct(t["key"], t["chars"])).alias("turns"))


def paths_of(sequences: DataFrame) -> DataFrame:
    """``path binary, chars array<bigint>, n, least, ends``: each different
    sequence with its members' number, smallest id and the digest of their ids."""
    whole = sequences.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["key"])), "")).alias("path"),
        F.transform("turns", lambda t: t["chars"]).alias("chars"))
    whole = store(whole.withColumn("hash", F.unhex(F.substring(F.sha2("path", 256), 1, 2 * KEY_BYTES))), "trie-paths")
    # the texts' lengths follow from the path
    paths = whole.groupBy("path", "hash").agg(
        F.first("chars").alias("chars"), F.count("*").alias("n"), F.min("conv_id").alias("least"))
    digests = member_digests(whole.select("hash", "conv_id"))
    return paths.join(digests.withColumnRenamed("hash", "h"), F.col("hash") == F.col("h")).select(
        "path", "chars", "n", "least", "ends")


def member_digests(members: DataFrame) -> DataFrame:
    """``hash, ends``: SHA-256 of each hash's ids in order, joined by commas.

    Ids are sorted over all tasks, one hash's too, and written as blocks of text
    of an Arrow batch; a hash's blocks then pass one by one through its digest."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            rows = [(key, [i for _, i in own]) for key, own in itertools.groupby(pairs, operator.itemgetter(0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([key for key, _ in rows], pa.binary()), pa.array([own[0] for _, own in rows], pa.int64()),
                 pa.array([",".join(map(str, own)) for _, own in rows], pa.string())], ["hash", "first", "ids"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, done = None, None, []
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key == last:
                    state.update(b",")
                else:
                    if state:
                        done.append((last, state.hexdigest()))
                    last, state = key, hashlib.sha256()
                state.update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done])], ["hash", "ends"])
                done = []
        if state:
            yield pa.RecordBatch.from_arrays(
                [pa.array([last], pa.binary()), pa.array([state.hexdigest()])], ["hash", "ends"])

    texts = members.repartitionByRange("hash", "conv_id").sortWithinPartitions("hash", "conv_id").mapInArrow(
        blocks, "hash binary, first bigint, ids string")
    return texts.repartition("hash").sortWithinPartitions("hash", "first").select("hash", "ids").mapInArrow(
        digests, "hash binary, ends string")


class TernaryTree:
    """A ternary search tree over sequences of small numbers.  Node 0 is the
    empty sequence; ``down`` is a node's first child in insertion order, the top
    of the binary tree of its children."""

    def __init__(self) -> None:
        self.letter, self.less, self.more, self.down, self.up = [-1], [0], [0], [0], [-1]

    def insert(self, sequence: list[int]) -> int:
        """The sequence's node."""
        letter, less, more, down, up = self.letter, self.less, self.more, self.down, self.up
        node = 0
        for x in sequence:
            at, links, place = down[node], down, node
            while at and letter[at] != x:
                links, place = (less, at) if x < letter[at] else (more, at)
                at = links[place]
            if not at:
                at = links[place] = len(letter)
                letter.append(x)
                less.append(0)
                more.append(0)
                down.append(0)
                up.append(node)
            node = at
        return node

    def insert_balanced(self, sequences: list[list[int]]) -> list[int]:
        """The nodes of sorted sequences, which are inserted medians first."""
        ends = [0] * len(sequences)
        ranges = collections.deque([(0, len(sequences))])
        while ranges:
            a, b = ranges.popleft()
            if a < b:
                middle = (a + b) // 2
                ends[middle] = self.insert(sequences[middle])
                ranges += ((a, middle), (middle + 1, b))
        return ends

    def children(self, node: int) -> list[int]:
        out, waiting = [], [self.down[node]]
        while waiting:
            at = waiting.pop()
            if at:
                out.append(at)
                waiting += (self.less[at], self.more[at])
        return out

    def way(self, node: int) -> list[int]:
        """The nodes from the root to ``node``."""
        out = []
        while node >= 0:
            out.append(node)
            node = self.up[node]
        return out[::-1]


@dataclass
class _Node:
    """A trie node of a shard or a merged group: of itself the members, of its
    settled children their number, leaves and savings."""

    depth: int
    chars: int
    least: int = sys.maxsize
    node: bytes | None = None
    parent: bytes | None = None
    n: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str | None = None
    first: bool = False
    last: bool = False


def _prefix_keys(path: bytes) -> list[bytes]:
    """Hashes of a path's prefixes from the empty one."""
    keys = [b"\0" * KEY_BYTES]
    for at in range(0, len(path), KEY_BYTES):
        keys.append(hashlib.sha256(keys[-1] + path[at: at + KEY_BYTES]).digest()[:KEY_BYTES])
    return keys


def _final(v: _Node) -> tuple[int, int, int, int]:
    """(members, children, leaves, saved tokens) of a node whose children are settled."""
    return v.n, v.children, v.leaves or 1, v.saved + (v.n - 1) * v.chars


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    columns = zip(*rows) if rows else [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[part.split()[1]]) for c, part in zip(columns, _NODE.split(", "))], _NAMES)


def _open_row(v: _Node, shard: int) -> tuple:
    return (v.least, v.depth, None, v.n, v.children, v.leaves, v.saved, v.ends, v.node, v.parent, v.chars, shard,
            v.first, v.last, True)


def _settled_row(v: _Node, parent: _Node | None, parent_open: bool) -> tuple:
    n, children, leaves, saved = _final(v)
    return (v.least, v.depth, None if parent is None or parent_open else parent.least, n, children, leaves, saved,
            v.ends or _NO_ENDS, v.node, parent.node if parent is not None and parent_open else None, None, None, None,
            None, False)


def _fold(v: _Node, parent: _Node) -> None:
    _, _, leaves, saved = _final(v)
    parent.children += 1
    parent.leaves += leaves
    parent.saved += saved


def shard_nodes(rows: list[tuple[bytes, list[int], int, int, str]], shard: int) -> Iterator[tuple]:
    """The nodes of sorted paths ``(path, chars, n, least, ends)``: open ones
    and final ones."""
    size = KEY_BYTES
    turns = [[path[at: at + size] for at in range(0, len(path), size)] for path, *_ in rows]
    numbers = {key: i for i, key in enumerate(sorted({key for keys in turns for key in keys}))}
    tree = TernaryTree()
    ends = tree.insert_balanced([[numbers[key] for key in keys] for keys in turns])
    nodes: list[_Node | None] = [None] * len(tree.up)
    nodes[0] = _Node(0, 0)
    for x, (_, chars, n, least, digest) in zip(ends, rows):
        depth, y = len(chars), x
        while nodes[y] is None:  # nodes above one that is known are known
            nodes[y] = _Node(depth, chars[depth - 1])
            depth, y = depth - 1, tree.up[y]
        v = nodes[x]
        v.n, v.least, v.ends = n, least, digest
    for i, side in ((0, "first"), (-1, "last")):
        keys = _prefix_keys(rows[i][0])
        for k, x in enumerate(tree.way(ends[i])):
            nodes[x].node, nodes[x].parent = keys[k], keys[k - 1] if k else None
            setattr(nodes[x], side, True)
    order, stack = [], [0]
    while stack:
        x = stack.pop()
        order.append(x)
        stack += tree.children(x)
    order.reverse()  # children before their parents
    for x in order[:-1]:
        v, parent = nodes[x], nodes[tree.up[x]]
        parent.n += v.n
        parent.least = min(parent.least, v.least)
    for x in order:
        v = nodes[x]
        parent = nodes[tree.up[x]] if x else None
        if v.first or v.last:
            yield _open_row(v, shard)
            continue
        # nodes above an open one are open, so a final node's subtree is final
        _fold(v, parent)
        yield _settled_row(v, parent, parent.first or parent.last)


def merge_nodes(rows: list[_Node], shards: list[int], group: int, whole: bool) -> Iterator[tuple]:
    """One group of open nodes of neighbouring shards: merged nodes that stay
    open (none, if it is the whole trie) and final ones."""
    low, high = min(shards), max(shards)
    merged: dict[bytes, _Node] = {}
    for v, shard in zip(rows, shards):
        first, last = v.first and shard == low, v.last and shard == high
        own = merged.get(v.node)
        if own is None:
            v.first, v.last = first, last
            merged[v.node] = v
            continue
        own.n += v.n
        own.least = min(own.least, v.least)
        own.children += v.children
        own.leaves += v.leaves
        own.saved += v.saved
        own.ends = own.ends or v.ends
        own.first, own.last = own.first or first, own.last or last
    for v in sorted(merged.values(), key=lambda v: -v.depth):
        if not whole and (v.first or v.last):
            yield _open_row(v, group)
            continue
        parent = merged[v.parent] if v.parent is not None else None
        if parent is not None:
            _fold(v, parent)
        yield _settled_row(v, parent, not whole and parent is not None and (parent.first or parent.last))


def _shard_stage(paths: DataFrame, shards: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns])]
        if not rows:
            return
        held = []
        for row in shard_nodes(rows, TaskContext.get().partitionId()):
            held.append(row)
            if len(held) == 20_000:
                yield _batch(held)
                held = []
        yield _batch(held)

    return paths.repartitionByRange(shards, "path").sortWithinPartitions("path").mapInArrow(run, _NODE)


def _merge_round(open_nodes: DataFrame, groups: int, fan: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, nodes, shards = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] // fan != group and nodes:
                    yield _batch(list(merge_nodes(nodes, shards, group, groups == 1)))
                    nodes, shards = [], []
                group = row["shard"] // fan
                shards.append(row["shard"])
                nodes.append(_Node(row["depth"], row["chars"], row["conv_id"], row["node"], row["parent"],
                                   row["n_convs"], row["n_children"], row["n_leaves"], row["saved_tokens"],
                                   row["ends"], row["first"], row["last"]))
        if nodes:
            yield _batch(list(merge_nodes(nodes, shards, group, groups == 1)))

    group = F.floor(F.col("shard") / fan)
    return open_nodes.repartition(group).sortWithinPartitions(group, "shard").mapInArrow(run, _NODE)


def prefix_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS, fan: int = FAN) -> DataFrame:
    """One row per node of the trie of ``conv_id, turns`` (ids are different,
    see :func:`turn_sequences`): ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id`` (the root's is null), ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    A null or empty sequence ends at the root; repeated turns are nodes one below
    the other; other columns are not read; no rows give no nodes.
    """
    paths = store(paths_of(sequences.select("conv_id", F.coalesce(
        "turns", F.array().cast("array<struct<key: binary, chars: bigint>>")).alias("turns"))), "trie-counted")
    total = paths.agg(F.sum(F.size("chars") + 1)).first()[0] or 0
    nodes = [store(_shard_stage(paths, max(1, -(-total // shard_turns))), "trie-shards")]
    while True:
        left = nodes[-1].where("open")
        last = left.agg(F.max("shard")).first()[0]
        if last is None:
            break
        nodes.append(store(_merge_round(left, last // fan + 1, fan), "trie-merged"))
    final = nodes[0]
    for more in nodes[1:]:
        final = final.unionByName(more)
    final = final.where("not open")
    heads = final.where("node is not null").select(F.col("node").alias("key"), F.col("conv_id").alias("head"))
    # at most two paths' nodes a shard; counted before they are broadcast
    heads = F.broadcast(heads) if heads.count() <= BROADCAST_NODES else heads.hint("merge")
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
             F.col("ends").alias("ends_sha256")]
    below = final.where("parent is not null").join(heads, F.col("parent") == F.col("key")).withColumn(
        "parent_conv_id", F.col("head"))
    return final.where("parent is null").select(*names).unionByName(below.select(*names))
