"""Prefix trie of conversations, by a splitter skeleton.

A conversation's path is the sequence of its turns, each a digest of role and
text.  Conversations are dealt by ranges of (path, id): a node's members stand
next to each other, so only nodes on the paths of the range splitters (the
skeleton) can have members in two shards.

1. Splitters.  A sample of bounded size gives one splitter a shard; their paths,
   as a trie, go to all tasks (at most ``SPLIT_TURNS`` turns a shard).
2. Shards.  Each is scanned in order with a stack of open nodes.  Nodes off the
   skeleton lie in one shard and are finished there; a skeleton node leaves a
   partial aggregate and, in order, the ids of the members that end there.
3. Reduction.  The partial aggregates of the skeleton are summed by node, then
   over each node's ancestors within the skeleton.

Many equal conversations are cut by their ids, so one hot path is dealt over
many shards.  A task holds the open nodes and one finished subtree below the
skeleton; texts are digested before anything is dealt.  A conversation is one
row of 36 bytes a turn.  Conversations alike in over ``SPLIT_TURNS`` turns stay in
one shard; they are streamed there.

Defined results: null roles and texts are empty; rows without a conversation id
take no part; turns with equal numbers are ordered by role and text, null numbers
first; repeated rows are turns of their own; an empty table gives no rows.  Other
columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shuffle_partitions, stage

DIGEST = 32  # characters of a turn in a path
SHARD_ROWS, SAMPLES, SPLIT_TURNS = 200_000, 4, 64
BROADCAST_ROWS = 500_000
ENDS_CHARS, OUT_ROWS = 65_536, 4096
BLOCK, HEADS = 100, 6  # fixed values of the rebuilding rule
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
NODES = ("kind int, path string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
         "n_leaves long, saved_tokens long, ends string, chars long, shard int, seq long")
FINISHED, PARTIAL, ENDS = 0, 1, 2
SCHEMA = pa.schema([(n, {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}[t])
                    for n, t in (c.split() for c in NODES.split(", "))])


def paths(turns: DataFrame) -> DataFrame:
    """(conv_id, own): the digests and sizes of each conversation's turns, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    digest = F.substring(F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256), 1, DIGEST)
    return (rows.filter(F.col("conv_id").isNotNull()).withColumn("at", F.row_number().over(order))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
                "at", digest.alias("digest"), F.char_length("text").alias("chars")))).alias("own")))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, path, chars): the first h turns of the block's first
    conversation, then the own ones after h; h = crc32(id) % 6."""
    own = paths(turns)
    head = own.filter(F.col("conv_id") % BLOCK == 0).select(
        F.col("conv_id").alias("base"), F.slice("own", 1, HEADS - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    both = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % BLOCK).join(head, "base", "left").withColumn("h", h)
    # a slice of no turns where the block's first conversation is absent
    turns_of = F.concat(F.slice(F.coalesce("head", F.slice("own", 1, 0)), F.lit(1), F.col("h")),
                        F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0))))
    both = both.select("conv_id", turns_of.alias("t"))
    return both.select("conv_id", F.array_join(F.col("t.digest"), "").alias("path"), F.col("t.chars").alias("chars"))


def splitters(rows: DataFrame, shards: int, convs: int) -> list[tuple[str, int]]:
    """At most ``shards - 1`` bounds of (path, id) from a sample of bounded size."""
    if shards < 2:
        return []
    share = min(1.0, SAMPLES * shards / convs)
    limit = DIGEST * SPLIT_TURNS
    cut = F.length("path") > limit
    some = rows.filter(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < int(share * (1 << 30))).select(
        F.substring("path", 1, limit), F.when(~cut, F.col("conv_id")))
    found = sorted((p, -(1 << 64) if c is None else c) for p, c in some.collect())
    if not found:
        return []
    return sorted({found[len(found) * i // shards] for i in range(1, shards)})


def trie_of(bounds: list[tuple[str, int]]) -> dict:
    """The bounds' paths as nested dictionaries, from the root."""
    root: dict = {}
    for path, _ in bounds:
        node = root
        for i in range(0, len(path), DIGEST):
            node = node.setdefault(path[i:i + DIGEST], {})
    return root


class Node:
    """An open node; ``inside`` is its place in the skeleton's trie, if any."""

    __slots__ = ("inside", "chars", "conv", "convs", "children", "leaves", "saved", "ends", "any", "slot", "held", "size", "seq")

    def __init__(self, inside: dict | None, chars: int) -> None:
        self.inside, self.chars = inside, chars
        self.conv, self.convs, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends = hashlib.sha256() if inside is None else None
        self.any, self.slot, self.held, self.size, self.seq = False, -1, [], 0, 0

    def merge(self, conv: int, convs: int) -> None:
        self.conv = conv if self.conv is None else min(self.conv, conv)
        self.convs += convs


class Scan:
    """One shard in order of (path, id).  ``out`` collects rows of ``NODES``."""

    def __init__(self, shard: int, trie: dict, out: list[tuple]) -> None:
        self.shard, self.out = shard, out
        self.path, self.open = [], [Node(trie, 0)]
        self.done: list[tuple | None] = []  # finished nodes of one subtree below the skeleton

    def add(self, conv: int, path: str, chars: list[int]) -> None:
        turns = [path[i:i + DIGEST] for i in range(0, len(path), DIGEST)]
        same = 0
        while same < min(len(turns), len(self.path)) and turns[same] == self.path[same]:
            same += 1
        while len(self.open) > same + 1:
            self.close()
        for t, n in zip(turns[same:], chars[same:]):
            last = self.open[-1].inside
            node = Node(None if last is None else last.get(t), n)
            if node.inside is None:
                node.slot = len(self.done)
                self.done.append(None)
            self.open.append(node)
        self.path = turns
        node = self.open[-1]
        node.merge(conv, 1)
        said = f",{conv}" if node.any else str(conv)
        node.any = True
        if node.inside is None:
            node.ends.update(said.encode())
            return
        node.held.append(said)
        node.size += len(said)
        if node.size >= ENDS_CHARS:
            self.send_ends(node, "".join(turns))

    def send_ends(self, node: Node, path: str) -> None:
        """Ids that end at a skeleton node; each piece but the node's first in
        this shard starts with its comma."""
        if node.held:
            self.out.append((ENDS, path, None, None, None, None, None, None, None, "".join(node.held), None, self.shard, node.seq))
            node.held, node.size, node.seq = [], 0, node.seq + 1

    def close(self) -> None:
        node, depth = self.open.pop(), len(self.open)
        if node.inside is not None:
            path = "".join(self.path[:depth])
            self.send_ends(node, path)
            if node.convs:
                self.out.append((PARTIAL, path, node.conv, depth, None, node.convs, node.children, node.leaves, node.saved,
                                 None, node.chars, self.shard, None))
                if self.open:
                    self.open[-1].merge(node.conv, node.convs)
            return
        up = self.open[-1]
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.convs - 1) * node.chars
        up.merge(node.conv, node.convs)
        up.children, up.leaves, up.saved = up.children + 1, up.leaves + leaves, up.saved + saved
        self.done[node.slot] = (node.conv, depth, up.slot, node.convs, node.children, leaves, saved, node.ends.hexdigest())
        if up.inside is not None:  # the subtree is complete
            path = "".join(self.path[:depth - 1])
            for conv, d, slot, *rest, ends in self.done:
                parent = self.done[slot][0] if slot >= 0 else None
                self.out.append((FINISHED, None if slot >= 0 else path, conv, d, parent, *rest, ends, None, None, None))
            self.done = []

    def end(self) -> None:
        while self.open:
            self.close()


def _scanned(rows: DataFrame, bounds: list[tuple[str, int]]) -> DataFrame:
    """The shards' nodes, as rows of ``NODES``."""
    trie = trie_of(bounds)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = [bisect_right(bounds, k) for k in zip(b.column(1).to_pylist(), b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], names=["conv_id", "path", "chars", "shard"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, scan = [], None

        def sent() -> pa.RecordBatch:
            found = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), SCHEMA.types)], schema=SCHEMA)
            out.clear()
            return found

        for b in batches:
            for conv, path, chars, shard in zip(*[c.to_pylist() for c in b.columns]):
                if scan is None or scan.shard != shard:
                    if scan:
                        scan.end()
                    scan = Scan(shard, trie, out)
                scan.add(conv, path, chars)
                if len(out) >= OUT_ROWS:
                    yield sent()
        if scan:
            scan.end()
        if out:
            yield sent()

    dealt = rows.select("conv_id", "path", "chars").mapInArrow(deal, "conv_id long, path string, chars array<int>, shard int")
    return (dealt.repartition(len(bounds) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")
            .mapInArrow(work, NODES))


def _ends_digests(found: DataFrame) -> DataFrame:
    """(path, ends_sha256) of skeleton nodes: their pieces, joined in order."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], names=["path", "ends_sha256"])

        for b in batches:
            for path, piece in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if digest is None or path != now:
                    if digest is not None:
                        yield sent()
                    now, digest = path, hashlib.sha256(piece.encode())
                else:
                    digest.update((piece if piece.startswith(",") else "," + piece).encode())
        if digest is not None:
            yield sent()

    pieces = found.filter(F.col("kind") == ENDS).select("path", "shard", "seq", "ends")
    return (pieces.repartition("path").sortWithinPartitions("path", "shard", "seq").select("path", "ends")
            .mapInArrow(work, "path string, ends_sha256 string"))


def _above(path: Column, turns: Column | int) -> Column:
    return F.substring(path, F.lit(1), (F.lit(DIGEST) * turns).cast("int"))


def _skeleton(found: DataFrame) -> DataFrame:
    """The skeleton's nodes with whole aggregates, and their ``path``."""
    part = stage(found.filter(F.col("kind") == PARTIAL).groupBy("path").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("below"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"),
        F.max("chars").alias("chars")), "skeleton")
    inner = part.filter("depth > 0").groupBy(_above(F.col("path"), F.col("depth") - 1).alias("path")).agg(
        F.count("*").alias("inner_children"))
    own = part.join(inner, "path", "left").withColumn("n_children", F.col("below") + F.coalesce("inner_children", F.lit(0)))
    own = own.withColumns({
        "n_leaves": F.when(F.col("n_children") == 0, F.lit(1)).otherwise(F.col("n_leaves")),
        "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars")})
    sums = (own.select("path", F.explode(F.sequence(F.lit(0), F.col("depth").cast("int"))).alias("up"), "n_leaves", "saved_tokens")
            .groupBy(_above(F.col("path"), F.col("up")).alias("path"))
            .agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")))
    parent = part.select(F.col("path").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    up = F.when(F.col("depth") > 0, _above(F.col("path"), F.col("depth") - 1)).alias("up")
    return (own.select("path", "conv_id", "depth", "n_convs", "n_children", up)
            .join(sums, "path").join(parent, "up", "left").join(_ends_digests(found), "path", "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY_SHA))))


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_nodes(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row a node of the trie over ``rows`` (conv_id, path, chars)."""
    rows = stage(rows, "paths")
    convs, turns = rows.agg(F.count("*"), F.coalesce(F.sum(F.size("chars")), F.lit(0))).first()
    shards = max(shuffle_partitions(rows.sparkSession), -(-(convs + turns) // shard_rows))
    found = stage(_scanned(rows, splitters(rows, shards, max(1, convs))), "nodes")
    skeleton = stage(_skeleton(found), "skeleton-nodes")
    parents = skeleton.select("path", F.col("conv_id").alias("above"))
    if parents.count() <= BROADCAST_ROWS:
        parents = F.broadcast(parents)
    finished = found.filter(F.col("kind") == FINISHED).withColumnRenamed("ends", "ends_sha256")
    finished = finished.join(parents, "path", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return finished.select(*COLUMNS).unionByName(skeleton.select(*COLUMNS))


def conversation_trie(turns: DataFrame, **how) -> DataFrame:
    """The nodes of the trie of rebuilt conversations."""
    return trie_nodes(rebuilt(turns), **how)
