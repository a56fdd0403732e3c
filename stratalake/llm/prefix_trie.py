"""The trie of shared conversation prefixes, its subtree totals by time-forward processing.

**Turns.** Turns are put in order by one range-partitioned sort, so that one conversation may be many partitions; a turn's place is its number in
its partition plus the turns of the conversation in earlier ones. Only a digest of role and text goes on. A conversation is
rebuilt from the first turns of its family's first conversation and its own later ones.

**Nodes.** A prefix is told by sums of hashes of (place, role, text), four lanes of 32 bits each, which add up over partitions
and give the parent's sums by subtraction. Rows with the same sums and depth are one node. A node is named by its smallest
member and its depth. Two different prefixes fall together with a chance near ``n ** 2 / 2 ** 128``.

**Totals.** Nodes are dealt into shards (ranges of conversations times blocks of levels). A shard's nodes are sorted by level, the deepest first; a
node takes the messages that its children sent into a priority queue, adds its own share and sends the sum to its parent.
The queue writes sorted runs to disk beyond a size. What a shard sends to others leaves at the roots of its pieces. Pieces nothing was
sent to are done: their messages are added up per target. The others form a much smaller tree of shard roots,
which is solved the same way with coarser shards, up to a single one. Then every shard goes through its nodes again, with all messages from outside.

Null ids take no part; null roles and texts count as empty; null turns come first. Turns of one number are ordered by role and the
md5 of the text; repeated rows are turns of their own. An empty table has no node, not even the root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import struct
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from stratalake.session import Scratch

from .store import column, stored

#: Parameters: nodes of a shard, levels of a block, messages that a queue keeps in memory, and how much coarser each next level's shards are.
SHARD_NODES = 1 << 17
BLOCK_LEVELS = 1 << 16
QUEUE = 1 << 18
COARSER = 16
#: There are never more ranges, so what the driver holds stays small; shards beyond that get larger.
MOST_RANGES = 4096
#: Parents with more than this share of all nodes as children are at most as many, and are broadcast.
HOT_PARENTS = 4096
_LANES = ("s1", "s2", "s3", "s4")
_EMPTY = hashlib.sha256(b"").hexdigest()


# --- turns and nodes ----------------------------------------------------------------------------------------


def rebuilt(conversations: DataFrame, scratch: Scratch, family: int = 5, shared: int = 9) -> tuple[DataFrame, DataFrame]:
    """(``x``, ``part``, ``depth``, ``last``, ``size``, lanes) of every rebuilt turn, and (``x``, ``full``) of every conversation."""
    text = F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("x"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.md5(text).alias("m"), F.octet_length(text).cast("long").alias("size")
    )
    order = ["x", "turn", "role", "m"]
    turns = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    turns = turns.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("i"))
    turns = scratch.save(turns.select("x", "part", "i", "size", F.xxhash64("role", "m").alias("t1"), F.xxhash64(F.lit(1), "m", "role").alias("t2")))

    pieces = turns.groupBy("x", "part").agg(F.min("i").alias("first"), F.count("*").alias("n"))
    length = pieces.groupBy("x").agg(F.sum("n").alias("length"))
    head = F.pmod(F.crc32(F.col("x").cast("string")), F.lit(shared)).alias("head")
    told = length.select("x", "length", head, (F.col("x") - F.col("x") % family).alias("base"))
    told = told.join(length.select(F.col("x").alias("base"), F.col("length").alias("there")), "base", "left")
    kept = F.least(F.col("head"), F.coalesce("there", F.lit(0)))
    full = kept + F.greatest(F.col("length") - F.col("head"), F.lit(0))
    told = scratch.save(told.select("x", "head", "base", kept.alias("kept"), full.alias("full")))

    before = F.coalesce(F.sum("n").over(W.partitionBy("x").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    shift = pieces.select("x", "part", (before - F.col("first") + 1).alias("shift")).join(told, "x")
    placed = turns.join(shift, ["x", "part"]).withColumn("place", F.col("i") + F.col("shift"))
    placed = scratch.save(placed.drop("i", "shift", "base"))
    own = placed.where("place > head").withColumn("depth", F.col("place") - F.col("head") + F.col("kept"))
    # at most ``shared`` - 1 turns of a conversation go to at most ``family`` conversations
    opening = placed.where(F.col("place") < shared).select(F.col("x").alias("base"), F.col("place").alias("depth"), "size", "t1", "t2")
    copies = told.join(opening, "base").where("depth <= kept").withColumn("part", F.lit(-1))
    columns = ["x", "part", "depth", "full", "size", "t1", "t2"]
    rows = own.select(*columns).unionByName(copies.select(*columns))
    g, g2, low = F.xxhash64("t1", "t2", "depth"), F.xxhash64("depth", "t2", "t1"), F.lit(0xFFFFFFFF)
    lanes = {s: v for s, v in zip(_LANES, (g.bitwiseAND(low), F.shiftrightunsigned(g, 32), g2.bitwiseAND(low), F.shiftrightunsigned(g2, 32)), strict=True)}
    rows = rows.select("x", "part", "depth", (F.col("depth") == F.col("full")).alias("last"), "size", *[v.alias(s) for s, v in lanes.items()])
    return scratch.save(rows), told.select("x", "full")


def _key(sums: list[Column], depth: Column) -> tuple[Column, Column]:
    return F.xxhash64(*sums, depth), F.xxhash64(depth, *reversed(sums))


def trie(rows: DataFrame, told: DataFrame, scratch: Scratch) -> DataFrame:
    """(``conv``, ``depth``, ``up``, ``n``, ``children``, ``saved``, ``ends``) of every node; ``up`` names the parent."""
    piece = W.partitionBy("x", "part").orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy("x").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sums = rows.groupBy("x", "part").agg(*[F.sum(s).alias(s) for s in _LANES])
    sums = sums.select("x", "part", *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{s}_before") for s in _LANES])
    run = rows.select("*", *[F.sum(s).over(piece).alias(f"{s}_here") for s in _LANES]).join(sums, ["x", "part"])
    total = [F.col(f"{s}_before") + F.col(f"{s}_here") for s in _LANES]
    k1, k2 = _key(total, F.col("depth"))
    u1, u2 = _key([t - F.col(s) for t, s in zip(total, _LANES, strict=True)], F.col("depth") - 1)
    run = scratch.save(run.select("x", "depth", "last", "size", k1.alias("k1"), k2.alias("k2"), u1.alias("u1"), u2.alias("u2")))

    zero = [F.lit(0).cast("long")] * len(_LANES)
    r1, r2 = _key(zero, F.lit(0).cast("long"))
    none = F.lit(None).cast("long")
    seen = [F.min("x").alias("conv"), F.count("*").alias("n")]
    nodes = run.groupBy("k1", "k2").agg(*seen, F.max("depth").alias("depth"), F.max("size").alias("size"), F.min("u1").alias("u1"), F.min("u2").alias("u2"))
    root = told.agg(*seen).where("n > 0").select(r1.alias("k1"), r2.alias("k2"), "conv", "n", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("size"), none.alias("u1"), none.alias("u2"))
    nodes = scratch.save(nodes.unionByName(root))
    ends = run.where("last").select("k1", "k2", "x").union(told.where("full = 0").select(r1, r2, "x"))
    children = nodes.where("u1 is not null").groupBy(F.col("u1").alias("k1"), F.col("u2").alias("k2")).agg(F.count("*").alias("children"))
    nodes = nodes.join(children, ["k1", "k2"], "left").join(ended(ends), ["k1", "k2"], "left")
    nodes = nodes.fillna({"children": 0, "ends": _EMPTY})
    nodes = scratch.save(nodes.withColumn("saved", (F.col("n") - 1) * F.col("size")).drop("size"))

    # every parent's name: those with very many children are few and broadcast, all others joined
    parents = nodes.select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), F.col("conv").alias("up"), "children")
    many = F.col("children") * HOT_PARENTS > nodes.count()
    hot = nodes.join(F.broadcast(parents.where(many).drop("children")), ["u1", "u2"], "left")
    rest = hot.where("up is null and u1 is not null").drop("up").join(parents.where(~many).drop("children"), ["u1", "u2"])
    out = hot.where("up is not null or u1 is null").unionByName(rest)
    return scratch.save(out.select("conv", "depth", "up", "n", "children", "saved", "ends"))


def ended(ends: DataFrame, at_once: int = 4096) -> DataFrame:
    """(``k1``, ``k2``, ``ends``): sha256 of the comma-joined ids ``x`` of each key, ascending.

    Ids are sorted and written out range by range; only the text of a key's ids, in pieces, goes to one task.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            a, b, x = (column(batch, c).to_numpy() for c in ("k1", "k2", "x"))
            cut = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
            length = np.diff(np.r_[cut, len(a)])
            cut = np.concatenate([np.arange(s, s + n, at_once) for s, n in zip(cut.tolist(), length.tolist(), strict=True)])
            ids = x.tolist()
            joined = [",".join(map(str, ids[s:e])) for s, e in zip(cut.tolist(), [*cut[1:].tolist(), len(ids)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(a[cut]), pa.array(b[cut]), pa.array(x[cut]), pa.array(joined)], names=["k1", "k2", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        for batch in batches:
            for a, b, ids in zip(*(column(batch, c).to_pylist() for c in ("k1", "k2", "ids")), strict=True):
                if (a, b) == key:
                    state.update(b"," + ids.encode())
                else:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (a, b), hashlib.sha256(ids.encode())
            if len(out) >= 10_000:
                yield _batch(out, "k1 k2 ends")
                out = []
        if key is not None:
            out.append((*key, state.hexdigest()))
        if out:
            yield _batch(out, "k1 k2 ends")

    order = ["k1", "k2", "x"]
    found = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(chunks, "k1 long, k2 long, first long, ids string")
    found = found.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").select("k1", "k2", "ids")
    return found.mapInArrow(hashed, "k1 long, k2 long, ends string")


def _batch(rows: list[tuple], names: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=names.split())


# --- time-forward processing ----------------------------------------------------------------------------------


class SpillingQueue:
    """A priority queue of tuples of four longs; beyond ``most`` entries the queue goes to disk as a sorted run.

    The runs are unnamed files of Spark's local folder of this task, gone with it.
    """

    _FORM = struct.Struct("<4q")

    def __init__(self, most: int = QUEUE):
        self.most, self.heap, self.runs, self.spills = most, [], [], 0

    def push(self, entry: tuple) -> None:
        heapq.heappush(self.heap, entry)
        if len(self.heap) > self.most:
            folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
            file = tempfile.TemporaryFile(dir=folder)
            self.heap.sort()
            file.write(b"".join(self._FORM.pack(*e) for e in self.heap))
            file.seek(0)
            self.heap, self.spills = [], self.spills + 1
            self._next(self.spills, file)

    def _next(self, number: int, file) -> None:
        raw = file.read(self._FORM.size)
        if raw:
            heapq.heappush(self.runs, (self._FORM.unpack(raw), number, file))
        else:
            file.close()

    def least(self) -> tuple | None:
        first = self.heap[0] if self.heap else None
        return min(first, self.runs[0][0]) if self.runs and first else self.runs[0][0] if self.runs else first

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] <= self.heap[0]):
            entry, number, file = heapq.heappop(self.runs)
            self._next(number, file)
            return entry
        return heapq.heappop(self.heap)


#: A node of a tree: name, level, piece (nodes of one name and piece hang together), the same of its parent, and its own share.
_TREE = "conv long, depth long, piece long, up long, up_depth long, up_piece long, leaves long, saved long"
_OUT = "kind int, conv long, depth long, to long, to_depth long, leaves long, saved long"
_TOTAL, _SENT, _PIECE = 0, 1, 2


def _dealt(tree: DataFrame, messages: DataFrame | None, splits: np.ndarray, block: int | None) -> DataFrame:
    """Nodes, and messages before the nodes they are for, by shard and then by level, the deepest first."""
    names = [f.split()[0] for f in _TREE.split(", ")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            conv, depth = column(batch, "conv").to_numpy(), column(batch, "depth").to_numpy()
            up, up_depth = (column(batch, c).fill_null(0).to_numpy() for c in ("up", "up_depth"))
            own = np.searchsorted(splits, conv, side="right"), depth // block if block else 0 * depth
            over = np.searchsorted(splits, up, side="right"), up_depth // block if block else 0 * depth
            inside = (own[0] == over[0]) & (own[1] == over[1])
            inside &= column(batch, "up").is_valid().to_numpy(zero_copy_only=False)
            more = [pa.array(own[0].astype(np.int64)), pa.array(own[1].astype(np.int64)), pa.array(inside)]
            yield pa.RecordBatch.from_arrays([*(column(batch, c) for c in names), column(batch, "node"), *more], names=[*names, "node", "band", "block", "inside"])

    rows = tree.select(*names, F.lit(True).alias("node"))
    if messages is not None:
        none = [F.lit(None).cast("long").alias(c) for c in ("piece", "up", "up_depth", "up_piece")]
        rows = rows.unionByName(messages.select(F.col("to").alias("conv"), F.col("to_depth").alias("depth"), *none, "leaves", "saved", F.lit(False).alias("node")))
    rows = rows.mapInArrow(place, f"{_TREE}, node boolean, band long, block long, inside boolean")
    return rows.repartition("band", "block").sortWithinPartitions("band", "block", F.desc("depth"), "conv", "node")


def _forward(final: bool, queue: int):
    """Totals of all nodes (``final``), or what leaves each shard, and the piece's root of every piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, pending, tops, out = None, SpillingQueue(queue), {}, []
        outside = [0, 0]

        def finish() -> None:
            """The root of each piece: its own top, or that of the piece above it in the same shard."""
            roots: dict[tuple, tuple] = {}
            for piece, (depth, above) in sorted(tops.items(), key=lambda item: item[1][0]):
                roots[piece] = (piece[0], depth) if above is None else roots[above]
                out.append((_PIECE, *piece, *roots[piece], 0, 0))
            tops.clear()

        for batch in batches:
            fields = ("band", "block", "conv", "depth", "piece", "up", "up_depth", "up_piece", "leaves", "saved", "node", "inside")
            for band, block, conv, depth, piece, up, up_depth, up_piece, leaves, saved, node, inside in zip(*(column(batch, c).to_pylist() for c in fields), strict=True):
                if (band, block) != shard:
                    if not final:
                        finish()
                    shard = (band, block)
                if not node:
                    outside[0] += leaves
                    outside[1] += saved
                    continue
                leaves, saved = leaves + outside[0], saved + outside[1]
                outside = [0, 0]
                while (first := pending.least()) is not None and first[:2] == (-depth, conv):
                    first = pending.pop()
                    leaves, saved = leaves + first[2], saved + first[3]
                if inside:
                    pending.push((-up_depth, up, leaves, saved))
                if final:
                    out.append((_TOTAL, conv, depth, 0, 0, leaves, saved))
                else:
                    # the last row of a piece is its top
                    tops[conv, piece] = (depth, (up, up_piece) if inside and (up, up_piece) != (conv, piece) else None)
                    if not inside and up is not None:
                        out.append((_SENT, conv, depth, up, up_depth, leaves, saved))
            if len(out) >= 50_000:
                yield _typed(out)
                out = []
        if not final:
            finish()
        if out:
            yield _typed(out)

    return run


def _typed(rows: list[tuple]) -> pa.RecordBatch:
    kind, *rest = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), *(pa.array(c, pa.int64()) for c in rest)], names=[f.split()[0] for f in _OUT.split(", ")])


def totals(tree: DataFrame, splits: np.ndarray, block: int | None, scratch: Scratch, queue: int = QUEUE) -> DataFrame:
    """(``conv``, ``depth``, ``leaves``, ``saved``): the sums over each node's subtree. ``tree`` is stored.

    Shards are the ranges between ``splits`` times blocks of ``block`` levels (None: one).
    """
    messages = None
    if len(splits) or block:
        first = scratch.save(_dealt(tree, None, splits, block).mapInArrow(_forward(False, queue), _OUT))
        sent = first.where(F.col("kind") == _SENT).drop("kind")
        piece = first.where(F.col("kind") == _PIECE).select(F.col("conv").alias("to"), F.col("depth").alias("to_piece"), F.col("to").alias("up"), F.col("to_depth").alias("up_depth"))
        # where messages go: the piece of the node they are for, and that piece's root
        target = tree.select(F.col("up").alias("to"), F.col("up_depth").alias("to_depth"), F.col("up_piece").alias("to_piece")).where("to is not null").distinct()
        target = target.join(sent.select("to", "to_depth").distinct(), ["to", "to_depth"], "left_semi").join(piece, ["to", "to_piece"])
        target = scratch.save(target.select("to", "to_depth", "up", "up_depth"))
        inner = target.select(F.col("up").alias("conv"), F.col("up_depth").alias("depth")).distinct().withColumn("inner", F.lit(True))
        sent = scratch.save(sent.join(inner, ["conv", "depth"], "left"))
        sums = [F.sum(c).alias(c) for c in ("leaves", "saved")]
        messages = sent.where("inner is null").groupBy("to", "to_depth").agg(*sums)
        # the tree of shard roots that got something: what they sent, and what leaves sent to their piece
        came = messages.join(target, ["to", "to_depth"]).groupBy(F.col("up").alias("conv"), F.col("up_depth").alias("depth")).agg(F.sum("leaves").alias("more"), F.sum("saved").alias("more_saved"))
        roots = sent.where("inner").join(came, ["conv", "depth"], "left").join(target, ["to", "to_depth"])
        # a root at depth 0 sends nothing on
        above = F.when(F.col("up_depth") > 0, F.col("up"))
        roots = roots.select(
            "conv", "depth", F.col("depth").alias("piece"), above.alias("up"), "up_depth", F.col("up_depth").alias("up_piece"),
            (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
        )
        roots = scratch.save(roots)
        if not roots.isEmpty():
            coarse = splits[COARSER - 1 :: COARSER]
            deeper = block * COARSER if block and roots.agg(F.max("depth")).first()[0] >= block * COARSER else None
            done = totals(roots, coarse, deeper, scratch, queue)
            late = sent.where("inner").select("conv", "depth", "to", "to_depth").join(done, ["conv", "depth"])
            messages = messages.unionByName(late.groupBy("to", "to_depth").agg(*sums)).groupBy("to", "to_depth").agg(*sums)
        messages = scratch.save(messages)
    found = _dealt(tree, messages, splits, block).mapInArrow(_forward(True, queue), _OUT)
    return scratch.save(found.select("conv", "depth", "leaves", "saved"))


def prefixes(
    conversations: DataFrame, family: int = 5, shared: int = 9, shard_nodes: int = SHARD_NODES, block_levels: int = BLOCK_LEVELS, queue: int = QUEUE
) -> DataFrame:
    """One row per node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    A conversation's first turns, as many as crc32 of its id modulo ``shared``, come from the first of its ``family``.
    """
    spark = conversations.sparkSession
    with Scratch(spark, "trie") as scratch:
        nodes = trie(*rebuilt(conversations, scratch, family, shared), scratch)
        told = nodes.agg(F.count("*"), F.max("depth")).first()
        bands = min(MOST_RANGES, -(-told[0] // shard_nodes))
        splits = nodes.approxQuantile("conv", [i / bands for i in range(1, bands)], 0.1 / bands) if bands > 1 else []
        splits = np.unique(np.array(splits, dtype=np.int64))
        block = block_levels if (told[1] or 0) >= block_levels else None

        def level(depth: Column) -> Column:
            return F.floor(depth / block_levels) if block else F.lit(0).cast("long")

        above = F.col("depth") - 1
        tree = nodes.select(
            "conv", "depth", level(F.col("depth")).alias("piece"), "up", F.when(F.col("up").isNotNull(), above).alias("up_depth"), level(above).alias("up_piece"),
            (F.col("children") == 0).cast("long").alias("leaves"), "saved",
        )
        sums = totals(scratch.save(tree), splits, block, scratch, queue)
        out = nodes.drop("saved").join(sums, ["conv", "depth"])
        return stored(
            out.select(
                F.col("conv").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"),
                F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
            ),
            "prefixes",
        )
