"""N-gram Jaccard join: which documents share at least ``threshold`` per cent of their word shingles.

A document's set has the hashes of its distinct shingles of ``n`` lower-cased words. Sets are joined by
prefixes: if all sets are sorted in one order, two sets that are similar enough share an
element among the first ``size - ceil(t * size) + 1`` of each.

* Rare first. The order is that of a frequency sketch over all documents (``COUNTERS`` counters, a fixed size; it
  decides nothing but the order), so prefixes hold rare shingles and common lines hardly meet.
* Documents with equal sets are one class, named by its smallest id; only classes are joined. Of a class, a task sends
  its prefix once.
* Groups first. Near copies of one document would meet in every list of the join. So classes that agree
  in at least ``AGREE`` of ``KEYS`` minimum hashes with the smallest class that has the same one are verified with
  that class and connected. The join then looks for pairs between different components only: within a component no
  link can change the result.
* Length filter: sizes within the threshold. Positional filter: the elements that two prefixes share, and all
  that can follow, reach the overlap that is needed; and so do the elements of either that are not known, from its
  prefix, to be in no other set. Suffix filter: sets are cut into ranges of
  hashes, and the smaller of the counts in each bounds the overlap.
* In a list of more than ``LONG`` sets, pairs are counted by a product of 0/1 matrices of the sets' tokens of such lists, so
  they don't leave the task once for each of those tokens.
* What is left is verified once per pair, on the sets themselves. They are made again from the texts of the few
  documents that have a candidate, and meet in groups of one document and at most about ``GROUP`` others.

Shingles are compared by 64-bit hashes. Null and empty texts have no set and are linked with nothing;
fewer than ``n`` words make one shingle. Rows without an id have a size and no component. Rows with the
same id count as linked. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.session import Scratch, settings

from . import words
from .components import components
from .store import SMALL_BATCHES, binaries, column, join_few, ragged, spread, stored, text_slices

SHINGLE = 5
THRESHOLD = 75
COUNTERS = 1 << 20
KEYS, AGREE = 8, 3
RANGES = 64
GROUP = 64
LONG = 64
_BLOCK = 1 << 12
_TURNS = np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, KEYS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sets_of(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every text, ascending, one text after another, and their numbers."""
    found = words.words_of(texts, lower=True)
    counts = found.count()
    starts = spread(found.first[:-1], np.maximum(counts - n + 1, 0))
    text = np.repeat(np.arange(len(counts)), np.maximum(counts - n + 1, 0))
    grams = words.gram_hashes(found.hash, n)[starts] if len(starts) else np.zeros(0, dtype=np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < n))
    whole = np.array([words.gram_hashes(found.hash[found.first[i] : found.first[i + 1]], int(counts[i]))[0] ^ np.uint64(counts[i]) for i in short], dtype=np.uint64)
    text, grams = np.concatenate([text, short]), np.concatenate([grams, whole])
    if len(short):
        order = np.argsort(text, kind="stable")
        text, grams = text[order], grams[order]
    else:
        grams = grams.copy()
    sizes = np.bincount(text, minlength=len(counts))
    ends = np.cumsum(sizes)
    for lo, hi in zip((ends - sizes).tolist(), ends.tolist(), strict=True):
        grams[lo:hi].sort()
    new = np.ones(len(grams), dtype=bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    return grams[new], np.bincount(text[new], minlength=len(counts))


def prefix_length(size: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    return size - -(-threshold * size // 100) + 1


def needed(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> np.ndarray:
    """The smallest overlap with which sets of these sizes are linked."""
    return -(-threshold * (a + b) // (100 + threshold))


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values, out=sums[1:], dtype=np.uint64)
    ends = np.cumsum(counts)
    return sums[ends] - sums[ends - counts]


def _class_keys(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return words.signed(words.mix(_sums(words.mix(grams + np.uint64(1)), counts) + counts.astype(np.uint64)))


def _scan(docs: DataFrame, n: int) -> DataFrame:
    """Per row (``kind`` 0) the size, two hashes of the set and its minimum hashes; per task (``kind`` 1) its counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(COUNTERS, dtype=np.uint32)
        shift = np.uint64(64 - COUNTERS.bit_length() + 1)
        for batch in text_slices(batches, "text"):
            grams, counts = sets_of(column(batch, "text"), n)
            counters += np.bincount((grams >> shift).astype(np.int64), minlength=COUNTERS).astype(np.uint32)
            keys = np.zeros((len(counts), KEYS), dtype=np.uint64)
            some = counts > 0
            if some.any():
                firsts = (np.cumsum(counts) - counts)[some]
                for k, turn in enumerate(_TURNS):
                    keys[some, k] = np.minimum.reduceat(grams * turn, firsts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(len(counts), dtype=np.int32)),
                    column(batch, "id"),
                    pa.array(counts, pa.int64()),
                    pa.array(_class_keys(grams, counts)),
                    pa.array(words.signed(_sums(words.mix(grams ^ np.uint64(0xABCDEF)), counts))),
                    ragged(words.signed(keys[some].ravel()), np.where(some, KEYS, 0), pa.int64()),
                    pa.nulls(len(counts), pa.binary()),
                ],
                names=names,
            )
        blocks = np.flatnonzero(counters.reshape(-1, _BLOCK).any(axis=1))
        task = TaskContext.get().partitionId()
        if len(blocks):
            nulls = pa.nulls(len(blocks), pa.int64())
            parts = [
                pa.array(np.ones(len(blocks), dtype=np.int32)),
                pa.array(blocks, pa.int64()),
                pa.array(np.full(len(blocks), task), pa.int64()),
                nulls,
                nulls,
                pa.nulls(len(blocks), pa.list_(pa.int64())),
                pa.array([counters[b * _BLOCK : (b + 1) * _BLOCK].tobytes() for b in blocks.tolist()], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(parts, names=names)

    names = ["kind", "id", "size", "k1", "k2", "keys", "counters"]
    return docs.mapInArrow(run, "kind int, id long, size long, k1 long, k2 long, keys array<long>, counters binary")


def _levels(scan: DataFrame) -> np.ndarray:
    """The rank of each counter: four steps for each doubling of its count. A fixed size, whatever the input's."""

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total = np.zeros(_BLOCK, dtype=np.uint64)
        for raw in table.column("counters"):
            own = np.frombuffer(raw.as_buffer(), dtype=np.uint32 if len(raw.as_buffer()) == 4 * _BLOCK else np.uint64)
            total += own
        return pa.table({"block": [key[0].as_py()], "counters": pa.array([total.tobytes()], pa.binary())})

    parts = scan.where("kind = 1").select(F.col("id").alias("block"), F.pmod("size", F.lit(64)).alias("part"), "counters")
    parts = parts.groupBy("block", "part").applyInArrow(add, "block long, counters binary")
    counts = np.zeros(COUNTERS, dtype=np.uint64)
    for r in parts.groupBy("block").applyInArrow(add, "block long, counters binary").collect():
        counts[r["block"] * _BLOCK : (r["block"] + 1) * _BLOCK] = np.frombuffer(r["counters"], dtype=np.uint64)
    return np.round(4 * np.log2(counts.astype(np.float64) + 1)).astype(np.uint8)


def _prefixes(docs: DataFrame, n: int, threshold: int, levels: np.ndarray) -> DataFrame:
    """(``token``, ``k1``, ``size``) for the prefix of each set, ``size`` negative with its last element; a task sends
    each set once."""
    shift = np.uint64(64 - COUNTERS.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in text_slices(batches, "text"):
            grams, counts = sets_of(column(batch, "text"), n)
            k1 = _class_keys(grams, counts)
            new = np.zeros(len(counts), dtype=bool)
            for i, k in enumerate(k1.tolist()):
                if counts[i] and k not in sent:
                    sent.add(k)
                    new[i] = True
            grams = grams[np.repeat(new, counts)]
            size = counts[new]
            starts, length = np.cumsum(size) - size, prefix_length(size, threshold)
            # by level, then by hash, of which the sets are in order already
            key = levels[(grams >> shift).astype(np.int64)]
            first = [np.zeros(0, dtype=np.int64)]
            for lo, m, few in zip(starts.tolist(), size.tolist(), length.tolist(), strict=True):
                first.append(lo + np.argsort(key[lo : lo + m], kind="stable")[:few])
            first = np.concatenate(first)
            told = np.repeat(size, length)
            told[np.cumsum(length) - 1] *= -1
            yield pa.RecordBatch.from_arrays(
                [pa.array(words.signed(grams[first])), pa.array(np.repeat(k1[new], length)), pa.array(told, pa.int32())],
                names=["token", "k1", "size"],
            )

    return docs.mapInArrow(run, "token long, k1 long, size int")


def _shared(prefixes: DataFrame, levels: np.ndarray) -> DataFrame:
    """The rows of tokens that more than one prefix has, each set once, and the last row of each prefix.

    ``alone`` tells a last row whose token nothing shares; ``end`` is the rank of a last row's token, else -1.
    Streams partitions sorted by token.
    """
    shift = np.uint64(64 - COUNTERS.bit_length() + 1)
    names = ["token", "k1", "size", "alone", "end"]

    def told(token: np.ndarray, k1: np.ndarray, size: np.ndarray, alone: np.ndarray) -> pa.RecordBatch:
        gram = words.unsigned(token)
        rank = levels[(gram >> shift).astype(np.int64)].astype(np.int64) << 55 | (gram >> np.uint64(9)).astype(np.int64)
        return pa.RecordBatch.from_arrays(
            [pa.array(token), pa.array(k1), pa.array(np.abs(size), pa.int32()), pa.array(alone), pa.array(np.where(size < 0, rank, -1))], names=names
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the last row waits for what follows it
        for batch in batches:
            if batch.num_rows == 0:
                continue
            token, k1, size = (column(batch, c).to_numpy() for c in ("token", "k1", "size"))
            joins = False
            if last is not None:
                token, k1, size = (np.concatenate([x, y]) for x, y in zip(last[:3], (token, k1, size), strict=True))
                joins = last[3]  # whether the waiting row's token was seen before it
            same = token[1:] == token[:-1]
            new = np.r_[True, ~same | (k1[1:] != k1[:-1])]
            token, k1, size = token[new], k1[new], size[new]
            same = token[1:] == token[:-1]
            shared = np.r_[joins, same] | np.r_[same, False]
            keep = (shared | (size < 0))[:-1]
            last = token[-1:], k1[-1:], size[-1:], bool(shared[-1])
            if keep.any():
                yield told(token[:-1][keep], k1[:-1][keep], size[:-1][keep], ~shared[:-1][keep])
        if last is not None and (last[3] or last[2][0] < 0):
            yield told(*last[:3], np.array([not last[3]]))

    dealt = prefixes.repartition("token").sortWithinPartitions("token", "k1")
    return dealt.mapInArrow(run, "token long, k1 long, size int, alone boolean, end long")


def _fits(rows: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray, threshold: int) -> np.ndarray:
    """Whether sets at places a and b may be a pair: of different components, by length, and by what they can share.

    Of two sets, let x be the one whose prefix ends first in the order. An element of x's prefix that the other set has
    is in the other's prefix too, so those that no other prefix has are not in it: ``most``, the size of x without
    them, bounds the overlap. ``end`` is where a prefix ends.
    """
    size, most, end = rows["size"], rows["most"], rows["end"]
    low, high = np.minimum(size[a], size[b]).astype(np.int64), np.maximum(size[a], size[b]).astype(np.int64)
    first = np.where(end[a] < end[b], most[a], np.where(end[a] > end[b], most[b], np.maximum(most[a], most[b])))
    return (rows["part"][a] != rows["part"][b]) & (100 * low >= threshold * high) & (first >= needed(low, high, threshold))


def _pairs(rows: dict[str, np.ndarray], a: np.ndarray, b: np.ndarray, shared: np.ndarray) -> pa.RecordBatch:
    k1, size = rows["k1"], rows["size"]
    x, y = np.where(k1[a] < k1[b], a, b), np.where(k1[a] < k1[b], b, a)
    return pa.RecordBatch.from_arrays(
        [pa.array(k1[x]), pa.array(k1[y]), pa.array(size[x], pa.int32()), pa.array(size[y], pa.int32()), pa.array(shared, pa.int32())],
        names=["a", "b", "na", "nb", "shared"],
    )


_PAIRS = "a long, b long, na int, nb int, shared int"
_KNOWN = ["token", "k1", "size", "part", "most", "end"]


def _lists(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Whole lists of a partition sorted by token, some at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        token = column(batch, "token").to_numpy()
        cut = int(np.searchsorted(token, token[-1], side="left"))  # the last one may go on in the next batch
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)]).select(names)
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held).select(names)


def _met(lists: DataFrame, threshold: int) -> DataFrame:
    """Of lists of up to ``LONG`` sets: the pairs that fit, once per token that they share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _lists(batches, _KNOWN):
            rows = {c: table.column(c).to_numpy() for c in _KNOWN}
            token = rows["token"]
            firsts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            lengths = np.diff(np.r_[firsts, len(token)])
            for m in np.unique(lengths[(lengths > 1) & (lengths <= LONG)]).tolist():
                own = firsts[lengths == m]
                i, j = np.triu_indices(m, 1)
                step = max(1, (1 << 18) // len(i))
                for at in range(0, len(own), step):
                    a, b = (own[at : at + step, None] + i).ravel(), (own[at : at + step, None] + j).ravel()
                    keep = _fits(rows, a, b, threshold)
                    if keep.any():
                        yield _pairs(rows, a[keep], b[keep], np.ones(int(keep.sum())))

    return lists.repartition("token").sortWithinPartitions("token", "k1").select(*_KNOWN).mapInArrow(run, _PAIRS)


def _met_in_long(lists: DataFrame, threshold: int) -> DataFrame:
    """Of longer lists: the pairs that fit, each once, with how many such tokens they share.

    Every row has the tokens of its set's prefix that lie in long lists (``tokens``; a prefix bounds them). The
    numbers that pairs share are one product of 0/1 matrices; a pair belongs to the first token that it shares. It
    is dropped here if what it shares, and at most could share in shorter lists and beyond the prefixes, is too little.
    """
    names = [*_KNOWN, "others", "tokens"]

    def of(table: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = {c: table.column(c).to_numpy() for c in names[:-1]}
        if (rows["part"] == rows["part"][0]).all():
            return
        tokens = table.column("tokens").combine_chunks()
        counts = np.diff(tokens.offsets.to_numpy())
        known, place = np.unique(tokens.flatten().to_numpy(), return_inverse=True)
        has = np.zeros((len(counts), len(known)), dtype=np.float32)
        has[np.repeat(np.arange(len(counts)), counts), place] = 1
        before = has[:, known < rows["token"][0]]
        rest = -(-threshold * rows["size"].astype(np.int64) // 100) - 1
        for lo in range(0, len(counts), 256):
            hi = min(lo + 256, len(counts))
            shared, earlier = has[lo:hi] @ has[lo:].T, before[lo:hi] @ before[lo:].T
            i, j = np.nonzero(np.triu(earlier == 0, 1))
            a, b = i + lo, j + lo
            keep = _fits(rows, a, b, threshold)
            a, b, c = a[keep], b[keep], shared[i[keep], j[keep]].astype(np.int64)
            first = np.where(rows["end"][a] < rows["end"][b], rest[a], np.where(rows["end"][a] > rows["end"][b], rest[b], np.maximum(rest[a], rest[b])))
            enough = c + np.minimum(rows["others"][a], rows["others"][b]) + first >= needed(rows["size"][a].astype(np.int64), rows["size"][b].astype(np.int64), threshold)
            if enough.any():
                yield _pairs(rows, a[enough], b[enough], c[enough])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _lists(batches, names):
            token = table.column("token").to_numpy()
            firsts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
            for lo, hi in zip(firsts.tolist(), [*firsts[1:].tolist(), len(token)], strict=True):
                yield from of(table.slice(lo, hi - lo))

    return lists.repartition("token").sortWithinPartitions("token", "k1").select(*names).mapInArrow(run, _PAIRS)


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """(``k1``, ``a``, ``salt``, ``set``: ascending hashes) of leaders' texts.

    Rows whose text has another set (an id that occurs twice) are left out.
    """
    names = ["k1", "a", "salt", "set"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text"):
            grams, counts = sets_of(column(batch, "text"), n)
            out = pa.RecordBatch.from_arrays([*(column(batch, c) for c in names[:3]), binaries(grams, counts)], names=names)
            yield out.filter(pa.array(column(batch, "k1").to_numpy() == _class_keys(grams, counts)))

    return docs.select(*names[:3], "text").mapInArrow(run, "k1 long, a long, salt int, set binary")


def overlap_bound(a: np.ndarray, b: np.ndarray) -> int:
    """Suffix filter: the most that two sets can share, by their counts in the ranges of hashes."""
    counts = [np.diff(np.searchsorted(x, _EDGES), append=len(x)) for x in (a, b)]
    return int(np.minimum(*counts).sum())


_EDGES = np.arange(RANGES, dtype=np.uint64) << np.uint64(58)


def linked(a: np.ndarray, b: np.ndarray, threshold: int = THRESHOLD) -> bool:
    least = -(-threshold * (len(a) + len(b)) // (100 + threshold))
    if min(len(a), len(b)) < least or overlap_bound(a, b) < least:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum()) >= least


def _verified(pairs: DataFrame, rows: DataFrame, named: DataFrame, n: int, threshold: int, scratch: Scratch) -> DataFrame:
    """The pairs (``a``, ``b``) that are linked, by the sets of their texts."""
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).alias("salts"))
    dealt = pairs.join(salts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
    dealt = scratch.save(dealt)
    need = dealt.select(F.col("b").alias("k1"), "a", "salt").union(dealt.select(F.col("a").alias("k1"), "a", "salt").distinct())
    wanted = need.join(named, "k1").select(F.col("leader").alias("id"), "k1", "a", "salt")
    sets = _sets(join_few(rows, wanted, ["id"]), n)

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        hub, names = key[0].as_py(), table.column("k1").to_pylist()
        own = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in table.column("set")]
        found = [k for k, x in zip(names, own, strict=True) if k != hub and hub in names and linked(own[names.index(hub)], x, threshold)]
        return pa.table({"a": pa.array([hub] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return sets.groupBy("a", "salt").applyInArrow(run, "a long, b long").distinct()


def join(docs: DataFrame, n: int = SHINGLE, threshold: int = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: the id, ``n_shingles`` (size of its set) and ``component_id`` (smallest id reachable by links)."""
    with Scratch(docs.sparkSession, "ngram") as scratch, settings(docs.sparkSession, SMALL_BATCHES):
        return stored(_join(docs, n, threshold, id_column, text_column, scratch), "ngram")


def _join(docs: DataFrame, n: int, threshold: int, id_column: str, text_column: str, scratch: Scratch) -> DataFrame:
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    scan = scratch.save(_scan(rows, n))
    own = scan.where("kind = 0").select("id", "size", "k1", "k2", "keys")
    levels = _levels(scan)

    # classes of equal sets, and the document that stands for each
    some = own.where("size > 0 and id is not null")
    classes = some.groupBy("k1", "k2", "size").agg(F.min("id").alias("leader"), F.any_value("keys").alias("keys"))
    classes = scratch.save(classes)

    lists = scratch.save(_shared(_prefixes(rows.where("id is not null"), n, threshold, levels), levels))
    named = classes.select("k1", "leader")

    # near copies: each class with the smallest one of those that share a minimum hash
    keyed = classes.join(lists.where("not alone").select("k1").distinct(), "k1").select("k1", "leader", F.posexplode("keys").alias("place", "key"))
    hubs = keyed.groupBy("place", "key").agg(F.min_by("k1", "leader").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    agree = keyed.join(hubs, ["place", "key"]).where("k1 <> hub").groupBy(F.col("hub").alias("a"), F.col("k1").alias("b")).count().where(f"count >= {AGREE}")
    links = scratch.save(_verified(agree.select("a", "b"), rows, named, n, threshold, scratch))
    parts = components(links, scratch)

    # all pairs between different components
    # per set: its component, its size without the elements of its prefix that nothing shares, the end of its prefix
    shared, end = F.count_if(~F.col("alone")).alias("shared"), F.max("end").alias("end")
    known = lists.groupBy("k1").agg(shared, end, F.first("size").alias("size"))
    known = known.join(parts.withColumnsRenamed({"node": "k1", "component": "part"}), "k1", "left")
    most = F.floor((threshold * F.col("size") + 99) / 100) - 1 + F.col("shared")
    known = known.select("k1", F.coalesce("part", "k1").alias("part"), most.cast("int").alias("most"), "end", "shared")
    common = lists.where("not alone")
    long = common.groupBy("token").count().where(f"count > {LONG}").select("token")
    whole = common.drop("end").join(known, "k1")
    apart = scratch.save(common.drop("end").join(long, "token").join(known, "k1"))  # the rows of long lists
    held = apart.groupBy("k1").agg(F.collect_list("token").alias("tokens"))  # no more than a prefix has
    apart = apart.join(held, "k1").withColumn("others", (F.col("shared") - F.size("tokens")).cast("int"))

    met = _met(whole, threshold).union(_met_in_long(apart, threshold))
    met = met.groupBy("a", "b").agg(F.sum("shared").alias("n"), F.first("na").cast("long").alias("na"), F.first("nb").cast("long").alias("nb"))
    # beyond its prefix a set has ceil(t * size) - 1 elements
    rest = F.floor((threshold * F.greatest("na", "nb") + 99) / 100) - 1
    wanted = F.floor((threshold * (F.col("na") + F.col("nb")) + 99 + threshold) / (100 + threshold))
    met = met.where(F.col("n") + rest >= wanted)
    more = scratch.save(_verified(met.select("a", "b"), rows, named, n, threshold, scratch))

    # from classes to ids; rows with one id and different texts are one node
    edges = links.union(more).join(named.withColumnsRenamed({"k1": "a", "leader": "la"}), "a").join(named.withColumnsRenamed({"k1": "b", "leader": "lb"}), "b")
    edges = edges.select(F.col("la").alias("a"), F.col("lb").alias("b"))
    placed = own.select("id", "size", "k1", "k2").join(classes.select("k1", "k2", "size", "leader"), ["k1", "k2", "size"], "left")
    placed = placed.select("id", F.col("size").alias("n_shingles"), F.when(F.col("id").isNotNull(), F.col("leader")).alias("leader"))
    twice = placed.where("leader is not null").groupBy("id").agg(F.min("leader").alias("a"), F.max("leader").alias("b")).where("a <> b")
    twice = twice.join(placed.where("leader is not null"), "id").select("a", F.col("leader").alias("b"))
    found = components(edges.union(twice), scratch)
    out = placed.join(found.withColumnsRenamed({"node": "leader"}), "leader", "left")
    return out.select(F.col("id").alias(id_column), "n_shingles", F.coalesce("component", "leader", "id").alias("component_id"))
