"""Passages that recur across documents: confirmed, compiled into automata, located everywhere.

A window is ``window`` consecutive words of one document. A word is removed if a window covers it whose
words also start in a document with a smaller id.

1. Scan. Every window has an anchor: the smallest hash of the short phrases in it. Equal windows have equal
   anchors, and neighbouring windows mostly share theirs, so a document has few.
2. Confirm. Anchors that occur in documents with different words are kept; of the windows that have
   one, those that start in at least two documents are confirmed, each owned by the smallest id. (A document
   with the words of a smaller one loses all its windows at once and takes no further part.)
3. Compile. Runs of confirmed windows of their owner are passages. Documents in which a confirmed
   window was met are dealt into buckets; every bucket gets the passages of its documents, each once, and
   compiles them into one Aho-Corasick automaton over words. Its patterns are the passages' blocks of half
   a window: every window of a passage holds one of them whole.
4. Locate. The bucket's documents are streamed through its automaton; the windows around each hit
   are looked up among those of the passages, and what they cover is removed if the owner is smaller.

A passage that very many documents share is one row of an aggregate and one pattern of a
bucket, however often it occurs; a bucket has about ``BUCKET_BYTES`` of text. Windows are compared by
64-bit hashes of their words.

Null and empty texts have no words. Rows without an id neither lose words nor take any from others. Rows
with the same id don't take words from each other. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.session import Scratch, settings

from . import words
from .store import FREED_SHUFFLES, SMALL_BATCHES, column, join_few, ragged, split_few, spread, stored, text_slices, with_columns

WINDOW = 50
PHRASE = 8
BUCKET_BYTES = 8 << 20
SLICE = 1 << 20  # bytes of text whose words are hashed at once: their arrays are many times as large
_KEY, _MARK = "_id", "_mark"


def window_starts(first: np.ndarray, window: int) -> np.ndarray:
    """Of the batch's words, those at which a window of their own text starts."""
    counts = np.maximum(np.diff(first) - window + 1, 0)
    return spread(first[:-1], counts)


def anchors(hashes: np.ndarray, window: int, phrase: int) -> np.ndarray:
    """For every ``window`` consecutive words, the smallest hash of a phrase in them."""
    grams = words.gram_hashes(hashes, phrase)
    width = window - phrase + 1
    least, have = grams, 1
    while have * 2 <= width:
        least = np.minimum(least[: len(least) - have], least[have:]) if len(least) > have else least[:0]
        have *= 2
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    return np.minimum(least[:n], least[width - have : width - have + n])


def _fingerprints(found: words.Words, base: int) -> np.ndarray:
    """One hash of all words of each text."""
    n = len(found.hash)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(found.hash * words.powers(base, n), out=sums[1:], dtype=np.uint64)
    down = words.powers(pow(base, -1, 1 << 64), n + 1)
    return words.mix((sums[found.first[1:]] - sums[found.first[:-1]]) * down[found.first[:-1]] + found.count().astype(np.uint64))


def _scan(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """Per row: n_words, two hashes of its words, the sha256 of its words, its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", SLICE):
            found = words.words_of(column(batch, "text"))
            counts = found.count()
            starts = window_starts(found.first, window)
            least = anchors(found.hash, window, phrase)[starts] if len(starts) else np.zeros(0, dtype=np.uint64)
            text = np.repeat(np.arange(len(counts)), np.maximum(counts - window + 1, 0))
            new = np.ones(len(least), dtype=bool)
            new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
            sha = [hashlib.sha256(found.joined(lo, hi)).hexdigest() for lo, hi in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True)]
            more = {
                "n_words": pa.array(counts, pa.int64()),
                "f1": pa.array(words.signed(_fingerprints(found, 0x9E3779B97F4A7C15))),
                "f2": pa.array(words.signed(_fingerprints(found, 0xC2B2AE3D27D4EB4F))),
                "sha": pa.array(sha, pa.string()),
                "anchors": ragged(words.signed(least[new]), np.bincount(text[new], minlength=len(counts)), pa.int64()),
            }
            yield with_columns(batch, [_KEY, _MARK], more)

    return docs.mapInArrow(run, f"{_KEY} long, {_MARK} long, n_words long, f1 long, f2 long, sha string, anchors array<long>")


def _windows(docs: DataFrame, window: int, phrase: int) -> DataFrame:
    """Of each document, the hashes of the windows whose anchor is among its ``anchors``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", SLICE):
            found = words.words_of(column(batch, "text"))
            least, all_windows = anchors(found.hash, window, phrase), words.rolling_hashes(found.hash, window)
            wanted = column(batch, "anchors")
            hashes, counts = [], []
            for i in range(batch.num_rows):
                lo, hi = int(found.first[i]), max(int(found.first[i + 1]) - window + 1, int(found.first[i]))
                own = words.unsigned(np.asarray(wanted[i].values, dtype=np.int64))
                at = np.flatnonzero(np.isin(least[lo:hi], own))
                hashes.append(all_windows[lo + at])
                counts.append(len(at))
            more = {"hashes": ragged(words.signed(np.concatenate(hashes)), np.array(counts), pa.int64())}
            yield with_columns(batch, [_KEY, _MARK, "text"], more)

    return docs.select(_KEY, _MARK, "text", "anchors").mapInArrow(run, f"{_KEY} long, {_MARK} long, text string, hashes array<long>")


def _passages(owners: DataFrame, window: int) -> DataFrame:
    """Runs of consecutive owned windows (column ``owned``) as texts with the hashes of their windows.

    The windows are hashed again from the text, which is less to shuffle than all that the owner had.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", SLICE):
            found = words.words_of(column(batch, "text"))
            all_windows = words.signed(words.rolling_hashes(found.hash, window))
            ids, begins, texts, hashes = [], [], [], []
            for i, owner in enumerate(column(batch, _KEY).to_pylist()):
                lo, hi = int(found.first[i]), max(int(found.first[i + 1]) - window + 1, int(found.first[i]))
                own = all_windows[lo:hi]
                at = np.flatnonzero(np.isin(own, np.asarray(column(batch, "owned")[i].values, dtype=np.int64)))
                cuts = np.flatnonzero(np.diff(at) != 1) + 1
                for s, h in zip(np.split(at, cuts), np.split(own[at], cuts), strict=True):
                    if len(s):
                        ids.append(owner)
                        begins.append(int(s[0]))
                        texts.append(found.joined(lo + int(s[0]), lo + int(s[-1]) + window).decode())
                        hashes.append(h)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(begins, pa.int32()),
                    pa.array(texts, pa.string()),
                    ragged(np.concatenate([np.zeros(0, dtype=np.int64), *hashes]), np.array([len(h) for h in hashes], dtype=np.int64), pa.int64()),
                ],
                names=["owner", "begin", "text", "hashes"],
            )

    return owners.select(_KEY, "text", "owned").mapInArrow(run, "owner long, begin int, text string, hashes array<long>")


def compile_automaton(codes: list[np.ndarray], block: int):
    """An Aho-Corasick automaton over 32-bit word codes, of all whole blocks of the passages."""
    import ahocorasick

    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for own in codes:
        for at in range(0, len(own) - block + 1, block):
            automaton.add_word(tuple(own[at : at + block].tolist()))
    automaton.make_automaton()
    return automaton


def _locate(window: int):
    block = window // 2

    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, passages: pa.Table) -> pa.Table:
        made: dict[str, list] = {_KEY: [], _MARK: [], "n_removed": [], "kept_sha256": [], "begins": [], "ends": []}
        if docs.num_rows and passages.num_rows:
            known = words.words_of(passages.column("text"))
            edges = list(zip(known.first[:-1].tolist(), known.first[1:].tolist(), strict=True))
            codes = (known.hash >> np.uint64(32)).astype(np.uint32)
            automaton = compile_automaton([codes[lo:hi] for lo, hi in edges], block)
            starts = window_starts(known.first, window)
            hashes = words.rolling_hashes(known.hash, window)[starts]
            owner = passages.column("owner").to_numpy()[words.text_numbers(known.first)[starts]]
            order = np.lexsort((owner, hashes))
            hashes, owner = hashes[order], owner[order]
            first = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
            hashes, owner = hashes[first], owner[first]
            found = words.words_of(docs.column("text"))
            codes = (found.hash >> np.uint64(32)).astype(np.uint32)
            rolled = words.rolling_hashes(found.hash, window)
            for i, (doc_id, mark) in enumerate(zip(docs.column(_KEY).to_pylist(), docs.column(_MARK).to_pylist(), strict=True)):
                lo, hi = int(found.first[i]), int(found.first[i + 1])
                n = hi - lo - window + 1
                if n <= 0:
                    continue
                hits = np.fromiter((e for e, _ in automaton.iter(tuple(codes[lo:hi].tolist()))), dtype=np.int64)
                # a hit that ends at word e lies in the windows that start from e - window + 1 to e - block + 1
                marks = np.zeros(n + 1, dtype=np.int64)
                np.add.at(marks, np.clip(hits - window + 1, 0, n), 1)
                np.add.at(marks, np.clip(hits - block + 2, 0, n), -1)
                near = np.flatnonzero(np.cumsum(marks[:-1]) > 0)
                place = np.searchsorted(hashes, rolled[lo + near])
                place = np.minimum(place, len(hashes) - 1)
                gone = near[(hashes[place] == rolled[lo + near]) & (owner[place] < doc_id)]
                if len(gone) == 0:
                    continue
                cover = np.zeros(hi - lo + 1, dtype=np.int64)
                np.add.at(cover, gone, 1)
                np.add.at(cover, gone + window, -1)
                removed = np.cumsum(cover[:-1]) > 0
                kept = lo + np.flatnonzero(~removed)
                text = words.joined(found.data, found.begin[kept], found.end[kept])
                border = np.diff(np.concatenate([[0], removed.astype(np.int8), [0]]))
                for name, value in zip(made, (doc_id, mark, int(removed.sum()), hashlib.sha256(text).hexdigest(), np.flatnonzero(border == 1).tolist(), np.flatnonzero(border == -1).tolist()), strict=True):
                    made[name].append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()), pa.list_(pa.int32()))
        return pa.table({n: pa.array(v, k) for (n, v), k in zip(made.items(), kinds, strict=True)})

    return run


def find(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, id_column: str = "doc_id", text_column: str = "text", bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Per row: the id, ``text_hash``, ``n_words``, ``n_removed``, ``kept_sha256`` (of the kept words joined by one space)
    and the removed ranges of words, ``begins`` (inclusive) and ``ends`` (exclusive).
    """
    with Scratch(docs.sparkSession, "repeats") as scratch, settings(docs.sparkSession, SMALL_BATCHES | FREED_SHUFFLES):
        return stored(_find(docs, window, phrase, id_column, text_column, bucket_bytes, scratch), "repeats")


def _find(docs: DataFrame, window: int, phrase: int, id_column: str, text_column: str, bucket_bytes: int, scratch: Scratch) -> DataFrame:
    rows = docs.select(F.col(id_column).cast("long").alias(_KEY), F.xxhash64(text_column).alias(_MARK), F.col(text_column).alias("text"))
    scan = scratch.save(_scan(rows, window, phrase))
    classes = scan.where(f"{_KEY} is not null and n_words >= {window}").groupBy("f1", "f2", "n_words").agg(F.min(_KEY).alias("leader"))
    # two kinds of documents share an anchor if two hashes of their words do
    met = scan.where(f"{_KEY} is not null").select("f1", F.explode("anchors").alias("anchor"))
    recurring = met.groupBy("anchor").agg(F.min("f1").alias("low"), F.max("f1").alias("high")).where("low <> high").select("anchor")
    leaders = scan.select(_KEY, _MARK, "f1", "f2", "n_words", "anchors").join(classes, ["f1", "f2", "n_words"]).where(F.col(_KEY) == F.col("leader"))
    own = leaders.select(_KEY, _MARK, F.explode(F.array_distinct("anchors")).alias("anchor")).join(recurring, "anchor")
    own = scratch.save(own.groupBy(_KEY, _MARK).agg(F.collect_set("anchor").alias("anchors")))  # no more than the document's words
    near = scratch.save(_windows(join_few(rows, own, [_KEY, _MARK]), window, phrase))
    near = near.where(F.size("hashes") > 0)

    # confirmed windows, each with its owner
    met = near.select(_KEY, F.explode("hashes").alias("hash"))
    confirmed = scratch.save(met.groupBy("hash").agg(F.min(_KEY).alias("owner"), F.max(_KEY).alias("last")).where("owner < last").select("hash", "owner"))
    owned = confirmed.groupBy(F.col("owner").alias(_KEY)).agg(F.collect_list("hash").alias("owned"))
    passages = scratch.save(_passages(join_few(near.select(_KEY, "text"), owned, [_KEY]), window))

    buckets = max(1, -(-(near.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // bucket_bytes))
    bucket = F.pmod(F.xxhash64(_KEY, F.lit(17)), F.lit(buckets)).cast("int").alias("bucket")
    places = near.select(bucket, F.explode("hashes").alias("hash")).distinct()
    wanted = passages.select("owner", "begin", F.explode("hashes").alias("hash")).join(places, "hash").select("owner", "begin", "bucket").distinct()
    sent = passages.select("owner", "begin", "text").join(wanted, ["owner", "begin"])
    found = near.select(_KEY, _MARK, "text", bucket).groupBy("bucket").cogroup(sent.groupBy("bucket"))
    removed = found.applyInArrow(_locate(window), f"{_KEY} long, {_MARK} long, n_removed long, kept_sha256 string, begins array<int>, ends array<int>")
    removed = scratch.save(removed.dropDuplicates([_KEY, _MARK]))

    # rows whose words a smaller id has too lose every window
    full = scan.drop("anchors").join(classes, ["f1", "f2", "n_words"], "left").join(removed, [_KEY, _MARK], "left")
    copied = F.coalesce(F.col(_KEY) > F.col("leader"), F.lit(False))
    none = F.lit([]).cast("array<int>")
    return full.select(
        F.col(_KEY).alias(id_column),
        F.col(_MARK).alias("text_hash"),
        "n_words",
        F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copied, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.when(copied, F.array(F.lit(0))).otherwise(F.coalesce("begins", none)).alias("begins"),
        F.when(copied, F.array(F.col("n_words").cast("int"))).otherwise(F.coalesce("ends", none)).alias("ends"),
    )


def remove(docs: DataFrame, found: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the ranges of words in ``found``: kept words are joined by one space, texts that lose
    nothing stay as they are, and rows that lose all their words are left out."""
    cut = found.where("n_removed > 0").select(id_column, "text_hash", "begins", "ends").dropDuplicates([id_column, "text_hash"])
    cut = cut.withColumnsRenamed({id_column: _KEY, "text_hash": _MARK, "begins": "_begins", "ends": "_ends"})
    marked = docs.withColumn(_MARK, F.xxhash64(text_column)).withColumn(_KEY, F.col(id_column).cast("long"))
    may, whole = split_few(marked, cut, [_KEY, _MARK])
    joined = may.join(cut, [_KEY, _MARK], "left")
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text_column, SLICE):
            found = words.words_of(column(batch, text_column))
            old, begins, ends = column(batch, text_column).to_pylist(), column(batch, "_begins").to_pylist(), column(batch, "_ends").to_pylist()
            texts, stay = [], []
            for i, text in enumerate(old):
                if begins[i] is not None:
                    lo, hi = int(found.first[i]), int(found.first[i + 1])
                    keep = np.ones(hi - lo, dtype=bool)
                    for b, e in zip(begins[i], ends[i], strict=True):
                        keep[b:e] = False
                    at = lo + np.flatnonzero(keep)
                    text = words.joined(found.data, found.begin[at], found.end[at]).decode()
                    if not text:
                        continue
                texts.append(text)
                stay.append(i)
            kept = batch.take(pa.array(stay, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if n == text_column else column(kept, n) for n in names], names=names)

    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == text_column else f for f in docs.schema.fields])
    return joined.select(*names, "_begins", "_ends").mapInArrow(run, schema).union(whole.select(*names))
