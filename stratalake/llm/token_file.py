"""Token ids as directly addressable codes, in a file format of segments.

A segment holds whole documents, about ``segment_tokens`` ids of them. Its ids are cut
into chunks of eight bits. Level 0 has the lowest chunk of every id, level 1 the next
chunk of those ids that need one, and so on. A bitmap beside each level marks the ids that
go on, and a rank directory has the number of marks before every 512th bit: the
place of an id on the next level is the rank of its bit. So any id is found by a few
look-ups, and nothing else is decoded.

Layout of a payload (little-endian): ``DAC1``, levels (uint32), ids (uint64); for each level
its number of chunks (uint64), the chunks, the bitmap (padded to whole directory blocks of 64
bytes) and the directory (uint32 for each block).

The file is a Parquet table of segments (columns ``part``, ``seq``, ``first``, ``n_tokens``,
``doc_ids``, ``lengths``, ``payload``), written uncompressed by Spark's committer, so a lost
executor leaves no half segment. Parts follow each other in the order of the ids;
``first`` is the place of the segment in its part.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunks import byte_pair
from .store import binaries, column, ragged, text_slices

MAGIC = b"DAC1"
_BLOCK = 512


def encode(ids: np.ndarray) -> bytes:
    """Unsigned 32-bit ids as a payload."""
    rest = np.asarray(ids, dtype=np.uint32)
    levels = []
    while True:
        chunk, rest = (rest & 0xFF).astype(np.uint8), rest >> np.uint32(8)
        goes_on = rest > 0
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.concatenate([bits, np.zeros(-len(bits) % (_BLOCK // 8), dtype=np.uint8)])
        marks = np.bitwise_count(bits).reshape(-1, _BLOCK // 8).sum(axis=1, dtype=np.uint32)
        ranks = (np.cumsum(marks, dtype=np.uint32) - marks).astype("<u4")
        levels.append(struct.pack("<Q", len(chunk)) + chunk.tobytes() + bits.tobytes() + ranks.tobytes())
        rest = rest[goes_on]
        if len(rest) == 0:
            break
    return MAGIC + struct.pack("<IQ", len(levels), len(ids)) + b"".join(levels)


class Codes:
    """A payload, read in place."""

    def __init__(self, payload: bytes):
        if payload[:4] != MAGIC:
            raise ValueError("not a payload of this format")
        count, self.n = struct.unpack_from("<IQ", payload, 4)
        self.levels, at = [], 16
        for _ in range(count):
            (n,) = struct.unpack_from("<Q", payload, at)
            blocks = -(-(-(-n // 8)) // (_BLOCK // 8))
            chunk = np.frombuffer(payload, np.uint8, n, at + 8)
            bits = np.frombuffer(payload, np.uint8, blocks * (_BLOCK // 8), at + 8 + n)
            ranks = np.frombuffer(payload, "<u4", blocks, at + 8 + n + len(bits))
            self.levels.append((chunk, bits, ranks))
            at += 8 + n + len(bits) + 4 * blocks

    def at(self, places: np.ndarray) -> np.ndarray:
        """The ids at the given places."""
        place = np.asarray(places, dtype=np.int64)
        if len(place) and (place.min() < 0 or place.max() >= self.n):
            raise IndexError("no id at this place")
        out = np.zeros(len(place), dtype=np.uint32)
        alive = np.arange(len(place))
        for k, (chunk, bits, ranks) in enumerate(self.levels):
            out[alive] |= chunk[place].astype(np.uint32) << np.uint32(8 * k)
            goes_on = (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            alive, place = alive[goes_on], place[goes_on]
            if len(place) == 0:
                break
            block = place // _BLOCK
            inside = np.bitwise_count(bits.reshape(-1, _BLOCK // 8)[block] & _BELOW[place % _BLOCK]).sum(axis=1, dtype=np.int64)
            place = ranks[block].astype(np.int64) + inside
        return out

    def all(self) -> np.ndarray:
        """All ids, in order."""
        out = np.zeros(self.n, dtype=np.uint32)
        alive = slice(None)
        for k, (chunk, bits, _) in enumerate(self.levels):
            if k == 0:
                out[:] = chunk
                here = np.flatnonzero(np.unpackbits(bits, count=len(chunk), bitorder="little"))
                alive = here
                continue
            out[alive] |= chunk.astype(np.uint32) << np.uint32(8 * k)
            alive = alive[np.flatnonzero(np.unpackbits(bits, count=len(chunk), bitorder="little"))]
        return out


#: For each place in a block, the bits before it.
_BELOW = np.packbits(np.tril(np.ones((_BLOCK, _BLOCK), dtype=np.uint8), -1), axis=1, bitorder="little")


def write(
    docs: DataFrame,
    path: str,
    vocabulary: str,
    end_id: int = 2,
    segment_tokens: int = 1 << 20,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> None:
    """Tokenize all texts, append ``end_id`` to each, and write them in the order of their ids to ``path``.

    Null texts count as empty. Null ids come first; rows with equal ids are ordered by a hash of
    their text, so many of them are no single task. Repeated rows are written as often as
    they occur. An empty table gives an empty file.
    """
    kind = docs.schema[id_column].dataType
    schema = T.StructType(
        [
            *T._parse_datatype_string("part int, seq int, first long, n_tokens long").fields,
            T.StructField("doc_ids", T.ArrayType(kind)),
            *T._parse_datatype_string("lengths array<int>, payload binary").fields,
        ]
    )

    def segment(seq: int, first: int, held: list) -> pa.RecordBatch:
        ids = np.concatenate([x for _, x, _ in held])
        lengths = np.concatenate([n for _, _, n in held])
        names = pa.concat_arrays([d for d, _, _ in held])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([TaskContext.get().partitionId()], pa.int32()),
                pa.array([seq], pa.int32()),
                pa.array([first], pa.int64()),
                pa.array([len(ids)], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                ragged(lengths.astype(np.int32), np.array([len(lengths)]), pa.int32()),
                pa.array([encode(ids)], pa.binary()),
            ],
            names=schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_pair(vocabulary)
        seq, first, held, size = 0, 0, [], 0
        for part in text_slices(batches, text_column, 1 << 20):
            ids, counts = encoder.encode(column(part, text_column))
            # the end id goes in behind each document
            ids = np.insert(ids, np.cumsum(counts), np.uint32(end_id))
            held.append((column(part, id_column), ids, counts + 1))
            size += len(ids)
            if size >= segment_tokens:
                yield segment(seq, first, held)
                seq, first, held, size = seq + 1, first + size, [], 0
        if held:
            yield segment(seq, first, held)

    tie = F.xxhash64(text_column)
    ordered = docs.select(id_column, text_column).repartitionByRange(F.col(id_column), tie).sortWithinPartitions(F.col(id_column), tie)
    ordered.mapInArrow(run, schema).write.option("compression", "uncompressed").parquet(path)


def _bases(segments: DataFrame) -> dict[int, int]:
    """Where each part starts. One number for each part, of which there are as many as shuffle partitions."""
    totals = segments.groupBy("part").agg(F.max(F.col("first") + F.col("n_tokens")).alias("n")).collect()
    out, at = {}, 0
    for part, n in sorted((r["part"], r["n"]) for r in totals):
        out[part], at = at, at + n
    return out


def read(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """One row per document: its id, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids``
    (little-endian unsigned 32-bit), all from the file."""
    segments = spark.read.parquet(path)
    bases = _bases(segments)
    kind = segments.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField(id_column, kind), *T._parse_datatype_string("start long, n_tokens long, ids binary").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                ids = Codes(column(one, "payload")[0].as_py()).all()
                lengths = np.asarray(column(one, "lengths")[0].values, dtype=np.int64)
                start = bases[column(one, "part")[0].as_py()] + column(one, "first")[0].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        column(one, "doc_ids")[0].values,
                        pa.array(start + np.cumsum(lengths) - lengths),
                        pa.array(lengths),
                        binaries(ids.astype("<u4"), lengths),
                    ],
                    names=schema.names,
                )

    return segments.select("part", "first", "doc_ids", "lengths", "payload").mapInArrow(run, schema)


def tokens_at(spark: SparkSession, path: str, places: DataFrame) -> DataFrame:
    """The ids at places (column ``place``, counted over the whole file): rows (place, id).

    Places outside the file are left out. Segments are found by an equi-join on blocks of
    2**20 places that the segment covers, and only their payloads are touched.
    """
    segments = spark.read.parquet(path)
    bases = _bases(segments)
    block = 1 << 20
    base = F.create_map(*[F.lit(x) for item in (bases or {-1: 0}).items() for x in item])[F.col("part")]
    found = segments.select("payload", "n_tokens", (base + F.col("first")).alias("begin"))
    found = found.withColumn("block", F.explode(F.sequence(F.floor(F.col("begin") / block), F.floor((F.col("begin") + F.col("n_tokens") - 1) / block))))
    asked = places.select("place").withColumn("block", F.floor(F.col("place") / block))
    pairs = found.join(asked, "block").where("place >= begin and place < begin + n_tokens")

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        wanted = table.column("place").to_numpy() - key[0].as_py()
        got = Codes(table.column("payload")[0].as_py()).at(wanted)
        return pa.table({"place": table.column("place"), "id": pa.array(got.astype(np.int64))})

    return pairs.groupBy("begin").applyInArrow(run, "place long, id long")
