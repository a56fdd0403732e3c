"""Intermediate tables in the shared folder of the cluster, and slices of Arrow batches.

A stored table cuts the lineage: whatever follows starts from files that
outlive executors. Operators keep their own tables in a ``Scratch`` folder, which goes when their
result is stored; the folder of a result stays until the session's owner clears
``spark.checkpoint.dir``, since it is read lazily.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import save_and_read, scratch_path

#: Texts are handled in slices of about so many bytes, which bounds what a Python worker holds.
SLICE_BYTES = 4 << 20
#: And handed to Python in batches of about so many: a batch is held by Spark and by the worker, outside of the heap.
SMALL_BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": str(SLICE_BYTES)}
#: What an execution shuffled goes when it ends, instead of when the driver collects garbage. For frames that are executed once.
FREED_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    For workers on machines that have the same path; elsewhere the package is installed or sent
    with ``--py-files``, and this changes nothing.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def small_batches(spark: SparkSession) -> None:
    """``SMALL_BATCHES`` for results that are read lazily: they stay set, unless the session has its own."""
    for key, value in SMALL_BATCHES.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    return save_and_read(df, scratch_path(df.sparkSession, label))


#: Words of 64 bits in the bitmap that thins out rows before a join: a fixed size, whatever the input's.
BITMAP_WORDS = 1 << 17


def split_few(rows: DataFrame, few: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` that may have a partner in ``few`` on columns ``on``, and those that have none for sure.

    A bitmap of hashes of the wanted keys, of a fixed size, goes to all tasks: only the first need be shuffled. It
    may take rows too many for them; with very many keys it takes all. Columns ``on`` have the same types in both.
    """
    place = F.xxhash64(*on)
    word, bit = F.pmod(place, F.lit(BITMAP_WORDS)), F.pmod(F.shiftright(place, 40), F.lit(64)).cast("int")
    bits = few.select(word.alias("_word"), F.expr("1L").alias("_one"), bit.alias("_bit"))
    bits = bits.groupBy("_word").agg(F.bit_or(F.call_function("shiftleft", "_one", "_bit")).alias("_bits"))
    marked = rows.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(bits), "_word", "left")  # at most BITMAP_WORDS rows
    there = F.coalesce(F.call_function("shiftrightunsigned", "_bits", "_bit").bitwiseAND(F.lit(1)) == 1, F.lit(False))
    may, none = marked.where(there), marked.where(~there)
    return may.drop("_word", "_bit", "_bits"), none.drop("_word", "_bit", "_bits")


def join_few(rows: DataFrame, few: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` joined (inner) with ``few`` on columns ``on``, where most rows of the wide ``rows`` have no partner."""
    return split_few(rows, few, on)[0].join(few, on)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in slices whose texts have about ``most`` bytes (one longer text makes a slice)."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        ends = np.cumsum(sizes, dtype=np.int64)
        lo = 0
        while lo < batch.num_rows:
            base = ends[lo - 1] if lo else 0
            hi = max(int(np.searchsorted(ends, base + most, side="right")), lo + 1)
            yield batch.slice(lo, hi - lo)
            lo = hi


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Flat values cut into lists of the given lengths."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Flat fixed-width values cut into byte strings of the given numbers of values."""
    raw = np.ascontiguousarray(values)
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(np.asarray(counts) * raw.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])


def with_columns(batch: pa.RecordBatch, keep: list[str], more: dict[str, pa.Array]) -> pa.RecordBatch:
    names = [*keep, *more]
    return pa.RecordBatch.from_arrays([*(column(batch, c) for c in keep), *more.values()], names=names)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions starts[i], starts[i] + 1, ... (counts[i] of them) for every i, one after another."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total, dtype=np.int64) + np.repeat(starts - (ends - counts), counts)
