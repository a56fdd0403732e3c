"""Sum-of-squares online packing of tokenized documents into fixed windows.

Documents arrive one after another. Of a document longer than the window, full
windows are cut off first. What is left, of length ``s``, goes to the fill
level ``h`` that makes the sum of the squared counts of partially filled
windows smallest: moving one window from level ``h`` to ``h + s`` changes the
sum by ``2 N[h + s] - 2 N[h] + 2`` (a window that gets full leaves the sum, a new one
comes from level 0). The counts ``N`` are one array over the levels.

Every input partition is packed by itself, so nothing is shuffled and no task
depends on another. When a partition ends, or ``MOST_OPEN`` windows are open, the
emptiest open windows are cut to fill the fullest; at most one window of each such
round stays partially filled. The number of open windows bounds the memory.

Null or empty texts have the end id alone. Repeated rows, null or equal ids are
packed as the rows they are. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .chunks import byte_pair
from .store import column, text_slices

MOST_OPEN = 4096
_PART_SHIFT = 36


class Window:
    __slots__ = ("fill", "pieces")

    def __init__(self) -> None:
        self.fill, self.pieces = 0, []

    def add(self, piece: tuple) -> None:
        self.pieces.append(piece)
        self.fill += len(piece[2])


class Packer:
    """Pieces are (document, start in the document, ids); ``closed`` has the windows that are done."""

    def __init__(self, capacity: int, most_open: int = MOST_OPEN):
        self.capacity, self.most_open = capacity, most_open
        self.counts = np.zeros(capacity + 1, dtype=np.int64)
        self.open: list[list[Window]] = [[] for _ in range(capacity)]
        self.n_open = 0
        self.closed: list[Window] = []

    def level_for(self, size: int) -> int:
        """The level whose windows should take ``size`` more ids (0: a new window); ties take the fullest."""
        n = self.counts
        top = self.capacity - size
        after = 2 * n[size : self.capacity + 1] + 1  # what a window at level h + size adds
        after[top] = 0
        change = after[1 : top + 1] - 2 * n[1 : top + 1] + 1
        change[n[1 : top + 1] == 0] = np.iinfo(np.int64).max
        new = int(after[0])
        if top == 0:
            return 0
        best = top - int(np.argmin(change[::-1]))
        return best if change[best - 1] <= new and n[best] > 0 else 0

    def add(self, document, ids: np.ndarray) -> None:
        whole = len(ids) // self.capacity * self.capacity
        for at in range(0, whole, self.capacity):
            window = Window()
            window.add((document, at, ids[at : at + self.capacity]))
            self.closed.append(window)
        rest = ids[whole:]
        if len(rest) == 0:
            return
        level = self.level_for(len(rest))
        if level:
            window = self.open[level].pop()
            self.counts[level] -= 1
            self.n_open -= 1
        else:
            window = Window()
        window.add((document, whole, rest.copy()))
        if window.fill == self.capacity:
            self.closed.append(window)
        else:
            self.open[window.fill].append(window)
            self.counts[window.fill] += 1
            self.n_open += 1
            if self.n_open > self.most_open:
                self.flush()

    def flush(self) -> None:
        """Close all open windows: the emptiest give their pieces, cut where needed, to the fullest."""
        left = [w for level in reversed(self.open) for w in level]
        lo, hi = 0, len(left) - 1
        while lo < hi:
            taker, giver = left[lo], left[hi]
            room = self.capacity - taker.fill
            document, start, ids = giver.pieces.pop()
            taker.add((document, start, ids[:room]))
            giver.fill -= min(room, len(ids))
            if len(ids) > room:
                giver.pieces.append((document, start + room, ids[room:]))
            lo += taker.fill == self.capacity
            hi -= giver.fill == 0
        self.closed.extend(w for w in left[: hi + 1] if w.fill)
        self.open = [[] for _ in range(self.capacity)]
        self.counts[:] = 0
        self.n_open = 0


def pack(
    docs: DataFrame,
    vocabulary: str,
    capacity: int = 2048,
    end_id: int = 1,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per piece: the document's id, ``start``, ``length``, ``ids`` (little-endian unsigned
    32-bit ids), ``doc_tokens``, ``sequence_id`` and ``offset`` in that sequence.

    ``vocabulary`` is the path of a byte-level vocabulary of the tokenizers library; all
    executors need it. Other columns are not read.
    """
    fixed = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType), *T._parse_datatype_string(fixed).fields])
    if len(set(schema.names)) < len(schema.names):
        raise ValueError(f"the id column can't be named {id_column}")

    def rows(done: list[Window], first: int, kind: pa.DataType) -> pa.RecordBatch:
        pieces = [(d, s, ids, first + k) for k, w in enumerate(done) for d, s, ids in w.pieces]
        lengths = np.array([len(p[2]) for p in pieces], dtype=np.int64)
        fills = np.cumsum(lengths) - lengths
        opens = np.repeat([fills[i] for i in np.cumsum([0, *(len(w.pieces) for w in done[:-1])])], [len(w.pieces) for w in done])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([p[0][0] for p in pieces], type=kind),
                pa.array([p[1] for p in pieces], type=pa.int64()),
                pa.array(lengths),
                pa.array([p[2].astype("<u4").tobytes() for p in pieces], type=pa.binary()),
                pa.array([p[0][1] for p in pieces], type=pa.int64()),
                pa.array([p[3] for p in pieces], type=pa.int64()),
                pa.array(fills - opens),
            ],
            names=schema.names,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = byte_pair(vocabulary), Packer(capacity)
        number, kind = TaskContext.get().partitionId() << _PART_SHIFT, None
        for part in text_slices(batches, text_column, 1 << 20):
            kind = column(part, id_column).type
            ids, counts = encoder.encode(column(part, text_column))
            ends = np.cumsum(counts)
            for doc_id, lo, hi in zip(column(part, id_column).to_pylist(), (ends - counts).tolist(), ends.tolist(), strict=True):
                packer.add((doc_id, hi - lo + 1), np.append(ids[lo:hi], np.uint32(end_id)))
                if len(packer.closed) >= 1000:
                    yield rows(packer.closed, number, kind)
                    number += len(packer.closed)
                    packer.closed = []
        packer.flush()
        if packer.closed:
            yield rows(packer.closed, number, kind)

    return docs.select(id_column, text_column).mapInArrow(run, schema)


def sequences(pieces: DataFrame) -> DataFrame:
    """The windows themselves: one row per sequence with its ids as one byte string, and its length.

    A sequence has at most ``capacity`` ids, so each group is small.
    """
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(
        F.expr("cast(sum(length) as long)").alias("length"),
        F.aggregate(parts, F.lit(b""), lambda done, p: F.concat(done, p["ids"])).alias("ids"),
    )
