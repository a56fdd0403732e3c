"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Words are runs of letters, digits and characters beyond ASCII, or runs of other visible ASCII characters. Every word and every
pair of neighbouring words is hashed to one of ``2 ** bits`` coordinates. A text's vector has ``1 + log(count)`` at each coordinate it
meets, scaled to length 1, and a constant. The model is one weight per coordinate; a score is the logistic function of the
sparse dot product of weights and vector, computed for whole batches of whole texts.

Training sees at most ``sample`` labelled documents (those with the smallest hashes of their ids, a documented bound; in all other
respects everything is looked at). They are dealt into ``shards`` by hash. In each round every shard goes through its documents
in hash order, one update after the other, starting from the state of the round before; the shards' states
(two numbers per coordinate, a fixed size) are averaged. Result and order depend on ids and texts only, not on partitions.

Null and empty texts have the constant alone: they get the score of a text that tells nothing. A document's label is that of its id;
where an id has several labels the mean counts (1 from one half on), where it has several texts the smallest text is
learned. Null ids and null labels teach nothing. Repeated rows get equal scores each. Without a single label every score is 0.5. Texts
are taken in slices of some megabytes; one longer text makes a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.session import Scratch

from . import words
from .store import column, text_slices, with_columns

#: Parameters: labelled documents learned from at most, shards, rounds, coordinates (a power of two).
SAMPLE = 32_768
SHARDS = 4
ROUNDS = 5
BITS = 18
#: Parameters of the updates: rate, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 8.0, 1.0, 0.05, 0.01

_CLASS = np.full(256, 2, dtype=np.uint8)
_CLASS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_CLASS[:33] = 0
_CLASS[127] = 0


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each text's coordinates begin (and the last ends), the coordinates and their values; null counts as empty."""
    data, starts = words.text_bytes(texts)
    n = len(starts) - 1
    if len(data) == 0:
        return np.zeros(n + 1, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
    kind = _CLASS[data]
    opens = np.ones(len(data), dtype=bool)
    opens[1:] = kind[1:] != kind[:-1]
    opens[starts[:-1][starts[:-1] < len(data)]] = True
    begin = np.flatnonzero(opens)
    end = np.append(begin[1:], len(data))
    begin, end = begin[kind[begin] > 0], end[kind[begin] > 0]
    text = np.searchsorted(starts, begin, side="right") - 1
    hashes = words._word_hashes(data, begin, end)
    pairs = words.gram_hashes(hashes, 2)
    inside = text[1:] == text[:-1] if len(text) else np.zeros(0, dtype=bool)
    at = np.concatenate([hashes, pairs[inside]]) & np.uint64((1 << bits) - 1)
    key = (np.concatenate([text, text[1:][inside]]) << bits) | at.astype(np.int64)
    key, count = np.unique(key, return_counts=True)
    of, value = key >> bits, 1.0 + np.log(count)
    value /= np.sqrt(np.bincount(of, weights=value * value, minlength=n))[of]
    return np.searchsorted(of, np.arange(n + 1)), key & ((1 << bits) - 1), value


class Leader:
    """The state of the updates; the constant is the last coordinate."""

    def __init__(self, state: np.ndarray, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2):
        self.z, self.n = state[0].copy(), state[1].copy()
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        at, value = np.append(at, len(self.z) - 1), np.append(value, 1.0)
        w, n = self.weights(at), self.n[at]
        slope = (logistic(float(w @ value)) - label) * value
        grown = n + slope * slope
        self.z[at] += slope - (np.sqrt(grown) - np.sqrt(n)) / self.alpha * w
        self.n[at] = grown


def logistic(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -50.0, 50.0)))


def _learner(state: np.ndarray, bits: int):
    """Goes through a stream of shards, each in its order, and sends the state after each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, leader, seen = None, None, 0

        def done() -> pa.RecordBatch:
            raw = np.stack([leader.z, leader.n]).astype(np.float32).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([seen], pa.int64()), pa.array([raw], pa.binary())], names=["shard", "seen", "state"])

        for batch in text_slices(batches, "text"):
            first, at, value = features(column(batch, "text"), bits)
            for i, (own, label) in enumerate(zip(column(batch, "shard").to_pylist(), column(batch, "label").to_pylist(), strict=True)):
                if own != shard:
                    if leader is not None:
                        yield done()
                    shard, leader, seen = own, Leader(state), 0
                leader.learn(at[first[i] : first[i + 1]], value[first[i] : first[i + 1]], label)
                seen += 1
        if leader is not None:
            yield done()

    return run


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_column: str = "doc_id", text_column: str = "text",
    sample: int = SAMPLE, shards: int = SHARDS, rounds: int = ROUNDS, bits: int = BITS,
) -> np.ndarray:
    """Weights of all coordinates and of the constant, from the ids that ``labels`` names."""
    size = (1 << bits) + 1
    draw = F.xxhash64(F.col("id"), F.lit(11))
    known = labels.select(F.col(id_column).alias("id"), F.col(label).alias("label")).where("id is not null and label is not null")
    chosen = known.groupBy("id").agg((F.avg("label") >= 0.5).cast("int").alias("label")).orderBy(draw, "id").limit(sample)
    # at most ``sample`` rows of an id and a label are broadcast
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).join(F.broadcast(chosen), "id")
    rows = rows.groupBy("id", "label").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    rows = rows.select(F.pmod(F.xxhash64(F.col("id"), F.lit(12)), F.lit(shards)).cast("int").alias("shard"), draw.alias("draw"), "id", "label", "text")
    state = np.zeros((2, size))
    with Scratch(docs.sparkSession, "quality") as scratch:
        # the documents are read once; what was drawn from them is small and goes to its shards in each round
        rows = scratch.save(rows)
        for _ in range(rounds):
            dealt = rows.repartition(shards, "shard").sortWithinPartitions("shard", "draw", "id")
            # ``shards`` rows of a fixed size; in the order of the shards, so that sums come out the same each time
            parts = sorted(dealt.mapInArrow(_learner(state, bits), "shard int, seen long, state binary").collect())
            if not parts:
                break
            total = sum(r["seen"] for r in parts)
            state = sum(np.frombuffer(r["state"], dtype=np.float32).reshape(2, size).astype(np.float64) * (r["seen"] / total) for r in parts)
    return Leader(state).weights()


def score(docs: DataFrame, weights: np.ndarray, text_column: str = "text", carry: list[str] | None = None) -> DataFrame:
    """All columns (or those in ``carry``) and ``score``: how likely label 1 is. A column of that name is replaced."""
    keep = [f for f in docs.schema.fields if f.name != "score" and (carry is None or f.name in carry)]
    names = [f.name for f in keep]
    bits = (len(weights) - 1).bit_length() - 1
    model, constant = weights[:-1].astype(np.float32), float(weights[-1])
    text = "_text"
    while text in names:
        text += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, text):
            first, at, value = features(column(batch, text), bits)
            of = np.repeat(np.arange(batch.num_rows), np.diff(first))
            told = np.bincount(of, weights=model[at] * value, minlength=batch.num_rows)
            yield with_columns(batch, names, {"score": pa.array(logistic(told + constant))})

    return docs.select(*names, F.col(text_column).alias(text)).mapInArrow(run, T.StructType([*keep, T.StructField("score", T.DoubleType())]))
