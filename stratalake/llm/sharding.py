"""Sharding by sampled splitters, in DataFrame operations only.

1. A narrow table of (key, size) is stored for the while; the key is a hash of the text, so equal texts have equal keys.
2. A sample is drawn in which a row's chance grows with its size, and its quantiles are
   the splitters: they cut the keys into ranges of nearly equal bytes.
3. Every record is placed into its range (a binary search over the splitters), and the ranges are
   measured exactly. A range that is overfull, that is, larger than a share of a shard,
   is subdivided: first between its keys, and a key alone that is larger than
   half a shard by a second hash, of the row's id.
4. Ranges go to shards, the largest first, each to the shard with the fewest bytes so far. Slots
   are numbered within each range, and a range starts where the ranges before it in its shard end.

What the driver holds is one number for each range and sub-range, of which there are at most a fixed
number (``MOST_RANGES`` for each shard, and as many parts as overfull ranges need to fit). No step
gathers a shard in one task.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratalake.session import Scratch

#: Ranges for each shard at least and at most, between them one for so many bytes; sampled rows for each range;
#: the largest part of a shard that one range may be.
RANGES = 64
MOST_RANGES = 4096
RANGE_BYTES = 256 << 20
SAMPLES = 32
SHARE = 1 / 32


def _range_of(splitters: list[int], key: str) -> Column:
    """The number of splitters at or below the key, by binary search."""
    steps = [1 << i for i in reversed(range(len(splitters).bit_length()))]
    bounds = F.lit(splitters)

    def step(at: Column, width: Column) -> Column:
        inside = at + width <= len(splitters)
        return F.when(inside & (F.element_at(bounds, F.least(at + width, F.lit(len(splitters)))) <= F.col(key)), at + width).otherwise(at)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step) if splitters else F.lit(0)


def splitters(sizes: DataFrame, total: int, ranges: int, samples: int = SAMPLES) -> list[int]:
    """Key quantiles of a size-weighted sample of (key, tie, size) rows; about ``ranges * samples`` rows are drawn."""
    if total == 0:
        return []
    wanted = ranges * samples
    draw = F.xxhash64("key", "tie", F.lit(11)) / F.lit(2.0**64) + 0.5
    drawn = sizes.where(draw < F.col("size") * (wanted / total))
    # rows larger than one step of the sample stand for as many steps
    weight = F.greatest(F.lit(1), F.round(F.col("size") * (wanted / total))).cast("long")
    points = [i / ranges for i in range(1, ranges)]
    got = drawn.agg(F.percentile("key", F.lit(points), weight).alias("q")).first()["q"] if points else []
    return sorted({max(-(2**63), min(int(x), 2**63 - 1)) for x in got or []})


def shard(docs: DataFrame, shards: int, size: Column, key: Column, tie: Column, ranges: int = RANGES, share: float = SHARE) -> DataFrame:
    """All columns of ``docs``, and ``shard`` (from 0) and ``slot`` (gapless from 0 in each shard).

    ``size`` is the weight of a row, ``key`` a long that equal records share (spread evenly, such as a hash),
    ``tie`` tells rows with the same key apart. Shards get nearly equal sizes; rows with one key stay in one
    shard unless they are larger than half a shard. Null sizes weigh 0, null keys are
    one group, as null ties are. Rows equal in key and tie are told apart by nothing, so their slots among each other are
    arbitrary. Columns of ``docs`` named shard or slot are replaced. An empty table gives an empty result.
    """
    docs = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "slot")))
    own = {"_key": F.coalesce(key, F.lit(0)), "_tie": F.coalesce(F.xxhash64(tie, F.lit(3)), F.lit(0)), "_size": F.coalesce(size, F.lit(0)).cast("long")}
    keyed = docs.withColumns(own)
    with Scratch(docs.sparkSession, "sharding") as scratch:
        narrow = scratch.save(keyed.select(F.col("_key").alias("key"), F.col("_tie").alias("tie"), F.col("_size").alias("size")))
        total = narrow.agg(F.sum("size")).first()[0] or 0
        ranges = min(MOST_RANGES, max(ranges, total // (shards * RANGE_BYTES)))
        bounds = splitters(narrow, total, shards * ranges)
        ranged = narrow.withColumn("range", _range_of(bounds, "key"))
        whole = {r["range"]: r["size"] for r in ranged.groupBy("range").agg(F.sum("size").alias("size")).collect()}
        most = max(1, int(total / shards * share))
        half = max(1, total // (2 * shards))

        # an overfull range is cut at its keys; a key that fills more than half a shard, by the ties
        parts = {r: min(-(-n // most) * 2, 1 << 16) for r, n in whole.items() if n > most}
        pieces = F.coalesce(_lookup(parts, "range"), F.lit(1))
        ranged = ranged.withColumn("part", F.pmod(F.xxhash64("key", F.lit(5)), pieces).cast("int"))
        heavy: dict[int, int] = {}
        if parts:
            large = ranged.where(F.col("range").isin(list(parts))).groupBy("key").agg(F.sum("size").alias("size")).where(F.col("size") > half)
            heavy = {r["key"]: min(-(-r["size"] // most), 1 << 16) for r in large.collect()}  # fewer than two for each shard
        salts = F.coalesce(_lookup(heavy, "key"), F.lit(1))
        ranged = ranged.withColumn("salt", F.when(salts > 1, 1 + F.pmod(F.xxhash64("tie", F.lit(13)), salts)).otherwise(0).cast("int"))
        measured = ranged.groupBy("range", "part", "salt").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()

    place, load, rows = {}, [(0, 0, s) for s in range(shards)], [0] * shards
    heapq.heapify(load)
    for r in sorted(measured, key=lambda r: (-r["size"], r["range"], r["part"], r["salt"])):
        used, n, s = heapq.heappop(load)
        place[r["range"], r["part"], r["salt"]] = (s, rows[s])
        rows[s] += r["n"]
        heapq.heappush(load, (used + r["size"], n + r["n"], s))

    names = {k: i for i, k in enumerate(sorted(place))}
    key_of = {f"{r}/{p}/{s}": i for (r, p, s), i in names.items()}
    ordered = [place[k] for k in sorted(place)] or [(0, 0)]
    out = keyed.withColumn("_range", _range_of(bounds, "_key"))
    out = out.withColumn("_part", F.pmod(F.xxhash64("_key", F.lit(5)), F.coalesce(_lookup(parts, "_range"), F.lit(1))).cast("int"))
    salts = F.coalesce(_lookup(heavy, "_key"), F.lit(1))
    out = out.withColumn("_salt", F.when(salts > 1, 1 + F.pmod(F.xxhash64("_tie", F.lit(13)), salts)).otherwise(0).cast("int"))
    spark = docs.sparkSession
    listed = spark.range(len(ordered)).select(
        F.element_at(F.lit(sorted(key_of, key=key_of.get) or [""]), F.col("id").cast("int") + 1).alias("_bin"),
        F.element_at(F.lit([s for s, _ in ordered]), F.col("id").cast("int") + 1).alias("shard"),
        F.element_at(F.lit([b for _, b in ordered]), F.col("id").cast("int") + 1).cast("long").alias("_first"),
    )
    out = out.withColumn("_bin", F.concat_ws("/", "_range", "_part", "_salt"))
    out = out.join(F.broadcast(listed), "_bin")  # one row for each range: a bounded number
    number = F.row_number().over(W.partitionBy("_bin").orderBy("_key", "_tie"))
    out = out.withColumn("slot", (F.col("_first") + number - 1).cast("long")).withColumn("shard", F.col("shard").cast("int"))
    return out.select(*(F.col(f"`{c}`") for c in docs.columns), "shard", "slot")


def _lookup(values: dict[int, int], column: str) -> Column:
    if not values:
        return F.lit(None).cast("int")
    keys = F.lit(list(values))
    found = F.array_position(keys, F.col(column))
    return F.when(found > 0, F.element_at(F.lit(list(values.values())), F.greatest(found, F.lit(1)).cast("int")))
