"""The job of one batch: bronze -> silver -> gold.

Everything a run would change is computed and stored aside first, then all gates are held against
it, and only then the tables are replaced, one after the other. A run that a gate
refuses leaves silver and gold as they were. A replay of a run changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.composite import composite, coverage_ratio, minmax_norm, pivot_norms, weighted_channels
from ..operators.dedup import append_then_dedup, latest_wins
from ..operators.joins import null_safe_join
from ..operators.merge import scd2_as_of, scd2_step, upsert
from ..operators.quality import GateError, enforce, history_report, interval_report, range_checks, row_report
from ..operators.rolling import add_rolling, refresh_changed
from ..operators.standardize import standardize, with_history_columns, with_lineage, with_month_partition
from ..session import Scratch
from ..sources import tables
from ..sources.bronze import CORRUPT, MEMBERS, scan_bronze
from .manifest import manifest_gate
from .registry import METADATA, DatasetSpec, IndexSpec, find


@dataclass(frozen=True)
class Run:
    """What a scheduler hands to a job. ``as_of`` is the one clock of the run."""

    run_id: str
    as_of: str
    dag_id: str = ""
    record_count: int | None = None
    require_newer: bool = False


@dataclass(frozen=True)
class Layers:
    """Database names, so several environments can share a catalog."""

    silver: str = "silver"
    gold: str = "gold"
    ops: str = "ops"
    provider: str = "parquet"
    location: str | None = None


# ``run`` is dataset@run_id, the partition that a replay replaces
_QUARANTINE = {"line": "string", "run_id": "string", "dataset": "string", "run": "string"}
_RUNS = {
    "run_id": "string",
    "dag_id": "string",
    "dataset": "string",
    "as_of": "timestamp",
    "status": "string",
    "problem": "string",
    "keys": "array<string>",
    "bronze_rows": "bigint",
    "quarantined": "bigint",
    "batch_rows": "bigint",
    "cast_failures": "map<string,bigint>",
    "run": "string",
}

# Versioned tables have a second level of partitions: current rows are in one, what a run closed is in one of its own
CLOSED_BY = "closed_by"
CURRENT = "current"

_CHANGES = {"name": "string", "as_of": "timestamp", "value": "string", "run": "string"}


@dataclass
class Outcome:
    """What a run found, for the log."""

    keys: Sequence[str] = ()
    bronze_rows: int = 0
    quarantined: int = 0
    batch_rows: int = 0
    cast_failures: dict[str, int] = field(default_factory=dict)


class Publications:
    """Stored results that wait until all gates are passed."""

    def __init__(self, spark: SparkSession, scratch: Scratch, layers: Layers):
        self.spark, self.scratch, self.layers = spark, scratch, layers
        self.waiting: list[tuple[str, DataFrame, str | Sequence[str], list]] = []

    def table(self, name: str, columns: dict[str, str], partition: str | Sequence[str] | None) -> DataFrame:
        tables.create_table(self.spark, name, columns, partition, self.layers.provider, self.layers.location)
        return self.spark.table(name)

    def replace(self, name: str, rows: DataFrame, partition: str | Sequence[str], gone: list | None = None) -> None:
        """``rows`` (stored) will replace their partitions of a table; partitions ``gone`` have no rows any more."""
        self.waiting.append((name, rows, partition, gone or []))

    def after(self, name: str, rows: DataFrame, partition: str, gone: DataFrame | None = None) -> DataFrame:
        """The table as it will be: the partitions of ``rows`` (and those in ``gone``) from there, the others as they are."""
        seen = rows.select(partition).distinct()
        if gone is not None:
            seen = seen.union(gone.select(partition)).distinct()
        old = self.spark.table(name)
        return null_safe_join(old, seen, [partition], "left_anti").unionByName(rows.select(*old.columns))

    def publish(self) -> None:
        for name, rows, partition, gone in self.waiting:
            tables.publish_partitions(rows, name, partition)
            tables.drop_partitions(self.spark, name, partition, gone)
        self.waiting = []


# --- from bronze to a batch ------------------------------------------------------------------------


def _finite(number: Column) -> Column:
    """The number, or NULL where it is none or has no end."""
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def standardized(bronze: DataFrame, spec: DatasetSpec, run: Run, keep: Sequence[str] = ()) -> DataFrame:
    """Typed silver rows of a batch, not yet deduplicated, and columns to ``keep`` behind them.

    Numbers that are not finite become NULL, as other values that don't convert.
    """
    df = standardize(bronze, {**spec.columns, **METADATA}, spec.renames, keep)
    df = df.withColumns({c: _finite(F.col(c)) for c, dtype in spec.columns.items() if dtype == "double"})
    if spec.month_of:
        df = with_month_partition(df, spec.month_of)
    if spec.style == "scd2":
        df = with_history_columns(df, spec.hash_columns, run.as_of)
    return with_lineage(df, run.dag_id, run.run_id, run.as_of).select(*spec.silver_columns, *keep)


def index_scores(current: DataFrame, index: IndexSpec) -> DataFrame:
    """Channel scores, coverage and the index per (country, year) from current indicator rows."""
    rows = current.where(F.col("indicator").isin(index.indicators)).select(
        "indicator", "country", "year", "value"
    )
    wide = pivot_norms(minmax_norm(rows, directions=index.directions), index.indicators)
    scores = weighted_channels(wide, index.channels, index.missing)
    return scores.withColumn("coverage_ratio", coverage_ratio(index.indicators)).withColumn(
        index.name, composite(index.weights)
    )


_RAW = "_raw_"
#: What is told about a row, one bit each, in whole numbers of so many bits.
_TOLD, _BITS = "_told_", 62


def _staged_bronze(bronze: DataFrame, spec: DatasetSpec, run: Run, scratch: Scratch) -> tuple[DataFrame, dict]:
    """Typed rows and malformed lines, stored by one pass, and counts of what the gates ask for.

    What takes the line itself to tell is stored beside the row, as bits of a number; the counts read that number and the keys.
    """
    back = {new: old for old, new in spec.renames.items()}
    kept = [c for c in (CORRUPT, MEMBERS) if c in bronze.columns]
    told = {c: back[c] if back.get(c) in bronze.columns else c for c in spec.columns}
    told = {c: old for c, old in told.items() if old in bronze.columns}
    raw = {c: f"{_RAW}{c}" for c in told}
    carried = bronze.select("*", *[F.col(told[c]).alias(raw[c]) for c in told])
    rows = standardized(carried, spec, run, [*kept, *raw.values()])

    good = F.col(CORRUPT).isNull() if CORRUPT in kept else F.lit(True)
    counts = [F.count_if(good).alias("good"), F.count_if(~good).alias("bad")]
    counts += [F.count_if(good & F.col(k).isNull()).alias(f"null {k}") for k in spec.keys]
    flags = {f"failed {c}": F.col(raw[c]).isNotNull() & F.col(c).isNull() for c in told}
    required = [back.get(c, c) for c in spec.required]
    named = [c for c in required if c not in bronze.columns or c in spec.bronze_columns] if MEMBERS in kept else []
    flags |= {f"has {c}": F.col(MEMBERS).isNull() | F.array_contains(MEMBERS, c) for c in named}

    places = {flag: (f"{_TOLD}{i // _BITS}", 1 << i % _BITS) for i, flag in enumerate(flags)}
    words = {}
    for flag, (word, bit) in places.items():
        words[word] = words.get(word, F.lit(0)) + F.when(flags[flag], F.lit(bit)).otherwise(F.lit(0)).cast("bigint")
    stored = scratch.save(rows.withColumns(words).drop(MEMBERS, *raw.values()))
    counts += [F.count_if(good & (F.col(word).bitwiseAND(F.lit(bit)) != 0)).alias(flag) for flag, (word, bit) in places.items()]
    found = stored.agg(*counts).first().asDict()
    stored = stored.drop(*words)
    if MEMBERS in kept:
        # folders above the objects give columns too; their values are in the rows
        folders = [c for c in named if found[f"has {c}"] == 0 and c in METADATA and c in bronze.columns]
        present = {c for c in folders if not stored.where(F.col(c).isNotNull()).isEmpty()}
        found["absent"] = [c for c in named if found[f"has {c}"] == 0 and c not in present]
    else:
        found["absent"] = [c for c in required if c not in bronze.columns and spec.renames.get(c, c) not in bronze.columns]
    return stored, found


def _gate_bronze(found: dict, spec: DatasetSpec, run: Run) -> None:
    """The batch is not empty, as complete as announced, has its columns and keys."""
    if found["good"] == 0:
        raise GateError(f"{spec.name}: no records")
    total = found["good"] + found["bad"]
    if run.record_count is not None and total != run.record_count:
        raise GateError(f"{spec.name}: manifest announced {run.record_count} records, found {total}")
    if found["absent"]:
        raise GateError(f"{spec.name}: missing columns {sorted(found['absent'])}")
    unknown = {f"{k}_present": found[f"null {k}"] for k in spec.keys if found[f"null {k}"]}
    if unknown:
        raise GateError(f"{spec.name} batch: {unknown}")


# --- staging ------------------------------------------------------------------------------------------


def _stage_silver(batch: DataFrame, spec: DatasetSpec, run: Run, layers: Layers, out: Publications) -> DataFrame:
    """The rows of the silver table that the batch replaces: the partitions it touches, as they will be."""
    if spec.style == "scd2":
        return _stage_versions(batch, spec, run, layers, out)
    name = spec.table(layers.silver, "clean")
    stored = out.table(name, spec.silver_columns, spec.partition)
    merged = out.scratch.save(append_then_dedup(tables.touched(stored, batch, spec.partition), batch, spec.keys))
    out.replace(name, merged, spec.partition)
    return merged


def _version_levels(spec: DatasetSpec) -> list[str]:
    return [spec.partition, CLOSED_BY]


def _stage_versions(batch: DataFrame, spec: DatasetSpec, run: Run, layers: Layers, out: Publications) -> DataFrame:
    """The current rows of the touched partitions as they will be, and what the run closes.

    What earlier runs closed is neither shuffled nor written again. It is read for the gates only: for the time of stored versions, and all
    versions of those keys of which the run closes one. What an earlier try of the same run closed stays, unless the run closes it anew.
    """
    name = spec.table(layers.silver, "clean")
    stored = out.table(name, spec.silver_columns | {CLOSED_BY: "string"}, _version_levels(spec))
    target = tables.touched(stored, batch, spec.partition)
    at = F.lit(run.as_of).cast("timestamp")
    if not target.where(F.greatest("effective_from", "effective_to") > at).limit(1).isEmpty():
        raise GateError(f"{name}: the run's time {run.as_of} is before that of a stored version")
    own = _key(spec, run)
    step = scd2_step(target.where(F.col(CLOSED_BY) == CURRENT).drop(CLOSED_BY), batch, spec.keys, run.require_newer)
    step = out.scratch.save(step.withColumn(CLOSED_BY, F.when(F.col("is_current"), CURRENT).otherwise(own)))
    ended = step.where(F.col(CLOSED_BY) == own)
    if ended.limit(1).isEmpty():
        merged = checked = step
    else:
        past = target.where(F.col(CLOSED_BY) != CURRENT)
        version = [*spec.keys, "effective_from"]
        before = null_safe_join(past.where(F.col(CLOSED_BY) == own), ended, version, "left_anti")
        others = null_safe_join(past.where(F.col(CLOSED_BY) != own), ended, spec.keys, "left_semi")
        merged = out.scratch.save(step.unionByName(before))
        checked = merged.unionByName(others)
    enforce(history_report(checked, spec.keys), name)
    enforce(interval_report(checked, spec.keys), name)
    out.replace(name, merged, _version_levels(spec))
    return merged


def _stage_fact(merged: DataFrame, batch: DataFrame, spec: DatasetSpec, run: Run, layers: Layers, out: Publications) -> DataFrame:
    """The touched partitions of the fact: upserted with the rows of the batch's keys, or made of silver anew."""
    name = spec.table(layers.gold, "fact")
    stored = out.table(name, spec.fact_columns, spec.partition)
    current = merged.where("is_current") if spec.style == "scd2" else merged
    if spec.fact_style == "upsert":
        target = tables.touched(stored, batch, spec.partition)
        changed = null_safe_join(current, batch.select(*spec.keys), spec.keys, "left_semi")
        rows = upsert(target, changed.select(*spec.fact), spec.keys, spec.fact_update, "processed_at", run.as_of)
    else:
        rows = current.select(*spec.fact_columns)
    rows = out.scratch.save(rows.select(*spec.fact_columns))
    out.replace(name, rows, spec.partition)
    return out.after(name, rows, spec.partition)


def _stamped(df: DataFrame, as_of: str) -> DataFrame:
    return df.withColumn("processed_at", F.lit(as_of).cast("timestamp"))


def _metric_columns(spec: DatasetSpec) -> dict[str, str]:
    own = ["daily_return", *[f"ma_{n}_{spec.rolling.value}" for n in spec.rolling.means], f"volatility_{spec.rolling.volatility}"]
    return spec.fact_columns | dict.fromkeys(own, "double")


#: The last rows of entities are dealt into so many partitions by the hash of the entity.
TAIL_BUCKETS = 64


def _bucket(entity: str) -> Column:
    return F.format_string("%02d", F.pmod(F.xxhash64(F.col(entity)), F.lit(TAIL_BUCKETS))).alias("part")



def _stage_metrics(
    changed: DataFrame, fact: DataFrame, spec: DatasetSpec, as_of: str, layers: Layers, out: Publications, know_tails: bool = True
) -> None:
    """Metrics of the rows that depend on changed ones; all others of their partitions are carried over.

    The table of tails keeps the last rows of each entity, so that a run at the end of the series
    reads no older partition. It is dealt into buckets of entities: a run reads and replaces those of its own entities.
    """
    rolling, name, tail_name = spec.rolling, spec.table(layers.gold, "metrics"), spec.table(layers.gold, "tails")
    columns = _metric_columns(spec)
    stored = out.table(name, columns, spec.partition)
    held = out.table(tail_name, spec.fact_columns | {"part": "string"}, "part")
    buckets = changed.select(_bucket(rolling.entity)).distinct()
    own = tables.touched(held, buckets, "part").drop("part")
    tails = own if know_tails and not held.isEmpty() else None
    metrics, ends = refresh_changed(fact, changed, rolling, tails)
    metrics = out.scratch.save(_stamped(metrics, as_of).select(*columns))
    touched = metrics.select(spec.partition).union(changed.select(spec.partition)).distinct()
    # rows whose metrics stay: neither recomputed nor gone
    others = null_safe_join(tables.touched(stored, touched, spec.partition), metrics, [rolling.entity, *rolling.sort], "left_anti")
    there = null_safe_join(fact, touched, [spec.partition], "left_semi")
    others = null_safe_join(others, there, [rolling.entity, *rolling.sort], "left_semi")
    rows = out.scratch.save(metrics.unionByName(others.select(*columns)))
    empty = null_safe_join(touched, rows, [spec.partition], "left_anti")
    out.replace(name, rows, spec.partition, [r[0] for r in empty.collect()])

    # the entities of the batch get new tails, all others of their buckets keep theirs
    kept = null_safe_join(own, changed.select(rolling.entity).distinct(), [rolling.entity], "left_anti")
    new = out.scratch.save(kept.unionByName(ends.select(*own.columns)).withColumn("part", _bucket(rolling.entity)))
    out.replace(tail_name, new, "part", [r[0] for r in null_safe_join(buckets, new, ["part"], "left_anti").collect()])


def _stage_index(silver: DataFrame, years: DataFrame, spec: DatasetSpec, as_of: str, layers: Layers, out: Publications) -> None:
    """Scores and index of the given years; a year's extremes depend on that year only."""
    current = null_safe_join(silver.where("is_current"), years, ["year"], "left_semi")
    scores = out.scratch.save(_stamped(index_scores(current, spec.index), as_of))
    enforce(row_report(scores, range_checks(scores), non_empty=False), f"{spec.name} scores")
    gone = [r[0] for r in null_safe_join(years, scores, ["year"], "left_anti").collect()]
    for suffix, values in (("scores", [*spec.index.channels, "coverage_ratio"]), ("tvi", [spec.index.name])):
        columns = {"country": "string", "year": "int"} | dict.fromkeys(values, "double") | {"processed_at": "timestamp"}
        name = spec.table(layers.gold, suffix)
        out.table(name, columns, "year")
        out.replace(name, scores.select(*columns), "year", gone)


# --- runs ------------------------------------------------------------------------------------------------


def process_batch(
    spark: SparkSession, spec: DatasetSpec, bronze: DataFrame, run: Run, layers: Layers = Layers(), keys: Sequence[str] = ()
) -> None:
    """Carry one bronze batch through all layers of its dataset; malformed lines are set aside.

    The run is logged, also one that a gate refuses.
    """
    if spec.style == "raw":
        raise ValueError(f"{spec.name} ends in the raw zone")
    outcome = Outcome(keys)
    try:
        with Scratch(spark, spec.name) as scratch:
            out = Publications(spark, scratch, layers)
            stored, found = _staged_bronze(bronze, spec, run, scratch)
            outcome.bronze_rows, outcome.quarantined = found["good"], found["bad"]
            outcome.cast_failures = {k.removeprefix("failed "): n for k, n in found.items() if k.startswith("failed ") and n}
            _gate_bronze(found, spec, run)
            good = stored.where(F.col(CORRUPT).isNull()) if CORRUPT in stored.columns else stored
            counted = Observation(f"batch of {spec.name}")
            latest = latest_wins(good.select(*spec.silver_columns), spec.keys)
            batch = scratch.save(latest.observe(counted, F.count(F.lit(1)).alias("n")))
            outcome.batch_rows = counted.get["n"]
            merged = _stage_silver(batch, spec, run, layers, out)
            fact = _stage_fact(merged, batch, spec, run, layers, out)
            if spec.rolling:
                _stage_metrics(batch.select(*spec.keys), fact, spec, run.as_of, layers, out)
            if spec.index:
                silver = out.after(spec.table(layers.silver, "clean"), merged, spec.partition)
                _stage_index(silver, batch.select("year").distinct(), spec, run.as_of, layers, out)
            if found["bad"]:
                _stage_quarantine(stored, spec, run, out)
            if spec.style == "scd2":
                _log_changes(spec, run, batch, out)
            out.publish()
    except GateError as refused:
        _log_run(spark, spec, run, layers, outcome, "refused", str(refused))
        raise
    _log_run(spark, spec, run, layers, outcome, "done")


def run_dataset(
    spark: SparkSession,
    spec: DatasetSpec,
    keys: Sequence[str],
    run: Run,
    layers: Layers = Layers(),
    base_path: str | None = None,
) -> None:
    """Run the job of a dataset over exactly the given bronze objects."""
    bronze = scan_bronze(spark, keys, spec.bronze_columns, spec.scan_mode, base_path, members=True)
    process_batch(spark, spec, bronze, run, layers, keys)


def run_manifest(
    spark: SparkSession,
    manifest: str,
    run_id: str,
    as_of: str,
    layers: Layers = Layers(),
    dag_id: str = "",
    base_path: str | None = None,
) -> None:
    """Run the dataset that a manifest (JSON text) names over the objects it names, if the manifest is sound."""
    row = manifest_gate(spark.range(1).select(F.lit(manifest).alias("manifest"))).first()
    if row["problem"]:
        raise GateError(f"manifest: {row['problem']}")
    spec = find(row["domain"], row["source"], row["dataset"])
    run = Run(run_id, as_of, dag_id, row["record_count"])
    run_dataset(spark, spec, row["keys"], run, layers, base_path)


def _key(spec: DatasetSpec, run: Run) -> str:
    return f"{spec.name}@{run.run_id}"


def _stage_quarantine(stored: DataFrame, spec: DatasetSpec, run: Run, out: Publications) -> None:
    """The malformed lines of a permissive scan with the run that met them; a replay replaces its own."""
    name = f"{out.layers.ops}.quarantine"
    out.table(name, _QUARANTINE, "run")
    lines = stored.where(F.col(CORRUPT).isNotNull()).select(
        F.col(CORRUPT).alias("line"),
        F.lit(run.run_id).alias("run_id"),
        F.lit(spec.name).alias("dataset"),
        F.lit(_key(spec, run)).alias("run"),
    )
    out.replace(name, lines, "run")


def _log_run(
    spark: SparkSession, spec: DatasetSpec, run: Run, layers: Layers, outcome: Outcome, status: str, problem: str | None = None
) -> None:
    """One row per run of a dataset; a replay replaces its own."""
    name = f"{layers.ops}.dataset_runs"
    tables.create_table(spark, name, _RUNS, "run", layers.provider, layers.location)
    failures = [F.lit(x) for item in outcome.cast_failures.items() for x in item]
    values = {
        "run_id": F.lit(run.run_id),
        "dag_id": F.lit(run.dag_id),
        "dataset": F.lit(spec.name),
        "as_of": F.lit(run.as_of),
        "status": F.lit(status),
        "problem": F.lit(problem),
        "keys": F.array(*map(F.lit, outcome.keys)),
        "bronze_rows": F.lit(outcome.bronze_rows),
        "quarantined": F.lit(outcome.quarantined),
        "batch_rows": F.lit(outcome.batch_rows),
        "cast_failures": F.create_map(*failures),
        "run": F.lit(_key(spec, run)),
    }
    row = spark.range(1).select(*[value.cast(_RUNS[c]).alias(c) for c, value in values.items()])
    tables.publish_partitions(row, name, "run")


def _log_changes(spec: DatasetSpec, run: Run, batch: DataFrame, out: Publications) -> None:
    """The partitions of a versioned table that a run is about to replace, besides those that an earlier try of it replaced.

    Written before the table itself: after a failure the log may name partitions too many, never too few.
    """
    spark, layers, key = out.spark, out.layers, f"{_key(spec, run)}@{run.as_of}"
    name = f"{layers.ops}.changes"
    earlier = out.table(name, _CHANGES, "run").where(F.col("run") == key)
    told = batch.select(
        F.lit(spec.table(layers.silver, "clean")).alias("name"),
        F.lit(run.as_of).cast("timestamp").alias("as_of"),
        F.col(spec.partition).cast("string").alias("value"),
        F.lit(key).alias("run"),
    )
    tables.publish_partitions(out.scratch.save(told.unionByName(earlier).distinct()), name, "run")


def _changed_since(spark: SparkSession, spec: DatasetSpec, at: Column, layers: Layers) -> DataFrame | None:
    """The partitions that runs after a moment replaced; None where the log doesn't reach back so far."""
    log = f"{layers.ops}.changes"
    if not spark.catalog.tableExists(log):
        return None
    own = spark.table(log).where(F.col("name") == spec.table(layers.silver, "clean"))
    if not own.agg((F.min("as_of") <= at).alias("reaches")).first()["reaches"]:
        return None
    return own.where(F.col("as_of") > at).select(F.col("value").cast(spec.silver_columns[spec.partition]).alias(spec.partition)).distinct()


# --- repair -----------------------------------------------------------------------------------------------


def _fact_of(silver: DataFrame, spec: DatasetSpec) -> DataFrame:
    """The fact that silver gives: current rows, with insert-only columns from the first version of their key."""
    if spec.style != "scd2":
        return silver.select(*spec.fact_columns)
    current = silver.where("is_current")
    fixed = [c for c in spec.fact if c not in spec.keys and c not in spec.fact_update]
    if spec.fact_style != "upsert" or not fixed:
        return current.select(*spec.fact_columns)
    first = silver.groupBy(*spec.keys).agg(F.min_by(F.struct(*fixed), "effective_from").alias("_first"))
    joined = null_safe_join(current.drop(*fixed), first, spec.keys, "left").select("*", "_first.*")
    return joined.select(*spec.fact_columns)


def rebuild_gold(spark: SparkSession, spec: DatasetSpec, as_of: str, layers: Layers = Layers()) -> None:
    """Replace fact, metrics and index as a whole by what current silver gives, for use after a repair by hand."""
    silver = spark.table(spec.table(layers.silver, "clean"))
    with Scratch(spark, spec.name) as scratch:
        out = Publications(spark, scratch, layers)
        fact = spec.table(layers.gold, "fact")
        out.table(fact, spec.fact_columns, spec.partition)
        whole = scratch.save(_fact_of(silver, spec))
        snapshots = [(fact, whole, spec.partition)]
        if spec.rolling:
            columns, name, tail = _metric_columns(spec), spec.table(layers.gold, "metrics"), spec.table(layers.gold, "tails")
            out.table(name, columns, spec.partition)
            out.table(tail, spec.fact_columns | {"part": "string"}, "part")
            snapshots.append((name, scratch.save(_stamped(add_rolling(whole, spec.rolling), as_of).select(*columns)), spec.partition))
            _, ends = refresh_changed(whole, whole, spec.rolling)
            snapshots.append((tail, scratch.save(ends.withColumn("part", _bucket(spec.rolling.entity))), "part"))
        if spec.index:
            years = silver.where("is_current").select("year").distinct()
            _stage_index(silver, years, spec, as_of, layers, out)
            snapshots += [(name, rows, partition) for name, rows, partition, _ in out.waiting]
        for name, rows, partition in snapshots:
            tables.publish_snapshot(rows, name, partition)


def roll_back(spark: SparkSession, spec: DatasetSpec, moment: str, layers: Layers = Layers(), run_id: str = "roll back") -> None:
    """Put a versioned table and its gold tables back to the state after the run at ``moment``.

    The log of changes tells which partitions later runs replaced: only these are read, and those with versions opened or closed
    later are written; of the metrics and the index what depends on them. (For a moment before the log begins, the whole table is looked
    through.) Insert-only columns of the fact come from the first
    version of each key. ``processed_at`` of rows that change is ``moment``. The roll back is logged.
    """
    if spec.style != "scd2":
        raise ValueError(f"{spec.name} keeps no versions, so it can't be rolled back")
    name = spec.table(layers.silver, "clean")
    at = F.lit(moment).cast("timestamp")
    run = Run(run_id, moment)
    with Scratch(spark, spec.name) as scratch:
        out = Publications(spark, scratch, layers)
        silver = spark.table(name)
        later = (F.col("effective_from") > at) | (F.col("effective_to") > at)
        logged = _changed_since(spark, spec, at, layers)
        near = silver if logged is None else tables.touched(silver, logged, spec.partition)
        changed = scratch.save(near.where(later).select(*spec.keys).distinct())
        if changed.isEmpty():
            _log_run(spark, spec, run, layers, Outcome(), "rolled back")
            return
        partitions = changed.select(spec.partition).distinct()
        own = tables.touched(silver, changed, spec.partition)
        back = scd2_as_of(own, moment).withColumn(CLOSED_BY, F.when(F.col("is_current"), CURRENT).otherwise(F.col(CLOSED_BY)))
        # a roll back that failed half-way may have opened a version and not yet removed its closed row
        opened = back.where("is_current").dropDuplicates([*spec.keys, "effective_from", "record_hash"])
        earlier = scratch.save(opened.unionByName(back.where("not is_current")))
        enforce(history_report(earlier, spec.keys), name)

        fact_name = spec.table(layers.gold, "fact")
        stored = out.table(fact_name, spec.fact_columns, spec.partition)
        keep = null_safe_join(tables.touched(stored, changed, spec.partition), changed, spec.keys, "left_anti")
        restored = null_safe_join(_stamped(_fact_of(earlier, spec), moment), changed, spec.keys, "left_semi")
        fact = scratch.save(keep.unionByName(restored.select(*stored.columns)))
        gone = [r[0] for r in null_safe_join(partitions, fact, [spec.partition], "left_anti").collect()]
        out.replace(fact_name, fact, spec.partition, gone)
        if spec.rolling:
            view = out.after(fact_name, fact, spec.partition, partitions)
            _stage_metrics(changed, view, spec, moment, layers, out, know_tails=False)
        if spec.index:
            after = out.after(name, earlier, spec.partition, partitions)
            _stage_index(after, changed.select("year").distinct(), spec, moment, layers, out)
        # last, since the versions tell what is to be rolled back; partitions without later versions stay as they are
        levels = _version_levels(spec)
        replaced = scratch.save(own.where(later | (F.col(CLOSED_BY) == CURRENT)).select(*levels).distinct())
        past = null_safe_join(earlier.where(F.col(CLOSED_BY) != CURRENT), replaced, levels, "left_semi")
        rows = scratch.save(earlier.where(F.col(CLOSED_BY) == CURRENT).unionByName(past))
        out.replace(name, rows, levels, [tuple(r) for r in null_safe_join(replaced, rows, levels, "left_anti").collect()])
        out.publish()
        _log_run(spark, spec, run, layers, Outcome(batch_rows=changed.count()), "rolled back")
