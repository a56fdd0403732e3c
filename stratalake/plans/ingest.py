"""The ingestion of a dataset: landed raw payloads to bronze objects and a manifest.

Responses that report an error, and elements that are not what the format has, are set aside with their
request; all other elements become rows, which are stamped and written to the raw zone, or below one folder
for each entity. Every ingestion has folders of its own, named by its dataset and time. The manifest names them and is published
last: it alone says that the ingestion happened, and is what a run starts from. A try that ended before has left folders without a
manifest; the next try removes them. An ingestion whose manifest is there is not done again: a replay returns what the manifest says.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.payload import redact_url
from ..operators.flatten import FLATTENERS
from ..operators.quality import GateError
from ..session import Scratch
from ..sources import tables
from ..sources.bronze import publish_text, published_text, remove_folders, run_folders, run_name, write_per_entity, write_raw_zone
from .jobs import Layers
from .manifest import SUCCESS
from .registry import DatasetSpec, checked_parameters

_REJECTED = {
    "request_url": "string", "received_at": "string", "path": "string", "problem": "string", "raw": "string",
    "dataset": "string", "ingested_at": "string", "run": "string",
}


@dataclass(frozen=True)
class Ingested:
    """``manifest`` is the JSON text that ``run_manifest`` takes; ``keys`` are folders; ``rejected`` counts what gave no row."""

    manifest: str
    keys: tuple[str, ...]
    record_count: int
    rejected: int


def ingest(
    spark: SparkSession,
    spec: DatasetSpec,
    raw: DataFrame,
    base: str,
    ingested_at: str,
    layers: Layers = Layers(),
    parameters: Mapping[str, object] | None = None,
    entity: str | None = None,
) -> Ingested:
    """Flatten the responses ``raw`` of a dataset into objects below ``base``.

    ``raw`` has ``payload``, ``request_url``, ``received_at`` and the request parameters of the dataset's
    flattener. ``parameters`` are what the request asked for, checked against what the dataset allows. With
    ``entity`` (a column of the rows) the objects of each entity lie in a folder of their own. A batch
    without a single row is refused. Secrets in request addresses are not stored.
    """
    options = checked_parameters(spec, parameters or {})
    flattener = FLATTENERS[spec.flattener](**options)
    run, own = f"{spec.name}@{ingested_at}", run_name(spec.name, ingested_at)
    place = f"{base.rstrip('/')}/_manifests/{own}.json"
    done = published_text(spark, place)
    if done is not None:
        return _ingested(done)
    with Scratch(spark, f"ingest-{spec.name}") as scratch:
        clean = raw.withColumn("request_url", redact_url(F.col("request_url")))
        opened = scratch.save(flattener.opened(clean))  # parsed once, for the rows and for what gives none
        rows = flattener.convert(opened.where("problem IS NULL"))  # made while they are written; to count them reads next to nothing
        bad = flattener.rejected_of(opened)
        n_bad, n = bad.count(), rows.count()
        if n_bad:
            name = f"{layers.ops}.rejected"
            tables.create_table(spark, name, _REJECTED, "run", layers.provider, layers.location)
            told = {"dataset": F.lit(spec.name), "ingested_at": F.lit(ingested_at), "run": F.lit(run)}
            tables.publish_partitions(bad.withColumns(told), name, "run")
        if n == 0:
            raise GateError(f"{spec.name}: no records in {raw.count()} responses")
        if "source_api" in rows.columns and "source" not in rows.columns:
            rows = rows.withColumn("source", F.col("source_api"))
        # the folder of the zone takes the dataset of the registry
        rows = rows.withColumns({"source": F.lit(spec.source), "dataset": F.coalesce("dataset", F.lit(spec.dataset))})
        remove_folders(spark, run_folders(spark, base, spec.source, ingested_at, own))
        if entity:
            write_per_entity(rows, base, F.col(entity), ingested_at, run=own)
        else:
            write_raw_zone(rows, base, ingested_at, run=own)
    keys = run_folders(spark, base, spec.source, ingested_at, own, bool(entity))
    told = {
        "status": SUCCESS, "lambda_exec_ts": ingested_at, "domain": spec.domain, "source": spec.source, "dataset": spec.dataset,
        "keys": keys, "record_count": n, "ingested_at": ingested_at, "rejected": n_bad,
    }
    publish_text(spark, place, json.dumps(told))
    return _ingested(json.dumps(told))


def _ingested(manifest: str) -> Ingested:
    told = json.loads(manifest)
    return Ingested(manifest, tuple(told["keys"]), told["record_count"], told["rejected"])
