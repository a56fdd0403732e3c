"""Process whatever landed since the last call, each object exactly once."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from ..plans.jobs import Layers, Run, process_batch
from ..plans.registry import DatasetSpec
from ..sources.bronze import CORRUPT


def drain_landing(
    spark: SparkSession,
    spec: DatasetSpec,
    landing: str,
    checkpoint: str,
    layers: Layers = Layers(),
    as_of: str | None = None,
    max_files: int | None = None,
) -> StreamingQuery:
    """Run the dataset's batch job over all new files below ``landing``, then stop.

    ``landing`` is a folder of files or a raw zone, whose ``name=value`` folders
    become columns. The stream's checkpoint remembers which objects were read.
    A batch that is replayed after a failure merges to the same tables.
    """
    columns = spec.bronze_columns
    if spec.scan_mode == "PERMISSIVE":
        columns = [*columns, CORRUPT]
    reader = (
        spark.readStream.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
        .option("mode", spec.scan_mode)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.json(landing)

    def each(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        now = as_of or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
        run = Run(run_id=f"{spec.name}-{batch_id}", as_of=now, dag_id="landing")
        process_batch(batch.sparkSession, spec, batch, run, layers)

    return (
        lines.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
