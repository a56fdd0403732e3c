"""Session defaults for local runs, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_folder: str | None = None


def local_session(cores: int | str = 8, name: str = "stratalake") -> SparkSession:
    """A session for tests and the bench; clusters bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent and the
    session runs in local mode.
    """
    global _local_folder
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="stratalake-")
    return _local_folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/stratalake/{label}-{uuid.uuid4().hex}"


#: Two threads must not change settings of a session at once.
_SETTING = threading.RLock()


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Settings of the session for the moment; afterwards they are as before."""
    with _SETTING:
        before = {key: spark.conf.get(key, None) for key in values}
        try:
            for key, value in values.items():
                spark.conf.set(key, value)
            yield
        finally:
            for key, value in before.items():
                if value is None:
                    spark.conf.unset(key)
                else:
                    spark.conf.set(key, value)


def save_and_read(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` and read it back: whatever follows starts from the files."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables of one job in the shared folder, removed when the job ends.

    A saved table outlives executors, and a table may be overwritten although
    the saved rows were computed from it.
    """

    def __init__(self, spark: SparkSession, label: str = "job"):
        self.spark = spark
        self.path = scratch_path(spark, label)
        self._saved = 0

    def save(self, df: DataFrame) -> DataFrame:
        self._saved += 1
        return save_and_read(df, f"{self.path}/{self._saved}")

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure) -> None:
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
