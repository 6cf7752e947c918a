"""Session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidyforge.functions.names import ref, replace_columns

# Runtime settings the operators rely on.  Skew splitting is forced so that a hot
# join key is split even where that costs one more exchange.  Batches sent to Python
# are bounded in bytes, since a record may be a whole file or page.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16MB",
    "spark.sql.session.timeZone": "UTC",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime settings on an existing session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g",
                  **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidyforge")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**RUNTIME_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, taken from ``spark.checkpoint.dir``.

    Only a session whose tasks run in its own process may fall back to a folder of this
    machine, as tests do; anywhere else executors could not see it, so a missing setting is
    an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="tidyforge-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; never reused."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


class WorkTables:
    """The intermediate tables of a run; ``release`` deletes them once its result is saved.

    Used as a context, it collects every table that :func:`materialize` writes meanwhile::

        with WorkTables(spark) as tables:
            df = process_data(spark, ...)
            df.write.parquet("result")
            tables.release()
    """

    _open: list["WorkTables"] = []

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> "WorkTables":
        self._open.append(self)
        return self

    def __exit__(self, *_) -> None:
        self._open.remove(self)

    def release(self) -> None:
        """Delete the tables; frames that still read them can no longer run."""
        for path in self.paths:
            target = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
        self.paths.clear()


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage before several jobs read the same prefix.  A columnar table is
    used instead of an RDD checkpoint so that each later job reads only its columns,
    and it survives the loss of executors.
    """
    path = shared_path(df.sparkSession, name)
    for tables in WorkTables._open:
        tables.paths.append(path)
    untyped = [f.name for f in df.schema if isinstance(f.dataType, T.NullType)]
    if untyped:                                  # columns of nothing but NULL literals
        df = replace_columns(df, {c: ref(c).cast("string") for c in untyped})
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
