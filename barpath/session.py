"""Session helpers: a test session and the shared folder that cuts lineage."""

from __future__ import annotations

import gc
import re
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The hint for joins of tables that grow: Spark guesses their size by that of their files, which are packed, before rows are copied to
#: their bins, and would send them through the driver to all executors.
SHUFFLED = "merge"


def local_session(cores: str = "8", memory: str = "12g", partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("barpath")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; one of our own only where that is unset and all tasks run in
    this process (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.conf.get("barpath.scratch.dir", None)
        if not path:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            path = "file://" + tempfile.mkdtemp(prefix="barpath-")
            spark.conf.set("barpath.scratch.dir", path)
    return path.rstrip("/")


def materialise(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage in a way that a lost executor cannot undo."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if partition_by:  # a writer for each of few partitions: no sort of the rows before they are written
        spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "16")
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hold_batches(spark: SparkSession, **most: int) -> None:
    """Hold Arrow batches of this session to ``maxRecordsPerBatch`` rows, ``maxBytesPerBatch`` bytes, or both."""
    for name, n in most.items():
        now = re.match(r"\d+", spark.conf.get(f"spark.sql.execution.arrow.{name}"))
        if not now or int(now[0]) == 0 or int(now[0]) > n:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(n))


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of tables that nothing refers to any more. References go in two steps,
    those of Python's objects and then those of Spark's."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
