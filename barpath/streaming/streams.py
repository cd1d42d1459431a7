"""The same work as streams: enrichment, counts, windows, and recomputation of what late rows touch. SURVEY STM-*."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barpath.operators.tables import changes, first_by, upsert
from barpath.session import scratch_dir
from barpath.streaming.keyed import BUCKETS, KeyedTable


def source(spark: SparkSession, path: str) -> DataFrame:
    """A file or folder of Parquet as a stream of its files."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", 16)
    return reader.option("pathGlobFilter", name).parquet(folder) if name.endswith(".parquet") and not _is_folder(spark, path) else reader.parquet(path)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory()


def run_once(stream: DataFrame, mode: str) -> DataFrame:
    """Runs a stream over all that is there and gives what it wrote. Each batch has a folder of its own, so a batch that is run
    again takes the place of itself."""
    spark = stream.sparkSession
    path = f"{scratch_dir(spark)}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out" if mode == "complete" else f"{path}/out/batch={n}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    out = spark.read.parquet(f"{path}/out")
    return out if mode == "complete" else out.drop("batch")


def hourly(spark: SparkSession, path: str) -> DataFrame:
    """Beyond the reference: event-time windows with a watermark. Complete mode keeps late rows too."""
    w = source(spark, path).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", "1 day").groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"))
    return run_once(w, "complete").select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("hour"), "event_type", "n")


def upsert_into(stream: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], fields: Sequence[str], buckets: int = BUCKETS):
    """STM-5: the last row of each key in a batch, by ``order``, is upserted into the keyed table at ``path/table`` if any of
    ``fields`` changes; what happened to each key of the batch goes to ``path/feed``. A batch reads and rewrites only the buckets
    of its keys, and of these only those in which something changes."""

    def each(batch: DataFrame, n: int) -> None:
        table = KeyedTable(batch.sparkSession, f"{path}/table", keys, buckets)
        new = batch.persist()
        try:
            last = first_by(new, list(keys), [F.desc(c) for c in order])
            old = table.read(n, table.touched(last))
            old = last.limit(0) if old is None else old
            status = changes(old.join(last.select(*keys), list(keys), "left_semi"), last, list(keys), list(fields))
            status.write.mode("overwrite").parquet(f"{path}/feed/batch={n}")
            # what has been written is read again: the decision is made once
            said = batch.sparkSession.read.schema(status.schema).parquet(f"{path}/feed/batch={n}")
            changed = last.join(said.where("status in ('new', 'updated')"), list(keys), "left_semi")
            if touched := table.touched(changed):
                table.replace(n, touched, upsert(old.where(table.bucket().isin(touched)), changed, list(keys)))
        finally:
            new.unpersist()

    return stream.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(each).start()


def recompute_affected(stream: DataFrame, keys: Sequence[str], compute: Callable[[DataFrame], DataFrame], path: str, buckets: int = BUCKETS):
    """STM-2, 3, 4, 6: whatever shares a key with new rows is computed again from all rows of that key and takes the place of
    what was there, so late rows count exactly and nothing stale stays.

    The rows of the stream so far (``path/facts``) and what is computed from them (``path/table``; it has the keys) are keyed tables:
    a batch reads and rewrites the buckets of its keys in both, and no others. A batch that is run again counts once.
    """

    def each(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        facts, table = (KeyedTable(spark, f"{path}/{name}", keys, buckets) for name in ("facts", "table"))
        touched = facts.touched(batch)
        if not touched:
            return
        before = facts.read(n, touched)
        facts.replace(n, touched, batch if before is None else before.unionByName(batch))
        named = batch.select(*keys).distinct()
        new = compute(_same_keys(facts.read(n + 1, touched), named, keys, "left_semi"))
        old = table.read(n, touched)
        table.replace(n, touched, new if old is None else _same_keys(old, named, keys, "left_anti").unionByName(new))

    return stream.writeStream.option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).foreachBatch(each).start()


def _same_keys(rows: DataFrame, named: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """A semi or anti join in which null keys are equal."""
    same = reduce(lambda x, y: x & y, (F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys))
    return rows.alias("l").join(named.alias("r"), same, how)


def latest(spark: SparkSession, path: str, keys: Sequence[str], buckets: int = BUCKETS) -> DataFrame | None:
    """What ``upsert_into`` or ``recompute_affected`` has made so far."""
    return KeyedTable(spark, f"{path}/table", keys, buckets).read()


def append_to(stream: DataFrame, path: str, checkpoint: str):
    """STM-8: new rows go to Parquet files. A later run with the same checkpoint goes on where this one ended."""
    return stream.writeStream.outputMode("append").format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
