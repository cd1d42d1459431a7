"""What the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barpath.session import hold_batches

#: Rows and bytes in an Arrow batch: texts are long, and a task holds a batch at a time.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes in this session."""
    hold_batches(spark, maxRecordsPerBatch=BATCH_ROWS, maxBytesPerBatch=BATCH_BYTES)


def crc32_mod(column: str, n: int):
    """crc32 of a column as text, mod n; null as the empty string."""
    return F.pmod(F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(column).to_pylist()]


def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b for b in it if b.num_rows)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star forest with the components of the links (a, b): every node that is not the least of its own, and that least."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    root = np.arange(len(nodes))
    while len(i):
        low, high = np.minimum(root[i], root[j]), np.maximum(root[i], root[j])
        apart = low < high
        if not apart.any():
            break
        i, j = i[apart], j[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]
