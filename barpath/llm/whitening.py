"""Operator 12, embedding whitening by a tiled covariance.

Entries become whole numbers. Their sums (exact) come first. Then the rows of a task are cut into row blocks and the dimensions
into column blocks; a pair of column blocks is a tile. Column blocks are shuffled by row block and tile, each tile of a row
block is multiplied where its two column blocks meet, a task adds up what it has of a tile, and a second shuffle adds up the
tasks. Only the assembled matrix, as large as the square of the dimensions whatever the rows, reaches the driver, which takes
its eigenvectors. Two more passes project the rows: one measures the covariance of what the other returns.

Row blocks are numbered by the partition they are read from, so the table must give the same rows in the same order when a
lost task is run again (files do; write other inputs first).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barpath.llm.common import batches
from barpath.session import shuffle_partitions

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
#: Dimensions of a column block, rows of a row block.
TILE_DIMS = 32
BLOCK_ROWS = 4096
#: Entries from which SCALE times the entry is no whole number of a double any more; such a vector counts as not finite.
LARGEST = float(1 << 43)
#: Share of the trace below which an eigenvalue is that of a direction without variance.
NOTHING = 1e-13


@dataclass
class Whitening:
    """What was fit for vectors of one length: sums of the shifted entries, covariance, eigenvalues from the largest down (those
    of ``components`` at most) and unit eigenvectors in columns, of which the largest entry is positive."""

    n: int
    sums: np.ndarray
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    @classmethod
    def of(cls, n: int, sums: np.ndarray, covariance: np.ndarray, components: int) -> Whitening:
        values, vectors = np.linalg.eigh(covariance)
        order = np.argsort(-values, kind="stable")[:components]
        values, vectors = np.maximum(values[order], 0), vectors[:, order]
        vectors = vectors * np.where(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], axis=0) < 0, -1.0, 1.0)
        trace = float(np.trace(covariance))
        return cls(n, sums, covariance, values, vectors, values / trace if trace > 0 else np.full(len(values), np.nan))

    @property
    def varies(self) -> np.ndarray:
        """Which components have a variance to divide by."""
        return self.values > NOTHING * len(self.sums) * float(np.trace(self.covariance))

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; not a number in components without variance."""
        root = np.where(self.varies, np.sqrt(self.values), np.nan)
        return (x - self.sums / self.n) @ self.vectors / root

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n x - S)^2, exact; null where no long can hold it."""
        rough = np.abs(self.n * x.astype(float) - self.sums).max(initial=0.0)
        if rough < 2.0**31 and rough * rough * x.shape[1] < 2.0**62:
            return ((self.n * x - self.sums) ** 2).sum(axis=1).tolist()
        sums = self.sums.tolist()
        exact = (sum((self.n * v - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist())
        return [v if v < 1 << 63 else None for v in exact]


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``key`` and the vector as ``v`` (doubles) of rows whose vector is there, has entries, and only finite ones."""
    v = F.col(vector).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LARGEST)) & (F.size(v) > 0)
    return vectors.select(F.col(key).alias("key"), v.alias("v")).where(F.coalesce(fine, F.lit(False)))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows of the batch, their entries as whole numbers)."""
    column = batch.column("v")
    dims, values = np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False)
    begin = np.cumsum(dims) - dims
    for d in np.unique(dims).tolist():
        rows = np.flatnonzero(dims == d)
        yield d, rows, np.floor(SCALE * values[begin[rows][:, None] + np.arange(d)]).astype(np.int64) + SHIFT


def _sums(rows: DataFrame) -> dict[int, tuple[int, np.ndarray]]:
    """By length: how many vectors, and the sum of each dimension."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches(it):
            for d, at, x in _by_length(batch):
                held = total.setdefault(d, [0, np.zeros(d, np.int64)])
                held[0] += len(at)
                held[1] += x.sum(axis=0)
        for d, (n, s) in total.items():
            yield pa.RecordBatch.from_pydict({"dims": np.full(d, d), "at": np.arange(d), "n": np.full(d, n), "s": s})

    got = rows.select("v").mapInArrow(run, "dims long, at long, n long, s long").groupBy("dims", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    out: dict[int, tuple[int, np.ndarray]] = {}
    for r in sorted(got, key=lambda r: (r.dims, r["at"])):
        out.setdefault(r.dims, (r.n, np.zeros(r.dims, np.int64)))[1][r["at"]] = r.s
    return out


def _cut(d: int, tile: int) -> list[slice]:
    return [slice(a, min(d, a + tile)) for a in range(0, d, tile)]


def covariances(rows: DataFrame, sums: dict[int, tuple[int, np.ndarray]], tile: int = TILE_DIMS, block_rows: int = BLOCK_ROWS) -> dict[int, np.ndarray]:
    """By length: the covariance matrix, divisor n. The method of this module."""
    shared = rows.sparkSession.sparkContext.broadcast({d: s / n for d, (n, s) in sums.items()})  # a mean for each dimension

    def deal(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches(it):
            for d, _, x in _by_length(batch):
                for a in range(0, len(x), block_rows):
                    part = x[a : a + block_rows] - SHIFT
                    width = next((w for w in (2, 4) if np.abs(part).max() < 1 << (8 * w - 1)), 8)
                    cut = _cut(d, tile)
                    for k, columns in enumerate(cut):
                        body = np.ascontiguousarray(part[:, columns]).astype(f"<i{width}").tobytes()
                        tiles = [(min(k, j), max(k, j)) for j in range(len(cut))]  # all that this column block is a side of
                        yield pa.RecordBatch.from_pydict({
                            "dims": [d] * len(cut), "i": [t[0] for t in tiles], "j": [t[1] for t in tiles], "block": [block] * len(cut), "side": [k] * len(cut),
                            "width": [width] * len(cut), "body": pa.array([body] * len(cut), pa.binary()),
                        })
                    block += 1

    def multiply(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean = shared.value
        now, total, first = None, None, None
        for batch in batches(it):
            for d, i, j, block, side, width, body in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                cut = _cut(d, tile)
                if now != (d, i, j):
                    if now is not None:
                        yield _tile(now, total)
                    now, total = (d, i, j), np.zeros((cut[i].stop - cut[i].start, cut[j].stop - cut[j].start))
                x = np.frombuffer(body, f"<i{width}").reshape(-1, cut[side].stop - cut[side].start) + (SHIFT - mean[d][cut[side]])
                if i == j:
                    total += x.T @ x
                elif side == i:
                    first = block, x
                else:
                    assert first is not None and first[0] == block
                    total += first[1].T @ x
        if now is not None:
            yield _tile(now, total)

    def add(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches(it):
            for d, i, j, body in zip(*(batch.column(c).to_pylist() for c in batch.schema.names), strict=True):
                if now != (d, i, j):
                    if now is not None:
                        yield _tile(now, total)
                    now, total = (d, i, j), 0.0
                total = total + np.frombuffer(body)
        if now is not None:
            yield _tile(now, total)

    n = shuffle_partitions(rows.sparkSession)
    dealt = rows.select("v").mapInArrow(deal, "dims long, i long, j long, block long, side long, width long, body binary")
    dealt = dealt.repartition(n, "dims", "block", "i", "j").sortWithinPartitions("dims", "i", "j", "block", "side")
    parts = dealt.mapInArrow(multiply, _TILE).repartition(n, "dims", "i", "j").sortWithinPartitions("dims", "i", "j")
    out = {d: np.zeros((d, d)) for d in sums}
    for r in parts.mapInArrow(add, _TILE).collect():  # the matrix: its size is that of the square of the dimensions
        cut = _cut(r.dims, tile)
        a, b = cut[r.i], cut[r.j]
        out[r.dims][a, b] = np.frombuffer(r.body).reshape(a.stop - a.start, b.stop - b.start) / sums[r.dims][0]
        out[r.dims][b, a] = out[r.dims][a, b].T
    return out


_TILE = "dims long, i long, j long, body binary"


def _tile(at: tuple[int, int, int], total: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"dims": [at[0]], "i": [at[1]], "j": [at[2]], "body": pa.array([total.tobytes()], pa.binary())})


def fit(rows: DataFrame, components: int = COMPONENTS, tile: int = TILE_DIMS, block_rows: int = BLOCK_ROWS) -> dict[int, Whitening]:
    """By length of the vectors of ``rows`` (``usable``): what whitens them, with the error of the whitened covariance measured
    over all rows."""
    sums = _sums(rows)
    matrices = covariances(rows, sums, tile, block_rows)
    models = {d: Whitening.of(n, s, matrices[d], components) for d, (n, s) in sums.items()}
    shared = rows.sparkSession.sparkContext.broadcast(models)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches(it):
            for d, _, x in _by_length(batch):
                w = np.column_stack([np.ones(len(x)), shared.value[d].project(x)])
                total[d] = total.get(d, 0.0) + w.T @ w
        for d, t in total.items():
            i, j = np.indices(t.shape)
            yield pa.RecordBatch.from_pydict({"dims": np.full(t.size, d), "i": i.ravel(), "j": j.ravel(), "s": t.ravel()})

    got = rows.select("v").mapInArrow(run, "dims long, i long, j long, s double").groupBy("dims", "i", "j").agg(F.sum("s").alias("s")).collect()
    for d, m in models.items():
        k = len(m.values) + 1
        t = np.zeros((k, k))
        for r in got:
            if r.dims == d:
                t[r.i, r.j] = r.s / m.n
        off = np.abs(t[1:, 1:] - np.outer(t[1:, 0], t[1:, 0]) - np.eye(k - 1))[np.ix_(m.varies, m.varies)]
        m.identity_error = float(off.max()) if off.size else None
    return models


def whiten(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, tile: int = TILE_DIMS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Per row and component (from 1, by falling eigenvalue, up to ``components``): the key, ``component``, ``n``, ``deviation``,
    ``whitened``, ``explained`` and ``identity_error``.

    Rows whose vector is null, empty or holds a null or a number that is not finite are left out; all others are fit and
    returned, rows that repeat a key and rows of a null key too. Vectors of different lengths are different spaces, each fit by
    itself. A component without variance (fewer vectors than dimensions, repeated rows) has a null ``whitened`` and takes no part in
    ``identity_error``, which is null if none has any; ``explained`` is null where nothing varies at all, and ``deviation`` where it
    is too large for a long. An entry is floored to a 1024th; from 2**43 on it counts as not finite. Other columns are not
    looked at. An empty table gives an empty table.
    """
    rows = usable(vectors, key, vector)
    shared = rows.sparkSession.sparkContext.broadcast(fit(rows, components, tile, block_rows))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            for d, at, x in _by_length(batch):
                m = shared.value[d]
                k, w = len(m.values), m.project(x)
                each = lambda values, kind, k=k: pa.array(np.repeat(np.array(values, dtype=object), k).tolist(), kind)
                same = lambda values, kind, rows=len(at): pa.array(np.tile(values, rows), kind, from_pandas=True)
                yield pa.RecordBatch.from_arrays([
                    batch.column("key").take(pa.array(np.repeat(at, k))), same(np.arange(1, k + 1, dtype=np.int32), pa.int32()), same(np.full(k, m.n), pa.int64()), each(m.deviations(x), pa.int64()),
                    pa.array(w.ravel(), pa.float64(), from_pandas=True), same(m.explained, pa.float64()), pa.array([m.identity_error] * (len(at) * k), pa.float64()),
                ], names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = vectors.schema[key].dataType.simpleString()
    out = rows.mapInArrow(run, f"key {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return out.withColumnRenamed("key", key) if key != "key" else out


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
