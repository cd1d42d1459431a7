"""Operator 4, near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine c are sqrt(2 - 2c) apart. They are rotated at random and split into blocks of few dimensions; if
two are within that distance, then in some block their squared distance is within the block's share of the budget (in
proportion to its dimensions). Each block is range-joined over a grid of two of its dimensions, candidates are verified
with the whole vectors in double precision, and a pair counts in the first block that proposes it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barpath.llm.common import batches, forest
from barpath.operators.components import components
from barpath.session import materialise, shuffle_partitions

COSINE = 0.95
#: Dimensions of a block, cells along each of the two gridded ones, vectors that a task holds at once.
BLOCK_DIMS = 8
CUTS = 3
CELL_ROWS = 32_768
#: Vectors whose quantiles place the grid. Any grid gives the same links.
SAMPLE = 4096
#: What the distances in single precision may be off, and distances of the same two rotated vectors at most.
LOOSE, SLACK = 1e-4, 1e-6
#: Distances computed at a time.
TILE = 1 << 20


class Space:
    """Rotation, blocks and grid for vectors of one length."""

    def __init__(self, dims: int, cosine: float = COSINE, sample: np.ndarray | None = None):
        q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
        self.rotation = q * np.sign(np.diag(r))
        n = max(1, dims // BLOCK_DIMS)
        self.blocks = [np.asarray(b) for b in np.array_split(np.arange(dims), n)]
        self.budgets = [(2 - 2 * cosine) * len(b) / dims + SLACK for b in self.blocks]
        ranks = np.arange(1, CUTS) / CUTS
        rotated = self.rotated(sample) if sample is not None and len(sample) else np.zeros((1, dims))
        self.cuts = [[np.quantile(rotated[:, k], ranks) for k in b[:2]] for b in self.blocks]

    def rotated(self, unit: np.ndarray) -> np.ndarray:
        """The same numbers for the same vector in any task: sums in one order, rounded to single precision."""
        return np.einsum("ij,jk->ik", unit, self.rotation).astype(np.float32)

    def cells(self, rotated: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The home cell of each vector; and (vector, cell) for the cells in which its partners are looked up: those of
        vectors that are not before it in the first dimension, so that a pair is met once."""
        reach = np.sqrt(self.budgets[block]) + SLACK
        dims = self.blocks[block][:2]
        place = lambda k, shift: np.searchsorted(self.cuts[block][k], rotated[:, dims[k]].astype(np.float64) + shift, side="right")
        spans = [(place(0, 0.0), place(0, reach))] + [(place(k, -reach), place(k, reach)) for k in range(1, len(dims))]
        home = place(0, 0.0) * CUTS + (place(1, 0.0) if len(dims) > 1 else 0)
        who, cell = [], []
        for i in range(CUTS):
            for j in range(CUTS if len(dims) > 1 else 1):
                hit = (spans[0][0] <= i) & (i <= spans[0][1])
                if len(dims) > 1:
                    hit &= (spans[1][0] <= j) & (j <= spans[1][1])
                at = np.flatnonzero(hit)
                who.append(at)
                cell.append(np.full(len(at), i * CUTS + j))
        return home, np.concatenate(who), np.concatenate(cell)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def _key(dims: int, block: int, cell: np.ndarray) -> np.ndarray:
    return (dims << 20) + (block * CUTS * CUTS + cell)


class Group:
    """Vectors of one cell of one block, ready to be compared."""

    def __init__(self, space: Space, block: int, rep: np.ndarray, copies: np.ndarray, raw: np.ndarray):
        self.space, self.block, self.rep, self.copies = space, block, rep, copies
        self.raw = raw
        self.unit = unit(raw)
        self.rotated = space.rotated(self.unit)
        near = self.rotated[:, space.blocks[block]]
        half, one = np.einsum("ij,ij->i", near, near) / 2, np.ones(len(near), np.float32)
        # the product of these two is minus half the squared distance
        self.as_probe = np.column_stack([near, -half, -one])
        self.as_vector = np.ascontiguousarray(np.column_stack([near, one, half]).T)

    def links(self, probes: Group, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(probe, vector) indices of the linked pairs that this block counts."""
        space, b = self.space, self.block
        first = space.blocks[b][0]
        step = max(1, TILE // max(1, len(self.rep)))
        for at in range(0, len(probes.rep), step):
            end = at + step
            i, j = np.divmod(np.flatnonzero(probes.as_probe[at:end] @ self.as_vector >= -(space.budgets[b] + LOOSE) / 2), len(self.rep))
            i += at
            x, y = probes.rotated[i, first], self.rotated[j, first]
            keep = (x < y) | (x == y) & (probes.rep[i] < self.rep[j])
            for lo in range(0, len(i), 1 << 16):
                part = slice(lo, lo + (1 << 16))
                p, q = i[part][keep[part]], j[part][keep[part]]
                gap = (probes.rotated[p].astype(np.float64) - self.rotated[q]) ** 2
                inside = [gap[:, space.blocks[k]].sum(axis=1) <= space.budgets[k] for k in range(b + 1)]
                own = inside[b]
                for before in inside[:b]:
                    own = own & ~before
                p, q = p[own], q[own]
                close = np.einsum("ij,ij->i", probes.unit[p], self.unit[q]) >= cosine
                if close.any():
                    yield p[close], q[close]


def _raw(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def rep_links(reps: DataFrame, cosine: float = COSINE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """From distinct vectors ``rep, copies, v``: rows ``(a, b, n)``. b null: n more rows link with vector a. Else a link of
    a spanning forest. Both are gathered in the tasks, so no pairs of a dense group leave them."""
    spark = reps.sparkSession
    picked = reps.select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
    samples: dict[int, list] = {}
    for r in picked:
        samples.setdefault(len(r.v), []).append(r.v)
    cuts = {d: unit(np.array(x, dtype=np.float64)) for d, x in samples.items()}
    kind = pa.float32() if reps.schema["v"].dataType.elementType.typeName() == "float" else pa.float64()
    bytes_ = kind.bit_width // 8

    def spaces():
        known: dict[int, Space] = {}

        def of(dims: int) -> Space:
            if dims not in known:
                known[dims] = Space(dims, cosine, cuts.get(dims))
            return known[dims]

        return of

    def by_dims(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
        dims = np.diff(batch.column("v").offsets.to_numpy())
        for d in np.unique(dims).tolist():
            yield d, batch.take(pa.array(np.flatnonzero(dims == d)))

    def homes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = spaces()
        for batch in batches(it):
            for d, part in by_dims(batch):
                r = of(d).rotated(unit(_raw(part.column("v"))))
                keys = np.concatenate([_key(d, b, of(d).cells(r, b)[0]) for b in range(len(of(d).blocks))])
                yield pa.RecordBatch.from_pydict({"key": pa.array(np.unique(keys)), "n": pa.array(np.unique(keys, return_counts=True)[1], pa.int64())})

    counts = reps.select("v").mapInArrow(homes, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    large = {r.key: -(-r.n // cell_rows) for r in counts.where(F.col("n") > cell_rows).collect()}  # not more than vectors / cell_rows

    def deal(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = spaces()
        for batch in batches(it):
            for d, part in by_dims(batch):
                space = of(d)
                raw = _raw(part.column("v"))
                r = space.rotated(unit(raw))
                rep, copies = part.column("rep"), part.column("copies")
                spread = rep.to_numpy() * 0x9E3779B1 % 1_000_003
                data = np.ascontiguousarray(raw.astype(kind.to_pandas_dtype()))
                packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(d * bytes_), len(raw), [None, pa.py_buffer(data)]).cast(pa.binary())
                for b in range(len(space.blocks)):
                    home, who, cell = space.cells(r, b)
                    own = _key(d, b, home)
                    chunks = np.array([large.get(k, 1) for k in own.tolist()], dtype=np.int64)
                    rows, keys, chunk, probe = [np.arange(len(raw))], [own], [spread % chunks], [np.zeros(len(raw), np.int8)]
                    look = _key(d, b, cell)
                    times = np.array([large.get(k, 1) for k in look.tolist()], dtype=np.int64)
                    rows.append(np.repeat(who, times))
                    keys.append(np.repeat(look, times))
                    chunk.append(np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
                    probe.append(np.ones(int(times.sum()), np.int8))
                    take = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_pydict({
                        "key": pa.array(np.concatenate(keys), pa.int64()), "chunk": pa.array(np.concatenate(chunk), pa.int64()), "probe": pa.array(np.concatenate(probe)),
                        "rep": rep.take(take), "copies": copies.take(take), "v": packed.take(take),
                    })

    dealt = reps.select("rep", "copies", "v").mapInArrow(deal, "key long, chunk long, probe byte, rep long, copies long, v binary")
    dealt = dealt.repartition(shuffle_partitions(spark), "key", "chunk").sortWithinPartitions("key", "chunk", "probe")

    def compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = spaces()
        at, held, group = None, [], None

        def made(part: pa.RecordBatch) -> Group:
            key = part.column("key")[0].as_py()
            d, block = key >> 20, (key & ((1 << 20) - 1)) // (CUTS * CUTS)
            raw = np.frombuffer(b"".join(part.column("v").to_pylist()), kind.to_pandas_dtype()).astype(np.float64).reshape(-1, d)
            return Group(of(d), block, part.column("rep").to_numpy(), part.column("copies").to_numpy(), raw)

        for batch in batches(it):
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("key", "chunk", "probe")])
            bounds = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(bounds, bounds[1:], strict=False):
                part = batch.slice(a, b - a)
                if (now := tuple(keys[a, :2])) != at:
                    at, held, group = now, [], None
                if not keys[a, 2]:
                    held.append(part)
                    continue
                if not held:
                    continue
                if group is None:
                    group = made(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                probes = made(part)
                for i, j in group.links(probes, cosine):
                    x, y = probes.rep[i], group.rep[j]
                    ends, back = np.unique(np.concatenate([x, y]), return_inverse=True)
                    more = np.bincount(back, weights=np.concatenate([group.copies[j], probes.copies[i]])).astype(np.int64)
                    p, q = forest(x, y)
                    yield pa.RecordBatch.from_pydict({"a": pa.array(np.concatenate([ends, p])), "b": pa.array([*[None] * len(ends), *q.tolist()], pa.int64()), "n": pa.array([*more.tolist(), *[None] * len(p)], pa.int64())})

    return dealt.mapInArrow(compare, "a long, b long, n long")


def near_vectors(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, cell_rows: int = CELL_ROWS) -> DataFrame:
    """All columns but the vector, ``n_links`` (other rows linked directly), ``component_id`` and ``kept``.

    Rows link at a cosine of at least ``cosine``, in double precision; vectors of different lengths never do, nor those that
    are null, empty, zero or hold a null or a number that is not finite: these are components by themselves. So is a row of
    a null key, whose component is null and which is not kept. Equal vectors are collapsed before the join and counted by
    their number; rows that repeat a key count as rows. Every row stays.
    """
    kind = "float" if vectors.schema[vector].dataType.elementType.typeName() == "float" else "double"
    rows = vectors.drop("n_links", "component_id", "kept")
    v = F.col(vector).cast(f"array<{kind}>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0) & F.col(key).isNotNull()
    rows = rows.withColumn("__v", F.when(fine, F.transform(v, lambda x: x + F.lit(0).cast(kind)))).drop(vector)
    reps = rows.where(F.col("__v").isNotNull()).groupBy(F.col("__v").alias("v")).agg(F.min(key).alias("least"), F.count("*").alias("copies"))
    reps = materialise(reps.withColumn("rep", F.monotonically_increasing_id()), "reps")
    found = materialise(rep_links(reps, cosine, cell_rows), "links")
    more = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("more"))
    joined = components(found.where("b is not null").select("a", "b"))
    named = reps.join(more, "rep", "left").join(joined.withColumnRenamed("node", "rep"), "rep", "left").withColumn("root", F.coalesce("component", "rep"))
    named = named.select("v", "least", "root", (F.col("copies") - 1 + F.coalesce("more", F.lit(0))).alias("n_links"))
    named = named.join(named.groupBy("root").agg(F.min("least").alias("component_id")), "root")
    # rows without a vector that can link meet in no join: however many there are, they are no hot key
    out = rows.where(F.col("__v").isNotNull()).join(named.select(F.col("v").alias("__v"), "n_links", "component_id"), "__v", "left")
    none = rows.where(F.col("__v").isNull()).withColumns({"n_links": F.lit(0).cast("long"), "component_id": F.lit(None).cast(rows.schema[key].dataType)})
    out = out.unionByName(none)
    component = F.coalesce("component_id", key)
    names = [c for c in rows.columns if c != "__v"]
    return out.select(*names, F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col(key) == component, F.lit(False)).alias("kept"))


def op4_embeddings(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
