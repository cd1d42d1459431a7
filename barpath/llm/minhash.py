"""Near-duplicates of the pipeline: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

SimHash fingerprints of the sets that differ in at most three bits, found in the BK-trees of operator 8, and bands of a MinHash
signature propose groups. No row goes on a proposal: in each group, the shingle sets themselves are compared, every pair that other
links do not already join. Fingerprints of a pair at 0.8 differ in some ten bits, too many for selective shards, so the bands are for
what lies further apart than three: a pair at 0.8 shares no band with probability (1 - 0.8 ** ROWS) ** BANDS = 0.00011, a closer pair
less often, and a pair that neither proposes is still found if others lead both texts to one group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barpath.llm.common import batches, small_batches
from barpath.llm.simhash import BROADCAST_ROWS, fingerprint_links, fingerprint_of, keep_least
from barpath.operators.components import components
from barpath.session import materialise, shuffle_partitions

WORDS = 5
#: The least similarity, 4 / 5, in whole numbers: no rounding at the border.
LEAST = (4, 5)
BANDS = 30
ROWS = 6
#: Shingles of one part of a group; larger groups are compared in pairs of parts.
PART_SHINGLES = 1 << 21
#: Shingles that are permuted at a time.
BLOCK = 1 << 12

_RANDOM = np.random.default_rng(5).integers(0, 1 << 32, (2, BANDS * ROWS), dtype=np.uint32)
_TIMES, _PLUS = _RANDOM[0][:, None] | np.uint32(1), _RANDOM[1][:, None]


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """The sorted distinct hashes of all runs of ``words`` words of a whole text; a shorter text is one run."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    k = min(words, len(parts))
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    stops = (ends[k - 1 :] - 1).tolist()
    starts = [0, *ends[: len(parts) - k].tolist()]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts)))


def bands(found: np.ndarray) -> np.ndarray:
    """A key for each band of the signature, as signed longs; no shingles have no bands."""
    if not len(found):
        return np.zeros(0, dtype=np.int64)
    x = found.astype(np.uint32)
    least = np.full(BANDS * ROWS, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(x), BLOCK):
        np.minimum(least, (_TIMES * x[at : at + BLOCK] + _PLUS).min(axis=1), out=least)
    return np.array([xxhash.xxh64_intdigest(b.tobytes(), k) for k, b in enumerate(least.reshape(BANDS, ROWS))], dtype=np.uint64).view(np.int64)


def similar(own: int, other: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Is the Jaccard similarity of sets of these sizes and common members at least ``LEAST``?"""
    return LEAST[1] * both >= LEAST[0] * (own + other - both)


def set_links(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links ``(i, j)`` of similar sets whose components are those of all similar pairs.

    A component is walked from a set of it; each set is compared with every set that no walk has reached yet.
    """
    if not sets:
        return []
    sizes = np.array([len(s) for s in sets])
    numbers = np.unique(np.concatenate(sets), return_inverse=True)[1].ravel()
    own = np.split(numbers, np.cumsum(sizes)[:-1])
    mark = np.zeros(int(numbers.max(initial=-1)) + 1, dtype=bool)
    out, todo = [], np.arange(len(sets))
    flat, walk = numbers, []
    while len(todo):
        if not walk:
            walk.append(int(todo[0]))
            flat, todo = flat[sizes[todo[0]] :], todo[1:]
            continue
        at = walk.pop()
        mark[own[at]] = True
        total = np.concatenate([[0], np.cumsum(mark[flat])])
        mark[own[at]] = False
        ends = np.cumsum(sizes[todo])
        hit = similar(sizes[at], sizes[todo], total[ends] - total[ends - sizes[todo]])
        if hit.any():
            out += [(at, j) for j in todo[hit].tolist()]
            walk += todo[hit].tolist()
            flat, todo = flat[np.repeat(~hit, sizes[todo])], todo[~hit]
    return out


def _marked(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).alias("key"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``mark`` (a hash of the text), ``set`` (one of its shingle set), ``size`` of the set, its SimHash ``fingerprint``, and ``bands``."""
    small_batches(docs.sparkSession)
    rows = _marked(docs, key, text)
    schema = T.StructType([rows.schema["key"], rows.schema["mark"], T.StructField("set", T.LongType()), T.StructField("size", T.LongType()), T.StructField("fingerprint", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            found = [shingles(t) for t in batch.column("text").to_pylist()]
            prints = np.array([fingerprint_of(s) for s in found], dtype=np.uint64).view(np.int64)
            ids = np.array([xxhash.xxh64_intdigest(s.tobytes(), 7) for s in found], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("key"), "mark": batch.column("mark"), "set": pa.array(ids), "size": pa.array([len(s) for s in found], pa.int64()),
                "fingerprint": pa.array(prints), "bands": pa.array([bands(s) for s in found], pa.list_(pa.int64())),
            })

    return rows.mapInArrow(run, schema)


def print_proposals(signed: DataFrame) -> DataFrame:
    """``(set, least)``: a set and the least one of its fingerprint, and the least ones of fingerprints that differ in few bits."""
    rows = signed.where("size > 0").select("set", "fingerprint").distinct()
    least = materialise(rows.groupBy("fingerprint").agg(F.min("set").alias("least")), "prints")
    own = rows.join(least, "fingerprint").select("set", "least")
    at = lambda c: least.select(F.col("fingerprint").alias(c), F.col("least").alias(f"{c}_set"))
    near = fingerprint_links(least.select("fingerprint")).join(at("a"), "a").join(at("b"), "b").select(F.greatest("a_set", "b_set").alias("set"), F.least("a_set", "b_set").alias("least"))
    return own.unionByName(near).where("set != least").distinct()


def band_proposals(signed: DataFrame) -> DataFrame:
    """``(set, least)``: a set and the least one that shares a band with it, where that is another one."""
    rows = signed.select("set", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.min("set").alias("least"), F.max("set").alias("most")).where("least < most").select("band", "least")
    return rows.join(shared, "band").where("set != least").select("set", "least").distinct()


def similar_links(docs: DataFrame, signed: DataFrame, key: str = "doc_id", text: str = "text", part_shingles: int = PART_SHINGLES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Links ``(a, b)`` of shingle sets (by ``set`` of ``signatures``) that are compared and similar.

    The text of one row of each proposed set goes to its group. Groups of more than ``part_shingles`` shingles are dealt
    in parts, and each pair of parts meets in a task of its own, so no task holds more than two parts.
    """
    spark = docs.sparkSession
    groups = components(materialise(print_proposals(signed).unionByName(band_proposals(signed)), "proposals"), "set", "least").withColumnsRenamed({"node": "set", "component": "group"})
    picks = signed.select("key", "mark", "set", "size").join(groups, "set").groupBy("set", "group").agg(F.min("size").alias("size"), F.min(F.struct("key", "mark")).alias("pick"))
    picks = materialise(picks.select("pick.*", "set", "group", "size"), "picks")
    large = picks.groupBy("group").agg(F.sum("size").alias("n")).where(F.col("n") > part_shingles).select("group", F.ceil(F.col("n") / part_shingles).cast("long").alias("parts"))
    wanted = picks.join(large, "group", "left").select(F.col("key").alias("__key"), F.col("mark").alias("__mark"), "set", "group", F.coalesce("parts", F.lit(1).cast("long")).alias("parts"))
    few = picks.count() <= broadcast_rows
    rows = _marked(docs, key, text).join(F.broadcast(wanted) if few else wanted, F.col("mark").eqNullSafe(F.col("__mark")) & F.col("key").eqNullSafe(F.col("__key"))).select("text", "set", "group", "parts")

    def sets(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            found = [shingles(t).view(np.int64) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in ("set", "group", "parts")} | {"members": pa.array(found, pa.list_(pa.int64()))})

    small_batches(spark)
    rows = rows.mapInArrow(sets, "set long, `group` long, parts long, members array<long>")
    part = F.pmod(F.xxhash64("set"), F.col("parts"))
    # part p meets part q in the cell (min, max); a row goes to the cells of its own part
    cell = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda q: F.greatest(q, part) * F.col("parts") + F.least(q, part))
    rows = rows.select("set", "group", "members", F.explode(cell).alias("cell"))
    rows = rows.repartition(max(shuffle_partitions(spark), 1), "group", "cell").sortWithinPartitions("group", "cell")

    def links(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(held: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
            if found := set_links(list(held.values())):
                ids = np.array(list(held), dtype=np.int64)
                a, b = ids[np.array(found)].T
                yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

        at, held = None, {}
        for batch in batches(it):
            places = zip(batch.column("group").to_pylist(), batch.column("cell").to_pylist(), strict=True)
            for i, (place, one) in enumerate(zip(places, batch.column("set").to_pylist(), strict=True)):
                if place != at:
                    yield from flush(held)
                    at, held = place, {}
                if one not in held:  # rows of one key and text
                    held[one] = batch.column("members")[i].values.to_numpy().view(np.uint64).copy()
        yield from flush(held)

    return rows.mapInArrow(links, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", part_shingles: int = PART_SHINGLES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``key`` and ``component_id``, the smallest key reachable by links, for every row. Texts with no words are equal."""
    signed = materialise(signatures(docs, key, text), "signatures")
    joined = components(materialise(similar_links(docs, signed, key, text, part_shingles, broadcast_rows), "similar"))
    least = signed.groupBy("set").agg(F.min("key").alias("__least"))
    named = least.join(joined, least["set"] == joined["node"], "left").select("set", "__least", F.coalesce("component", "set").alias("__root"))
    names = named.groupBy("__root").agg(F.min("__least").alias("component_id"))
    classes = named.select("set", "__root").join(names, "__root").select("set", "component_id")
    return signed.select(F.col("key").alias(key), "set").join(classes, "set").select(key, "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", part_shingles: int = PART_SHINGLES, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row of each group of near-duplicates, as ``simhash.keep_least`` chooses it."""
    return keep_least(docs, near_duplicates(docs.select(key, text), key, text, part_shingles, broadcast_rows), key, broadcast_rows)
