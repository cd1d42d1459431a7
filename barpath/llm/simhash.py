"""Operator 8, SimHash near-duplicates through broadcast BK-trees.

Two fingerprints that differ in at most ``radius`` bits agree in at least one of ``radius + 1`` blocks: they share the shard of that
block and its value. A shard is a BK-tree: children are keyed by their integer Hamming distance to the parent, and a search
follows only the edges within the radius. Trees of a task are built and searched together, a level at a time.

Shards are dealt to rounds of a bounded size. A round is broadcast, and only the fingerprints of its shards are read: a task gets
those of some shards, makes their trees from the broadcast and searches them. So a fingerprint is broadcast and read once for each
of its blocks, whatever the number of rounds. Of a shard that is larger than a round, each part is broadcast by itself and searched by the
whole shard.

``shuffled_links`` brings each fingerprint to the shards of its blocks by a shuffle instead, and gives the same links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barpath.llm.common import batches, forest, small_batches, table
from barpath.operators.components import components
from barpath.session import materialise, shuffle_partitions

BITS = 64
RADIUS = 3
WORDS = 3
#: Rows of a round, a fingerprint in one of its shards each: four megabytes are broadcast at a time.
ROUND_ROWS = 1 << 18
#: Shards are dealt to rounds by so many buckets: their counts are known to the driver.
BUCKETS = 1 << 16
#: Rows of a round that a task searches, about.
TASK_ROWS = 1 << 14
#: Fingerprints that one tree of ``shuffled_links`` holds at most; larger shards are searched in pairs of parts.
TREE_ROWS = 4000
#: Keys that are broadcast at most when duplicates are dropped.
BROADCAST_ROWS = 200_000
#: Shingles whose bits are counted at a time.
BLOCK = 1 << 15

_MASKS = np.array([0xFF << (8 * i) for i in range(8)], dtype=np.uint64)


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The SimHash of a whole text: a bit is 1 if it is set in over half the hashes of its shingles."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    k = min(words, len(parts))
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    stops = (ends[k - 1 :] - 1).tolist()
    starts = [0, *ends[: len(parts) - k].tolist()]
    n = len(starts)
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, BLOCK):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at : at + BLOCK], stops[at : at + BLOCK], strict=True)], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > n).tolist())


def fingerprint_of(hashes: np.ndarray) -> int:
    """The SimHash of distinct shingles by their hashes, each once."""
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), BLOCK):
        counts += np.unpackbits(hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, text: str = "text", words: int = WORDS) -> DataFrame:
    """All columns but the text, and ``fingerprint`` as a signed long of the 64 bits."""
    small_batches(docs.sparkSession)
    keep = [f for f in docs.schema.fields if f.name not in (text, "fingerprint")]
    names = [f.name for f in keep]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            prints = np.array([fingerprint(t, words) for t in batch.column(text).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_pydict({n: batch.column(n) for n in names} | {"fingerprint": pa.array(prints, pa.int64())})

    return docs.select(*names, text).mapInArrow(run, T.StructType([*keep, T.StructField("fingerprint", T.LongType())]))


class BKForest:
    """BK-trees of many shards over one array of fingerprints. Node i is fingerprint i; a child is found by (parent, distance)."""

    def __init__(self, prints: np.ndarray, shard: np.ndarray):
        """``prints`` uint64, ``shard`` any integers; a row is in the tree of its shard."""
        n = len(prints)
        self.prints = prints
        self.shards, root = np.unique(shard, return_index=True)
        self.root = root
        node = root[np.searchsorted(self.shards, shard)]  # where a row stands on its way down
        todo = np.flatnonzero(node != np.arange(n))
        edges = []
        while len(todo):
            key = node[todo] * (BITS + 1) + np.bitwise_count(prints[todo] ^ prints[node[todo]]).astype(np.int64)
            seen, first, back = np.unique(key, return_index=True, return_inverse=True)
            edges.append((seen, todo[first]))
            node[todo] = todo[first][back]
            todo = todo[node[todo] != todo]
        keys = np.concatenate([e[0] for e in edges]) if edges else np.zeros(0, np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.child = (np.concatenate([e[1] for e in edges]) if edges else np.zeros(0, np.int64))[order]

    def search(self, prints: np.ndarray, shard: np.ndarray, radius: int, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) within the radius, in parts. A query visits its shard's root and then edges within the radius."""
        at = np.minimum(np.searchsorted(self.shards, shard), max(0, len(self.shards) - 1))
        there = np.flatnonzero(self.shards[at] == shard) if len(self.shards) else np.zeros(0, np.int64)
        stack = [(there[i : i + most], self.root[at[there[i : i + most]]]) for i in range(0, len(there), most)]
        while stack:
            query, node = stack.pop()
            if len(query) > most:
                stack += [(query[most:], node[most:])]
                query, node = query[:most], node[:most]
            d = np.bitwise_count(prints[query] ^ self.prints[node]).astype(np.int64)
            hit = d <= radius
            if hit.any():
                yield query[hit], node[hit]
            # one run of sorted keys holds a node's edges between two distances
            lo = np.searchsorted(self.keys, node * (BITS + 1) + np.maximum(0, d - radius))
            hi = np.searchsorted(self.keys, node * (BITS + 1) + np.minimum(BITS, d + radius), side="right")
            n = hi - lo
            if total := int(n.sum()):
                child = self.child[np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)]
                stack.append((np.repeat(query, n), child))


def _blocks(radius: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each of ``radius + 1`` blocks."""
    width = BITS // (radius + 1)
    return [(k * width, width if k < radius else BITS - k * width) for k in range(radius + 1)]


def _shard_column(radius: int):
    """The shards of a fingerprint, an array: the value of each block and, in the last eight bits, the block."""
    return F.array(*[F.shiftleft(F.shiftrightunsigned("fingerprint", at).bitwiseAND(F.lit((1 << n) - 1)), 8).bitwiseOR(F.lit(k)) for k, (at, n) in enumerate(_blocks(radius))])


def rounds_of(counts: dict[int, int], round_rows: int) -> list[tuple[int, int, int]]:
    """(first bucket, last bucket, parts): runs of buckets of ``round_rows`` rows at most; a larger bucket is a run of its own, in parts."""
    out, held = [], 0
    for bucket, n in sorted(counts.items()):
        if n > round_rows:
            out.append((bucket, bucket, -(-n // round_rows)))
            held = round_rows  # nothing joins it
        elif not out or held + n > round_rows:
            out.append((bucket, bucket, 1))
            held = n
        else:
            out[-1] = (out[-1][0], bucket, 1)
            held += n
    return out


def fingerprint_links(prints: DataFrame, radius: int = RADIUS, round_rows: int = ROUND_ROWS) -> DataFrame:
    """Links ``(a, b)``, a < b, whose components are those of all distinct ``fingerprint`` values within ``radius`` bits.

    Rows of fingerprint and shard are stored in the order of their buckets, so a round reads its own. Tasks send on a spanning
    forest of what they find.
    """
    spark = prints.sparkSession
    rows = prints.select("fingerprint", F.explode(_shard_column(radius)).alias("shard")).withColumn("bucket", F.pmod(F.xxhash64("shard"), F.lit(BUCKETS)))
    shards = materialise(rows.repartitionByRange(shuffle_partitions(spark), "bucket").sortWithinPartitions("bucket"), "shards")
    counts = {r["bucket"]: r["count"] for r in shards.groupBy("bucket").count().collect()}  # BUCKETS at most
    found = []
    for first, last, parts in rounds_of(counts, round_rows):
        own = shards.where(F.col("bucket").between(first, last)).select("fingerprint", "shard")
        size = sum(counts.get(b, 0) for b in range(first, last + 1))
        for k in range(parts):
            part = own.where(F.pmod(F.xxhash64("fingerprint"), F.lit(parts)) == k).toPandas()  # about round_rows at most
            shared = spark.sparkContext.broadcast((part["fingerprint"].to_numpy(np.int64).view(np.uint64), part["shard"].to_numpy(np.int64)))

            def search(it: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
                held = [(b.column("fingerprint").to_numpy().view(np.uint64), b.column("shard").to_numpy()) for b in batches(it)]
                if not held:
                    return
                asked, where = (np.concatenate(x) for x in zip(*held, strict=True))
                nodes, shard = shared.value
                mine = np.isin(shard, np.unique(where))
                nodes, shard = nodes[mine], shard[mine]
                for i, j in BKForest(nodes, shard).search(asked, where, radius):
                    a, b = nodes[j].view(np.int64), asked[i].view(np.int64)
                    a, b = forest(a[a != b], b[a != b])
                    if len(a):
                        yield pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

            tasks = max(1, min(shuffle_partitions(spark), -(-size // TASK_ROWS)))
            # a shard in parts may be any size: its rows go to all tasks, of which each makes the part's tree
            dealt = own.repartition(tasks, "shard") if parts == 1 else own.repartition(max(tasks, -(-size // round_rows)))
            found.append(materialise(dealt.mapInArrow(search, "a long, b long"), "links"))
            shared.unpersist()
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], "a long, b long")


def shuffled_links(prints: DataFrame, radius: int = RADIUS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """The links of ``fingerprint_links`` by a shuffle: a spanning forest of every shard.

    Shards with more than ``tree_rows`` fingerprints are dealt in parts, and each pair of parts meets in a task of its own,
    so no task holds more than two parts. Their number is known from a count per shard, whose large ones only are kept.
    """
    rows = prints.select("fingerprint", F.explode(_shard_column(radius)).alias("shard"))
    large = rows.groupBy("shard").count().where(F.col("count") > tree_rows).select("shard", F.ceil(F.col("count") / tree_rows).cast("long").alias("parts"))
    rows = rows.join(large, "shard", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    part = F.pmod(F.xxhash64("fingerprint"), F.col("parts"))
    # part p meets part q in the cell (min, max); a row goes to the cells of its own part
    cell = F.transform(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1), lambda q: F.greatest(q, part) * F.col("parts") + F.least(q, part))
    rows = rows.select("fingerprint", "shard", F.explode(cell).alias("cell"))
    n = max(int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")), 1)
    rows = rows.repartition(n, "shard", "cell").sortWithinPartitions("shard", "cell")

    def links(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush(block: np.ndarray) -> Iterator[pa.RecordBatch]:
            key = np.unique(block[:, 1:], axis=0, return_inverse=True)[1].ravel()
            p = np.ascontiguousarray(block[:, 0]).view(np.uint64)
            for a, b in BKForest(p, key).search(p, key, radius):
                keep = a < b
                a, b = forest(block[a[keep], 0], block[b[keep], 0])
                if len(a):
                    yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

        for batch in batches(it):
            held.append(np.column_stack([batch.column(c).to_numpy() for c in ("fingerprint", "shard", "cell")]))
            if sum(map(len, held)) >= 1 << 16:
                block = np.concatenate(held)
                last = np.flatnonzero((block[:, 1:] != block[-1, 1:]).any(axis=1))
                cut = int(last[-1]) + 1 if len(last) else 0  # the last tree may go on in the next batch
                if cut:
                    yield from flush(block[:cut])
                held = [block[cut:]]
        if held and sum(map(len, held)):
            yield from flush(np.concatenate(held))

    return rows.mapInArrow(links, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, words: int = WORDS, round_rows: int = ROUND_ROWS) -> DataFrame:
    """All columns but the text, ``fingerprint`` (long), and ``component_id``: the smallest key reachable by links.

    Texts of no words (null, empty, white space) have fingerprint zero and link with one another. Rows with equal
    fingerprints, repeated rows too, are in one component. A null key is never a component's name unless all its keys are
    null. Texts are read whole, however long. Columns of the names added are replaced. Every row stays. An empty table gives
    an empty table.
    """
    prints = materialise(with_fingerprints(docs.drop("component_id"), text, words), "prints")
    least = materialise(prints.groupBy("fingerprint").agg(F.min(key).alias("__least")), "distinct")
    joined = components(fingerprint_links(least, radius, round_rows))
    named = least.join(joined, least["fingerprint"] == joined["node"], "left").select("fingerprint", "__least", F.coalesce("component", "fingerprint").alias("__root"))
    names = named.groupBy("__root").agg(F.min("__least").alias("component_id"))
    classes = named.select("fingerprint", "__root").join(names, "__root").select("fingerprint", "component_id")
    return prints.join(classes, "fingerprint")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row of each group of near-duplicates, as ``keep_least`` chooses it."""
    return keep_least(docs, near_duplicates(docs.select(key, text), key, text), key, broadcast_rows)


def keep_least(docs: DataFrame, found: DataFrame, key: str = "doc_id", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row of each group of ``found`` (key, ``component_id``), with the columns of ``docs``: that with the smallest key, and
    of rows that share it the one of the least hash over all columns. Rows of a null key all stay: nothing names them.

    The keys to go are broadcast up to ``broadcast_rows`` of them, and joined by a shuffle beyond.
    """
    groups = materialise(found.where(F.col(key).isNotNull()).select(key, "component_id"), "groups")
    go = groups.where(F.col(key) != F.col("component_id")).select(key)
    repeated = groups.where(F.col(key) == F.col("component_id")).groupBy(key).count().where("count > 1").select(key)
    out = go.unionByName(repeated)
    n = out.count()
    kept = docs.join(F.broadcast(out) if n <= broadcast_rows else out, key, "left_anti").select(*docs.columns)
    if not repeated.isEmpty():
        same = docs.join(repeated, key, "left_semi").groupBy(key).agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*docs.columns)).alias("__row"))
        kept = kept.unionByName(same.select("__row.*"))
    return kept


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")
