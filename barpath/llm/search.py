"""Operator 11, ranked lexical search by Block-Max WAND.

The index is a table. A task takes its documents in shards of some millions of terms, orders them by key and writes a row for
each term of a shard: its postings, cut into blocks of ``BLOCK`` documents. Of a block the heads are kept open (the last
document, the largest impact of a posting, how its numbers are packed); gaps between documents and term frequencies are packed
in as few bits as the block needs. The impact of a posting is what the term adds to the score for each unit of its weight.

A search takes the rows of the queries' terms to their shards. For a query, the shallow pointers of all its lists move over the
heads alone: the ends of blocks cut the documents of a shard into spans, and in a span the score is at most the sum of the
weighted largest impacts of the blocks that lie over it. Lists whose largest impacts together stay below the
threshold are no pivots: a span without a block of another list is passed over. Spans are taken from the highest bound down, and
once the bound is below the threshold (the score of the last document held), what is left is skipped before it
is unpacked. Blocks are unpacked once in a shard, however many queries read them. The threshold goes on from shard to shard
of a task; the tasks' best are merged by a window with a limit.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barpath.llm.common import batches, small_batches, table
from barpath.session import scratch_dir, shuffle_partitions

TOP = 50
#: Postings of a block.
BLOCK = 128
#: Terms with repeats, and documents, after which a shard ends.
SHARD_TERMS = 1 << 21
SHARD_DOCS = 1 << 16
#: Queries, and distinct terms of theirs, that are broadcast at a time: more queries go in several rounds.
QUERIES = 4096
QUERY_TERMS = 1 << 16
UNIT = 1_000_000_000

#: Of the bytes of UTF-8, those of terms stay (A-Z in lower case); all others become spaces.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

#: A row of the index: ``term`` null has the shard's documents (keys, lengths); ``n`` counts documents.
ROWS = "shard long, term string, n long, heads binary, body binary"


def words(text: str | None) -> list[bytes]:
    """The terms of a text, with repeats."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERMS).split()


# Blocks.


def bits(values: np.ndarray) -> np.ndarray:
    """How many bits each of some numbers below 2**32 needs; at least one."""
    return np.maximum(np.frexp(values.astype(np.float64))[1], 1).astype(np.uint8)


def _places(counts: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first byte of each block of ``counts`` numbers of ``widths`` bits (and the end), and the first bit of each number."""
    size = (counts.astype(np.int64) * widths + 7) >> 3
    at = np.concatenate([[0], np.cumsum(size)])
    place = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return at, np.repeat(at[:-1] * 8, counts) + place * np.repeat(widths.astype(np.int64), counts)


def pack(values: np.ndarray, counts: np.ndarray, widths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of blocks, each block in bits of its width: the bytes, and where each block begins in them (and the end)."""
    at, first = _places(counts, widths)
    out = np.zeros(int(at[-1]) * 8, np.uint8)
    of = np.repeat(widths, counts)
    for w in np.unique(widths).tolist():
        mine = np.flatnonzero(of == w)
        for k in range(w):
            out[first[mine] + k] = (values[mine] >> k) & 1
    return np.packbits(out, bitorder="little"), at


def unpack(body: np.ndarray, counts: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """The numbers again: the blocks follow one another in ``body``."""
    _, first = _places(counts, widths)
    raw = np.unpackbits(body, bitorder="little")
    of = np.repeat(widths, counts)
    out = np.zeros(len(of), np.int64)
    for w in np.unique(widths).tolist():
        mine = np.flatnonzero(of == w)
        value = np.zeros(len(mine), np.int64)
        for k in range(w):
            value |= raw[first[mine] + k].astype(np.int64) << k
        out[mine] = value
    return out


_HEAD = np.dtype([("last", "<u4"), ("impact", "<i8"), ("count", "u1"), ("gap_bits", "u1"), ("tf_bits", "u1"), ("size", "<u2")])


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return UNIT * tf // (1000 * tf + 20 * m)


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


# The index.


class Index:
    """An index in a folder that all executors share: the table ``postings``, and the counts N (documents with a term) and L
    (terms with repeats)."""

    def __init__(self, spark: SparkSession, path: str, n: int, length: int):
        self.spark, self.path, self.n, self.length = spark, path, n, length

    @property
    def postings(self) -> DataFrame:
        return self.spark.read.schema(ROWS).parquet(f"{self.path}/postings")

    def frequencies(self) -> DataFrame:
        """(term, df) of the whole corpus."""
        return self.postings.where("term is not null").groupBy("term").agg(F.sum("n").alias("df"))


def _shard(number: int, keys: list[int | None], held: list[np.ndarray], vocabulary: dict[bytes, int], n: int, length: int) -> pa.RecordBatch:
    """The rows of a shard, terms rising. ``held``: the terms of each document as numbers of the vocabulary."""
    held = [held[i] for i in sorted(range(len(keys)), key=lambda i: (keys[i] is None, keys[i] or 0))]
    sizes = np.array([len(w) for w in held], np.int64)
    m = 100 - 50 + 50 * sizes * n // length
    names = sorted(vocabulary)
    rank = np.empty(len(names), np.int64)
    rank[[vocabulary[w] for w in names]] = np.arange(len(names))
    pairs, tf = np.unique(rank[np.concatenate(held)] << 32 | np.repeat(np.arange(len(held)), sizes), return_counts=True)
    term, doc = pairs >> 32, pairs & 0xFFFFFFFF
    # blocks: of one term, BLOCK postings at most
    begin = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]]))
    df = np.diff(np.append(begin, len(term)))
    place = np.arange(len(term)) - np.repeat(begin, df)
    starts = np.flatnonzero(place % BLOCK == 0)
    counts = np.diff(np.append(starts, len(term)))
    gap = doc - np.where(place == 0, -1, np.concatenate([[0], doc[:-1]])) - 1
    heads = np.zeros(len(starts), _HEAD)
    heads["last"] = doc[starts + counts - 1]
    heads["impact"] = np.maximum.reduceat(impacts(tf, m[doc]), starts)
    heads["count"] = counts
    heads["gap_bits"], heads["tf_bits"] = bits(np.maximum.reduceat(gap, starts)), bits(np.maximum.reduceat(tf - 1, starts))
    # the gaps of a block and then its frequencies
    two = np.repeat(counts, 2)
    widths = np.column_stack([heads["gap_bits"], heads["tf_bits"]]).ravel()
    block = np.repeat(np.arange(len(starts)), counts)
    into = np.arange(len(term)) + np.repeat(np.cumsum(counts) - counts, counts)
    values = np.empty(2 * len(term), np.int64)
    values[into] = gap
    values[into + counts[block]] = tf - 1
    body, at = pack(values, two, widths)
    heads["size"] = at[2::2] - at[:-1:2]
    blocks = np.append(np.searchsorted(starts, begin), len(starts))
    binary = lambda data, ends: pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(data)])
    known = np.array([k for k in keys if k is not None], np.int64)
    documents = [pa.array([np.sort(known).tobytes()], pa.binary()), pa.array([m.astype("<i8").tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(names) + 1, number)), pa.array([None, *(w.decode("utf-8", "surrogatepass") for w in names)]), pa.array(np.append(len(held), df)),
        pa.concat_arrays([documents[0], binary(heads.tobytes(), blocks * _HEAD.itemsize)]), pa.concat_arrays([documents[1], binary(body.tobytes(), at[2 * blocks])]),
    ], names=["shard", "term", "n", "heads", "body"])


def build_index(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_terms: int = SHARD_TERMS) -> Index:
    """Index every row that has a term, in the shared folder."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = length = 0
        for batch in batches(it):
            sizes = [len(words(t)) for t in batch.column("text").to_pylist()]
            n, length = n + sum(map(bool, sizes)), length + sum(sizes)
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "length": pa.array([length], pa.int64())})

    sums = rows.select("text").mapInArrow(count, "n long, length long").agg(F.sum("n").alias("n"), F.sum("length").alias("length")).first()
    n, length = sums.n or 0, sums.length or 0

    def shards(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        empty = lambda: ([], [], defaultdict(itertools.count().__next__), 0)
        keys, held, vocabulary, size = empty()
        for batch in batches(it):
            for k, t in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if w := words(t):
                    keys.append(k)
                    held.append(np.fromiter(map(vocabulary.__getitem__, w), np.int32, len(w)))
                    size += len(w)
                if size >= shard_terms or len(keys) >= SHARD_DOCS:
                    yield _shard(number, keys, held, vocabulary, n, length)
                    number += 1
                    keys, held, vocabulary, size = empty()
        if held:
            yield _shard(number, keys, held, vocabulary, n, length)

    path = f"{scratch_dir(spark)}/index-{uuid.uuid4().hex}"
    rows.mapInArrow(shards, ROWS).write.option("compression", "zstd").parquet(f"{path}/postings")
    return Index(spark, path, n, length)


# Searching.


class Shard:
    """The lists of a shard that queries ask for."""

    def __init__(self, rows: list[tuple]):
        """Rows (term, n, heads, body) of one shard."""
        documents = next(r for r in rows if r[0] is None)
        self.n = documents[1]
        self.keys, self.m = np.frombuffer(documents[2], np.int64), np.frombuffer(documents[3], np.int64)
        self.heads = {t: np.frombuffer(h, _HEAD) for t, _, h, _ in rows if t is not None}
        self.bodies = {t: np.frombuffer(b, np.uint8) for t, _, _, b in rows if t is not None}
        self.open: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        self.unpacked = 0

    def postings(self, term: str, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, impact) of the wanted blocks of a list, which are unpacked unless they have been."""
        heads = self.heads[term]
        if term not in self.open:
            ends = np.cumsum(heads["count"], dtype=np.int64)
            self.open[term] = ends - heads["count"], np.zeros(len(heads), bool), np.zeros(ends[-1], np.int64), np.zeros(ends[-1], np.int64)
        first, known, docs, scores = self.open[term]
        new = wanted[~known[wanted]]
        if len(new):
            h = heads[new]
            counts = h["count"].astype(np.int64)
            size = heads["size"].astype(np.int64)
            begin = (np.cumsum(size) - size)[new]
            spread = lambda start, n: np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())
            values = unpack(self.bodies[term][spread(begin, size[new])], np.repeat(counts, 2), np.column_stack([h["gap_bits"], h["tf_bits"]]).ravel())
            at = np.cumsum(2 * counts) - 2 * counts
            gap, tf = values[spread(at, counts)] + 1, values[spread(at + counts, counts)] + 1
            run = np.cumsum(gap)
            before = np.where(new > 0, heads["last"][np.maximum(new, 1) - 1].astype(np.int64), -1)
            head = np.cumsum(counts) - counts
            into = spread(first[new], counts)
            docs[into] = run - np.repeat(run[head] - gap[head] - before, counts)
            scores[into] = impacts(tf, self.m[docs[into]])
            known[new] = True
            self.unpacked += len(new)
        into = np.repeat(first[wanted] - np.cumsum(heads["count"][wanted], dtype=np.int64) + heads["count"][wanted], heads["count"][wanted]) + np.arange(int(heads["count"][wanted].sum()))
        return docs[into], scores[into]

    def key(self, doc: int) -> int | None:
        return int(self.keys[doc]) if doc < len(self.keys) else None

    def search(self, query: list[tuple[str, int]], best: list[tuple[int, int, int | None]], top: int) -> list[tuple[int, int, int | None]]:
        """The ``top`` best of ``best`` and this shard, as (-score, key or the largest number, key): the best first."""
        lists = [(t, w, self.heads[t]) for t, w in query if w > 0 and t in self.heads]
        if not lists:
            return best
        worst = best[-1] if len(best) == top else (0, 0, None)
        need = -worst[0]  # what a document must reach; at this very score, by a lesser key
        # spans between the ends of blocks, and what a document in each of them can reach
        ends = np.unique(np.concatenate([h["last"] for _, _, h in lists]).astype(np.int64))
        over = [np.searchsorted(h["last"], ends) for _, _, h in lists]  # the block over each span
        bound = np.zeros(len(ends), np.int64)
        pivots = np.zeros(len(ends), bool)
        most = [w * int(h["impact"].max()) for _, w, h in lists]
        weak = 0
        for k in sorted(range(len(lists)), key=most.__getitem__):
            _, w, h = lists[k]
            here = over[k] < len(h)
            bound[here] += w * h["impact"][over[k][here]]
            weak += most[k]
            if weak >= need:  # a document of the weaker lists alone is below the threshold
                pivots |= here
        order = np.flatnonzero(pivots & (bound >= need))
        order = order[np.argsort(-bound[order], kind="stable")]
        at = 0
        while at < len(order):
            take = order[at : at + max(8, len(order) // 8)]
            take = take[bound[take] >= need]
            at += max(8, len(order) // 8)
            if not len(take):
                break
            inside = np.zeros(len(ends), bool)
            inside[take] = True
            score = np.zeros(self.n, np.int64)
            for (t, w, h), o in zip(lists, over, strict=True):
                blocks = np.unique(o[take])
                docs, scores = self.postings(t, blocks[blocks < len(h)])
                score[docs] += w * scores
            score[~inside[np.minimum(np.searchsorted(ends, np.arange(self.n)), len(ends) - 1)]] = 0
            hit = np.flatnonzero(score >= max(need, 1))
            if len(hit) > top:  # documents are in the order of their keys
                hit = hit[np.argsort(-score[hit], kind="stable")[:top]]
            best = sorted([*best, *((-int(score[d]), 1 << 63 if self.key(d) is None else self.key(d), self.key(d)) for d in hit.tolist())])[:top] if len(hit) else best
            if len(best) == top:
                need = -best[-1][0]
        return best


def _round(index: Index, queries: list[tuple[int, list[str]]], top: int) -> DataFrame:
    """(query, key, score): the best of each task, for one round of queries."""
    spark = index.spark
    asked = spark.createDataFrame([(t,) for t in sorted({t for _, ts in queries for t in ts})], "term string")
    found = index.postings.join(F.broadcast(asked), "term", "left_semi")  # QUERY_TERMS and one query's at most
    df = {r.term: r.df for r in found.groupBy("term").agg(F.sum("n").alias("df")).collect()}
    weighted = [(q, [(t, weight(index.n, df[t])) for t in ts if t in df]) for q, ts in queries]
    shared = spark.sparkContext.broadcast([q for q in weighted if q[1]])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {}
        held, now = [], None

        def search() -> None:
            shard = Shard(held)
            if len(shard.heads):
                for q, lists in shared.value:
                    best[q] = shard.search(lists, best.get(q, []), top)

        for batch in batches(it):
            for number, *row in zip(*(batch.column(c).to_pylist() for c in ("shard", "term", "n", "heads", "body")), strict=True):
                if held and number != now:
                    search()
                    held = []
                now = number
                held.append(row)
        if held:
            search()
        rows = [(q, key, -score) for q, found in best.items() for score, _, key in found]
        if rows:
            q, key, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(key, pa.int64()), pa.array(score, pa.int64())], names=["query", "key", "score"])

    rows = found.select("shard", "term", "n", "heads", "body").unionByName(index.postings.where("term is null"))
    rows = rows.repartition(shuffle_partitions(spark), "shard").sortWithinPartitions("shard")
    return rows.mapInArrow(run, "query long, key long, score long")


def search(index: Index, items: DataFrame, key: str = "item_id", text: str = "text", top: int = TOP) -> DataFrame:
    """Per query the ``top`` documents of the highest scores above 0: ``key``, ``rank`` (from 1, equal scores by rising document
    key, null keys last), ``doc_id``, ``score``.

    Each row of ``items`` is a query of its own, rows that repeat a key too; one without a term that the index has gives no rows, and so
    does an empty table of either kind. Repeated documents are documents of their own. Queries are read by the driver in rounds of
    ``QUERIES`` at most, whose terms are broadcast.
    """
    spark = index.spark
    names, parts, queries, terms_ = [], [], [], 0
    for q, r in enumerate(items.select(F.col(key).alias("key"), F.col(text).alias("text")).toLocalIterator()):
        distinct = sorted({w.decode("utf-8", "surrogatepass") for w in words(r.text)})
        names.append((q, r.key))
        queries.append((q, distinct))
        terms_ += len(distinct)
        if len(queries) >= QUERIES or terms_ >= QUERY_TERMS:
            parts.append((_round(index, queries, top), names))
            names, queries, terms_ = [], [], 0
    if queries:
        parts.append((_round(index, queries, top), names))
    kind = items.schema[key].dataType
    out = spark.createDataFrame([], f"`{key}` {kind.simpleString()}, rank int, doc_id long, score long")
    for part, names in parts:
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
        ranked = part.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        named = F.broadcast(spark.createDataFrame(names, f"query long, name {kind.simpleString()}"))  # QUERIES at most
        out = out.unionByName(ranked.join(named, "query").select(F.col("name").alias(key), "rank", F.col("key").alias("doc_id"), "score"))
    return out


def op11_search(spark, sf_dir: str) -> DataFrame:
    return search(build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def oracle_sql() -> str:
    """The same by joins and one ranking, in DuckDB."""
    split = r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, {split.format('text')} AS w FROM documents WHERE text IS NOT NULL),
    k AS (SELECT row, doc_id, len(w) AS n, w FROM d WHERE len(w) > 0), s AS (SELECT COUNT(*)::BIGINT AS n_docs, SUM(n)::BIGINT AS l FROM k),
    p AS (SELECT row, term, COUNT(*) AS tf FROM (SELECT row, UNNEST(w) AS term FROM k) GROUP BY 1, 2),
    q AS (SELECT item_id, UNNEST(list_distinct({split.format('text')})) AS term FROM benchmark WHERE text IS NOT NULL),
    f AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * COUNT(*) + 1))) AS BIGINT) AS w FROM p, s WHERE term IN (SELECT term FROM q) GROUP BY term, n_docs),
    x AS (SELECT item_id, k.doc_id, k.row, SUM(f.w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * k.n * n_docs) // l))))::BIGINT AS score FROM q JOIN f USING (term) JOIN p USING (term) JOIN k USING (row), s GROUP BY 1, 2, 3),
    r AS (SELECT item_id, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, row) AS rank, doc_id, score FROM x WHERE score > 0)
    SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r WHERE rank <= 50"""
