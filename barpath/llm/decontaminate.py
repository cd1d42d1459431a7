"""Operator 9, benchmark decontamination with suffix arrays of the training text.

A task turns its documents into one array of word numbers, sorts the suffixes that can match (a shard's suffix array) and
binary-searches every benchmark suffix in it. Matches are then followed as far as they go. The benchmark is handed to the
tasks in slices of a bounded size; a larger benchmark takes more passes over the rows, with no shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barpath.llm.common import batches, small_batches, table

WINDOW = 10
#: Characters of benchmark text that go to the tasks at once.
SLICE_CHARS = 16_000_000
#: Words whose suffixes are sorted at a time; a longer document is a shard by itself.
SHARD_WORDS = 1 << 21

_FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class Benchmark:
    """A slice of the benchmark as word numbers, with its windows sorted."""

    def __init__(self, items: list[tuple[str, str]], window: int = WINDOW):
        self.window, self.vocabulary, self.items = window, {}, [i for i, _ in items]
        number = self.vocabulary.setdefault
        self.words = [np.array([number(w, len(self.vocabulary) + 1) for w in words(t)], dtype=">i4") for _, t in items]
        size = len(self.vocabulary) + 1
        pairs = [w[:-1].astype(np.int64) * size + w[1:] for w in self.words]
        self.pairs = np.unique(np.concatenate([*pairs, np.zeros(0, np.int64)]))
        # all items end to end, each followed by 0; places[k][window] lists the positions of a window of k words in them
        self.flat = np.concatenate([*(np.append(w, 0) for w in self.words), np.zeros(1, np.int64)]).astype(np.int64)
        self.item_of = np.repeat(np.arange(len(self.words)), [len(w) + 1 for w in self.words])
        self.begin = np.cumsum([0, *(len(w) + 1 for w in self.words)])
        self.places: dict[int, dict[bytes, list[int]]] = defaultdict(lambda: defaultdict(list))
        for n, w in enumerate(self.words):
            if k := min(window, len(w)):
                for j in range(len(w) - k + 1):
                    self.places[k][w[j : j + k].tobytes()].append(int(self.begin[n]) + j)
        self.sorted = {k: np.array(sorted(v), dtype=f"S{4 * k}") for k, v in self.places.items()}

    def numbers(self, text: str | None) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(w, 0) for w in words(text)], dtype=np.int64)

    def search(self, ids: np.ndarray) -> Iterator[tuple[int, bytes, np.ndarray]]:
        """(k, window, its positions) for every benchmark window that occurs in ``ids``; 0 is a word of no item."""
        if not len(ids) or not self.sorted:
            return
        size = len(self.vocabulary) + 1
        chain = np.zeros(len(ids), dtype=bool)  # does the benchmark hold this word and the next one, in this order
        near = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
        if len(self.pairs):
            key = ids[near] * size + ids[near + 1]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            chain[near] = self.pairs[at] == key
        ends = np.flatnonzero(~chain)  # the last position is always an end
        run = ends[np.searchsorted(ends, np.arange(len(ids)))] - np.arange(len(ids)) + 1
        for k, tests in self.sorted.items():
            starts = np.flatnonzero((run >= k) & (ids > 0))
            if not len(starts):
                continue
            suffixes = np.ascontiguousarray(ids[starts[:, None] + np.arange(k)].astype(">i4")).view(f"S{4 * k}").ravel()
            array = np.argsort(suffixes, kind="stable")
            suffixes = suffixes[array]
            low, high = np.searchsorted(suffixes, tests, "left"), np.searchsorted(suffixes, tests, "right")
            for t in np.flatnonzero(high > low).tolist():
                yield k, tests[t].ljust(4 * k, b"\0"), starts[array[low[t] : high[t]]]

    def matches(self, ids: np.ndarray, doc_of: np.ndarray, first: np.ndarray) -> tuple[dict[int, list[tuple[str, int, int, int]]], dict[int, set[str]]]:
        """By document: matches as (item, position in the item, position in the document, words), and the items of all windows
        that occur.

        From the first window on, each match is the longest that any item has there; the next one is sought from the first
        window that goes beyond its end. So matches together cover all that windows cover, and their number grows with the
        text, also where item and document repeat one word.
        """
        found: dict[int, list[tuple[str, int, int, int]]] = defaultdict(list)
        items: dict[int, set[str]] = defaultdict(set)
        whole: dict[int, list[int]] = {}
        for k, window, positions in self.search(ids):
            places = self.places[k][window]
            owners = {self.items[n] for n in np.unique(self.item_of[places]).tolist()}
            for d in np.unique(doc_of[positions]).tolist():
                items[d] |= owners
            if k == self.window:
                whole.update(dict.fromkeys(positions.tolist(), places))
                continue
            for p in positions.tolist():
                self._add(found, doc_of, first, places[0], p, k)
        end = -1
        for p in sorted(whole):
            if p + self.window <= end:
                continue
            at, length = np.array(whole[p]), self.window
            while p + length < len(ids) and ids[p + length]:
                on = self.flat[at + length] == ids[p + length]
                if not on.any():
                    break
                at, length = at[on], length + 1
            end = p + length
            self._add(found, doc_of, first, int(at[0]), p, length)
        return found, items

    def _add(self, found: dict, doc_of: np.ndarray, first: np.ndarray, at: int, p: int, length: int) -> None:
        n, d = int(self.item_of[at]), int(doc_of[p])
        found[d].append((self.items[n], at - int(self.begin[n]), p - int(first[d]), length))


MATCH = T.ArrayType(T.StructType([T.StructField("item_id", T.StringType()), T.StructField("item_word", T.LongType()), T.StructField("doc_word", T.LongType()), T.StructField("words", T.LongType())]))
_MATCH = pa.list_(pa.struct([("item_id", pa.string()), ("item_word", pa.int64()), ("doc_word", pa.int64()), ("words", pa.int64())]))
_ADDED = ("n_words", "n_hit", "bench_items", "matches")


def covered(found: list[tuple[str, int, int, int]]) -> int:
    total = end = 0
    for a, b in sorted((m[2], m[2] + m[3]) for m in found):
        total += max(0, b - max(a, end))
        end = max(end, b)
    return total


def _slices(bench: DataFrame, item: str, text: str, most: int) -> Iterator[list[tuple[str, str]]]:
    rows = bench.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    n = -(-(rows.agg(F.sum(F.length("t"))).first()[0] or 0) // most) or 1
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [(r.i, r.t) for r in part.collect()]


def find_matches(docs: DataFrame, bench: DataFrame, text: str = "text", item: str = "item_id", window: int = WINDOW, slice_chars: int = SLICE_CHARS) -> DataFrame:
    """All columns of ``docs`` and ``n_words``, ``n_hit``, ``bench_items`` (ids as strings, sorted), ``matches``.

    A window is ``window`` consecutive words of an item; a shorter item with words is one window. ``bench_items`` are all
    items that have a window in the document; ``matches`` the longest runs of words that cover what windows cover, each with
    one item that has it. Null and empty texts have no words; items of no words match nothing; a null item id counts as the
    empty string; items that repeat an id count once. Very long texts are whole. Columns of the names added are replaced.
    Every row stays, repeated ones too; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    small_batches(spark)
    keep = [f for f in docs.schema.fields if f.name not in _ADDED]
    names = [f.name for f in keep]
    schema = T.StructType([*keep, T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("bench_items", T.ArrayType(T.StringType())), T.StructField("matches", MATCH)])
    out = docs.select(*names)
    for n, items in enumerate(_slices(bench, item, text, slice_chars)):
        shared = spark.sparkContext.broadcast(items)

        def run(it: Iterator[pa.RecordBatch], shared=shared, later=n > 0) -> Iterator[pa.RecordBatch]:
            test = Benchmark(shared.value, window)
            for batch in batches(it):
                ids = [test.numbers(t) for t in batch.column(text).to_pylist()]
                found: list[list] = [[] for _ in ids]
                items_of: list[set] = [set() for _ in ids]
                at = 0
                while at < len(ids):  # a shard of whole documents
                    end, size = at + 1, len(ids[at])
                    while end < len(ids) and size + len(ids[end]) <= SHARD_WORDS:
                        size += len(ids[end])
                        end += 1
                    part = [x for d in ids[at:end] for x in (d, np.zeros(1, np.int64))]
                    lengths = np.array([len(d) + 1 for d in ids[at:end]])
                    first = np.concatenate([[0], np.cumsum(lengths)])
                    matches, owners = test.matches(np.concatenate(part), np.repeat(np.arange(end - at), lengths), first)
                    for d, m in matches.items():
                        found[at + d], items_of[at + d] = m, owners[d]
                    at = end
                if later:
                    old = batch.column("matches").to_pylist()
                    found = [f + [tuple(m.values()) for m in o] for f, o in zip(found, old, strict=True)]
                    items_of = [i | set(o) for i, o in zip(items_of, batch.column("bench_items").to_pylist(), strict=True)]
                columns = {c: batch.column(c) for c in names}
                columns["n_words"] = pa.array([len(d) for d in ids], pa.int64())
                columns["n_hit"] = pa.array([covered(f) for f in found], pa.int64())
                columns["bench_items"] = pa.array([sorted(i) for i in items_of], pa.list_(pa.string()))
                columns["matches"] = pa.array([[dict(zip(("item_id", "item_word", "doc_word", "words"), m, strict=True)) for m in f] for f in found], _MATCH)
                yield pa.RecordBatch.from_pydict(columns)

        out = out.mapInArrow(run, schema)
    return out


def decontaminate(docs: DataFrame, bench: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that share no window with the benchmark, with their columns."""
    return find_matches(docs, bench, text).where("n_hit = 0").select(*docs.columns)


def op9_decontaminate(spark, sf_dir: str) -> DataFrame:
    found = find_matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("bench_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("bench_items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )
