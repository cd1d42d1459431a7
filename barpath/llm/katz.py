"""Operator 1, language-model scores: a Katz backoff model of any order, in partitioned tables.

Counts up to K are discounted by Good-Turing; larger ones keep all but TAIL of their mass, so that every context has some
to give. With d_k(r) the discount of an r-fold k-gram, C a count in training and h' a history h without its first word:

    P1(w)     = d_1(C) C / N  if C = C(w) > 0, else all that is left, for the one class of unknown words
    Pk(w | h) = d_k(C) C / C(h)  if C = C(h w) > 0, else  a(h) Pk-1(w | h')
    a(h)      = (1 - sum of Pk(w | h) over seen w) / (1 - sum of Pk-1(w | h') over the same w), 1 for a history never seen

so that Pk(. | h) sums to one. A document begins with order - 1 START words, which are no tokens, and ends with END.

Documents are worked on in groups of about ``group_tokens`` tokens. A group knows its distinct words and, level by level, its
distinct k-grams: a k-gram is the number of its history among the (k-1)-grams and a word. At each level the groups send
their k-grams, with their counts in training, to the buckets of their histories; a bucket adds up the counts of all groups,
keeps its part of the model, and answers each group in the order of what it sent. So a k-gram has one entry for a group,
however often it occurs, and a bucket needs no documents. A group is a row of a table that holds what it knows so far; each
level's answers go into a new row, and the old one and the answers are deleted. At last each group evaluates the recursion
once for each of its distinct k-grams, and a text is the sum over its tokens.

Words are 64-bit hashes at first and get numbers at level 1, small ones to frequent words; two words of one hash would count
as one. The k-grams of a history of more than ``hot`` tokens are dealt to several buckets by word, and its sums are
put together afterwards; ``hot`` is at least a 2**20-th of all tokens, so there are never more such histories than that, and
those of a level, with their weights, are broadcast (8 bytes for each word and for the weight: 24 MB at most at order 3).
Tables of the model, partitioned by kind, each row a bucket: ``level1`` (words, numbers, counts), ``level2`` .. (k-grams with their
counts and lower counts, which give a(h); sums of hot histories by themselves), ``about`` (sizes, counts of counts).
``score_with`` scores other texts by a stored model.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barpath.llm.common import batches, crc32_mod, small_batches, table
from barpath.session import release_shuffles, scratch_dir, shuffle_partitions

ORDER = 3
K = 5
TAIL = 1e-6
#: Tokens of a group (a document is never cut) at least, and of a history that is dealt to several buckets.
GROUP_TOKENS = 1 << 20
HOT = 1 << 19
#: Tokens for which there is one more bucket, at least; and k-grams that a group sends to a bucket, about, at least. Groups and
#: buckets grow with the square root of the corpus beyond some 1e10 tokens, so rows stay few and of some size.
BUCKET_TOKENS = 1 << 19
ROW_GRAMS = 64
#: Entries from which on each place of a byte is compressed by itself.
APART = 1024
#: Documents of a group at most.
GROUP_DOCS = 1 << 16
FOLDS, HELD_OUT = 10, 0
END = xxhash.xxh64_intdigest(b"\n")  # white space is no word
UNKNOWN, START, FIRST = 0, 1, 2  # numbers of words

ROWS = "kind string, bucket long, grp long, body binary"
_EMPTY = np.zeros(0, np.int64)


def codes(text: str | None) -> np.ndarray:
    """The hashes of a text's words (A-Z in lower case) and then END."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    out = np.empty(len(words) + 1, dtype=np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64, copy=False)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def in_order(*numbers: np.ndarray) -> np.ndarray:
    """A stable order by several columns of numbers from 0 up, the first the least: sixteen bits at a time, which numpy sorts
    in linear time."""
    order = np.arange(len(numbers[0]))
    for x in numbers:
        top, shift = int(x.max()) if len(x) else 0, 0
        while shift == 0 or top >> shift:
            digit = (x >> shift).astype(np.uint16)
            order = order[np.argsort(digit[order], kind="stable")]
            shift += 16
    return order


def discounts(of: list[int], k: int = K) -> np.ndarray:
    """d(0..k) by Good-Turing, as Katz has it, from the number of types seen 1..k+1 times; d(0) is 0. The counts of counts are
    smoothed first by a line through their logarithms, which always falls fast enough for discounts between 0 and 1."""
    r = np.arange(1, k + 2)
    n = np.array([*of, *[0] * (k + 1)][: k + 1], dtype=float)
    x, y = np.log(r[n > 0]), np.log(n[n > 0])
    slope = ((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum() if len(x) > 1 else -2.0
    slope = min(slope, -1.1)
    kept = (1 + 1 / r[:k]) ** (slope + 1)
    rest = (k + 1.0) ** (slope + 1)
    return np.concatenate([[0.0], (kept - rest) / (1 - rest)])


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    """d(C) C."""
    return np.append(d, 1 - TAIL)[np.minimum(counts, K + 1)] * counts


def backoff(kinds: np.ndarray, mass: np.ndarray, d: np.ndarray) -> np.ndarray:
    """log10 a(h) of histories from how many k-grams they have of each count up to K, the sum of larger counts, and the
    probability of the same words by the lower order."""
    times = kinds[:, :K] * np.arange(1, K + 1)
    kept = (times * d[1:]).sum(axis=1) + (1 - TAIL) * kinds[:, K]
    return np.log10((1 - kept / (times.sum(axis=1) + kinds[:, K])) / (1 - mass))


# Arrays in rows.


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length, byte by byte, compressed: entries lie sorted and numbers are small, so most bytes repeat. Each
    place of a byte is compressed by itself, as its values have a distribution of their own; short arrays all together."""
    planes = [p for a in arrays for p in np.ascontiguousarray(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T)]
    press, n = zstandard.ZstdCompressor(level=1).compress, len(arrays[0])
    if n < APART:
        return bytes([0]) + press(b"".join(p.tobytes() for p in planes))
    frames = [press(p) if p.any() else b"" for p in planes]
    return bytes([1]) + n.to_bytes(8, "little") + b"".join(len(f).to_bytes(8, "little") + f for f in frames)


def unpack(body: bytes, *kinds: str) -> list[np.ndarray]:
    sizes, plain = [np.dtype(k).itemsize for k in kinds], zstandard.ZstdDecompressor().decompress
    if body[0]:
        n, zeros = int.from_bytes(body[1:9], "little"), None
        planes = []
        for frame in _split(body[9:]):
            zeros = np.zeros(n, np.uint8) if zeros is None and not frame else zeros
            planes.append(np.frombuffer(plain(frame), np.uint8) if frame else zeros)
    else:
        raw = plain(body[1:])
        n = len(raw) // sum(sizes)
        planes = list(np.frombuffer(raw, np.uint8).reshape(sum(sizes), n)) if n else [_EMPTY.astype(np.uint8)] * sum(sizes)
    out, at = [], 0
    for kind, size in zip(kinds, sizes, strict=True):
        out.append(np.stack(planes[at : at + size], axis=1).view(kind).ravel())
        at += size
    return out


def _row(kind: str, bucket: int, grp: int, body: bytes) -> tuple:
    return kind, bucket, grp, body


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kind, bucket, grp, body = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(bucket, pa.int64()), pa.array(grp, pa.int64()), pa.array(body, pa.binary())], names=["kind", "bucket", "grp", "body"])


def _by(it: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, list[tuple]]]:
    """(key, rows as (kind, bucket, grp, body)) from rows that are sorted by the key."""
    now, held = None, []
    for batch in batches(it):
        columns = [batch.column(c) for c in ("kind", "bucket", "grp", "body")]
        for i in range(batch.num_rows):
            row = tuple(c[i].as_py() for c in columns)
            k = row[1] if key == "bucket" else row[2]
            if held and k != now:
                yield now, held
                held = []
            now = k
            held.append(row)
    if held:
        yield now, held


def _dealt(rows: DataFrame, n: int, *keys: str) -> DataFrame:
    return rows.select("kind", "bucket", "grp", "body").repartition(n, keys[0]).sortWithinPartitions(*keys)


# The tables of a model.


class Model:
    """A model in a folder that all executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(ROWS).parquet(f"{self.path}/{name}")

    def write(self, rows: DataFrame, name: str, by_kind: bool = False) -> None:
        if by_kind:  # a writer for each of few kinds: no sort of the rows before they are written
            self.spark.conf.set("spark.sql.maxConcurrentOutputFileWriters", "16")
        writer = rows.write.mode("overwrite").option("compression", "none")  # bodies are compressed already
        (writer.partitionBy("kind") if by_kind else writer).parquet(f"{self.path}/{name}")

    def remove(self, name: str) -> None:
        """Delete a table of the work that nothing needs any more."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    @property
    def about(self) -> dict:
        """Sizes (order, tokens, types, documents, buckets, hot) and the counts of counts ``of<k>`` of each level."""
        return {r["name"]: list(r["values"]) for r in self.spark.read.parquet(f"{self.path}/about").collect()}

    def set_about(self, values: dict) -> None:
        self.spark.createDataFrame([(k, [int(x) for x in v]) for k, v in values.items()], "name string, values array<long>").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/about")

    def unigrams(self) -> DataFrame:
        """(word, number, count): the hash of each word as a signed long, its number and count."""
        return self._unpacked("level1", "words", ["u8", "i8", "i8"], ["word", "number", "count"])

    def grams(self, level: int) -> DataFrame:
        """(w1, ..., count, low, base): the numbers of the words of each k-gram, its count, and the counts of its last k-1 words
        and of their history, which give its probability by the lower order."""
        names = [*(f"w{i + 1}" for i in range(level)), "count", "low", "base", "hot"]
        return self._unpacked(f"level{level}", "grams", ["i8"] * (level + 3) + ["u1"], names).drop("hot")

    def contexts(self, level: int) -> DataFrame:
        """(w1, ..., count, alpha): histories of level - 1 words, their counts and backoff weights."""
        names, about = [f"w{i + 1}" for i in range(level - 1)], self.about
        kept = lambda c, k: F.element_at(F.array(*[F.lit(float(x)) for x in np.append(discounts(about[f"of{k}"])[1:], 1 - TAIL)]), F.least(F.col(c), F.lit(K + 1)).cast("int")) * F.col(c)
        sums = self.grams(level).groupBy(*names).agg(F.sum("count").alias("count"), F.sum(kept("count", level)).alias("kept"), F.sum(kept("low", level - 1) / F.col("base")).alias("mass"))
        return sums.select(*names, "count", ((1 - F.col("kept") / F.col("count")) / (1 - F.col("mass"))).alias("alpha"))

    def _unpacked(self, name: str, kind: str, kinds: list[str], names: list[str]) -> DataFrame:
        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches(it):
                for body in batch.column("body").to_pylist():
                    arrays = unpack(body, *kinds)
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64) if a.dtype == np.uint64 else a.astype(np.int64)) for a in arrays], names=names)

        schema = ", ".join(f"`{n}` long" for n in names)
        return self.read(name).where(F.col("kind") == kind).select("body").mapInArrow(run, schema)


# Groups of documents.


def _group_rows(docs: DataFrame, group_tokens: int) -> DataFrame:
    """Rows of kind 'group' and 'docs' for each group: its words (hashes), tokens as places among them; and its documents."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, keys, out, size, made = [], [], [], 0, TaskContext.get().partitionId() << 24

        def flush() -> pa.RecordBatch:
            words, tokens = np.unique(np.concatenate(held), return_inverse=True)
            lengths = np.array([len(h) for h in held], dtype="<i8")
            flags = np.array(out, dtype=np.uint8)
            names = pa.BufferOutputStream()
            with pa.ipc.new_stream(names, pa.schema([("key", pa.string())])) as writer:
                writer.write_batch(pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], names=["key"]))
            body = b"".join(len(x).to_bytes(8, "little") + x for x in (pack(words), pack(tokens.astype("<u4")), pack(lengths, flags)))
            return _batch([_row("group", -1, made, body), _row("docs", -1, made, zstandard.compress(names.getvalue().to_pybytes(), 1))])

        for batch in batches(it):
            for key, flag, text in zip(*(batch.column(c).to_pylist() for c in ("key", "held_out", "text")), strict=True):
                held.append(codes(text))
                keys.append(key)
                out.append(flag)
                size += len(held[-1])
                if size >= group_tokens or len(keys) >= GROUP_DOCS:
                    yield flush()
                    held, keys, out, size, made = [], [], [], 0, made + 1
        if held:
            yield flush()

    return docs.mapInArrow(run, ROWS)


def _split(body: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(body):
        n = int.from_bytes(body[at : at + 8], "little")
        out.append(body[at + 8 : at + 8 + n])
        at += 8 + n
    return out


class Hashed:
    """A group whose words are hashes."""

    def __init__(self, body: bytes):
        words, tokens, lengths = _split(body)
        (self.words,), (self.tokens,) = unpack(words, "<u8"), unpack(tokens, "<u4")
        self.lengths, self.out = unpack(lengths, "<i8", "u1")

    def requests(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The order in which the words are sent, and where each bucket begins in it."""
        bucket = (mixed(self.words) % np.uint64(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return order, np.searchsorted(bucket[order], np.arange(n + 1))

    def trained(self) -> np.ndarray:
        """Counts of the words in documents that are not held out."""
        return np.bincount(self.tokens, weights=np.repeat(self.out == 0, self.lengths), minlength=len(self.words)).astype(np.int64)


class Group:
    """A group whose words are numbers: its k-grams, level by level. ``tokens``: places among ``words``."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, out: np.ndarray, model: dict):
        self.words, self.tokens, self.lengths, self.out, self.model = words, tokens, lengths, out, model
        self.first = np.cumsum(lengths) - lengths
        self.train = np.repeat(out == 0, lengths)
        # level 1: gram is the word; count has one more place, that of the beginning
        self.gram, self.suffix, self.word = [None, tokens.astype(np.int32)], [None, None], [None, np.arange(len(words))]
        self.history, self.count = [None, None], [None, np.append(counts, model["docs"][0])]
        self.columns = [None, np.append(words, START)[:, None]]
        self.seen, self.alpha = [None, None], {}

    def extend(self) -> None:
        """The next level: distinct pairs of history and word."""
        k = len(self.gram)
        below = self.gram[k - 1]
        before = np.empty_like(below)
        before[1:] = below[:-1]
        before[self.first] = len(self.count[k - 1]) - 1
        key = before.astype(np.int64)
        key <<= 32
        key |= self.tokens
        order = np.argsort(key)  # places of one k-gram are alike: any of them may come first
        new = np.empty(len(key), bool)
        new[:1] = True
        np.not_equal(key[order[1:]], key[order[:-1]], out=new[1:])
        at = order[new]
        gram = np.empty(len(key), np.int32)
        gram[order] = np.cumsum(new, dtype=np.int32) - np.int32(1)
        key = key[at]
        del order, new, before
        self.gram.append(gram)
        self.history.append((key >> 32).astype(np.int32))
        self.word.append((key & 0xFFFFFFFF).astype(np.int32))
        self.suffix.append(below[at])
        self.seen.append(np.bincount(self.gram[k], weights=self.train, minlength=len(key)).astype(np.int32))
        columns = np.full((len(key) + 1, k), START, np.int64)
        for j in range(k - 1):
            columns[:-1, j] = self.columns[k - 1][self.history[k], j]
        columns[:-1, k - 1] = self.words[self.word[k]]
        self.columns.append(columns)
        self.count.append(None)

    def requests(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k-grams that are sent (their history occurs in training), in the order sent; where buckets begin; and whether
        the history of each is hot. Sorted by bucket, then history, its last word first (rows of one lower history stand
        together and compress well), and word: k-grams are numbered by history and word, so that is a stable order by the rest."""
        n, hot = self.model["buckets"][0], self.model["hot"][0]
        of = self.count[k - 1][self.history[k]]
        columns = self.columns[k][:-1]
        code = np.zeros(len(columns), np.uint64)
        for j in range(k - 1):
            code = mixed(code + columns[:, j].astype(np.uint64) + np.uint64(j + 1))
        parts = np.where(of > hot, -(-of // hot), 1).astype(np.uint64)
        code = mixed(code + mixed(columns[:, k - 1].astype(np.uint64) + np.uint64(77)) % parts)
        bucket = (code % np.uint64(n)).astype(np.int64)
        sent = np.flatnonzero(of > 0)
        order = sent[in_order(*(columns[sent, j] for j in range(1, k - 1)), bucket[sent])]
        return order, np.searchsorted(bucket[order], np.arange(n + 1)), of[order] > hot

    def lower(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """For each k-gram: the count of its last k-1 words and that of their history."""
        s = self.suffix[k]
        return self.count[k - 1][s], self.count[k - 2][self.history[k - 1][s]] if k > 2 else np.full(len(s), self.model["tokens"][0])

    def answer(self, k: int, answers: dict[int, bytes], hot: tuple[np.ndarray, np.ndarray]) -> None:
        """Counts of the level's k-grams, and backoff weights where they are needed, from what the buckets gave; ``hot``: the
        hot histories as sorted keys, and their weights."""
        order, ends, is_hot = self.requests(k)
        count = np.zeros(len(self.columns[k]), np.int64)
        log_alpha = np.zeros(len(count))
        d = discounts(self.model[f"of{k}"])
        for b in np.flatnonzero(ends[1:] > ends[:-1]).tolist():
            grams = order[ends[b] : ends[b + 1]]
            counts, sums = _split(answers[b])
            (count[grams],) = unpack(counts, "<i8")
            *kinds, mass = unpack(sums, *["<i8"] * (K + 1), "<f8")
            ask = grams[(count[grams] == 0) & ~is_hot[ends[b] : ends[b + 1]]]
            if len(ask):
                _, at = np.unique(self.history[k][ask], return_inverse=True)
                # the bucket has them by history in the order sent: that of first occurrence
                first = np.unique(self.history[k][ask], return_index=True)[1]
                place = np.empty(len(first), np.int64)
                place[np.argsort(first, kind="stable")] = np.arange(len(first))
                log_alpha[ask] = backoff(np.column_stack(kinds), mass, d)[place[at.ravel()]]
        ask = order[is_hot & (count[order] == 0)]
        if len(ask):
            asked, at = np.unique(self.history[k][ask], return_inverse=True)
            log_alpha[ask] = hot[1][np.searchsorted(hot[0], _keys(self.columns[k - 1][asked]))][at.ravel()]
        self.know(k, count[:-1], log_alpha[:-1])

    def know(self, k: int, count: np.ndarray, log_alpha: np.ndarray) -> None:
        self.count[k] = np.append(count, self.model["docs"][0])
        self.alpha[k] = log_alpha

    def evaluate(self, order: int) -> np.ndarray:
        """log10 Pk of each distinct k-gram of the highest level, by recursion from the words up."""
        n, of = self.model["tokens"][0], self.model["of1"]
        d = discounts(of)
        types = np.array(of[:K], dtype=float)
        small = (types * np.arange(1, K + 1)).sum()
        unknown = 1 - ((types * np.arange(1, K + 1) * d[1:]).sum() + (1 - TAIL) * (n - small)) / n if n else 1.0
        c = self.count[1][:-1]
        log = np.log10(np.where(c > 0, discounted(c, d) / max(n, 1), unknown))
        for k in range(2, order + 1):
            c, h = self.count[k][:-1], self.count[k - 1][self.history[k]]
            seen = np.log10(np.maximum(discounted(c, discounts(self.model[f"of{k}"])), 1e-300) / np.maximum(h, 1))
            log = np.where(c > 0, seen, self.alpha[k] + log[self.suffix[k]])
        return log


def _group(body: bytes, model: dict) -> Group:
    """A group with all levels that its row knows."""
    words, tokens, lengths, *levels = _split(body)
    number, count = unpack(words, "<i8", "<i8")
    group = Group(number, count, unpack(tokens, "<u4")[0], *unpack(lengths, "<i8", "u1"), model)
    for k, known in enumerate(levels, 2):
        group.extend()
        group.know(k, *unpack(known, "<i8", "<f8"))
    return group


def _keys(columns: np.ndarray) -> np.ndarray:
    """Rows of numbers as byte strings of the same order."""
    return np.ascontiguousarray(columns.astype(">i8")).view(f"S{8 * columns.shape[1]}").ravel()


# Buckets.


def _merge_words(n: int, numbered: bool):
    """Level 1: count the words of a bucket, give them numbers, answer the groups. ``numbered``: the model has them already."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by(it, "bucket"):
            asks = [(g, unpack(body, "<u8", "<i8")) for kind, _, g, body in rows if kind == "ask"]
            if numbered:
                held = [unpack(body, "u8", "i8", "i8") for kind, _, _, body in rows if kind == "words"]
                words, number, count = (np.concatenate([h[i] for h in held]) for i in range(3)) if held else (np.zeros(0, np.uint64), _EMPTY, _EMPTY)
            else:
                words, back = np.unique(np.concatenate([a[0] for _, a in asks]), return_inverse=True)
                count = np.bincount(back.ravel(), weights=np.concatenate([a[1] for _, a in asks]), minlength=len(words)).astype(np.int64)
                words, count = words[count > 0], count[count > 0]
                number = np.empty(len(words), np.int64)
                number[np.lexsort((words, -count))] = FIRST + np.arange(len(words)) * n + bucket
                of = np.bincount(np.minimum(count, K + 2), minlength=K + 3)[1 : K + 2]
                yield _batch([_row("words", bucket, -1, pack(words, number, count)), _row("sizes", bucket, -1, pack(np.array([count.sum(), len(words), *of], "<i8")))])
            for g, (asked, _) in asks:
                at = np.minimum(np.searchsorted(words, asked), max(len(words) - 1, 0))
                hit = words[at] == asked if len(words) else np.zeros(len(asked), bool)
                own = lambda x, at=at, hit=hit: np.where(hit, x[at], 0) if len(x) else np.zeros(len(at), np.int64)
                yield _batch([_row("answer", bucket, g, pack(own(number), own(count)))])

    return run


def _gram_order(columns: list[np.ndarray]) -> np.ndarray:
    """The order in which the groups sent them: history, its last word first, and word. One number for each k-gram where 63 bits
    are enough: what the groups sent is sorted, and numpy merges sorted runs."""
    sizes = [int(c.max()).bit_length() for c in columns]
    if sum(sizes) > 63:
        return in_order(columns[-1], *columns[:-1])
    key = np.zeros(len(columns[0]), np.int64)
    for j in [*range(len(columns) - 2, -1, -1), len(columns) - 1]:
        key = (key << sizes[j]) | columns[j]
    return np.argsort(key, kind="stable")


def _merge_grams(k: int, d: np.ndarray, counted: bool):
    """Level k: add up the k-grams of a bucket and what their histories need, answer the groups. ``counted``: the model has
    the counts already, and what the groups say of theirs does not matter."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds_ = ["<i8"] * (k - 1) + ["<i8"] + ["<i8", "<i8", "<i8"] + ["u1"]
        for bucket, rows in _by(it, "bucket"):
            asks = [(g, unpack(body, *kinds_)) for kind, _, g, body in rows if kind == "ask"]
            if not asks:
                continue
            if counted:  # the model's k-grams, as if one more group had sent them
                asks_and_model = [*(a for _, a in asks), *(unpack(body, *kinds_) for kind, _, _, body in rows if kind == "grams")]
            else:
                asks_and_model = [a for _, a in asks]
            del rows
            columns = [np.concatenate([p[j] for p in asks_and_model]) for j in range(k)]
            times, low, base, hot = (np.concatenate([p[k + j] for p in asks_and_model]) for j in range(4))
            sizes = [len(p[0]) for p in asks_and_model]
            asks = [(g, a[k + 3]) for g, a in asks]
            del asks_and_model
            # the number of each history, and of each k-gram
            order = _gram_order(columns)
            differs = lambda c: np.concatenate([[True], c[order[1:]] != c[order[:-1]]])
            new_history = np.logical_or.reduce([differs(c) for c in columns[:-1]])
            new = new_history | differs(columns[-1])
            gram, history = np.cumsum(new) - 1, np.cumsum(new_history) - 1
            at = np.flatnonzero(new)
            count = np.add.reduceat(times[order], at)
            of_gram = history[at]
            where = np.empty(len(order), np.int64)
            where[order] = gram
            n_histories = int(history[-1]) + 1
            heads = np.flatnonzero(new_history)
            trained = count > 0
            small = count <= K
            slot = of_gram * (K + 1) + np.where(small, np.maximum(count, 1) - 1, K)
            kinds = np.bincount(slot[trained], weights=np.where(small, 1, count)[trained], minlength=n_histories * (K + 1)).astype(np.int64).reshape(-1, K + 1)
            # every group that trained on a k-gram sent the same lower counts; any one of them will do
            low, base = np.maximum.reduceat(low[order], at), np.maximum.reduceat(base[order], at)
            mass = np.bincount(of_gram[trained], weights=(discounted(low, d) / np.maximum(base, 1))[trained], minlength=n_histories)
            if not counted:
                first = order[at][trained]
                grams = pack(*(c[first] for c in columns), count[trained], low[trained], base[trained], hot[first])
                of = np.bincount(np.minimum(count, K + 2), minlength=K + 3)[1 : K + 2]
                out = [_row("grams", bucket, -1, grams), _row("sizes", bucket, -1, pack(of.astype("<i8")))]
                if (mark := np.flatnonzero(kinds.any(axis=1) & (hot[order[heads]] > 0))).size:
                    out.append(_row("hot", bucket, -1, pack(*(c[order[heads]][mark] for c in columns[:-1]), *kinds[mark].T, mass[mark])))
                yield _batch(out)
            del columns, times, low, base, gram
            ends = np.cumsum([0, *sizes])
            history_of = np.empty(len(order), np.int64)
            history_of[order] = history
            for (g, is_hot), a, b in zip(asks, ends, ends[1:], strict=False):
                given = count[where[a:b]]
                ask = history_of[a:b][(given == 0) & (is_hot == 0)]
                ask = ask[np.concatenate([[True], ask[1:] != ask[:-1]])] if len(ask) else ask  # sent in the order of histories
                yield _batch([_row("answer", bucket, g, b"".join(len(x).to_bytes(8, "little") + x for x in (pack(given), pack(*kinds[ask].T, mass[ask]))))])

    return run


# Training and scoring.


def _sizes(rows: DataFrame) -> np.ndarray:
    """The sum of the short vectors of rows of kind 'sizes': one for each bucket."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = sum(unpack(body, "<i8")[0] for batch in batches(it) for body in batch.column("body").to_pylist())
        if not np.isscalar(total):
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total, pa.int64())], names=["i", "n"])

    got = rows.where("kind = 'sizes'").select("body").mapInArrow(run, "i int, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    return np.array([r["n"] for r in sorted(got, key=lambda r: r["i"])], dtype=np.int64)


def _hot(rows: DataFrame, k: int, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of hot histories, sorted, and their backoff weights; at most 2**20 of them: those of more than a 2**20-th of
    all tokens. Their sums are put together before they come to the driver."""
    words, kinds = [f"w{i + 1}" for i in range(k - 1)], [f"n{i + 1}" for i in range(K + 1)]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            for body in batch.column("body").to_pylist():
                arrays = unpack(body, *["<i8"] * (k + K), "<f8")
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=[*words, *kinds, "mass"])

    schema = ", ".join([*(f"{c} long" for c in (*words, *kinds)), "mass double"])
    got = rows.where("kind = 'hot'").select("body").mapInArrow(run, schema).groupBy(*words).agg(*(F.sum(c).alias(c) for c in (*kinds, "mass"))).toArrow()
    columns = lambda of: np.column_stack([got.column(c).to_numpy() for c in of])
    keys, weights = _keys(columns(words)), backoff(columns(kinds), got.column("mass").to_numpy(), d)
    order = np.argsort(keys)
    return keys[order], weights[order]


def _words_asked(n: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            for g, body in zip(batch.column("grp").to_pylist(), batch.column("body").to_pylist(), strict=True):
                group = Hashed(body)
                order, ends = group.requests(n)
                trained = group.trained()[order]
                yield _batch([_row("ask", b, g, pack(group.words[order[ends[b] : ends[b + 1]]], trained[ends[b] : ends[b + 1]])) for b in np.flatnonzero(ends[1:] > ends[:-1]).tolist()])

    return run


def _numbered(n: int):
    """Groups with numbers for words: those of no number are all the one unknown word."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, rows in _by(it, "grp"):
            group = Hashed(next(body for kind, _, _, body in rows if kind == "group"))
            order, ends = group.requests(n)
            number, count = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
            for kind, b, _, body in rows:
                if kind == "answer":
                    o = order[ends[b] : ends[b + 1]]
                    number[o], count[o] = unpack(body, "<i8", "<i8")
            words, place = np.unique(number, return_index=True)
            tokens = np.searchsorted(words, number)[group.tokens]
            body = b"".join(len(x).to_bytes(8, "little") + x for x in (pack(words, count[place]), pack(tokens.astype("<u4")), pack(group.lengths, group.out)))
            yield _batch([_row("group", -1, g, body)])

    return run


def _grams_asked(k: int, shared):
    """Rows of what groups ask of level k, from rows that know the levels before."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(it):
            for g, body in zip(batch.column("grp"), batch.column("body"), strict=True):
                group, g = _group(body.as_py(), shared.value), g.as_py()
                group.extend()
                order, ends, hot = group.requests(k)
                low, base = group.lower(k)
                seen = group.seen[k].astype(np.int64)
                arrays = [group.columns[k][order, j] for j in range(k)] + [seen[order], np.where(seen > 0, low, 0)[order], np.where(seen > 0, base, 0)[order], hot.astype(np.uint8)]
                del group
                yield _batch([_row("ask", -1, g, b"")] + [_row("ask", b, g, pack(*(a[ends[b] : ends[b + 1]] for a in arrays))) for b in np.flatnonzero(ends[1:] > ends[:-1]).tolist()])

    return run


def _answered(it: Iterator[pa.RecordBatch], k: int, shared) -> Iterator[tuple[int, Group, list[tuple]]]:
    """Groups with the answers of level k (none at level 1), and their rows."""
    model, hot = shared.value
    for g, rows in _by(it, "grp"):
        group = _group(next(body for kind, _, _, body in rows if kind == "group"), model)
        if k > 1:
            group.extend()
            group.answer(k, {b: body for kind, b, _, body in rows if kind == "answer"}, hot)
        yield g, group, rows


def _settled(k: int, shared):
    """Rows of groups that know level k too."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g, group, rows in _answered(it, k, shared):
            old = next(body for kind, _, _, body in rows if kind == "group")
            new = pack(group.count[k][:-1], group.alpha[k])
            yield _batch([_row("group", -1, g, old + len(new).to_bytes(8, "little") + new)])

    return run


def _scores(order: int, shared):
    names = ["key", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group, rows in _answered(it, order, shared):
            n, v = group.model["tokens"][0], group.model["types"][0]
            log, c = group.evaluate(order)[group.gram[order]], group.count[1][group.tokens]
            total = lambda x: np.add.reduceat(x, group.first)
            base = total(np.log10(c + 0.1)) - group.lengths * math.log10(n + 0.1 * (v + 1))
            keys = pa.ipc.open_stream(zstandard.decompress(next(body for kind, _, _, body in rows if kind == "docs"))).read_all().column("key").combine_chunks()
            columns = [keys, pa.array(group.out == 1), pa.array(group.lengths, pa.int64()), pa.array(total((c > 0).astype(np.int64))), pa.array(np.full(len(group.lengths), n, np.int64)), pa.array(base), pa.array(total(log))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


SCORES = "key string, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _run(docs: DataFrame, model: Model, order: int, group_tokens: int, hot: int, stored: bool) -> DataFrame:
    """Scores of ``docs`` (key, held_out, text) under a model: a stored one, or that of the rows not held out, which is written."""
    spark = docs.sparkSession
    least = shuffle_partitions(spark)
    about_tokens = int(docs.select(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]) // 5
    group_tokens = max(group_tokens, math.isqrt(ROW_GRAMS * about_tokens))
    about = model.about if stored else {}
    n = about["buckets"][0] if stored else max(least, -(-about_tokens // max(BUCKET_TOKENS, group_tokens)))
    work = Model(spark, f"{scratch_dir(spark)}/katz-work-{uuid.uuid4().hex}")
    work.write(_group_rows(docs, group_tokens), "groups", by_kind=True)
    groups, names = (work.read("groups").where(F.col("kind") == kind) for kind in ("group", "docs"))
    asked = groups.select("grp", "body").mapInArrow(_words_asked(n), ROWS)
    if stored:
        asked = asked.unionByName(model.read("level1").where("kind = 'words'"))
    (work if stored else model).write(_dealt(asked, n, "bucket").mapInArrow(_merge_words(n, stored), ROWS), "level1", by_kind=True)
    release_shuffles(spark)
    level1 = (work if stored else model).read("level1")
    if not stored:
        sizes = _sizes(level1)
        tokens, types, *of = sizes.tolist() if len(sizes) else [0] * (K + 3)
        about = {"order": [order], "tokens": [tokens], "types": [types], "docs": [_count_trained(groups)], "buckets": [n], "hot": [max(hot, tokens >> 20)], "of1": of}
    answers = level1.where("kind = 'answer'")
    work.write(_dealt(groups.unionByName(answers), least, "grp").mapInArrow(_numbered(n), ROWS), "numbered")
    release_shuffles(spark)
    work.remove("groups/kind=group")
    (work if stored else model).remove("level1/kind=answer")
    known, name, given, hot_ones = work.read("numbered"), "numbered", None, None
    kept = work if stored else model
    for k in range(2, order + 1):
        asked = known.select("grp", "body").mapInArrow(_grams_asked(k, spark.sparkContext.broadcast(about)), ROWS).where("bucket >= 0")
        if stored:
            asked = asked.unionByName(model.read(f"level{k}").where("kind = 'grams'"))
        d = discounts(about[f"of{k - 1}"])
        kept.write(_dealt(asked, n, "bucket").mapInArrow(_merge_grams(k, d, stored), ROWS), f"level{k}", by_kind=True)
        release_shuffles(spark)
        level = kept.read(f"level{k}")
        if not stored:
            of = _sizes(level)
            about[f"of{k}"] = of.tolist() if len(of) else [0] * (K + 1)
        hot_ones = _hot(model.read(f"level{k}"), k, discounts(about[f"of{k}"]))
        release_shuffles(spark)  # once more: until other jobs have run, Spark may still refer to the last one's shuffle
        given = level.where("kind = 'answer'")
        if k < order:
            shared = spark.sparkContext.broadcast((about, hot_ones))
            work.write(_dealt(known.unionByName(given), least, "grp").mapInArrow(_settled(k, shared), ROWS), f"known{k}")
            release_shuffles(spark)
            work.remove(name)
            kept.remove(f"level{k}/kind=answer")
            name = f"known{k}"
            known = work.read(name)
    if not stored:
        model.set_about(about)
    shared = spark.sparkContext.broadcast((about, hot_ones))
    parts = known.unionByName(names)
    if given is not None:
        parts = parts.unionByName(given)
    return _dealt(parts, least, "grp").mapInArrow(_scores(order, shared), SCORES)


def _count_trained(groups: DataFrame) -> int:
    """Documents that are not held out."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = sum(int((Hashed(body).out == 0).sum()) for batch in batches(it) for body in batch.column("body").to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return int(groups.select("body").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0)


def _rows(docs: DataFrame, key: str, text: str, held_out) -> DataFrame:
    small_batches(docs.sparkSession)
    return docs.select(F.col(key).cast("string").alias("key"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text).alias("text"))


def score(docs: DataFrame, key: str = "doc_id", text: str = "text", held_out=None, order: int = ORDER, group_tokens: int = GROUP_TOKENS, hot: int = HOT) -> tuple[DataFrame, Model]:
    """Scores of all texts under the model of those that are not held out, and that model.

    Scores: the key as text, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``. Null
    texts are empty: one token, the end. Every row is scored, repeated rows as often as they occur; a null key stays null. A
    text is held whole in one task, however long. Other columns of ``docs`` are not looked at. Without training rows all words
    are of the one unknown class, whose probability is 1. ``held_out`` is a Boolean column (default: crc32 of the key as text,
    mod 10, is 0).
    """
    spark = docs.sparkSession
    model = Model(spark, f"{scratch_dir(spark)}/katz-model-{uuid.uuid4().hex}")
    rows = _rows(docs, key, text, crc32_mod(key, FOLDS) == HELD_OUT if held_out is None else held_out)
    return _run(rows, model, order, group_tokens, hot, False), model


def score_with(model: Model, docs: DataFrame, key: str = "doc_id", text: str = "text", group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Scores of other texts under a stored model, with the columns of ``score``; all rows count as held out."""
    return _run(_rows(docs, key, text, F.lit(True)), model, model.about["order"][0], group_tokens, HOT, True)


def op1_katz(spark, sf_dir: str) -> DataFrame:
    scores, _ = score(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scores.select(F.col("key").cast("long").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
