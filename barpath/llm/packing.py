"""Operator 2, best-fit packing by the linear grouping scheme.

Only a histogram of piece lengths (at most ``capacity`` counts, whatever the corpus) reaches the driver. There, large
lengths are ordered, cut into groups of equal cardinality and rounded up to the largest of the group; configurations of
these few sizes are optimised by column generation; actual lengths are substituted. What the whole numbers of the
programme leave over is grouped again, more finely as it is less. Small lengths then go by best fit into the room of the
configurations' sequences. The plan is a list of intervals: pieces of one length, by rank, to consecutive sequences. Pieces
find their sequence by their rank among those of their length.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barpath.llm.common import batches, small_batches, table
from barpath.session import materialise, shuffle_partitions

CAPACITY = 2048
#: Sizes that large lengths are rounded to, and from which share of the capacity a length is large.
GROUPS = 128
LARGE = 1 / 6
#: Times that left-over large lengths are grouped again.
ROUNDS = 10
#: By how much a new configuration must beat the price of those in use.
TOLERANCE = 4e-3
#: Pieces of one length that are ranked in one task, at most about.
LANE_ROWS = 50_000
END_ID = 0
#: The rank library's expressions need a stack as deep as a run of white space is long; longer runs go to the other library.
BLANKS = 4096
_BLANKS = re.compile(r"\s{%d}" % BLANKS)


def default_tokenizer() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """Ids of a byte-level vocabulary file. The ranks are the same vocabulary and give the same ids several times as fast;
    texts that hold the string of a special token or BLANKS of white space on end go to the vocabulary file's own library."""

    def __init__(self, path: str, ranks_path: str):
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if any(s in text for s in self.special) or _BLANKS.search(text):
            return self.whole.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def tokenised(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Per piece: the key, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids`` (array of int).

    A document is its ids and then ``END_ID``. Only a longer one than ``capacity`` is cut, and only its first piece may be
    shorter. A null text is empty and gives one piece of one id.
    """
    small_batches(docs.sparkSession)
    path = default_tokenizer()
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*path)
        for batch in batches(it):
            keys, out = batch.column(key), {"row": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
            arrays = []
            for row, t in enumerate(batch.column(text).to_pylist()):
                ids = np.array([*encoder.ids(t or ""), END_ID], dtype="<u4")
                first = (len(ids) - 1) % capacity + 1
                for n, (a, b) in enumerate(zip([0, *range(first, len(ids), capacity)], range(first, len(ids) + 1, capacity), strict=True)):
                    for name, x in (("row", row), ("piece", n), ("start", a), ("length", b - a), ("ids_crc32", zlib.crc32(ids[a:b].tobytes()))):
                        out[name].append(x)
                    if with_ids:
                        arrays.append(ids[a:b].astype(np.int32))
            rows = pa.array(out.pop("row"), pa.int64())
            columns = {key: keys.take(rows), "piece": pa.array(out["piece"], pa.int32())}
            columns |= {c: pa.array(out[c], pa.int64()) for c in ("start", "length", "ids_crc32")}
            if with_ids:
                columns["ids"] = pa.array(arrays, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    return docs.select(key, text).mapInArrow(run, schema)


# The plan, over a histogram of lengths.


def _best_pattern(prices: np.ndarray, sizes: list[int], counts: list[int], capacity: int) -> np.ndarray:
    """The configuration (a count for each size, none over its own) within the capacity that is worth most: a knapsack."""
    value = np.zeros(capacity + 1)
    steps = []
    for k, (size, most) in enumerate(zip(sizes, counts, strict=True)):
        if prices[k] <= 1e-12:
            continue
        for _ in range(min(capacity // size, most)):
            more = value[:-size] + prices[k]
            better = more > value[size:] + 1e-12
            if not better.any():
                break
            value[size:][better] = more[better]
            steps.append((k, better))
    out, c = np.zeros(len(sizes)), capacity
    for k, better in reversed(steps):
        if c >= sizes[k] and better[c - sizes[k]]:
            out[k] += 1
            c -= sizes[k]
    return out


def configurations(sizes: list[int], counts: list[int], capacity: int, rounds: int = 1200) -> list[tuple[tuple[int, ...], float]]:
    """(configuration, how often) for a few sizes: the linear programme by column generation. How often is no whole number."""
    k = len(sizes)
    basis = np.diag([float(min(capacity // s, n)) for s, n in zip(sizes, counts, strict=True)])
    inverse = np.diag(1 / np.diag(basis))
    need = np.array(counts, dtype=float)
    used = (inverse * need).sum(axis=1)
    for n in range(1, rounds):
        prices = inverse.sum(axis=0)
        column = _best_pattern(prices, sizes, counts, capacity)
        if (prices * column).sum() <= 1 + TOLERANCE:
            break
        step = (inverse * column).sum(axis=1)
        ratio = np.where(step > 1e-9, used / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        basis[:, out] = column
        row = inverse[out] / step[out]  # the inverse follows a change of one column
        inverse -= step[:, None] * row
        inverse[out] = row
        if n % 50 == 0:  # a Newton step takes back what rounding has added; no threaded products in a process that forks
            inverse = 2 * inverse - np.einsum("ij,jk->ik", inverse, np.einsum("ij,jk->ik", basis, inverse))
        used = np.maximum((inverse * need).sum(axis=1), 0)
    return [(tuple(int(x) for x in basis[:, i]), float(n)) for i, n in enumerate(used) if n > 1e-9]


Step = tuple[int, int, int, int, int, int]


def _grouped(histogram: dict[int, int], big: list[int], groups: int) -> dict[int, list[list[int]]]:
    """Linear grouping: the lengths, falling, cut at equal cardinality. By rounded size, the [length, how many] of the group.
    Lengths that are no more than the groups are few sizes already, and are not rounded."""
    if len(big) <= groups:
        return {x: [[x, histogram[x]]] for x in big}
    share = room = -(-sum(histogram[x] for x in big) // groups)
    members: list[list[list[int]]] = [[]]
    for length in big:
        n = histogram[length]
        while n:
            if not room:
                members.append([])
                room = share
            m = min(n, room)
            members[-1].append([length, m])
            n, room = n - m, room - m
    by_size: dict[int, list[list[int]]] = defaultdict(list)
    for g in members:
        by_size[g[0][0]] += g
    return by_size


class _Plan:
    """Steps so far, pieces left by length, and sequences with room left."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity, self.sequences, self.steps = capacity, 0, []
        self.left = {length: n for length, n in histogram.items() if n > 0}
        self.taken: dict[int, int] = defaultdict(int)
        self.open: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.rooms: list[int] = []  # keys of open, rising

    def put(self, length: int, first: int, n: int, each: int, offset: int) -> None:
        self.steps.append((length, self.taken[length], n * each, first, each, offset))
        self.taken[length] += n * each
        self.left[length] -= n * each

    def leave(self, room: int, first: int, n: int) -> None:
        if room and n:
            if not self.open[room]:
                insort(self.rooms, room)
            self.open[room].append((first, n))

    def fill(self, lengths: list[tuple[int, int]], n: int) -> None:
        """n new sequences that each hold the given (length, how many)."""
        offset = 0
        for length, each in lengths:
            self.put(length, self.sequences, n, each, offset)
            offset += length * each
        self.leave(self.capacity - offset, self.sequences, n)
        self.sequences += n

    def best_fit(self) -> None:
        """What is left, falling, each into the least room that it fits, or into new sequences."""
        for length in sorted(self.left, reverse=True):
            while n := self.left[length]:
                at = bisect_left(self.rooms, length)
                if at == len(self.rooms):
                    each = self.capacity // length
                    self.fill([(length, min(each, n))], max(1, n // each))
                    continue
                room = self.rooms[at]
                first, m = self.open[room].pop()
                if not self.open[room]:
                    self.rooms.pop(at)
                each = min(room // length, n)
                use = min(m, n // each)
                self.put(length, first, use, each, self.capacity - room)
                self.leave(room - each * length, first, use)
                self.leave(room, first + use, m - use)


def _substitute(out: _Plan, by_size: dict[int, list[list[int]]], patterns: list[tuple[tuple[int, ...], int]]) -> None:
    """Sequences of the configurations, with actual lengths in the place of rounded ones, the longest first."""
    order = sorted(by_size, reverse=True)
    for pattern, times in patterns:
        while times:
            uses = []  # (member, how many in each sequence)
            for size, k in zip(order, pattern, strict=True):
                for member in by_size[size]:
                    if k and member[1]:
                        uses.append((member, min(k, member[1])))
                        k -= uses[-1][1]
            if not uses:
                break
            n = min([times, *(m[1] // k for m, k in uses)])
            held: dict[int, int] = defaultdict(int)
            for member, k in uses:
                member[1] -= n * k
                held[member[0]] += k
            out.fill(list(held.items()), n)
            times -= n


def configured(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: float = LARGE, rounds: int = ROUNDS) -> _Plan:
    """The large lengths in sequences of configurations; what is left of them after the last round is not yet placed.

    Each round takes the whole part of the programme; where no configuration is wanted a whole time, those wanted half a time
    or more are taken once.
    """
    out = _Plan(histogram, capacity)
    if capacity in out.left:
        out.fill([(capacity, 1)], out.left[capacity])
    for _ in range(rounds):
        big = sorted((x for x, n in out.left.items() if n > 0 and capacity * large < x < capacity), reverse=True)
        if not big:
            break
        by_size = _grouped(out.left, big, groups)
        sizes = sorted(by_size, reverse=True)
        found = configurations(sizes, [sum(m for _, m in by_size[s]) for s in sizes], capacity)
        whole = [(p, int(n + 1e-7)) for p, n in found if n >= 1 - 1e-7]
        _substitute(out, by_size, whole or [(p, 1) for p, n in sorted(found, key=lambda f: -f[1]) if n >= 0.5])
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS, large: float = LARGE, rounds: int = ROUNDS) -> list[Step]:
    """(length, first rank, how many, first sequence, in each sequence, offset) for every piece of a histogram.

    Pieces of one length with ranks ``first .. first + how many - 1`` fill consecutive sequences, ``in each`` at a time.
    The list grows with the number of different lengths, not with the pieces.
    """
    out = configured(histogram, capacity, groups, large, rounds)
    out.best_fit()
    return out.steps


def ranked(pieces: DataFrame, lane_rows: int = LANE_ROWS) -> DataFrame:
    """``rank`` from 0 among the pieces of equal length, from a stored table with a number ``__row`` for each. Pieces of a
    length are dealt to lanes by that number, ranked within their lane, and set off by the counts of the lanes before, so that
    neither a common length nor a document that occurs millions of times meets in one task."""
    lanes = max(-(-pieces.count() // lane_rows), 2 * shuffle_partitions(pieces.sparkSession))
    rows = pieces.withColumn("__lane", F.pmod(F.xxhash64("__row"), F.lit(lanes)))
    before = Window.partitionBy("length").orderBy("__lane").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("length", "__lane").count().select("length", "__lane", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("length", "__lane").orderBy("__row")
    local = rows.withColumn("__in", F.row_number().over(inside) - 1)
    return local.join(offsets, ["length", "__lane"]).withColumn("rank", F.col("__before") + F.col("__in")).drop("__lane", "__before", "__in", "__row")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Per piece: the key, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset`` (gapless from 0).

    Null texts are empty documents of one id, repeated rows are packed as often as they occur, a null key is kept, and an
    empty table gives no pieces. Other columns of ``docs`` are not looked at, so no name clashes. A text is held whole in its
    task, however long, and no limit is set to the pieces of a document. ``tokenised(..., with_ids=True)`` joined on key, piece
    and checksum fills the sequences.
    """
    pieces = materialise(tokenised(docs, key, text, capacity).withColumn("__row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    rows = plan(histogram, capacity, groups)
    steps = np.array(sorted(rows), dtype=np.int64).reshape(-1, 6)
    ids = np.concatenate([steps[:, 0] << 40 | steps[:, 1], steps[:, 1:].T.ravel()]).reshape(6, -1) if len(steps) else np.zeros((6, 0), np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(ids)
    kind = docs.schema[key].dataType.simpleString()

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, first, _, sequence, each, offset = shared.value
        for batch in batches(it):
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(starts, length << 40 | rank, side="right") - 1
            n, within = np.divmod(rank - first[at], each[at])
            columns = {c: batch.column(c) for c in (key, "piece", "start", "length", "ids_crc32")}
            columns |= {"sequence_id": pa.array(sequence[at] + n), "offset": pa.array(offset[at] + within * length)}
            yield pa.RecordBatch.from_pydict(columns)

    wanted = ranked(pieces).select(key, "piece", "start", "length", "ids_crc32", "rank")
    return wanted.mapInArrow(place, f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op2_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
