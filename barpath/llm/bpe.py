"""Operator 13, BPE encoding and decoding with content-defined chunk reuse.

Texts are cut where a rolling hash of their bytes says so, so that equal passages give equal chunks wherever they stand. A
group of documents (of one task) keeps of each document the list of its chunks, and sends each distinct chunk once, by its
hash, to a bucket. A bucket encodes each distinct chunk once, whatever number of groups sent it, and answers every group. The
group puts the documents together again and repairs the joins of their chunks.

A join is repaired by encoding a region around it again. A white space after another character always begins a new word of
the splitting pattern, whatever follows: what stands before such a place never changes the ids after it, nor the reverse. A region
goes from one such place of the left chunk to one of the right chunk, and holds one more of them on either side: where the
region's ids between the outer and the inner one agree with the chunk's own, the region is spliced in; else it is widened, over
whole chunks if need be, up to the ends of the text. Strings of special tokens end a text and begin another, as the library has it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barpath.llm.common import batches, small_batches, table
from barpath.llm.packing import _BLANKS, default_tokenizer
from barpath.session import shuffle_partitions

#: Bytes of a chunk at least and at most, and about how many more the rolling hash takes to end one.
LEAST, MOST, MEAN = 256, 8192, 1024
#: Bytes of text of a group and of a bucket, about.
GROUP_BYTES = 16 << 20
BUCKET_BYTES = 64 << 20
#: How hard texts and ids are compressed that are shuffled.
TEXT_LEVEL, IDS_LEVEL = 6, 9
#: Ids that are made bytes at a time.
SLAB = 1 << 17

ROWS = "kind string, bucket long, grp long, body binary"
_GEAR = np.random.default_rng(13).integers(0, 1 << 32, 256, dtype=np.uint32)
#: The hash of a chunk, and how long it is.
_ASK = np.dtype([("low", "<u8"), ("high", "<u8"), ("size", "<u4")])


def cuts(data: bytes) -> list[int]:
    """Where the chunks of some bytes of UTF-8 end. The gear hash of the last 32 bytes ends a chunk; only characters are cut off."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    b = np.frombuffer(data, np.uint8)
    h = _GEAR[b]
    for k in (1, 2, 4, 8, 16):  # h[i] becomes the sum of gear[b[i - j]] << j over twice as many j
        h[k:] += h[:-k] << np.uint32(k)
    places = (np.flatnonzero(h[:-1] >> np.uint32(32 - MEAN.bit_length() + 1) == 0) + 1).tolist()
    out, begin = [], 0
    for p in [*places, n]:
        while p - begin > MOST:
            begin = _whole(b, begin + MOST)
            out.append(begin)
        if p == n and p > begin or p - begin >= LEAST and b[min(p, n - 1)] & 0xC0 != 0x80:
            out.append(p)
            begin = p
    return out


def _whole(b: np.ndarray, p: int) -> int:
    while b[p] & 0xC0 == 0x80:
        p -= 1
    return p


def special_tokens(path: str) -> dict[str, int]:
    """The strings of a vocabulary file that are tokens by themselves."""
    from tokenizers import Tokenizer

    added = Tokenizer.from_file(path).get_added_tokens_decoder()
    if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added.values()):
        raise ValueError("special tokens that take part of the text around them are not supported")
    return {t.content: i for i, t in added.items()}


class Vocabulary:
    """Encoding, decoding and the bytes of each id. A task holds the rank file's library; the vocabulary file's own is loaded only for
    runs of white space that are too long for the former."""

    def __init__(self, path: str, ranks_path: str, special: dict[str, int] | None = None):
        import base64

        self.path, self.whole, self.fast = path, None, None
        self.special = special_tokens(path) if special is None else special
        self._split = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        with open(ranks_path, "rb") as f:
            self._ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        size = max([*self._ranks.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for x, i in self._ranks.items():
            self.bytes[i] = x
        for x, i in self.special.items():
            self.bytes[i] = x.encode()
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)
        self._blob, self._first = np.frombuffer(b"".join(self.bytes), np.uint8), np.cumsum(self.sizes) - self.sizes
        self.kind = "<u2" if size <= 1 << 16 else "<u4"

    def parts(self, text: str) -> list[str]:
        """Texts and strings of special tokens by turns; a text may be empty."""
        return self._split.split(text) if self._split and any(s in text for s in self.special) else [text]

    def ids(self, data: bytes) -> np.ndarray:
        """The ids of a text without special tokens."""
        text = data.decode("utf-8")
        if _BLANKS.search(text):
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.path)
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=self.kind)
        if self.fast is None:
            import public_tokenizers
            import tiktoken

            self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self._ranks, special_tokens={})
        return np.array(self.fast.encode_ordinary(text), dtype=self.kind)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of all ids, gathered from one blob, some ids at a time."""
        return b"".join(self._bytes(ids[a : a + SLAB]) for a in range(0, len(ids), SLAB))

    def _bytes(self, ids: np.ndarray) -> bytes:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self._blob[np.repeat(self._first[ids] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()


class Chunk:
    """A chunk, its ids, where they begin in its bytes, and its stable places, of which each is the beginning of a token."""

    __slots__ = ("at", "data", "ids", "stable")

    def __init__(self, ids: np.ndarray, data: bytes, at: np.ndarray, stable: np.ndarray):
        self.ids, self.data, self.at, self.stable = ids, data, at, stable

    def token(self, place: int) -> int:
        """The number of the token that begins at a place."""
        return int(self.at.searchsorted(place))


def chunks_of(vocabulary: Vocabulary, ids: list[np.ndarray]) -> list[Chunk]:
    """Chunks from their ids, many at once."""
    out, begin, size = [], 0, 0
    for k, x in enumerate(ids):
        size += len(x)
        if size >= SLAB or k + 1 == len(ids):
            out += _chunks(vocabulary, ids[begin : k + 1])
            begin, size = k + 1, 0
    return out


def _chunks(vocabulary: Vocabulary, ids: list[np.ndarray]) -> list[Chunk]:
    flat = np.concatenate(ids)
    data = vocabulary.decode(flat)
    at = np.concatenate([[0], np.cumsum(vocabulary.sizes[flat])])
    b = np.frombuffer(data, np.uint8)
    space = (b == 32) | ((b >= 9) & (b <= 13) & (b != 11) & (b != 12))
    ink = (b > 32) & (b < 127)
    if (b >= 128).any():  # the last byte of a character that is no white space: no two bytes after C2, no three after E1, E2, E3
        ink[1:] |= (b[1:] >= 128) & (b[:-1] >= 0xC3) & (b[:-1] <= 0xDF)
        ink[2:] |= (b[2:] >= 128) & (b[1:-1] >= 128) & (b[:-2] >= 0xE4) & (b[:-2] <= 0xED)
    begins = np.zeros(len(b) + 1, bool)
    begins[at] = True
    stable = np.flatnonzero(space[1:] & ink[:-1] & begins[1:-1]) + 1
    tokens = np.cumsum([0, *map(len, ids)])
    ends = at[tokens]
    places = np.searchsorted(stable, ends)
    places_after = np.searchsorted(stable, ends, side="right")  # the first place of a chunk is none: what stands before it is in another
    return [
        Chunk(x, data[lo:hi], (at[t : t + len(x) + 1] - lo).astype(np.int32), (stable[p:q] - lo).astype(np.int32))
        for x, lo, hi, t, p, q in zip(ids, ends.tolist(), ends[1:].tolist(), tokens.tolist(), places_after.tolist(), places[1:].tolist(), strict=False)
    ]


def joined(vocabulary: Vocabulary, chunks: list[Chunk], repairs: dict[bytes, np.ndarray] | None = None) -> np.ndarray:
    """The ids of a text from those of its chunks. ``repairs`` keeps regions that have been encoded."""
    repairs = {} if repairs is None else repairs
    out, i, begin = [], 0, 0  # all before ``begin`` in chunk i is done
    while i + 1 < len(chunks):
        left, wide = chunks[i], 2
        first = int(left.stable.searchsorted(begin, side="right"))
        while True:
            inside = len(left.stable) - first >= wide
            a = int(left.stable[-wide]) if inside else begin
            j = i + 1
            while j < len(chunks) and len(chunks[j].stable) < wide:
                j += 1
            right = chunks[j] if j < len(chunks) else None
            c = int(right.stable[wide - 1]) if right else 0
            region = b"".join([left.data[a:], *(x.data for x in chunks[i + 1 : j]), right.data[:c] if right else b""])
            ids = repairs.get(region)
            if ids is None:
                ids = vocabulary.ids(region)
                if len(region) < 256:
                    repairs[region] = ids
            fine = True
            if inside:  # the outer word of the left chunk
                word = left.ids[left.token(a) : left.token(left.stable[1 - wide])]
                fine = ids[: len(word)].tobytes() == word.tobytes()
            if fine and right:
                word = right.ids[right.token(right.stable[wide - 2]) : right.token(c)]
                fine = ids[max(0, len(ids) - len(word)) :].tobytes() == word.tobytes()
            if fine:
                break
            wide *= 2
        out += [left.ids[left.token(begin) : left.token(a)], ids]
        if right is None:
            return np.concatenate(out)
        i, begin = j, c
    if chunks:
        out.append(chunks[i].ids[chunks[i].token(begin) :])
    return np.concatenate(out) if out else np.zeros(0, vocabulary.kind)


def _sized(parts: list[bytes]) -> bytes:
    return b"".join(len(x).to_bytes(8, "little") + x for x in parts)


def _unsized(body: bytes) -> list[bytes]:
    out, at = [], 0
    while at < len(body):
        n = int.from_bytes(body[at : at + 8], "little")
        out.append(body[at + 8 : at + 8 + n])
        at += 8 + n
    return out


def _rows(rows: list[tuple[str, int, int, bytes]]) -> pa.RecordBatch:
    kind, bucket, grp, body = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(kind), pa.array(bucket, pa.int64()), pa.array(grp, pa.int64()), pa.array(body, pa.binary())], names=["kind", "bucket", "grp", "body"])


def _held(it: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[int, Iterator[tuple[str, int, int, bytes]]]]:
    for batch in batches(it):
        for row in zip(*(batch.column(c).to_pylist() for c in ("kind", "bucket", "grp", "body")), strict=True):
            yield row[1] if key == "bucket" else row[2], row


class _Group:
    """Documents of a task: their rows without the text, their parts as numbers of distinct chunks or special tokens."""

    def __init__(self):
        self.columns: list[pa.RecordBatch] = []
        self.numbers: dict[bytes, int] = {}
        self.chunks: list[bytes] = []
        self.documents: list[np.ndarray] = []
        self.size = 0

    def add(self, vocabulary: Vocabulary, text: str) -> None:
        """A document's list: numbers of chunks; -1 - id for a special token, which ends a text."""
        out = []
        for k, part in enumerate(vocabulary.parts(text)):
            if k % 2:
                out.append(-1 - vocabulary.special[part])
                continue
            data, begin = part.encode("utf-8", "surrogatepass"), 0
            for end in cuts(data):
                chunk = data[begin:end]
                number = self.numbers.setdefault(xxhash.xxh3_128_digest(chunk), len(self.numbers))
                if number == len(self.chunks):
                    self.chunks.append(chunk)
                out.append(number)
                begin = end
            self.size += len(data)
        self.documents.append(np.array(out, "<i4"))

    def order(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The order in which the chunks are sent to n buckets, where each bucket begins in it, and the hashes."""
        hashes = np.frombuffer(b"".join(self.numbers), "<u8").reshape(-1, 2)
        bucket = (hashes[:, 0] % np.uint64(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        return order, np.searchsorted(bucket[order], np.arange(n + 1)), hashes

    def rows(self, n: int, number: int) -> Iterator[pa.RecordBatch]:
        order, ends, hashes = self.order(n)
        sizes = np.array([len(c) for c in self.chunks], np.int64)
        for b in np.flatnonzero(ends[1:] > ends[:-1]).tolist():
            mine = order[ends[b] : ends[b + 1]]
            ask = np.zeros(len(mine), _ASK)
            ask["low"], ask["high"], ask["size"] = hashes[mine, 0], hashes[mine, 1], sizes[mine]
            yield _rows([("ask", b, number, zstandard.compress(_sized([ask.tobytes(), b"".join([self.chunks[i] for i in mine.tolist()])]), TEXT_LEVEL))])
        names = pa.BufferOutputStream()
        with pa.ipc.new_stream(names, self.columns[0].schema) as writer:
            for batch in self.columns:
                writer.write_batch(batch)
        lengths = np.array([len(d) for d in self.documents], "<i8")
        body = _sized([names.getvalue().to_pybytes(), lengths.tobytes(), np.concatenate(self.documents).tobytes(), order.astype("<i4").tobytes(), ends.astype("<i8").tobytes()])
        yield _rows([("group", number % n, number, zstandard.compress(body, 1))])


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", tokenizer: tuple[str, str] | None = None, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """All columns but the text, and ``ids``: the text's ids (array of int) as the tokenizers library gives them.

    ``tokenizer``: a byte-level vocabulary file and the rank file of the same vocabulary. A null text is empty and has no ids. Every row
    stays, repeated rows and rows of null keys too; a column of the name ``ids`` is replaced. A text is held whole in one
    task, however long. An empty table gives an empty table. Groups are numbered by the partition they are read from, so the table
    must give the same rows in the same order when a lost task is run again (files do).
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = tokenizer or default_tokenizer()
    path = (*path, special_tokens(path[0]))
    keep = [f for f in docs.schema.fields if f.name not in (text, ids)]
    names = [f.name for f in keep]
    one, whole = (next(c for c in (x + "_" * k for k in range(len(names) + 1)) if c not in names) for x in ("__row", "__text"))
    total = int(docs.select(F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()[0])
    n = max(shuffle_partitions(spark), -(-total // BUCKET_BYTES))

    def group(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, number, held = Vocabulary(*path), TaskContext.get().partitionId() << 24, _Group()
        for batch in batches(it):
            texts = batch.column(whole).to_pylist()
            begin = 0
            for k, t in enumerate(texts):
                held.add(vocabulary, t or "")
                if held.size >= group_bytes or k + 1 == len(texts):
                    held.columns.append(batch.select([one, *names]).slice(begin, k + 1 - begin))
                    begin = k + 1
                if held.size >= group_bytes:
                    yield from held.rows(n, number)
                    number, held = number + 1, _Group()
        if held.documents:
            yield from held.rows(n, number)

    def encode_chunks(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, now, known = Vocabulary(*path), None, {}
        for bucket, (kind, _, grp, body) in _held(it, "bucket"):
            if kind == "group":
                yield _rows([(kind, bucket, grp, body)])
                continue
            if bucket != now:
                now, known = bucket, {}
            asks, data = _unsized(zstandard.decompress(body))
            begin, given = 0, []
            for low, high, size in np.frombuffer(asks, _ASK).tolist():
                if (low, high) not in known:
                    known[low, high] = vocabulary.ids(data[begin : begin + size])
                given.append(known[low, high])
                begin += size
            sizes = np.array([len(g) for g in given], "<u4").tobytes()
            yield _rows([("answer", bucket, grp, zstandard.compress(_sized([sizes, np.concatenate(given).tobytes()]), IDS_LEVEL))])

    def assemble(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(*path)

        def made(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
            body = next(b for kind, _, _, b in rows if kind == "group")
            table_, lengths, documents, order, ends = _unsized(zstandard.decompress(body))
            lengths, order, ends = np.frombuffer(lengths, "<i8"), np.frombuffer(order, "<i4"), np.frombuffer(ends, "<i8")
            chunk_ids: list = [None] * len(order)
            for kind, b, _, body in rows:
                if kind == "answer":
                    sizes, flat = _unsized(zstandard.decompress(body))
                    flat = np.frombuffer(flat, vocabulary.kind)
                    for c, part in zip(order[ends[b] : ends[b + 1]].tolist(), np.split(flat, np.cumsum(np.frombuffer(sizes, "<u4"))[:-1]), strict=True):
                        chunk_ids[c] = part
            columns = pa.ipc.open_stream(table_).read_all().combine_chunks()
            documents, repairs = np.frombuffer(documents, "<i4"), {}
            chunks_ = chunks_of(vocabulary, chunk_ids)
            out, size, first, at = [], 0, 0, 0
            for k, m in enumerate(lengths.tolist()):
                parts, chunks = [], []
                for c in documents[at : at + m].tolist():
                    if c < 0:
                        parts += [joined(vocabulary, chunks, repairs), np.array([-1 - c], vocabulary.kind)]
                        chunks = []
                    else:
                        chunks.append(chunks_[c])
                at += m
                parts.append(joined(vocabulary, chunks, repairs))
                out.append(np.concatenate(parts).astype(np.int32))
                size += len(out[-1])
                if len(repairs) > 100_000:
                    repairs.clear()
                if size >= 1 << 20 or k + 1 == len(lengths):
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in out])])
                    array = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(out), pa.int32()))
                    rows_ = columns.slice(first, len(out)).combine_chunks()
                    yield pa.RecordBatch.from_arrays([*(rows_.column(c).combine_chunks() if rows_.column(c).num_chunks != 1 else rows_.column(c).chunk(0) for c in names), array], names=[*names, ids])
                    out, size, first = [], 0, k + 1

        now, held = None, []
        for grp, row in _held(it, "grp"):
            if held and grp != now:
                yield from made(held)
                held = []
            now = grp
            held.append(row)
        if held:
            yield from made(held)

    rows = docs.select(F.lit(0).alias(one), *names, F.col(text).alias(whole)).mapInArrow(group, ROWS)
    answers = rows.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(encode_chunks, ROWS)
    answers = answers.repartition(shuffle_partitions(spark), "grp").sortWithinPartitions("grp")
    return answers.mapInArrow(assemble, T.StructType([*keep, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(encoded: DataFrame, ids: str = "ids", text: str = "text", tokenizer: tuple[str, str] | None = None) -> DataFrame:
    """All columns, and ``text``: what the ids stand for, special tokens too, as the library's decoding gives it; bytes that are no
    UTF-8 become U+FFFD. Null ids give a null text; ids that the vocabulary does not have, and null ids in a list, are passed over. A column of the
    name ``text`` is replaced."""
    path = tokenizer or default_tokenizer()
    path = (*path, special_tokens(path[0]))
    keep = [f for f in encoded.schema.fields if f.name != text]
    names = [f.name for f in keep]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(*path)
        size = len(vocabulary.bytes)
        for batch in batches(it):
            texts = []
            for x in batch.column(ids):
                if not x.is_valid:
                    texts.append(None)
                    continue
                a = x.values.drop_null().to_numpy()
                texts.append(vocabulary.decode(a[(a >= 0) & (a < size)]).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(texts, pa.string())], names=[*names, text])

    return encoded.select(*names).mapInArrow(run, T.StructType([*keep, T.StructField(text, T.StringType())]))


def digests(encoded: DataFrame, ids: str = "ids", tokenizer: tuple[str, str] | None = None) -> DataFrame:
    """All columns but the ids, and ``n_tokens``, ``ids_sha256`` (of the ids as little-endian unsigned 32-bit numbers) and ``decoded_sha256``
    (of what ``decode`` makes of them, in UTF-8). Null ids have no digests."""
    path = tokenizer or default_tokenizer()
    path = (*path, special_tokens(path[0]))
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    keep = [f for f in encoded.schema.fields if f.name not in (ids, *(f.name for f in added))]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(*path)
        for batch in batches(it):
            found = []
            for x in batch.column(ids):
                if not x.is_valid:
                    found.append((None, None, None))
                    continue
                a = x.values.to_numpy()
                text = vocabulary.decode(a).decode("utf-8", "replace").encode("utf-8")
                found.append((len(a), hashlib.sha256(np.ascontiguousarray(a, dtype="<u4")).hexdigest(), hashlib.sha256(text).hexdigest()))
            n, of_ids, of_text = zip(*found, strict=True)
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in keep), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=[f.name for f in [*keep, *added]])

    return encoded.mapInArrow(run, T.StructType([*keep, *added]))


def op13_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(encode(table(spark, sf_dir, "documents").select("doc_id", "text")))
