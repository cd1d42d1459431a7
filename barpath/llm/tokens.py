"""Operator 10, token counts: overlap resynchronisation for huge documents.

Ordinary documents are encoded whole. A huge one is dealt to many tasks as overlapping chunks; each is encoded with the
places of its tokens, and neighbours are spliced at a boundary that the overlap proves stable: a space after another
character, where the tokens of both neighbours begin. No piece of the vocabulary goes over such a place, so what stands left
of it never changes the tokens right of it. An overlap is widened until it holds one, to the whole rest of the document if
need be; chunks that do not align are encoded again with wider overlaps, in the end as one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barpath.llm.common import batches, small_batches, table
from barpath.session import materialise

#: Characters beyond which a document is cut, of a chunk, and of an overlap at first.
HUGE = 1 << 16
CHUNK = 1 << 15
OVERLAP = 256
_STABLE = re.compile(r"(?<=[^ ▁]) ")
_MARK = "▁"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Counter:
    """Token counts of one sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def count(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.model.encode(texts, num_threads=1)] if texts else []

    def starts(self, text: str) -> list[int]:
        """Where the tokens of ``text`` begin, in bytes of UTF-8; byte tokens of one character begin together."""
        proto = self.model.encode(text, return_type="proto", num_threads=1)
        return [p.begin for p in proto.pieces]


def cuts(text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> list[tuple[int, int]]:
    """(begin, end) of the overlapping chunks of a text. Each overlap holds a stable boundary; widened until it does."""
    out, begin = [], 0
    while True:
        over = begin + chunk
        if over >= len(text):
            return [*out, (begin, len(text))]
        width = overlap
        while over + width < len(text) and not _STABLE.search(text, over + 1, over + width):
            width *= 2
        if over + width >= len(text):
            return [*out, (begin, len(text))]
        out.append((begin, over + width))
        begin = over


def spliced(counter: Counter, part: str, left: bool, right: int) -> int | None:
    """Tokens of a chunk between its splices. ``left``: it begins in an overlap with the one before; ``right``: where the
    overlap with the next one begins, or -1. None if a splice is not between two tokens: then the overlap proves nothing.

    A chunk that begins in an overlap begins anywhere in a word. The library puts a space before every text, so the
    tokens up to the first stable boundary may be others than in the document; none of them counts.
    """
    starts = counter.starts(part)
    a = len(part[: _STABLE.search(part, 1).start()].encode("utf-8")) if left else 0
    b = len(part[: _STABLE.search(part, right + 1).start() if right >= 0 else None].encode("utf-8"))
    if (left and a not in starts) or (right >= 0 and b not in starts):
        return None
    return sum(a <= s < b for s in starts) if right >= 0 else sum(a <= s for s in starts)


def count_tokens(docs: DataFrame, text: str = "text", model: str | None = None, huge: int = HUGE, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """All columns but the text, ``n_bytes`` (UTF-8) and ``n_tokens`` as the library gives them for the whole text.

    Null counts as empty: no bytes, no tokens. Every row stays, repeated rows and rows of no or equal keys too. Columns of the
    names added are replaced. Texts over ``huge`` characters are written to the shared folder once, with a number for each, so
    that both uses of them see the same numbers whatever the input is. Those of which two chunks do not splice are counted
    again with an overlap eight times as wide, and then whole.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = model or default_model()
    keep = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name not in (text, "n_bytes", "n_tokens")]
    names = [f.name for f in docs.schema.fields if f.name not in (text, "n_bytes", "n_tokens")]
    rows = docs.select(*names, F.coalesce(text, F.lit("")).alias("__text"))

    def whole(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches(it):
            texts = batch.column("__text").to_pylist()
            columns = {n: batch.column(n) for n in names}
            columns["n_bytes"] = pa.array([len(t.encode("utf-8")) for t in texts], pa.int64())
            columns["n_tokens"] = pa.array(counter.count(texts), pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    schema = ", ".join([*keep, "n_bytes long, n_tokens long"])
    short = rows.where(F.length("__text") <= huge).mapInArrow(whole, schema)
    long = rows.where(F.length("__text") > huge)
    if long.isEmpty():
        return short
    long = materialise(long.withColumn("__row", F.monotonically_increasing_id()), "huge")

    def deal(width: int):
        def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches(it):
                for row, t in zip(batch.column("__row").to_pylist(), batch.column("__text").to_pylist(), strict=True):
                    parts = cuts(t, chunk, width)
                    for k, (a, b) in enumerate(parts):
                        right = parts[k + 1][0] - a if k + 1 < len(parts) else -1
                        # bytes are counted up to where the next chunk begins
                        size = len(t[a : a + right if right >= 0 else b].encode("utf-8"))
                        yield pa.RecordBatch.from_pydict({"__row": [row], "k": [k], "right": [right], "size": [size], "part": [t[a:b]]})

        return run

    def encode(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches(it):
            n = [spliced(counter, p, k > 0, r) for k, r, p in zip(*(batch.column(c).to_pylist() for c in ("k", "right", "part")), strict=True)]
            yield pa.RecordBatch.from_pydict({"__row": batch.column("__row"), "size": batch.column("size"), "n": pa.array(n, pa.int64())})

    def chunked(left: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
        parts = left.select("__row", "__text").mapInArrow(deal(width), "__row long, k long, right long, size long, part string")
        counts = parts.repartition(F.xxhash64("__row", "k")).mapInArrow(encode, "__row long, size long, n long")
        sums = counts.groupBy("__row").agg(F.sum("size").alias("n_bytes"), F.sum("n").alias("n_tokens"), F.max(F.col("n").isNull()).alias("__failed"))
        sums = materialise(sums, "spliced")
        return left.select(*names, "__row").join(sums.where("not __failed").drop("__failed"), "__row").select(*names, "n_bytes", "n_tokens"), sums.where("__failed").select("__row")

    done, failed = chunked(long, overlap)
    out = short.unionByName(done)
    if not failed.isEmpty():
        again = long.join(failed, "__row", "left_semi")
        done, failed = chunked(again, 8 * overlap)
        out = out.unionByName(done).unionByName(again.join(failed, "__row", "left_semi").drop("__row").mapInArrow(whole, schema))
    return out


def op10_tokens(spark, sf_dir: str) -> DataFrame:
    counts = count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))
