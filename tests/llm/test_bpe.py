"""Encoding by reused chunks against the library on whole texts, and exact round trips."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from barpath.llm import bpe
from barpath.llm.packing import default_tokenizer

SCHEMA = "doc_id long, text string, ids string, __row int, n_tokens string, __text int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer()[0])


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(*default_tokenizer())


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh'strdmvl0129.,-éßЖ日本語　 \xa0👍") for _ in range(rng.randint(1, 9)))
    prose = lambda n: "".join(word() + rng.choice([" ", " ", " ", "  ", "\n", "\n\n ", "\t", "'s ", "", "\r\n"]) for _ in range(n))
    shared = prose(900)
    out = [None, "", " ", "a", "<|endoftext|>", "x <|endoftext|><|endoftext|> y", "<|endoftext", "|>", prose(5)]
    out += [prose(rng.randint(1, 60)) + shared + prose(rng.randint(1, 60)) for _ in range(12)] + [shared, shared, shared.upper()]
    out += ["日本語" * 6000, "a" * 30_000, " " * 9000, "x" + " \n" * 5000 + "y", "don't " * 5000, prose(400) + "<|endoftext|>" + prose(400) + " <|endoftext|>", "é" * 9001, "👍🏽" * 4000]
    return out + [prose(rng.randint(100, 1500)) for _ in range(40)]


def test_cuts(texts):
    for t in texts:
        data = (t or "").encode()
        ends = bpe.cuts(data)
        sizes = np.diff([0, *ends])
        assert (ends[-1] if data else 0) == len(data) and (sizes <= bpe.MOST).all() and (sizes[:-1] >= bpe.LEAST - 3).all()
        assert all(data[a:b].decode() is not None for a, b in zip([0, *ends], ends, strict=False))
    rng = random.Random(6)
    shared = "".join(rng.choice("abc de") for _ in range(40_000)).encode()
    pieces = lambda d: {d[a:b] for a, b in zip([0, *bpe.cuts(d)], bpe.cuts(d), strict=False)}
    a, b = pieces(b"some words before " + shared), pieces(b"x" * 777 + shared)
    assert len(a & b) >= len(a) - 3  # the same chunks wherever the passage stands


@pytest.mark.parametrize("size", [1, 7, 64, 1000])
def test_joins(vocabulary, library, texts, size):
    """Chunks cut anywhere, not only where the hash says so."""
    for t in texts[6:30]:
        if not t or "<|endoftext|>" in t:
            continue
        t = t[: 3000 * size]
        chunks = bpe.chunks_of(vocabulary, [vocabulary.ids(t[a : a + size].encode()) for a in range(0, len(t), size)])
        assert bpe.joined(vocabulary, chunks).tolist() == library.encode(t, add_special_tokens=False).ids


def test_a_region_that_does_not_agree_is_widened(vocabulary, library):
    t = "one two three four five six seven eight nine ten eleven twelve"
    a, b = bpe.chunks_of(vocabulary, [vocabulary.ids(x.encode()) for x in (t[:30], t[30:])])
    wrong = a.token(a.stable[-2])
    a.ids = a.ids.copy()
    a.ids[wrong] += 1  # as if the outer word had been encoded in another way
    whole = bpe.joined(vocabulary, [a, b]).tolist()
    assert whole == library.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("group_bytes", [1 << 15, 1 << 24])
def test_encode_and_decode(spark, library, texts, group_bytes):
    rows = [(None if i == 3 else i // 2, t, "clash", i, "x", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    encoded = bpe.encode(df, group_bytes=group_bytes)
    assert encoded.columns == ["doc_id", "__row", "n_tokens", "__text", "ids"]
    got = {r["__row"]: r for r in bpe.decode(encoded).collect()}
    assert len(got) == len(texts) and got[3].doc_id is None and got[5].n_tokens == "x"
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[i].ids == ids
        assert got[i].text == (t or "") == library.decode(ids, skip_special_tokens=False)


def test_decode_alone(spark, library):
    ids = [[], [198, 50256, 11], [159, 240], [447, 119, 119], None, [3, None, -5, 99999, 4]]
    got = {r.k: r.text for r in bpe.decode(spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "k int, ids array<int>")).collect()}
    for i, x in enumerate(ids[:4]):
        assert got[i] == library.decode(x, skip_special_tokens=False)
    assert got[4] is None and got[5] == library.decode([3, 4], skip_special_tokens=False)


def test_empty(spark):
    assert bpe.encode(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark, sf, library):
    rows = bpe.op13_bpe(spark, sf).collect()
    source = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(source)
    for r in rows:
        ids = library.encode(source[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
