"""Block-Max WAND against every document's score, and against the SQL beside it."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from barpath.llm import search

DOCS = "doc_id long, text string, rank string, score string, term int"
ITEMS = "item_id long, text string, query string, key string"
SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(t):
    return SPLIT.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def plain(docs, items, top=50):
    """Sorted (item, rank, doc, score)."""
    held = [(k, Counter(w), len(w)) for k, t in docs if (w := words(t))]
    n, length = len(held), sum(h[2] for h in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        found = []
        for k, c, size in held:
            m = 100 - 50 + (50 * size * n) // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(words(text)) if c[t])
            if score > 0:
                found.append((-score, k is None, k or 0))
        out += [(item, r, None if null else k, -s) for r, (s, null, k) in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def got(index, items, **more):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in search.search(index, items, **more).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    vocabulary = [a + b for a in ("Th", "on", "É", "er", "9", "ſ", "日") for b in ("e", "ing", "x", "ß", "K")]
    pick = lambda n: " ".join(rng.choice(vocabulary[: rng.choice([4, 12, 35])]) for _ in range(n))
    texts = [None, "", " .,-\x00\t", "the", "THE the, The!", "the " * 700, pick(5000), *(pick(rng.randint(1, 40)) for _ in range(900))]
    texts += texts[10:40] + ["common " + t for t in texts[40:400]]
    keys = rng.sample(range(-2000, 5000), len(texts))
    keys[20:24] = [None, None, keys[30], keys[30]]
    return list(zip(keys, texts, strict=True))


@pytest.mark.parametrize("shard_terms", [200, 3000, 1 << 21])
def test_search(spark, corpus, shard_terms):
    docs = spark.createDataFrame([(k, t, "clash", "x", 1) for k, t in corpus], DOCS).coalesce(2)
    items = [(1, "the ering nothing"), (2, None), (3, "..."), (4, "absent"), (5, "common Thx common"), (6, corpus[50][1]), (7, "9K 日ß éing Éing"), (None, "onx"), (9, "the"), (10, " ".join(t or "" for _, t in corpus[:60]))]
    index = search.build_index(docs, shard_terms=shard_terms)
    df = spark.createDataFrame([(i, t, "clash", "y") for i, t in items], ITEMS)
    assert got(index, df) == plain(corpus, items)
    assert got(index, df.where("item_id < 7"), top=3) == plain(corpus, items[:6], 3)
    assert index.frequencies().where("term = 'common'").first().df == sum("common" in words(t) for _, t in corpus)


def test_rounds_and_repeated_items(spark, corpus, monkeypatch):
    monkeypatch.setattr(search, "QUERIES", 2)
    docs = spark.createDataFrame([(k, t, "clash", "x", 1) for k, t in corpus], DOCS)
    items = [(5, "the onx"), (5, "the onx"), (6, "ering"), (7, "éing"), (8, "9x")]
    rows = got(search.build_index(docs), spark.createDataFrame([(i, t, "c", "y") for i, t in items], ITEMS))
    strip = lambda rows: sorted(rows, key=str)
    assert strip(rows) == strip(plain(corpus, items))


def test_empty(spark):
    docs = spark.createDataFrame([(1, None, "", "", 1), (2, "", "", "", 1)], DOCS)
    items = spark.createDataFrame([(1, "the", "", "")], ITEMS)
    assert search.search(search.build_index(docs), items).count() == 0
    assert search.search(search.build_index(docs.limit(0)), items).count() == 0
    assert search.search(search.build_index(docs), items.limit(0)).count() == 0
    one = search.build_index(spark.createDataFrame([(7, "the end", "", "", 1)], DOCS))
    assert got(one, items) == plain([(7, "the end")], [(1, "the")])


def test_blocks():
    rng = np.random.default_rng(3)
    counts = rng.integers(1, 129, 200)
    widths = rng.integers(1, 33, 200).astype(np.uint8)
    values = np.concatenate([rng.integers(0, 1 << int(w), c) for c, w in zip(counts, widths, strict=True)])
    body, at = search.pack(values, counts, widths)
    assert len(body) == at[-1] and (search.unpack(body, counts, widths) == values).all()
    assert search.bits(np.array([0, 1, 2, 3, 4, 255, 256, (1 << 32) - 1])).tolist() == [1, 1, 2, 2, 3, 8, 9, 32]


def test_blocks_are_skipped(monkeypatch):
    """A list that no document above the threshold stands in is never unpacked whole."""
    rng = random.Random(5)
    texts = ["rare word"] * 60 + ["word " + " ".join(rng.choice("abcdefgh") for _ in range(30)) for _ in range(5000)]
    vocabulary: dict = {}
    held = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in search.words(t)], np.int32) for t in texts]
    length = sum(map(len, held))
    batch = search._shard(0, list(range(len(texts))), held, vocabulary, len(texts), length)
    rows = [list(r.values())[1:] for r in batch.to_pylist()]
    shard = search.Shard(rows)
    df = {r[0]: r[1] for r in rows}
    best = shard.search([(t, search.weight(len(texts), df[t])) for t in ("rare", "word")], [], 50)
    assert [b[2] for b in best] == list(range(50))
    assert 0 < shard.unpacked < sum(len(h) for t, h in shard.heads.items() if t in ("rare", "word")) / 2


def test_query_and_sql(spark, sf):
    rows = sorted((r.item_id, r["rank"], r.doc_id, r.score) for r in search.op11_search(spark, sf).collect())
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert rows == sorted(con.execute(search.oracle_sql()).fetchall())
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert rows == plain(docs, items)
